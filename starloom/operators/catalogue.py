"""Item metadata, attribute bridges and user lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.text import join_list, split_list, user_name, year_of
from starloom.operators.index import with_index
from starloom.sources.workspace import Workspace


def first_items(items: DataFrame, n: int = 12) -> DataFrame:
    return items.orderBy("item").limit(n)


def newest_items(items: DataFrame, n: int = 12, date: str = "release_date") -> DataFrame:
    """Latest release dates first. Dates are text; '' and 'None' mean unknown."""
    known = ~F.col(date).isin("None", "")
    return items.where(known).orderBy(F.desc(date), "item").limit(n)


def items_of_genre(items: DataFrame, genre: str, n: int | None = 12, exact: bool = False) -> DataFrame:
    """Items whose genre list contains the text, or has it as an exact member."""
    genres = F.col("genres")
    hit = F.array_contains(split_list(genres), genre) if exact else genres.contains(genre)
    found = items.where(hit)
    return found if n is None else found.orderBy("item").limit(n)


def bridge(items: DataFrame, attribute: str, name: str) -> DataFrame:
    """One row per item and value of a delimited attribute; items without the
    attribute have no rows."""
    return items.select("item", F.explode(split_list(F.col(attribute))).alias(name))


def movies_with_links(movies: DataFrame, links: DataFrame) -> DataFrame:
    """Inner join on the item; a clashing column of the links gets a suffix."""
    clashing = [c for c in links.columns if c in movies.columns and c != "item"]
    return movies.join(links.withColumnsRenamed({c: f"{c}_2" for c in clashing}), "item")


def without_genres(movies: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Movies with links but without the genre list, and the genre bridge."""
    linked = movies_with_links(movies, links)
    return linked.drop("genres"), bridge(linked, "genres", "genre")


def _record(table: DataFrame, name: str) -> DataFrame:
    fields = [c for c in table.columns if c != "item"]
    return table.select("item", F.struct(*fields).alias(name))


def _text(field: Column) -> Column:
    return F.coalesce(field, F.lit(""))


def wide_items(movies: DataFrame, links: DataFrame, primary: DataFrame, fallback: DataFrame) -> DataFrame:
    """Movies, links and metadata in one table.

    Metadata comes from the primary source where it knows the item; otherwise
    the *whole* record comes from the fallback source, fields are never mixed.
    Missing fields become empty text, lists become delimited text.
    """
    linked = movies_with_links(movies, links)
    both = linked.join(_record(primary, "p"), "item", "left").join(_record(fallback, "f"), "item", "left")
    record = F.when(F.col("p").isNotNull(), F.col("p")).otherwise(F.col("f"))
    return both.withColumn("m", record).select(
        *linked.columns,
        _text(F.col("m.plot")).alias("plot_summary"),
        _text(F.col("m.release_date")).alias("release_date"),
        year_of(_text(F.col("m.release_date"))).alias("release_year"),
        _text(F.col("m.poster")).alias("poster_path"),
        _text(F.col("m.mpaa")).alias("mpaa"),
        _text(join_list(F.col("m.directors"))).alias("directors"),
        _text(join_list(F.col("m.actors"))).alias("actors"),
    )


def user_list(*activity: DataFrame) -> DataFrame:
    """Everybody who appears in any of the activity tables, with a name.
    Each table is reduced to distinct users before the union."""
    users = activity[0].select("user").distinct()
    for table in activity[1:]:
        users = users.union(table.select("user").distinct())
    return users.distinct().withColumn("username", user_name(F.col("user")))


def users_matched(ratings: DataFrame, tags: DataFrame) -> DataFrame:
    """Full outer match of rating users and tag users, with a flag per side."""
    left = ratings.select("user").distinct().withColumn("rated", F.lit(True))
    right = tags.select("user").distinct().withColumn("tagged", F.lit(True))
    return left.join(right, "user", "full").na.fill(False, ["rated", "tagged"])


def number_new_users(users: DataFrame, new_names: DataFrame, work: Workspace) -> DataFrame:
    """Give new user names the ids after the largest existing one, in name order."""
    numbered, _ = with_index(new_names.select("username"), ["username"], work, "new-users", start=1)
    top = users.agg(F.coalesce(F.max("user"), F.lit(0)).alias("top")).first()["top"]
    return numbered.select((F.col("idx") + F.lit(top)).alias("user"), "username")
