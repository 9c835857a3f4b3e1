"""Rating tables: latest value per pair, averages, histograms, look-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.scores import shown_average, star_band
from starloom.sources.workspace import Workspace

PAIR = ["user", "item"]
STARS = (1, 2, 3, 4, 5)


def latest_per_pair(events: DataFrame, *newest: str) -> DataFrame:
    """The newest rating of every (user, item); ``newest`` are the ordering
    columns, most significant first.

    The planner sees the limit of one row per pair and applies it before the
    shuffle: a pair rated a billion times leaves each map task as one row.
    """
    w = Window.partitionBy(*PAIR).orderBy(*[F.desc(c) for c in newest])
    return events.withColumn("_place", F.row_number().over(w)).where("_place = 1").drop("_place")


def upsert(stored: DataFrame, incoming: DataFrame, *newest: str) -> DataFrame:
    """Insert or update by (user, item); the newest row wins, so a late row
    never replaces a newer stored one."""
    return latest_per_pair(stored.unionByName(incoming), *newest)


def append(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    return stored.unionByName(incoming)


def rated_pairs(ratings: DataFrame, keys: DataFrame) -> DataFrame:
    """Ratings of the (user, item) pairs in ``keys``; both columns must match."""
    return ratings.join(keys.select(*PAIR).distinct(), PAIR, "left_semi")


def by_id(table: DataFrame, column: str, value) -> DataFrame:
    return table.where(F.col(column) == F.lit(value))


def item_averages(ratings: DataFrame, key: str = "item") -> DataFrame:
    return ratings.groupBy(key).agg(
        F.count("rating").alias("n_ratings"), F.avg("rating").alias("avg_rating")
    )


def top_rated(ratings: DataFrame, items: DataFrame, more_than: int = 150, n: int = 12) -> DataFrame:
    """The ``n`` best averages among items with more than ``more_than``
    ratings, joined to their item rows in rank order."""
    best = (
        item_averages(ratings)
        .where(F.col("n_ratings") > more_than)
        .orderBy(F.desc("avg_rating"), "item")
        .limit(n)
    )
    # ``best`` has n rows whatever the input size, so sending it to every task is safe.
    return (
        items.join(F.broadcast(best), "item")
        .orderBy(F.desc("avg_rating"), "item")
    )


def _star_count(star: int) -> tuple[Column, Column]:
    rating = F.col("rating")
    return F.count_if(rating == star - 0.5), F.count_if(rating == float(star))


def star_counts(ratings: DataFrame) -> DataFrame:
    """One row per item: votes, and the half/full count of each of five stars.
    Values off the half-star grid count as votes only."""
    cells = []
    for star in STARS:
        half, full = _star_count(star)
        cells += [half.alias(f"half_{star}"), full.alias(f"full_{star}")]
    return ratings.groupBy("item").agg(F.count("rating").alias("votes"), *cells)


def star_ratio(star: int) -> Column:
    """Share of one star in percent: the half and the full step are rounded
    separately and added, as the displayed figure is defined."""
    votes = F.col("votes")
    return F.round(F.col(f"half_{star}") * 100.0 / votes, 2) + F.round(
        F.col(f"full_{star}") * 100.0 / votes, 2
    )


def star_histogram(ratings: DataFrame) -> DataFrame:
    """Five rows per item: star, ratio in percent, count and votes in total."""
    bars = F.array(
        *[
            F.struct(
                F.lit(star).cast("bigint").alias("star"),
                star_ratio(star).alias("ratio"),
                (F.col(f"half_{star}") + F.col(f"full_{star}")).alias("n"),
            )
            for star in STARS
        ]
    )
    return star_counts(ratings).select("item", "votes", F.inline(bars))


def item_profiles(items: DataFrame, ratings: DataFrame) -> DataFrame:
    """Every item with its average, star band and star counts. Items without
    ratings keep a null average and zero counts."""
    rating = F.col("rating")
    stats = ratings.groupBy("item").agg(
        F.count("rating").alias("votes"),
        F.avg("rating").alias("average"),
        *[F.count_if(rating.isin(s - 0.5, float(s))).alias(f"stars_{s}") for s in STARS],
    )
    counts = ["votes"] + [f"stars_{s}" for s in STARS]
    return (
        items.join(stats, "item", "left")
        .na.fill(0, counts)
        .withColumn("shown", shown_average(F.col("average")))
        .withColumn("band", star_band(F.col("average")))
    )


def rating_stats(ratings: DataFrame) -> DataFrame:
    """One row: counts, distinct users and items, mean and the largest ids.

    Distinct counts come from per-user and per-item aggregates, which combine
    map-side, rather than from a distinct aggregate over expanded rows.
    """
    users = ratings.groupBy("user").agg(F.count("*").alias("n"), F.sum("rating").alias("s"))
    items = ratings.groupBy("item").agg(F.count("*").alias("n"))
    by_user = users.agg(
        F.sum("n").alias("n_ratings"),
        F.count("*").alias("n_users"),
        (F.sum("s") / F.sum("n")).alias("mean_rating"),
        F.max("user").alias("max_user"),
        F.max("n").alias("most_by_user"),
    )
    by_item = items.agg(
        F.count("*").alias("n_items"),
        F.max("item").alias("max_item"),
        F.max("n").alias("most_by_item"),
    )
    # Two one-row tables side by side.
    return by_user.withColumn("one", F.lit(1)).join(by_item.withColumn("one", F.lit(1)), "one").drop("one")


def distinct_counts(ratings: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct users and items, exact or by a sketch of fixed size."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return ratings.agg(count("user").alias("n_users"), count("item").alias("n_items"))


def degrees(ratings: DataFrame, key: str) -> DataFrame:
    return ratings.groupBy(key).agg(F.count("*").alias("n"))


def rated_by(ratings: DataFrame, key: str, keys: DataFrame, work: Workspace) -> DataFrame:
    """Ratings of the users (or items) in a key table, one row per rating."""
    wanted = work.write(keys.select(key).distinct(), f"wanted-{key}")
    return ratings.join(wanted, key, "left_semi")
