"""Approximate title search by edit distance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.blocks import rank_within
from starloom.sources.workspace import Workspace

# Cutoff and number of matches of the title search.
CUTOFF = 0.6
MATCHES = 3
# Strings longer than this that are within the cutoff always share a bigram.
SHORT = 5


def grams(title: Column) -> Column:
    """Bigrams; for short titles also single characters. Repeats are numbered,
    so that the grams two titles share can be counted as a set. Any two titles
    within the cutoff have at least one in common."""
    n = F.length(title)

    def pieces(width: int, mark: str) -> Column:
        places = F.sequence(F.lit(1), F.greatest(n - width + 1, F.lit(1)))
        return F.transform(places, lambda p: F.concat(F.lit(mark), F.substr(title, p, F.lit(width))))

    both = F.when(n <= SHORT, F.concat(pieces(2, ""), pieces(1, "="))).otherwise(pieces(2, ""))
    return F.transform(
        both,
        lambda g, at: F.concat(g, F.lit("#"), F.size(F.filter(F.slice(both, F.lit(1), at + 1), lambda x: x == g)).cast("string")),
    )


def shared_at_least(title: Column, cutoff: float) -> Column:
    """How many grams any title within the cutoff shares with this one: an edit
    destroys two bigrams, and at most (1 - cutoff) of the longer title is edited."""
    return F.greatest(F.ceil((2 * cutoff - 1) * F.length(title) - 1 - 1e-9), F.lit(1)).cast("int")


def telling_grams(titles: DataFrame, frequency: DataFrame, cutoff: float) -> DataFrame:
    """(title, grams): the rarest grams of each title. If two titles share s
    grams, they meet among all but the s - 1 most frequent of each, so the
    grams most titles have are left out and none is missed."""
    each = titles.select("title", F.explode(grams(F.col("title"))).alias("gram")).join(frequency, "gram", "left")
    known = F.struct(F.coalesce("df", F.lit(0)).alias("df"), "gram")
    ordered = each.groupBy("title").agg(F.sort_array(F.collect_list(known)).alias("g"))
    kept = F.size("g") - shared_at_least(F.col("title"), cutoff) + 1
    return ordered.select("title", F.slice(F.col("g.gram"), F.lit(1), F.greatest(kept, F.lit(1))).alias("grams"))


def similarity(a: Column, b: Column) -> Column:
    return F.lit(1.0) - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b))


def close_titles(
    wanted: DataFrame, titles: DataFrame, work: Workspace, n: int = MATCHES, cutoff: float = CUTOFF
) -> DataFrame:
    """Up to n known titles for every wanted one, best first:
    (wanted, title, score, rank). Both inputs have one column ``title``.

    Pairs meet on a shared telling gram. The length band and the distance are
    tested inside the join, and only at the smallest gram two titles share, so
    a pair leaves the join at most once and a failing pair never does.
    """
    if cutoff < CUTOFF:
        raise ValueError(f"shared grams are only certain for a cutoff of at least {CUTOFF}")
    known = work.write(titles.select("title").distinct(), "titles")
    asked = work.write(wanted.select("title").distinct(), "wanted")
    counted = known.select(F.explode(grams(F.col("title"))).alias("gram")).groupBy("gram").agg(F.count("*").alias("df"))
    frequency = work.write(counted, "grams")
    left = work.write(telling_grams(asked, frequency, cutoff).select(F.col("title").alias("wanted"), F.col("grams").alias("a")), "asked")
    right = work.write(telling_grams(known, frequency, cutoff).select("title", F.col("grams").alias("b")), "known")
    left = left.withColumn("gram", F.explode("a"))
    right = right.withColumn("gram", F.explode("b"))
    longer = F.greatest(F.length("wanted"), F.length("title"))
    shorter = F.least(F.length("wanted"), F.length("title"))
    smallest = F.array_min(F.array_intersect("a", "b"))
    score = F.round(similarity(F.col("wanted"), F.col("title")), 6)
    condition = (
        (left["gram"] == right["gram"])
        & (shorter >= F.lit(cutoff) * longer)
        & (left["gram"] == smallest)
        & (score >= cutoff)
    )
    close = left.join(right, condition).select("wanted", "title", score.alias("score"))
    return rank_within(close, "wanted", "score", "title", n)


def similar_to_titles(wanted: DataFrame, items: DataFrame, similar: DataFrame, work: Workspace) -> DataFrame:
    """Similar items of the best-matching title of every wanted one. Among
    items of that title the smallest id stands for it."""
    best = close_titles(wanted, items.select("title"), work, n=1).select("wanted", "title")
    chosen = items.groupBy("title").agg(F.min("item").alias("id"))
    return best.join(chosen, "title").join(similar, "id").select("wanted", "title", "id", "other", "score", "rank")
