"""Factor tables: start values, error measures and the block layout of ids.

A factor table has one row per id: ``(user|item BIGINT, f ARRAY<DOUBLE>)``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import accumulate
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.hashing import unit_vector
from starloom.functions.vectors import UNROLL_LIMIT, dot, squared_error, squared_norm

# Start range of the implicit model, and the hash prefix per side.
IMPLICIT_LOW = 0.000610352
IMPLICIT_HIGH = IMPLICIT_LOW * 10
PREFIX = {"user": "u", "item": "i"}


def start_factors(ratings: DataFrame, key: str, rank: int, low: float = 0.0, high: float = 1.0) -> DataFrame:
    """One uniform start vector per distinct id, fixed by the id."""
    ids = ratings.select(key).distinct()
    return ids.select(key, unit_vector(PREFIX[key], F.col(key), rank, low, high).alias("f"))


def implicit_start_factors(ratings: DataFrame, key: str, rank: int) -> DataFrame:
    return start_factors(ratings, key, rank, IMPLICIT_LOW, IMPLICIT_HIGH)


def scaled_start_factors(ratings: DataFrame, key: str, rank: int) -> DataFrame:
    """Start vectors times ``sqrt(mean rating / rank)``, so that first
    predictions land near the mean."""
    mean = ratings.agg(F.avg("rating").alias("mean")).first()["mean"] or 0.0
    scale = (mean / rank) ** 0.5
    return start_factors(ratings, key, rank).withColumn("f", F.transform("f", lambda x: x * F.lit(scale)))


def with_missing(factors: DataFrame, ids: DataFrame, key: str, rank: int) -> DataFrame:
    """Factors for every id in ``ids``; ids without a vector get a start vector."""
    fresh = unit_vector(PREFIX[key], F.col(key), rank)
    return ids.select(key).distinct().join(factors, key, "left").withColumn("f", F.coalesce("f", fresh))


def with_both(ratings: DataFrame, users: DataFrame, items: DataFrame, last: str = "item") -> DataFrame:
    """Ratings with the user vector ``w`` and the item vector ``h``.

    No hints: factor tables are stored tables, so the planner knows their size
    and broadcasts them only while they are small. ``last`` names the key of
    the second join: its shuffle also serves an aggregate by that key, unless
    a very busy id is split there; its partial sums are then shuffled.
    """
    w = users.select("user", F.col("f").alias("w"))
    h = items.select("item", F.col("f").alias("h"))
    if last == "item":
        return ratings.join(w, "user").join(h, "item")
    return ratings.join(h, "item").join(w, "user")


def rmse(ratings: DataFrame, users: DataFrame, items: DataFrame, rank: int, name: str = "rmse") -> DataFrame:
    error = squared_error(F.col("rating"), F.col("w"), F.col("h"), rank)
    return with_both(ratings, users, items).agg(F.sqrt(F.avg(error)).alias(name))


def offsets(ranks: Sequence[int]) -> list[int]:
    """Where the vectors of several models begin in one array, and its length."""
    return list(accumulate(ranks, initial=0))


def rmses(ratings: DataFrame, users: DataFrame, items: DataFrame, ranks: Sequence[int]) -> DataFrame:
    """One row with the error of every model whose vectors lie in a row in ``f``:
    ratings and vectors are joined once for all of them."""
    w, h = F.col("w"), F.col("h")
    errors = []
    for n, (at, rank) in enumerate(zip(offsets(ranks), ranks)):
        if rank <= UNROLL_LIMIT:
            score = reduce(add, [w[k] * h[k] for k in range(at, at + rank)])
        else:
            score = dot(F.slice(w, at + 1, rank), F.slice(h, at + 1, rank))
        errors.append(F.sqrt(F.avg(F.pow(F.col("rating") - score, 2))).alias(f"rmse{n}"))
    return with_both(ratings, users, items).agg(*errors)


def frobenius(factors: DataFrame, rank: int) -> Column:
    """Aggregate over a factor table: its Frobenius norm."""
    return F.sqrt(F.sum(squared_norm(F.col("f"), rank)))


def predict_pairs(pairs: DataFrame, users: DataFrame, items: DataFrame, rank: int) -> DataFrame:
    """Predictions for a table of pairs; 0 where a factor is unknown."""
    w = users.select("user", F.col("f").alias("w"))
    h = items.select("item", F.col("f").alias("h"))
    score = F.coalesce(dot(F.col("w"), F.col("h"), rank), F.lit(0.0))
    return pairs.join(w, "user", "left").join(h, "item", "left").withColumn("score", score).drop("w", "h")


def block_of(dense_id: Column, n: int, blocks: int, start: int = 1) -> Column:
    """Block 0..blocks-1 of a dense id: equal runs of consecutive ids."""
    size = max(-(-n // blocks), 1)
    return F.floor((dense_id - start) / F.lit(size)).cast("bigint")


def block_by_cuts(dense_id: Column, cuts: Sequence[int]) -> Column:
    """Block 0..len(cuts) of a dense id; ``cuts`` are the first ids of blocks 1 and on."""
    firsts = F.array(*[F.lit(cut).cast("bigint") for cut in cuts]) if cuts else F.array().cast("array<bigint>")
    return F.size(F.filter(firsts, lambda first: first <= dense_id))


def partner_block(row_block: Column, schedule: list[int]) -> Column:
    """The column block a row block works on under a schedule (a permutation)."""
    return F.element_at(F.array(*[F.lit(c) for c in schedule]), (row_block + 1).cast("int"))


def in_stratum(row_block: Column, col_block: Column, schedule: list[int]) -> Column:
    return partner_block(row_block, schedule) == col_block
