"""Train/test splits, folds and the filters that go with them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.hashing import percent_bucket
from starloom.operators.index import with_index
from starloom.sources.workspace import Workspace

PAIR = ["user", "item"]


def random_split(ratings: DataFrame, train_share: float = 0.8, seed: int = 42) -> list[DataFrame]:
    """Seeded split; the rows chosen depend on how the input is partitioned."""
    return ratings.randomSplit([train_share, 1 - train_share], seed)


def hash_split(ratings: DataFrame, train_percent: int = 80) -> DataFrame:
    """Adds ``in_train``, fixed by the ids alone: repeatable on any layout."""
    return ratings.withColumn("in_train", percent_bucket(F.col("user"), F.col("item")) < train_percent)


def seen_in(test: DataFrame, train: DataFrame, work: Workspace) -> DataFrame:
    """Test rows whose user and item both occur in train. The id lists are
    stored first, so that their size is known and busy ids can be split."""
    users = work.write(train.select("user").distinct(), "train-users")
    items = work.write(train.select("item").distinct(), "train-items")
    return test.join(users, "user", "left_semi").join(items, "item", "left_semi").select(*test.columns)


def ids_only_in(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    return left.select(column).distinct().join(right.select(column).distinct(), column, "left_anti")


def folds(rows: DataFrame, order_by: Sequence[str], k: int, work: Workspace) -> DataFrame:
    """Contiguous folds 1..k in row order, equal in size up to one row."""
    indexed, n = with_index(rows, order_by, work, "folds")
    fold = F.floor(F.col("idx") * k / F.lit(max(n, 1))).cast("bigint") + 1
    return indexed.withColumn("fold", fold).drop("idx")


def ordinal_in_user(rows: DataFrame, order_by: Sequence[str], work: Workspace) -> DataFrame:
    """Adds ``k``, the row's 1-based place among its user's rows.

    Rows are numbered globally by (user, order); the place is the distance
    from the user's first number. Range partitions cut a very active user into
    several tasks, which a window over the user could not.
    """
    indexed, _ = with_index(rows, ["user", *order_by], work, "ordinals")
    first = work.write(indexed.groupBy("user").agg(F.min("idx").alias("first")), "first")
    return indexed.join(first, "user").withColumn("k", F.col("idx") - F.col("first") + 1).drop("idx", "first")


def holdout(
    rows: DataFrame,
    order_by: Sequence[str],
    start: int,
    stop: int,
    work: Workspace,
    max_test: int = 0,
) -> DataFrame:
    """Adds ``in_test``: rows ``start..stop`` of every user in row order, until
    ``max_test`` rows are taken (0 or less: no limit)."""
    marked = ordinal_in_user(rows, order_by, work).withColumn(
        "in_test", F.col("k").between(start, stop)
    )
    if max_test <= 0:
        return marked.drop("k")
    stored = work.write(marked, "marked")
    chosen, _ = with_index(stored.where("in_test").select(*order_by), order_by, work, "chosen", start=1)
    kept = chosen.where(F.col("idx") <= max_test).select(*order_by, F.lit(True).alias("kept"))
    return (
        stored.join(kept, list(order_by), "left")
        .withColumn("in_test", F.coalesce("kept", F.lit(False)))
        .drop("k", "kept")
    )


def first_rows_per_user(rows: DataFrame, order_by: Sequence[str], stop: int) -> DataFrame:
    """Only the first ``stop`` rows of each user. The rank limit is applied
    before the shuffle, so no task sees more than ``stop`` rows per user and
    map task."""
    w = Window.partitionBy("user").orderBy(*order_by)
    return rows.withColumn("k", F.row_number().over(w)).where(F.col("k") <= stop)
