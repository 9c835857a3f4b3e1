"""Gap-free numbering of rows and ids without a global window."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.sources.workspace import Workspace

# monotonically_increasing_id() keeps the partition number above this bit and
# the position inside the partition below it.
_POSITION_BITS = 33


def with_index(
    df: DataFrame,
    order_by: Sequence[str | Column],
    work: Workspace,
    name: str,
    start: int = 0,
) -> tuple[DataFrame, int]:
    """Number rows by ``order_by`` and return them with their total.

    Rows are range-partitioned and sorted, so each task numbers its own slice;
    the driver adds up one count per partition. The sorted rows are written
    first: range boundaries are sampled, and a second evaluation (a retry
    included) could place rows differently. ``order_by`` should be unique.
    """
    slot = F.monotonically_increasing_id()
    ordered = (
        df.repartitionByRange(*order_by).sortWithinPartitions(*order_by).withColumn("_slot", slot)
    )
    stored = work.write(ordered, name)
    part = F.shiftright("_slot", _POSITION_BITS)
    sizes = sorted((r["part"], r["n"]) for r in stored.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    before = list(accumulate((n for _, n in sizes), initial=0))
    offsets = df.sparkSession.createDataFrame(
        [(p, b) for (p, _), b in zip(sizes, before)], "_part bigint, _before bigint"
    )
    position = F.col("_slot").bitwiseAND((1 << _POSITION_BITS) - 1)
    # One row per partition: always small enough to send everywhere.
    indexed = (
        stored.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select(*df.columns, (F.col("_before") + position + F.lit(start)).alias("idx"))
    )
    return indexed, before[-1]


def dense_ids(df: DataFrame, column: str, work: Workspace, start: int = 1) -> tuple[DataFrame, int]:
    """Dictionary (raw_id, dense_id) by ascending raw id."""
    ids = df.select(F.col(column).cast("bigint").alias("raw_id")).distinct()
    indexed, n = with_index(ids, ["raw_id"], work, f"ids-{column}", start)
    return indexed.withColumnRenamed("idx", "dense_id"), n


def to_dense(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Replace raw ids by dense ids."""
    keyed = ids.select(F.col("raw_id").alias(column), "dense_id")
    return df.join(keyed, column).withColumn(column, F.col("dense_id")).drop("dense_id").select(*df.columns)


def to_raw(df: DataFrame, column: str, ids: DataFrame, default: int | None = None) -> DataFrame:
    """Replace dense ids by raw ids. Unmapped ids become null, or ``default``."""
    keyed = ids.select(F.col("dense_id").alias(column), "raw_id")
    raw = F.col("raw_id") if default is None else F.coalesce("raw_id", F.lit(default).cast("bigint"))
    return df.join(keyed, column, "left").withColumn(column, raw).drop("raw_id").select(*df.columns)
