"""Shards along a Hilbert curve, so files can be skipped on any of several dimensions.

Every dimension is cut at its quantiles into 2**bits steps, a row's steps give
its place on the Hilbert curve through that grid, and rows in curve order are
cut into shards of equal row counts (law ``rows``). Neighbours on the curve are
close in all dimensions, so each shard spans a small range of every one.

Only keys and sizes are shuffled. Quantiles are a few numbers per dimension, of
text dimensions a few whole values, found from the counts of distinct ones.

Defined results: a null counts as the lowest step; a null text has 0 bytes; rows
with equal keys, repeated rows included, lie side by side in any order; columns
named like a result give way to it; an
empty table gives no rows; with fewer rows than shards the last shards are empty.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from functools import partial, reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import free_name, let
from starloom.operators.index import with_index
from starloom.sources.workspace import Workspace

BITS = 5
ROW_BYTES = 16


def hilbert_index(steps: Sequence[Column], bits: int) -> Column:
    """The place of a grid cell on the Hilbert curve, by bit operations."""
    n = len(steps)
    top = 1 << (bits - 1)
    levels = [top >> k for k in range(bits - 1)]

    def undo(level: int, axis: int, cell: Column) -> Column:
        low, own, mask = F.get(cell, F.lit(0)), F.get(cell, F.lit(axis)), level - 1
        hit = own.bitwiseAND(level) != 0
        change = F.when(hit, F.lit(0)).otherwise(low.bitwiseXOR(own).bitwiseAND(mask))
        first = F.when(hit, low.bitwiseXOR(F.lit(mask))).otherwise(low.bitwiseXOR(change))
        parts = [first] + [F.get(cell, F.lit(j)) for j in range(1, n)]
        if axis:
            parts[axis] = own.bitwiseXOR(change)
        return F.array(*parts)

    def turned(cell: Column) -> Column:
        grey = [F.get(cell, F.lit(0))]
        for j in range(1, n):
            grey.append(F.get(cell, F.lit(j)).bitwiseXOR(grey[-1]))
        flip = reduce(
            lambda a, b: a.bitwiseXOR(b),
            [F.when(grey[-1].bitwiseAND(q) != 0, F.lit(q - 1)).otherwise(F.lit(0)) for q in levels],
            F.lit(0),
        )
        return F.array(*[g.bitwiseXOR(flip) for g in grey])

    def woven(cell: Column) -> Column:
        out = F.lit(0).cast("bigint")
        for bit in reversed(range(bits)):
            for axis in range(n):
                own = F.shiftright(F.get(cell, F.lit(axis)), bit).bitwiseAND(1).cast("bigint")
                out = out.bitwiseOR(F.shiftleft(own, bit * n + n - 1 - axis))
        return out

    start = F.array(*[s.cast("int") for s in steps])
    column = start
    for level in levels:
        for axis in range(n):
            column = let(column, partial(undo, level, axis))
    return let(let(column, turned), woven)


def text_cuts(rows: DataFrame, column: str, parts: int, work: Workspace) -> list[str]:
    """The values at the quantiles k / parts of a text column, exact, nulls aside.

    Distinct values are counted, sorted in ranges and their counts cumulated
    within each; the driver holds one count per range and ``parts`` values.
    """
    value = F.col(column)
    counts = rows.filter(value.isNotNull()).groupBy(value.alias("value")).agg(F.count("*").alias("n"))
    ordered = counts.repartitionByRange("value").withColumn("part", F.spark_partition_id())
    ordered = work.write(ordered, f"values-{column}")
    sizes = sorted((r["part"], r["n"]) for r in ordered.groupBy("part").agg(F.sum("n").alias("n")).collect())
    total = sum(n for _, n in sizes)
    if not total:
        return []
    before = list(accumulate((n for _, n in sizes), initial=0))
    starts = rows.sparkSession.createDataFrame([(p, b) for (p, _), b in zip(sizes, before)], "part int, before bigint")
    upto = F.sum("n").over(Window.partitionBy("part").orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    reached = ordered.withColumn("upto", upto).join(F.broadcast(starts), "part")  # one row per range
    level = F.floor((F.col("upto") + F.col("before")) * parts / F.lit(total)).cast("int")
    firsts = reached.groupBy(level.alias("level")).agg(F.min("value").alias("value")).collect()
    return [min(r["value"] for r in firsts if r["level"] >= k) for k in range(1, parts)]


def place(
    docs: DataFrame,
    work: Workspace,
    shards: int = 40,
    dimensions: Sequence[str] = ("source", "lang", "size"),
    bits: int = BITS,
    keep: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """Every row's shard: the ``keep`` columns, size, text_crc32, curve, shard, slot.

    ``size`` may stand among the dimensions for the row's bytes.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    size = (F.octet_length(text) + ROW_BYTES).cast("bigint")
    rows = docs.withColumns({"size": size, "text_crc32": F.crc32(text.cast("binary"))})
    axes = [free_name(docs, f"axis_{k}") for k in range(len(dimensions))]
    kinds = dict(rows.dtypes)
    scaled = [F.col(d).cast("string" if kinds[d] == "string" else "double").alias(a) for a, d in zip(axes, dimensions)]
    rows = work.write(rows.select(*keep, "size", "text_crc32", *scaled), "keys")
    parts = 1 << bits
    at = F.array(*[F.lit(k / parts) for k in range(1, parts)])
    texts = [a for a, d in zip(axes, dimensions) if kinds[d] == "string"]
    numbers = [F.percentile_approx(a, at, 10000).alias(a) for a in axes if a not in texts]
    cuts = rows.agg(F.lit(0).alias("none_"), *numbers).first().asDict() | {a: text_cuts(rows, a, parts, work) for a in texts}
    # A value on many rows takes as many steps as quantiles, so all dimensions span the grid.
    steps = [
        reduce(lambda total, cut: total + F.when(F.col(a) > cut[0], cut[1]).otherwise(0), sorted(Counter(cuts[a] or []).items()), F.lit(0))
        for a in axes
    ]
    steps = [F.coalesce(s, F.lit(0)) for s in steps]
    curved = rows.select(*keep, "size", "text_crc32", hilbert_index(steps, bits).alias("curve"))
    ordered, n = with_index(curved, ["curve", keep[0], "text_crc32", "size"], work, "ordered")
    each, longer = divmod(n, shards)
    edge = longer * (each + 1)
    idx = F.col("idx")
    number = F.when(idx < edge, F.floor(idx / F.lit(each + 1)))
    first = F.when(idx < edge, F.col("shard") * (each + 1))
    if each:
        number = number.otherwise(longer + F.floor((idx - edge) / F.lit(each)))
        first = first.otherwise(edge + (F.col("shard") - longer) * each)
    placed = ordered.withColumn("shard", number.cast("int"))
    return placed.withColumn("slot", (idx - first).cast("bigint")).drop("idx")


def write_shards(placed: DataFrame, path: str) -> None:
    """Write placed rows, one folder per shard, in slot order within a file."""
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
