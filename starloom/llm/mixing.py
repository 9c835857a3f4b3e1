"""Mixing sources to target weights, no source beyond a number of epochs.

1. Words are counted per document and per source; sources are numbered in order
   and take the given weights in turn.
2. Capped water-filling: every source's target is weight x level, but at most
   ``epochs`` times its words. Each round clamps the sources that the level
   reaches and lifts the level by what they leave, in proportion to the other
   weights, until no further source is clamped. Only the level, one number, is
   on the driver; sources stay a table.
3. Every document of a source is taken the whole number of times that its
   target allows. The rest goes to documents in an order fixed by a seed, the
   doc_id and the text, whole ones first; the document at the cut is taken in
   part. So a source's words are its target rounded to a word.

The order needs no sort of a source: words are summed per slice of the order
(65,536 slices a source, summed before the shuffle), the slice at the cut is
known from these sums, and only its rows are ordered. Only keys and sizes are
stored; texts are read once and never shuffled.

Defined results: a null text has no words; a null source is a source of its own,
last in order; documents that share doc_id and text, repeated rows included,
share the part at the cut evenly, each rounded down, so a source may end less
than one word a row short there; a source without words has target 0; an empty
table gives no rows. The same table gives the same rows, however it is stored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import words
from starloom.operators.index import with_index
from starloom.sources.workspace import Workspace

WEIGHTS = (5, 2, 1)
SHARE = 1.5
EPOCHS = 2
SEED = "mix-1"
# Hex digits of the order key that name a slice.
SLICE_DIGITS = 4


def water_level(sources: DataFrame, budget: float, epochs: int) -> float:
    """The level at which min(weight x level, epochs x words) adds up to the budget.

    Each round starts from the sources that the last level clamped. Levels only
    rise, so the clamped set only grows and the rounds end.
    """
    level, clamped = 0.0, None
    while True:
        full = F.col("source_size") * epochs <= F.col("weight") * F.lit(level)
        kept, weight, n = sources.agg(
            F.coalesce(F.sum(F.when(full, F.col("source_size") * epochs)), F.lit(0)),
            F.sum(F.when(~full, F.col("weight"))),
            F.count(F.when(full, True)),
        ).first()
        if n == clamped or not weight:
            return level
        level, clamped = (budget - kept) / weight, n


def targets(sizes: DataFrame, work: Workspace, weights: Sequence[int], share: float, epochs: int) -> DataFrame:
    """(source, source_size, target) per source, stored."""
    found = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    numbered, _ = with_index(found, [F.col("source").asc_nulls_last()], work, "sources")
    turn = F.array(*[F.lit(w) for w in weights])
    sources = work.write(numbered.withColumn("weight", F.get(turn, (F.col("idx") % len(weights)).cast("int"))), "weighted")
    budget = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    level = water_level(sources, budget, epochs)
    most = F.col("source_size") * epochs
    target = F.when(most <= F.col("weight") * F.lit(level), most.cast("double")).otherwise(F.col("weight") * F.lit(level))
    return work.write(sources.select("source", "source_size", target.alias("target")), "targets")


def same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def mix(
    docs: DataFrame,
    work: Workspace,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    epochs: int = EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) of every row of ``docs``.

    ``share`` is the mix's size in words against all words; it may not ask for
    more than ``epochs`` times the words.
    """
    if not 0 < share <= epochs or not weights or min(weights) <= 0:
        raise ValueError("weights have to be positive, and share at most epochs")
    parts = [F.lit(seed), F.col("doc_id").cast("string"), F.md5(F.col("text").cast("binary"))]
    key = F.md5(F.concat_ws(":", *[F.coalesce(p, F.lit("")) for p in parts]).cast("binary"))
    size = F.size(words(F.col("text"))).cast("bigint")
    sizes = work.write(docs.select("doc_id", "source", size.alias("size"), key.alias("key")), "sizes")
    sources = targets(sizes, work, weights, share, epochs)

    # What a source takes beyond whole repetitions, in words.
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    whole = F.least(whole, F.lit(epochs)).cast("bigint")
    rest = F.floor(F.col("target") + 0.5) - whole * F.col("source_size")
    plan = sources.select("source", "source_size", "target", whole.alias("whole"), rest.alias("rest"))

    # The slice of the order in which the rest ends, and how much of it is left there.
    slice_ = F.substring("key", 1, SLICE_DIGITS)
    slices = sizes.groupBy("source", slice_.alias("slice")).agg(F.sum("size").alias("n"))
    in_order = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("before", F.coalesce(F.sum("n").over(in_order), F.lit(0)))
    cut = slices.join(plan.select(F.col("source").alias("own"), "rest"), same("source", "own"))
    cut = cut.filter("before < rest AND before + n >= rest").select("own", "slice", (F.col("rest") - F.col("before")).alias("left"))
    cut = work.write(cut.groupBy("own").agg(F.min(F.struct("slice", "left")).alias("cut")), "cuts")
    places = plan.withColumnRenamed("source", "name").join(cut, same("name", "own"), "left")
    places = work.write(places.select("name", "source_size", "target", "whole", "cut.slice", "cut.left"), "places")

    # Inside that slice by the whole key; rows with one key count as one.
    placed = sizes.join(places, same("source", "name"), "left")
    tail = placed.filter(slice_ == F.col("slice")).groupBy("name", "key", "left").agg(F.sum("size").alias("n"))
    by_key = Window.partitionBy("name").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    tail = tail.withColumn("room", F.col("left") - F.coalesce(F.sum("n").over(by_key), F.lit(0))).filter("room > 0 AND n > 0")
    tail = work.write(tail.select(F.col("name").alias("own"), F.col("key").alias("own_key"), "room", "n"), "tail")

    rows = placed.join(tail, same("name", "own") & (F.col("key") == F.col("own_key")), "left")
    part = F.when(F.col("room") >= F.col("n"), F.col("size")).otherwise(F.expr("size * room div n"))
    extra = F.when(slice_ < F.col("slice"), F.col("size")).when(F.col("room").isNotNull(), part).otherwise(0)
    taken = F.col("whole") * F.col("size") + extra
    return rows.select("doc_id", "source", "size", "source_size", "target", taken.cast("bigint").alias("taken"))
