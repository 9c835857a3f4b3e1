"""Removal of repeated passages by overlapping three-line windows.

Every three consecutive lines of a text that hold a word are one window, blank
lines aside. Of all windows with the same lines in the corpus the first stays,
by doc_id and then by place; the lines of every later one are covered, and each
covered line is removed once. Windows overlap, so a repeated passage of any
length from three lines up is covered whole.

Defined results: a null text stays null and has no lines; documents with fewer
than three such lines keep all of them; of rows that share a doc_id the one
with the smaller text digest comes first, equal rows are interchangeable; null
ids come first; blank lines stay; other columns, whatever their names, are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import digest, free_name, let, numbered, with_few
from starloom.sources.workspace import Workspace

WINDOW = 3


def _lines(text):
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def windows(docs: DataFrame, row: str) -> DataFrame:
    """(row, doc_id, tie, k, covered, h1, h2): the windows of every text.

    Two independent 64-bit hashes stand for the lines.
    """
    numbered_lines = F.transform(_lines(F.col("text")), lambda line, i: F.struct(i.alias("i"), line.alias("line")))
    real = F.filter(numbered_lines, lambda x: x["line"].rlike(r"[^\x20\x09-\x0D]"))

    def window(lines, k):
        cells = [F.get(lines, k + j) for j in range(WINDOW)]
        texts = [c["line"] for c in cells]
        return F.struct(
            k.alias("k"),
            F.array(*[c["i"] for c in cells]).alias("covered"),
            F.xxhash64(*texts).alias("h1"),
            F.xxhash64(F.lit("second"), *texts).alias("h2"),
        )

    def all_windows(lines):
        starts = F.when(F.size(lines) >= WINDOW, F.sequence(F.lit(0), F.size(lines) - WINDOW))
        return F.transform(starts, lambda k: window(lines, k))

    tie = digest(F.col("text")).alias("tie")
    found = docs.select(row, "doc_id", tie, F.explode_outer(let(real, all_windows)).alias("w"))
    return found.filter("w is not null").select(row, "doc_id", "tie", "w.k", "w.covered", "w.h1", "w.h2")


def covered_lines(docs: DataFrame, row: str, work: Workspace) -> DataFrame:
    """(row, gone): the numbers of the lines that repeat an earlier window."""
    found = work.write(windows(docs, row), "windows")
    at = F.struct("doc_id", "tie", row, "k")
    # One row per window and task leaves the first step, however common the window.
    firsts = found.groupBy("h1", "h2").agg(F.min(at).alias("first"), F.count("*").alias("n")).filter("n > 1")
    later = found.join(firsts, ["h1", "h2"]).filter(at > F.col("first"))
    return later.groupBy(row).agg(F.array_distinct(F.flatten(F.collect_list("covered"))).alias("gone"))


def remove_repeats(docs: DataFrame, work: Workspace) -> DataFrame:
    """``docs`` with repeated windows taken out of ``text``, and two counts:
    ``n_lines`` before and ``n_removed`` (underscores in front if taken)."""
    stored, row = numbered(docs, work, "rows")
    gone = free_name(stored, "gone")
    found = work.write(covered_lines(stored.select(row, "doc_id", "text"), row, work).withColumnRenamed("gone", gone), "gone")
    work.discard("windows")
    lines = _lines(F.col("text"))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    text = F.when(F.col(gone).isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    )
    n_lines, n_removed = free_name(docs, "n_lines"), free_name(docs, "n_removed")
    return (
        with_few(stored, found, row, F.size(gone) * 4 + 32)
        .withColumn(n_lines, F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("bigint"))
        .withColumn(n_removed, F.coalesce(F.size(gone), F.lit(0)).cast("bigint"))
        .withColumn("text", text)
        .drop(row, gone)
        .select(*docs.columns, n_lines, n_removed)
    )
