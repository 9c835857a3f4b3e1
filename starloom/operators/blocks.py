"""Products of vector tables, block by block.

All-pairs scores are the result itself here (a full prediction matrix) or are
cut to the best n per row before anything leaves the task (module ``best`` does
without most products where lengths differ). Vectors are packed
into blocks of a fixed number of rows; a task multiplies two blocks with one
matrix product. Blocks meet in rounds: a part of bounded size goes to every task,
where the other side's blocks pass it by.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.operators.index import with_index
from starloom.sources.workspace import Workspace

ROW_BLOCK = 1024
COL_BLOCK = 2048
# Vectors of the column side that are sent to every task at once.
BROADCAST_BYTES = 64 << 20
# Upper limit of tasks in one stage; beyond it a task takes several blocks.
MAX_TASKS = 100_000
# Rows per output batch of the full matrix.
OUT_ROWS = 1 << 18


def numbered(vectors: DataFrame, key: str, work: Workspace, name: str) -> tuple[DataFrame, int]:
    """Vectors (key, f) with a gap-free ``idx`` by ascending key."""
    return with_index(vectors.select(key, "f"), [key], work, name)


def packed(indexed: DataFrame, key: str, size: int, prefix: str) -> DataFrame:
    """One row per block: number, ids and the vectors end to end. Numbering is
    gap-free, so a block never holds more than ``size`` vectors."""
    members = F.sort_array(F.collect_list(F.struct("idx", key, "f")))
    block = F.floor(F.col("idx") / size).cast("bigint").alias(f"{prefix}_block")
    return (
        indexed.groupBy(block)
        .agg(members.alias("m"))
        .select(
            f"{prefix}_block",
            F.transform("m", lambda x: x[key]).alias(f"{prefix}_ids"),
            F.flatten(F.transform("m", lambda x: x["f"])).alias(f"{prefix}_f"),
        )
    )


def row_block(n_rows: int, cores: int) -> int:
    """Vectors per row block: ROW_BLOCK, or fewer where that would leave cores idle."""
    return max(min(ROW_BLOCK, -(-n_rows // (2 * cores))), 1)


def spread(df: DataFrame, n_blocks: int) -> DataFrame:
    """One task per row block, placed by its number. Blocks are small in bytes
    but long in work, so sizes alone would pack them into too few tasks."""
    return df.repartitionById(min(max(n_blocks, 1), MAX_TASKS), F.col("r_block").cast("int"))


def best_columns(scores: np.ndarray, ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column positions of the n best scores per row; equal scores go
    to the smaller id (``ids`` ascending). -inf marks cells to leave out."""
    n = min(n, scores.shape[1])
    if n < scores.shape[1]:
        edge = np.partition(scores, scores.shape[1] - n, axis=1)[:, scores.shape[1] - n, None]
        keep = scores >= edge
        # More ties at the edge than places: the smallest ids take them.
        ties = scores == edge
        room = n - (keep & ~ties).sum(axis=1, keepdims=True)
        keep &= ~ties | (np.cumsum(ties, axis=1) <= room)
    else:
        keep = np.ones(scores.shape, dtype=bool)
    return np.nonzero(keep & np.isfinite(scores))


def unpack(row, prefix: str, rank: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.asarray(getattr(row, f"{prefix}_ids"))
    return ids, np.asarray(getattr(row, f"{prefix}_f")).reshape(len(ids), rank)


def led_by(rows: DataFrame, part: DataFrame) -> DataFrame:
    """The columns of both: every task reads the rows of ``part``, which go to all
    tasks, and then its own of ``rows``. The other side's columns are null."""
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    # The first row of a task comes twice: once to meet the part, and as itself.
    own = F.when(F.col("_first"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1)))
    marked = rows.withColumn("_first", first).withColumn("_own", F.explode(own))
    emptied = marked.select("_own", *[F.when(F.col("_own") == 1, F.col(c)).alias(c) for c in rows.columns])
    return emptied.join(F.broadcast(part.withColumn("_own", F.lit(0))), "_own", "left").drop("_own")


def all_predictions(users: DataFrame, items: DataFrame, rank: int, work: Workspace) -> DataFrame:
    """The full prediction table (user, item, predict)."""
    u, n_u = numbered(users, "user", work, "rows")
    i, n_i = numbered(items, "item", work, "cols")
    size = row_block(n_u, work.spark.sparkContext.defaultParallelism)
    rows = spread(packed(u, "user", size, "r"), -(-n_u // size))
    cols = packed(i, "item", COL_BLOCK, "c")

    def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = []
        for batch in batches:
            for row in batch.itertuples():
                if row.r_ids is None:
                    part.append(unpack(row, "c", rank))
                    continue
                left, w = unpack(row, "r", rank)
                for right, h in part:
                    step = max(OUT_ROWS // len(right), 1)
                    for at in range(0, len(left), step):
                        scores = w[at : at + step] @ h.T
                        yield pd.DataFrame(
                            {
                                "user": np.repeat(left[at : at + step], len(right)),
                                "item": np.tile(right, len(scores)),
                                "predict": scores.ravel(),
                            }
                        )

    # A part of the items goes to every task; each row block passes all parts.
    step = max(BROADCAST_BYTES // (COL_BLOCK * (8 * rank + 8)), 1)
    parts = [cols.where(F.col("c_block").between(at, at + step - 1)) for at in range(0, max(-(-n_i // COL_BLOCK), 1), step)]
    made = [led_by(rows, part).mapInPandas(multiply, "user bigint, item bigint, predict double") for part in parts]
    return functools.reduce(DataFrame.unionByName, made)


class Found:
    """The n best others of each row of a block, among those a task has seen."""

    def __init__(self, ids, floor, n: int):
        self.ids, self.floor, self.n = np.asarray(ids), np.array(floor, float), n
        self.row, self.other, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        """Scores (rows x others) that reach a row's floor, which rises with its n-th best. Equal ones go to the smaller id."""
        keep = scores >= self.floor[:, None]
        r, c = np.nonzero(keep)
        if not len(r):
            return
        if len(r) > 2 * self.n * len(self.ids):
            order, alive = np.argsort(ids), np.flatnonzero(keep.any(axis=1))
            r, c = best_columns(np.where(keep[alive], scores[alive], -np.inf)[:, order], ids[order], self.n)
            r, c = alive[r], order[c]
        row, other, score = (np.append(*x) for x in ((self.row, r), (self.other, ids[c]), (self.score, scores[r, c])))
        order = np.lexsort((other, -score, row))
        count = np.bincount(row, minlength=len(self.ids))
        place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        order, last = order[place < self.n], place[place < self.n] == self.n - 1
        self.row, self.other, self.score = row[order], other[order], score[order]
        self.floor[self.row[last]] = np.maximum(self.floor[self.row[last]], self.score[last])

    def rows(self) -> pd.DataFrame:
        return pd.DataFrame({"id": self.ids[self.row], "other": self.other, "score": self.score})


def rank_within(rows: DataFrame, key: str, score: str, tie: str, n: int) -> DataFrame:
    """The best n rows per key. The limit is known to the planner, which cuts
    each map task's output to n rows per key before the shuffle."""
    w = Window.partitionBy(key).orderBy(F.desc(score), tie)
    return rows.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= n)


# What a round finds for a row block, and the n-th best score of its vectors.
BEST = "r_block bigint, floor array<double>, id array<bigint>, other array<bigint>, score array<double>"


def top_cosine(vectors: DataFrame, rank: int, n: int, work: Workspace, digits: int = 6, include_self: bool = False) -> DataFrame:
    """The n most similar vectors of every vector: (id, other, score, rank).
    Scores are rounded before ranking, so that equal vectors tie by id.

    Blocks are stored once. A round sends a part of them to every task, where the
    stored blocks pass it by; a task keeps the best of a block, and later rounds
    begin with the floors that earlier ones reached."""
    v, n_vectors = numbered(vectors, "id", work, "vectors")
    size = row_block(n_vectors, work.spark.sparkContext.defaultParallelism)
    norm = F.sqrt(F.aggregate(F.transform("f", lambda x: x * x), F.lit(0.0), lambda s, x: s + x))
    unit = v.withColumn("f", F.transform("f", lambda x: x / F.when(norm > 0, norm).otherwise(1.0)))
    n_blocks = -(-n_vectors // size)
    stored = work.write(spread(packed(unit, "id", size, "r"), n_blocks), "blocks")
    lowest = np.finfo(float).min

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = []
        for batch in batches:
            for row in batch.itertuples():
                if row.r_ids is None:
                    part.append((int(row.c_block), *unpack(row, "c", rank)))
                    continue
                left, a = unpack(row, "r", rank)
                mine = Found(left, np.full(len(left), lowest) if row.floor is None else row.floor, n)
                for block, right, b in part:
                    scores = np.round(a @ b.T, digits) + 0.0
                    if not include_self and block == row.r_block:
                        np.fill_diagonal(scores, -np.inf)
                    mine.add(scores, right)
                columns = {"r_block": int(row.r_block), "floor": mine.floor} | {c: x.to_numpy() for c, x in mine.rows().items()}
                yield pd.DataFrame({c: [x] for c, x in columns.items()})

    step = max(BROADCAST_BYTES // (size * (8 * rank + 8)), 1)
    left, rounds = stored.withColumn("floor", F.lit(None).cast("array<double>")), []
    for first in range(0, max(n_blocks, 1), step):
        if rounds:
            rounds[-1] = work.write(rounds[-1], f"round-{len(rounds)}")
            left = stored.join(F.broadcast(rounds[-1].select("r_block", "floor")), "r_block")
        part = stored.where(F.col("r_block").between(first, first + step - 1))
        part = part.select(*[F.col(f"r_{c}").alias(f"c_{c}") for c in ("block", "ids", "f")])
        rounds.append(led_by(left, part).mapInPandas(best, BEST))
    found = functools.reduce(DataFrame.unionByName, rounds)
    found = found.select(F.inline(F.arrays_zip("id", "other", "score")))
    return rank_within(found, "id", "score", "other", n)
