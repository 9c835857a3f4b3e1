"""The n best scores of every row vector, exactly, without most of the products.

A score w.h is at most |w| |h|. Column vectors are ordered by falling norm and
packed into blocks, so the norm of a block's first vector bounds the block. One
task keeps the running n best of a block of rows over a run of column blocks;
as soon as no row can gain from the next bound, that block and all behind it
are skipped.

The first run, the longest vectors, goes to every task (its size is bounded) and
all rows meet it. What it leaves open is known per row block: the number of
column blocks that can still matter. Only those pairs are formed and shuffled;
for most tables there are none. Either way n rows a user leave a task.

Rated cells are kept as sorted, delta-coded runs, one per row block and column
block, so no block of rows has to carry the cells of all columns.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators import blocks
from starloom.operators.blocks import packed, rank_within, row_block, spread, unpack
from starloom.operators.index import with_index
from starloom.sources.workspace import Workspace

# Column blocks per run: bounds the rated cells that one task holds.
RUN_BLOCKS = 64
# Scores from a matrix product are this exact, relative to |w| |h|.
SLACK = 1e-9

RUNS = "array<struct<c_block: bigint, width: int, deltas: binary>>"
FOUND = "r_block bigint, row int, user bigint, next bigint, products int, items array<bigint>, scores array<double>"


def by_norm(vectors: DataFrame, key: str, work: Workspace, name: str) -> tuple[DataFrame, int]:
    """Vectors (key, f, norm) with a gap-free ``idx`` by falling norm. Vectors
    that hold a NaN or an infinity have no score and are left out."""
    norm = F.sqrt(F.aggregate("f", F.lit(0.0), lambda s, x: s + x * x))
    sized = vectors.select(key, "f", norm.alias("norm")).where(~F.isnan("norm") & (F.col("norm") < float("inf")))
    return with_index(sized, [F.desc("norm"), key], work, name)


def delta_coded(cells: np.ndarray) -> tuple[int, bytes]:
    """Ascending cell numbers as differences of the least width that holds them."""
    steps = np.diff(cells, prepend=0)
    width = next(w for w in (1, 2, 4) if not len(steps) or int(steps.max()) < 1 << 8 * w)
    return width, steps.astype(f"<u{width}").tobytes()


def delta_decoded(width: int, deltas: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(deltas, f"<u{width}"), dtype=np.int64)


def rated_runs(rated: DataFrame, rows: DataFrame, cols: DataFrame, size: int, col_size: int) -> DataFrame:
    """(r_block, c_block, width, deltas): the rated cells of each pair of blocks.
    A run holds at most a pair's cells, however busy its users are."""
    place = (
        rated.select("user", "item")
        .join(rows.select("user", F.col("idx").alias("ui")), "user")
        .join(cols.select("item", F.col("idx").alias("ii")), "item")
    )
    cells = place.groupBy(
        F.floor(F.col("ui") / size).cast("bigint").alias("r_block"),
        F.floor(F.col("ii") / col_size).cast("bigint").alias("c_block"),
    ).agg(F.collect_set(((F.col("ui") % size) * col_size + F.col("ii") % col_size).cast("int")).alias("cells"))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = [delta_coded(np.sort(c.values.to_numpy())) for c in batch.column("cells")]
            columns = [batch.column("r_block"), batch.column("c_block")]
            columns += [pa.array([w for w, _ in runs], pa.int32()), pa.array([d for _, d in runs], pa.binary())]
            yield pa.record_batch(columns, names=["r_block", "c_block", "width", "deltas"])

    return cells.mapInArrow(code, "r_block bigint, c_block bigint, width int, deltas binary")


class RunningBest:
    """The n best (score, id) of each row so far; equal scores go to the smaller id."""

    def __init__(self, w: np.ndarray, n: int, floor: np.ndarray | None = None):
        self.w, self.n = w, n
        self.norm = np.sqrt((w * w).sum(axis=1))
        # Scores below are of no interest: n better ones are known elsewhere.
        self.floor = np.full(len(w), -np.inf) if floor is None else floor
        self.row, self.score, self.id = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
        self.products = 0

    def open_rows(self, bound: float) -> np.ndarray:
        """Rows that a vector of norm ``bound`` could still change."""
        return np.flatnonzero(self.norm * bound * (1 + SLACK) >= self.floor)

    def least_norm(self) -> float:
        """Vectors shorter than this change no row."""
        with np.errstate(divide="ignore", invalid="ignore"):
            least = np.where(self.norm > 0, self.floor / self.norm, -np.inf)
        return float(least.min(initial=np.inf)) / (1 + SLACK)

    def add(self, ids: np.ndarray, h: np.ndarray, norm: np.ndarray, done: np.ndarray | None, col_size: int) -> bool:
        """Take in a block of columns by falling norm; False if it cannot matter."""
        rows = self.open_rows(norm[0])
        if not len(rows):
            return False
        self.products += 1
        w, floor = self.w[rows], self.floor[rows]
        scores = w @ h.T
        if done is not None:
            local = np.full(len(self.w), -1)
            local[rows] = np.arange(len(rows))
            r, c = local[done // col_size], done % col_size
            scores[r[r >= 0], c[r >= 0]] = -np.inf
        slack = SLACK * self.norm[rows] * norm[0]
        if len(ids) > self.n and not np.isfinite(floor).all():
            floor = np.maximum(floor, np.partition(scores, len(ids) - self.n, axis=1)[:, len(ids) - self.n])
        r, c = np.nonzero((scores >= (floor - slack)[:, None]) & np.isfinite(scores))
        # Scores added up in one order: equal vectors get equal scores wherever they stand.
        exact = np.zeros(len(r))
        for k in range(h.shape[1]):
            exact += w[r, k] * h[c, k]
        self._keep(rows[r], exact, ids[c])
        return True

    def _keep(self, row: np.ndarray, score: np.ndarray, id_: np.ndarray) -> None:
        row, score = np.concatenate((self.row, row)), np.concatenate((self.score, score))
        id_ = np.concatenate((self.id, id_))
        order = np.lexsort((id_, -score, row))
        row, score, id_ = row[order], score[order], id_[order]
        first = np.searchsorted(row, row)
        place = np.arange(len(row)) - first
        kept = place < self.n
        self.row, self.score, self.id = row[kept], score[kept], id_[kept]
        last = place == self.n - 1
        self.floor[row[last]] = np.maximum(self.floor[row[last]], score[last])


def first_run(rows: DataFrame, n_rows: int, size: int, run: list[np.ndarray], tops: np.ndarray, n: int, rank: int) -> DataFrame:
    """FOUND of every row over the first run of columns.

    ``run`` holds ids, vectors and norms; ``tops`` the norm of each later block's first vector.
    ``next`` is the block behind the last one that can still change the row's block.
    """
    shared = rows.sparkSession.sparkContext.broadcast((*run, tops))
    col_size = blocks.COL_BLOCK

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, h, norm, tops = shared.value
        for batch in batches:
            for block in batch.itertuples():
                users, w = unpack(block, "r", rank)
                runs = block.runs if block.runs is not None else []
                done = {r["c_block"]: delta_decoded(r["width"], r["deltas"]) for r in runs}
                state = RunningBest(w, n)
                for at in range(0, len(ids), col_size):
                    part = slice(at, at + col_size)
                    if not state.add(ids[part], h[part], norm[part], done.get(at // col_size), col_size):
                        break
                cuts = np.searchsorted(state.row, np.arange(len(users) + 1))
                yield pd.DataFrame(
                    {
                        "r_block": block.r_block,
                        "row": np.arange(len(users)),
                        "user": users,
                        "next": -(-len(ids) // col_size) + int((tops >= state.least_norm()).sum()),
                        "products": state.products,
                        "items": [state.id[a:b] for a, b in zip(cuts, cuts[1:])],
                        "scores": [state.score[a:b] for a, b in zip(cuts, cuts[1:])],
                    }
                )

    return spread(rows, -(-n_rows // size)).mapInPandas(best, FOUND)


def later_runs(found: DataFrame, rows: DataFrame, cols: DataFrame, runs: DataFrame | None, length: int, n: int, rank: int) -> DataFrame:
    """(user, item, predict) from the pairs of blocks that the first run left open.

    ``cols`` holds one row per column block. A group is one block of rows and one run of columns.
    """
    col_size = blocks.COL_BLOCK
    reached = F.when(F.size("items") == n, F.element_at("scores", -1)).otherwise(float("-inf"))
    floors = (
        found.where(F.col("next") > length)
        .groupBy("r_block")
        .agg(F.max("next").alias("next"), F.sort_array(F.collect_list(F.struct("row", reached.alias("s")))).alias("m"))
        .select("r_block", "next", F.col("m.s").alias("floor"))
    )
    run = F.explode(F.sequence(F.lit(1).cast("bigint"), F.floor((F.col("next") - 1) / length))).alias("run")
    left = rows.join(floors, "r_block").select("r_block", "r_ids", "r_f", "floor", run)
    right = floors.select("r_block", "next", run).join(cols.where("run > 0"), "run").where("c_block < next").drop("next")
    if runs is not None:
        right = right.join(runs, ["r_block", "c_block"], "left")
    else:
        right = right.withColumns({"width": F.lit(None).cast("int"), "deltas": F.lit(None).cast("binary")})

    def best(rows: pd.DataFrame, cols: pd.DataFrame) -> pd.DataFrame:
        block = next(rows.itertuples())
        users, w = unpack(block, "r", rank)
        state = RunningBest(w, n, np.array(block.floor, np.float64))
        for c in cols.sort_values("c_block").itertuples():
            ids, h = unpack(c, "c", rank)
            done = None if c.deltas is None else delta_decoded(int(c.width), c.deltas)
            if not state.add(ids, h, np.asarray(c.c_norm), done, col_size):
                break
        return pd.DataFrame({"user": users[state.row], "item": state.id, "predict": state.score})

    groups = ["r_block", "run"]
    return left.groupBy(*groups).cogroup(right.groupBy(*groups)).applyInPandas(best, "user bigint, item bigint, predict double")


def _column_blocks(indexed: DataFrame, length: int) -> DataFrame:
    members = F.sort_array(F.collect_list(F.struct("idx", "item", "f", "norm")))
    block = F.floor(F.col("idx") / blocks.COL_BLOCK).cast("bigint").alias("c_block")
    return (
        indexed.groupBy(block)
        .agg(members.alias("m"))
        .select(
            F.floor(F.col("c_block") / length).alias("run"), "c_block", F.col("m.item").alias("c_ids"),
            F.flatten("m.f").alias("c_f"), F.col("m.norm").alias("c_norm"),
        )
    )


def _flat(column: Iterable) -> np.ndarray:
    return np.concatenate([np.asarray(c.values) for c in column]) if len(column) else np.zeros(0)


def found_first(
    users: DataFrame, items: DataFrame, rank: int, n: int, work: Workspace, rated: DataFrame | None = None
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame | None, int]:
    """The first run's result, stored, and what ``later_runs`` needs."""
    u, n_u = by_norm(users, "user", work, "rows")
    i, _ = by_norm(items, "item", work, "cols")
    col_size = blocks.COL_BLOCK
    length = max(min(RUN_BLOCKS, blocks.BROADCAST_BYTES // (col_size * (8 * rank + 16))), 1)
    cols = work.write(_column_blocks(i, length), "column-blocks")
    size = row_block(n_u, work.spark.sparkContext.defaultParallelism)
    rows = packed(u, "user", size, "r")
    runs = None
    if rated is not None:
        runs = work.write(rated_runs(rated, u, i, size, col_size), "rated-runs")
        near = runs.where(F.col("c_block") < length).groupBy("r_block")
        rows = rows.join(near.agg(F.collect_list(F.struct("c_block", "width", "deltas")).alias("runs")), "r_block", "left")
    else:
        rows = rows.withColumn("runs", F.lit(None).cast(RUNS))
    # At most BROADCAST_BYTES (one block at least), and one number per later block.
    run = cols.where("run = 0").orderBy("c_block").select("c_ids", "c_f", "c_norm").toArrow()
    ids, norm = _flat(run["c_ids"]).astype(np.int64), _flat(run["c_norm"])
    first = [ids, _flat(run["c_f"]).reshape(len(ids), rank), norm]
    tops = cols.where("run > 0").orderBy("c_block").select(F.get("c_norm", F.lit(0)).alias("top")).toArrow()["top"].to_numpy()
    found = work.write(first_run(rows, n_u, size, first, tops, n, rank), "found")
    return found, packed(u, "user", size, "r"), cols, runs, length


def top_n_per_user(
    users: DataFrame,
    items: DataFrame,
    rank: int,
    n: int,
    work: Workspace,
    rated: DataFrame | None = None,
) -> DataFrame:
    """The n best predicted items of every user, without the items in
    ``rated`` if given: (user, item, predict, rank). Equal scores go to the smaller item."""
    found, rows, cols, runs, length = found_first(users, items, rank, n, work, rated)
    listed = found.select("user", F.posexplode(F.arrays_zip("items", "scores")).alias("pos", "x"))
    listed = listed.select(
        "user", F.col("x.items").alias("item"), F.col("x.scores").alias("predict"), (F.col("pos") + 1).cast("bigint").alias("rank")
    )
    if found.agg(F.max("next")).first()[0] in (None, *range(length + 1)):
        return listed
    later = later_runs(found, rows, cols, runs, length, n, rank)
    return rank_within(listed.drop("rank").unionByName(later), "user", "predict", "item", n)
