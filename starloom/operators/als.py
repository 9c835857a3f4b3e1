"""Alternating least squares.

Both half-steps solve ``(X'X + lam I) w = X'r`` per id, where X holds the fixed
vectors of the id's ratings. Two routes give the same sums:

* ``joined``: join ratings with the fixed table and add up the k(k+1)/2 + k
  products with built-in aggregates. Partial sums keep busy ids cheap.
* ``routed``: ratings are cut once into cells of bounded size. A half-step
  sends each cell the fixed vectors it needs (one copy per cell instead of one
  per rating) and adds up the products inside the cell. Ids too busy for one
  cell are spread over several and their partial sums are combined.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.vectors import dot
from starloom.operators.factors import offsets, rmse, rmses, start_factors, with_both
from starloom.operators.split import seen_in
from starloom.sources.workspace import Workspace

OTHER = {"user": "item", "item": "user"}

# Unrolled sums stay within one generated method up to this rank.
JOINED_RANK = 10
# Fixed tables up to this size are broadcast by the joined route.
JOINED_BYTES = 64 << 20
CELL_ROWS = 1 << 18
MAX_CELLS = 100_000
# Numbers of packed sums a task holds at once while it solves several models.
PACKED_NUMBERS = 1 << 22


def upper_pairs(rank: int) -> list[tuple[int, int]]:
    return [(a, b) for a in range(rank) for b in range(a, rank)]


def solve_packed(packed: np.ndarray, rank: int, lam: float) -> np.ndarray:
    """Solve many small symmetric systems given as packed rows (upper triangle
    of X'X, then X'r). Singular systems get the shortest solution."""
    n = len(packed)
    gram = np.empty((n, rank, rank))
    upper = upper_pairs(rank)
    for at, (a, b) in enumerate(upper):
        gram[:, a, b] = gram[:, b, a] = packed[:, at]
    gram[:, range(rank), range(rank)] += lam
    right = packed[:, len(upper):, None]
    try:
        return np.linalg.solve(gram, right)[:, :, 0]
    except np.linalg.LinAlgError:
        return (np.linalg.pinv(gram, hermitian=True) @ right)[:, :, 0]


def solved(sums: DataFrame, rank: int, lam: float) -> DataFrame:
    """Replace the packed sums in column ``s`` by the solution ``f``, in Arrow
    batches, and by ``q`` = f'X'X f - 2 f'X'r: what the solution adds to the sum
    of squared ratings to give the sum of squared errors of its id."""
    a, b = map(np.array, zip(*upper_pairs(rank)))
    twice = np.where(a == b, 1.0, 2.0)

    @F.pandas_udf("f array<double>, q double")
    def solve(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for given in batches:
            if len(given):
                packed = np.stack(given.to_numpy())
                f = solve_packed(packed, rank, lam)
                q = (packed[:, : len(a)] * f[:, a] * f[:, b]) @ twice - 2.0 * np.einsum("nk,nk->n", packed[:, len(a) :], f)
                yield pd.DataFrame({"f": list(f), "q": q})
            else:
                yield pd.DataFrame({"f": pd.Series([], dtype=object), "q": pd.Series([], dtype=float)})

    return sums.withColumn("x", solve("s")).select(*[c for c in sums.columns if c != "s"], "x.f", "x.q")


def fits(rows: int, rank: int) -> bool:
    """Whether a factor table is small enough to broadcast."""
    return rows * (8 * rank + 32) <= JOINED_BYTES


def normal_sums(ratings: DataFrame, fixed: DataFrame, key: str, rank: int, gram: bool = True) -> DataFrame:
    """Per id the packed sums of the normal equations, as built-in aggregates."""
    f, r = F.col("f"), F.col("rating")
    cells = [F.sum(f[a] * f[b]) for a, b in upper_pairs(rank)] if gram else []
    cells += [F.sum(r * f[a]) for a in range(rank)]
    names = [f"s{n}" for n in range(len(cells))]
    sums = (
        ratings.join(fixed, OTHER[key])
        .groupBy(key)
        .agg(*[cell.alias(name) for cell, name in zip(cells, names)])
    )
    return sums.select(key, F.array(*names).alias("s"))


def joined_half_step(ratings: DataFrame, fixed: DataFrame, key: str, rank: int, lam: float) -> DataFrame:
    return solved(normal_sums(ratings, fixed, key, rank), rank, lam)


class RoutedRatings:
    """Ratings laid out for the half-step of one side.

    ``cells`` holds (cell, split, id, other, rating): the ratings of an id sit
    in one cell, or in several (``split``) when the id alone would overfill one.
    ``needed`` lists which fixed ids each cell uses. Both are built once.
    """

    def __init__(self, ratings: DataFrame, key: str, work: Workspace, cell_rows: int = CELL_ROWS):
        self.key, self.other, self.work = key, OTHER[key], work
        counts = ratings.groupBy(key).agg(F.count("*").alias("n"))
        total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
        cores = work.spark.sparkContext.defaultParallelism
        self.n_cells = min(max(-(-total // cell_rows), cores), MAX_CELLS)
        cell_rows = max(cell_rows, -(-total // MAX_CELLS))
        # At most total / cell_rows ids are this busy, no more than there are cells.
        busy = counts.where(F.col("n") > cell_rows).select(key, F.ceil(F.col("n") / cell_rows).alias("parts"))
        part = F.when(F.col("parts").isNull(), F.lit(0)).otherwise(
            F.pmod(F.xxhash64(self.other), F.col("parts"))
        )
        placed = ratings.join(F.broadcast(busy), key, "left").select(
            F.pmod(F.xxhash64(F.col(key), part), F.lit(self.n_cells)).cast("int").alias("cell"),
            F.col("parts").isNotNull().alias("split"),
            key,
            self.other,
            "rating",
        )
        # Bucketed, so that no half-step has to shuffle the ratings again.
        self.cells = work.write_bucketed(placed, f"cells-{key}", "cell", self.n_cells)
        self.needed = work.write(self.cells.select("cell", self.other).distinct(), f"needed-{key}")

    def half_step(self, fixed: DataFrame, rank: int, lam: float, name: str) -> DataFrame:
        key, other = self.key, self.other

        def add_up(rows: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
            if rows.empty:
                return pd.DataFrame({key: [], "split": [], "s": []})
            vectors = vectors.sort_values(other)
            table = np.stack(vectors["f"].to_numpy())
            rows = rows.sort_values([key, other])
            at = np.searchsorted(vectors[other].to_numpy(), rows[other].to_numpy())
            rating = rows["rating"].to_numpy()
            ids, first = np.unique(rows[key].to_numpy(), return_index=True)
            columns = [table[at, a] for a in range(rank)]
            sums = [np.add.reduceat(columns[a] * columns[b], first) for a, b in upper_pairs(rank)]
            sums += [np.add.reduceat(rating * columns[a], first) for a in range(rank)]
            return pd.DataFrame(
                {key: ids, "split": rows["split"].to_numpy()[first], "s": list(np.stack(sums, axis=1))}
            )

        sent = self.needed.join(fixed, other).select("cell", other, "f").repartition(self.n_cells, "cell")
        partial = (
            self.cells.groupBy("cell")
            .cogroup(sent.groupBy("cell"))
            .applyInPandas(add_up, f"{key} bigint, split boolean, s array<double>")
        )
        partial = self.work.write(partial, name)
        whole = partial.where(~F.col("split")).select(key, "s")
        # Few rows: one per busy id and cell. Summed element by element.
        pieces = (
            partial.where("split")
            .select(key, F.posexplode("s").alias("pos", "x"))
            .groupBy(key, "pos")
            .agg(F.sum("x").alias("x"))
            .groupBy(key)
            .agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda c: c["x"]).alias("s"))
        )
        return solved(whole.unionByName(pieces), rank, lam)


class PackedModels:
    """Which sums several models (rank, lam) need of one table of vectors.

    Model m uses the numbers ``starts[m]`` to ``starts[m] + rank``. Models that
    start at one place share the sums of the longest of them: a shorter one
    takes its part of that triangle.
    """

    def __init__(self, models: Sequence[tuple[int, float]], starts: Sequence[int]):
        self.models = list(models)
        longest: dict[int, int] = {}
        for (rank, _), at in zip(models, starts):
            longest[at] = max(rank, longest.get(at, 0))
        self.parts = list(longest.items())
        sizes = [rank * (rank + 1) // 2 + rank for _, rank in self.parts]
        self.width = sum(sizes)
        begin = dict(zip(longest, offsets(sizes)))
        self.columns = []
        for (rank, _), at in zip(models, starts):
            pairs = upper_pairs(longest[at])
            place = {pair: n for n, pair in enumerate(pairs)}
            own = [place[pair] for pair in upper_pairs(rank)] + [len(pairs) + a for a in range(rank)]
            self.columns.append(begin[at] + np.array(own))

    def sums(self, table: np.ndarray, rating: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Packed sums of runs of rows beginning at ``first``; ``table`` holds a row of vectors per rating."""
        out = np.empty((len(first), self.width))
        at = 0
        for begin, rank in self.parts:
            column = [np.ascontiguousarray(table[:, begin + a]) for a in range(rank)]
            for a, b in upper_pairs(rank):
                out[:, at] = np.add.reduceat(column[a] * column[b], first)
                at += 1
            for a in range(rank):
                out[:, at] = np.add.reduceat(rating * column[a], first)
                at += 1
        return out

    def solve(self, packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Solutions of all models in a row, and each model's ``q`` as in ``solved``."""
        found, gains = [], []
        for (rank, lam), own in zip(self.models, self.columns):
            mine = packed[:, own]
            f = solve_packed(mine, rank, lam)
            a, b = map(np.array, zip(*upper_pairs(rank)))
            twice = np.where(a == b, 1.0, 2.0)
            found.append(f)
            gains.append((mine[:, : len(a)] * f[:, a] * f[:, b]) @ twice - 2.0 * np.einsum("nk,nk->n", mine[:, len(a) :], f))
        return np.concatenate(found, axis=1), np.stack(gains, axis=1)


class AlsGrid:
    """Several least-squares models trained in one pass over one layout.

    Vectors of all models lie in a row in ``f``. A half-step sends every cell
    these rows once, adds up the products of each id and solves all models in
    the same task, so packed sums leave a task only for ids cut over several
    cells. In the first half-step all models read the same start vectors:
    the sums of the largest rank serve every rank and every lambda.

    What a task solves is stored once, as part of the next table of vectors; the
    rest are the few ids that are cut over several cells or have no train ratings.
    ``train`` and ``known`` are read several times and should be stored tables.
    """

    def __init__(self, train: DataFrame, known: DataFrame, work: Workspace, cell_rows: int = CELL_ROWS):
        self.work, self.known, self.train = work, known, train.select("user", "item", "rating")
        self.routed = {key: RoutedRatings(self.train, key, work, cell_rows) for key in ("user", "item")}
        row = self.train.agg(F.sum(F.col("rating") * F.col("rating")), F.count("*")).first()
        self.squares, self.n_train = row[0] or 0.0, row[1]
        self.steps = 0
        self.unrated: dict[str, DataFrame] = {}

    def start(self, models: Sequence[tuple[int, float]]) -> None:
        """Begin with new models on the same layout."""
        self.models = list(models)
        self.ranks = [rank for rank, _ in models]
        self.factors, self.starts, self.stored = {}, {}, {"user": None, "item": None}
        for key in ("user", "item"):
            name = f"start-{key}-{max(self.ranks)}"
            self.factors[key] = self.work.write(start_factors(self.known, key, max(self.ranks)), name)
            self.starts[key] = [0] * len(models)

    def half_step(self, key: str) -> None:
        other, routed, models = OTHER[key], self.routed[key], self.models
        packed = PackedModels(models, self.starts[other])
        chunk = max(PACKED_NUMBERS // packed.width, 1)

        def add_up(rows: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
            if rows.empty:
                return pd.DataFrame({key: [], "split": [], "f": [], "q": [], "s": []})
            vectors = vectors.sort_values(other)
            table = np.stack(vectors["f"].to_numpy())
            rows = rows.sort_values([key, other])
            at = np.searchsorted(vectors[other].to_numpy(), rows[other].to_numpy())
            rating, cut = rows["rating"].to_numpy(), rows["split"].to_numpy()
            ids, first = np.unique(rows[key].to_numpy(), return_index=True)
            out = []
            for begin in range(0, len(ids), chunk):
                own = first[begin : begin + chunk]
                span = slice(own[0], first[begin + chunk] if begin + chunk < len(ids) else len(rows))
                sums = packed.sums(table[at[span]], rating[span], own - own[0])
                split = cut[own]
                f, q, s = (np.full(len(own), None, dtype=object) for _ in range(3))
                if not split.all():
                    solutions, gains = packed.solve(sums[~split])
                    f[~split], q[~split] = _objects(solutions), _objects(gains)
                s[split] = _objects(sums[split])
                out.append(pd.DataFrame({key: ids[begin : begin + chunk], "split": split, "f": f, "q": q, "s": s}))
            return pd.concat(out, ignore_index=True)

        self.steps += 1
        sent = routed.needed.join(self.factors[other], other).select("cell", other, "f").repartition(routed.n_cells, "cell")
        done = (
            routed.cells.groupBy("cell")
            .cogroup(sent.groupBy("cell"))
            .applyInPandas(add_up, f"{key} bigint, split boolean, f array<double>, q array<double>, s array<double>")
        )
        partial = self.work.write(done, f"partial-{self.steps}")

        @F.pandas_udf("f array<double>, q array<double>")
        def solve(given: pd.Series) -> pd.DataFrame:
            if not len(given):
                return pd.DataFrame({"f": [], "q": []})
            f, q = packed.solve(np.stack(given.to_numpy()))
            return pd.DataFrame({"f": list(f), "q": list(q)})

        # Few rows: one per busy id and cell. Summed element by element.
        pieces = (
            partial.where("split")
            .select(key, F.posexplode("s").alias("pos", "x"))
            .groupBy(key, "pos")
            .agg(F.sum("x").alias("x"))
            .groupBy(key)
            .agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda c: c["x"]).alias("s"))
            .select(key, solve("s").alias("x"))
            .select(key, "x.f", "x.q")
        )
        before = self.factors[key]
        if key not in self.unrated:
            unrated = before.select(key).join(partial.select(key), key, "left_anti").withColumnRenamed(key, "kept")
            self.unrated[key] = self.work.write(unrated, f"unrated-{key}")
        # Ids without train ratings keep the vectors they had.
        old = F.concat(*[F.slice("f", at + 1, rank) for at, rank in zip(self.starts[key], self.ranks)])
        kept = before.join(self.unrated[key], F.col(key).eqNullSafe(F.col("kept")), "left_semi")
        kept = kept.select(key, old.alias("f"), F.lit(None).cast("array<double>").alias("q"))
        known = F.col(key).isNotNull()
        rest = self.work.write(pieces.where(known).unionByName(kept), f"{key}-{self.steps}")
        table = partial.where(~F.col("split") & known).select(key, "f", "q").unionByName(rest)
        for name in self.stored[key] or []:
            self.work.discard(name)
        self.factors[key], self.stored[key] = table.select(key, "f"), [f"partial-{self.steps}", f"{key}-{self.steps}"]
        self.starts[key], self.last = offsets(self.ranks)[:-1], table

    def train_rmses(self) -> list[float | None]:
        """Train errors after the last half-step, from its sums."""
        if not self.n_train:
            return [None] * len(self.models)
        left = self.last.agg(*[F.coalesce(F.sum(F.col("q")[m]), F.lit(0.0)) for m in range(len(self.models))]).first()
        return [(max(self.squares + x, 0.0) / self.n_train) ** 0.5 for x in left]

    def rmses(self, ratings: DataFrame) -> list[float | None]:
        return list(rmses(ratings, self.factors["user"], self.factors["item"], self.ranks).first())


def _objects(rows: np.ndarray) -> np.ndarray:
    """Rows of a matrix as the elements of an object array."""
    out = np.empty(len(rows), dtype=object)
    for n, row in enumerate(rows):
        out[n] = row
    return out


def train_als_models(
    train: DataFrame,
    test: DataFrame,
    models: Sequence[Sequence[tuple[int, float]]],
    iterations: int,
    work: Workspace,
) -> list[list[tuple[float | None, float | None]]]:
    """Final train and test errors of several passes of models (rank, lam),
    all on one layout of the ratings."""
    if iterations < 1:
        raise ValueError("iterations must be at least 1")
    grid = AlsGrid(train, train.select("user", "item").union(test.select("user", "item")), work)
    checked = work.write(seen_in(test, grid.train, work), "test")
    found = []
    for group in models:
        grid.start(group)
        for _ in range(iterations):
            grid.half_step("user")
            grid.half_step("item")
        found.append(list(zip(grid.train_rmses(), grid.rmses(checked))))
    return found


def keep_unrated(updated: DataFrame, before: DataFrame, key: str) -> DataFrame:
    """Updated vectors with their ``q``; ids that got none keep the vector they had."""
    old = before.select(key, F.col("f").alias("old"))
    return old.join(updated, key, "left").select(key, F.coalesce("f", "old").alias("f"), "q")


class AlsRun:
    """State of a training run: stored ratings and the current factor tables."""

    def __init__(
        self,
        train: DataFrame,
        rank: int,
        lam: float,
        work: Workspace,
        everyone: DataFrame | None = None,
        route: str = "auto",
    ):
        self.rank, self.lam, self.work = rank, lam, work
        self.train = work.write(train.select("user", "item", "rating"), "train")
        self.laid: dict[str, DataFrame] = {}
        known = self.train if everyone is None else everyone
        self.factors = {
            key: work.write(start_factors(known, key, rank), f"{key}-0") for key in ("user", "item")
        }
        self.steps = {"user": 0, "item": 0}
        self.last: DataFrame | None = None
        self.squares: float | None = None
        self.small = {key: fits(table.count(), rank) for key, table in self.factors.items()}
        self.routed: dict[str, RoutedRatings] = {}
        self.route = {key: self._route(OTHER[key], route) for key in ("user", "item")}

    def _route(self, fixed_side: str, route: str) -> str:
        if route != "auto":
            return route
        return "joined" if self.rank <= JOINED_RANK and self.small[fixed_side] else "routed"

    def clustered(self, key: str) -> DataFrame:
        """Train ratings sorted by one side over range partitions, stored once.

        A task then sees few ids with many ratings each, and its partial sums
        shrink to one row per id; the second sort column lets range partitions
        cut through a very busy id.
        """
        if key not in self.laid:
            order = [key, OTHER[key]]
            laid = self.train.repartitionByRange(*order).sortWithinPartitions(*order)
            self.laid[key] = self.work.write(laid, f"train-by-{key}")
        return self.laid[key]

    def half_step(self, key: str) -> None:
        fixed, before = self.factors[OTHER[key]], self.factors[key]
        step = self.steps[key] + 1
        if self.route[key] == "joined":
            fixed = F.broadcast(fixed) if self.small[OTHER[key]] else fixed
            updated = joined_half_step(self.clustered(key), fixed, key, self.rank, self.lam)
        else:
            if key not in self.routed:
                self.routed[key] = RoutedRatings(self.train, key, self.work)
            updated = self.routed[key].half_step(fixed, self.rank, self.lam, f"partial-{key}-{step}")
        stored = self.work.write(keep_unrated(updated, before, key), f"{key}-{step}")
        self.factors[key], self.steps[key], self.last = stored.select(key, "f"), step, stored
        if step > 1:
            self.work.discard(f"{key}-{step - 1}")

    def iterate(self) -> None:
        """One iteration: users first, then items."""
        self.half_step("user")
        self.half_step("item")

    def train_rmse(self) -> float | None:
        """RMSE of the train ratings after the last half-step, from the sums that
        it was solved from: ratings and factors are not joined again."""
        if self.squares is None:
            row = self.train.agg(F.sum(F.col("rating") * F.col("rating")), F.count("*")).first()
            self.squares, self.n_train = row[0] or 0.0, row[1]
        if not self.n_train:
            return None
        left = self.last.agg(F.sum("q")).first()[0] or 0.0
        return (max(self.squares + left, 0.0) / self.n_train) ** 0.5

    def rmse(self, ratings: DataFrame) -> float | None:
        return rmse(ratings, self.factors["user"], self.factors["item"], self.rank).first()["rmse"]


def train_als(
    train: DataFrame,
    rank: int,
    iterations: int,
    lam: float,
    work: Workspace,
    test: DataFrame | None = None,
    route: str = "auto",
) -> tuple[AlsRun, list[tuple[int, float, float | None]]]:
    """Train and return the run with its curve (iteration, train and test RMSE).
    Test rows whose user or item has no train rating are left out."""
    if iterations < 1:
        raise ValueError("iterations must be at least 1")
    everyone = None if test is None else train.select("user", "item").union(test.select("user", "item"))
    run = AlsRun(train, rank, lam, work, everyone, route)
    checked = None if test is None else work.write(seen_in(test, run.train, work), "test")
    curve = []
    for iteration in range(1, iterations + 1):
        run.iterate()
        curve.append((iteration, run.train_rmse(), None if checked is None else run.rmse(checked)))
    return run, curve


def curve_table(spark, curve: list[tuple[int, float, float | None]]) -> DataFrame:
    return spark.createDataFrame(curve, "iteration bigint, train_rmse double, test_rmse double")


def dense_half_step(ratings: DataFrame, fixed: DataFrame, key: str, rank: int, lam: float) -> DataFrame:
    """Half-step where a missing rating counts as 0.

    X'X then covers *all* fixed rows, so one Gram matrix serves every id; the
    ridge is ``lam`` times the number of fixed rows. Only X'r differs per id.
    """
    f = F.col("f")
    gram = fixed.agg(*[F.sum(f[a] * f[b]) for a, b in upper_pairs(rank)], F.count("*")).first()
    shared = F.array(*[F.lit(float(x or 0.0)) for x in gram[:-1]])
    fixed = F.broadcast(fixed) if fits(gram[-1], rank) else fixed
    sums = normal_sums(ratings, fixed, key, rank, gram=False).withColumn("s", F.concat(shared, "s"))
    return solved(sums, rank, lam * gram[-1])


def dense_rmse(ratings: DataFrame, users: DataFrame, items: DataFrame, rank: int) -> float:
    """RMSE over all cells, missing ones counted as 0, without forming them:
    the sum of squared predictions is the inner product of the two Gram
    matrices, and rated cells are corrected."""
    f = F.col("f")
    pairs = upper_pairs(rank)

    def gram(table: DataFrame):
        return table.agg(*[F.sum(f[a] * f[b]) for a, b in pairs], F.count("*")).first()

    gw, gh = gram(users), gram(items)
    weight = [1.0 if a == b else 2.0 for a, b in pairs]
    squares = sum(c * x * y for c, x, y in zip(weight, gw[:-1], gh[:-1]))
    score = dot(F.col("w"), F.col("h"), rank)
    fix = F.pow(F.col("rating") - score, 2) - F.pow(score, 2)
    correction = with_both(ratings, users, items).agg(F.sum(fix).alias("x")).first()["x"] or 0.0
    return ((squares + correction) / (gw[-1] * gh[-1])) ** 0.5
