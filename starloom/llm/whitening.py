"""Whitening of vectors by an exact covariance from squares alone.

Entries become whole numbers x, and each distinct vector x counts once. With
z = x less the nearest whole number to its mean, one pass adds up the squares of
every dimension and of the sum of every pair of dimensions, exactly, in whole
numbers. What the whole-number centre leaves of the mean is taken out on exact
totals, which gives n^2 Var(i) and n^2 Var(i + j); half of Var(i + j) - Var(i) -
Var(j) is the covariance. No product of two different dimensions is formed and
nothing is rounded before the matrix goes to ``eigh``.

Tasks send one sum per dimension or pair (d (d + 1) / 2 rows for d dimensions),
added up before and after the shuffle; the driver holds that many numbers and
the d x d matrix, whatever the number of vectors. Vectors are shuffled once, to
find the distinct ones, summed per task first, so a vector with many copies
is no hot group.

Defined results: rows with a null vector, an empty one, or one with null or
non-finite entries are dropped; so are rows whose vectors are not as wide as
most of the others (ties: the wider). 64 c is held within +-2^52. Components
whose eigenvalue is not above d x 2^-52 times the largest have no scale and are
left out, so equal vectors, a single one, or an empty table give no components.
Repeated rows and null ids are rows like others. A deviation beyond a 64-bit
number is null. Other columns stay, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructType

from starloom.llm.common import free_name, frugal
from starloom.sources.workspace import Workspace

SCALE = 64
SHIFT = 1_000_000
MOST = float(1 << 52)
COMPONENTS = 16
# Rows per step: below 2^24 the squares of pair sums add up within 64 bits.
STEP = 4096
SMALL = 1 << 24


class Model(NamedTuple):
    """What whitening needs: all of it is as large as d x components."""

    n: int
    centre: np.ndarray  # whole numbers next to the means
    rest: np.ndarray  # sum of x - centre per dimension, whole numbers
    vectors: np.ndarray  # d x components, unit columns
    values: np.ndarray  # eigenvalues of the components, falling
    explained: np.ndarray
    identity_error: float


def usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & fine, F.lit(False))


def whole(vector: Column) -> Column:
    """The vector's entries as whole numbers."""
    held = lambda c: F.greatest(F.least(c.cast("double") * SCALE, F.lit(MOST)), F.lit(-MOST))
    return F.transform(vector, lambda c: F.floor(held(c)) + SHIFT)


def matrix(column: pa.ListArray) -> np.ndarray:
    """A batch of equally wide vectors, one per row."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def square_sums(z: np.ndarray) -> list[int]:
    """Sums of z_i^2 and, for i < j, of (z_i + z_j)^2, row by row of the triangle, exactly."""
    if len(z) and np.abs(z).max() >= SMALL:
        z = z.astype(object)
    total = []
    for i in range(z.shape[1]):
        pair = z[:, i:] + z[:, i, None]
        pair[:, 0] = z[:, i]
        total += (pair * pair).sum(axis=0).tolist()
    return total


def whole_sums(vectors: DataFrame, width: int, sums: Callable[[np.ndarray], list[int]]) -> list[int]:
    """Sums over all vectors of what ``sums`` gives for a few of them, exact."""
    kind = pa.decimal128(38)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                x = matrix(batch.column("x").slice(at, STEP))
                found = sums(x)
                total = found if total is None else [a + b for a, b in zip(total, found)]
        if total is not None:
            place = pa.array(range(len(total)), pa.int32())
            yield pa.record_batch([place, pa.array([str(v) for v in total]).cast(kind)], names=["place", "v"])

    found = vectors.select("x").mapInArrow(frugal(work), "place int, v decimal(38,0)").groupBy("place").agg(F.sum("v").alias("v"))
    return [int(r["v"]) for r in sorted(found.collect(), key=lambda r: r["place"])]


def covariance(n: int, rest: list[int], squares: list[int]) -> np.ndarray:
    """The covariance, each entry rounded once, from sums of whole numbers."""
    d = len(rest)
    at = np.cumsum([0, *range(d, 0, -1)]).tolist()
    variance = [n * squares[at[i]] - rest[i] ** 2 for i in range(d)]
    out = np.zeros((d, d))
    for i in range(d):
        out[i, i] = variance[i] / n**2
        for j in range(i + 1, d):
            both = n * squares[at[i] + j - i] - (rest[i] + rest[j]) ** 2
            out[i, j] = out[j, i] = (both - variance[i] - variance[j]) / (2 * n**2)
    return out


def components(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of a covariance.

    A second turn, of the matrix in the first one's axes, corrects small
    eigenvalues beside very large ones. Each vector's largest entry is positive.
    """
    _, turn = np.linalg.eigh(v)
    exact = turn.astype(np.longdouble)
    turned = (exact.T @ v.astype(np.longdouble) @ exact).astype(np.float64)
    values, again = np.linalg.eigh((turned + turned.T) / 2)
    vectors = np.linalg.qr(turn @ again)[0]
    vectors = vectors * np.sign((vectors * (turn @ again)).sum(axis=0))
    vectors, values = vectors[:, ::-1], values[::-1]
    return values, vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(v))])


def projected(z: np.ndarray, model: Model) -> np.ndarray:
    """Whitened rows from x less the whole-number centre."""
    return (z - model.rest / model.n) @ model.vectors / np.sqrt(model.values)


def fit(vectors: DataFrame, width: int, work: Workspace, most: int = COMPONENTS) -> Model | None:
    """The whitening of the distinct vectors of ``vectors(x)``, all ``width`` wide; None without any."""
    distinct = work.write(vectors.select("x").distinct(), "distinct")
    n = distinct.count()
    if not n:
        return None
    sums = whole_sums(distinct, width, lambda x: x.sum(axis=0, dtype=object).tolist())
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    rest = [s - n * int(c) for s, c in zip(sums, centre)]
    v = covariance(n, rest, whole_sums(distinct, width, lambda x: square_sums(x - centre)))
    values, axes = components(v)
    real = values > width * 2.0**-52 * max(values[0], 0.0)
    k = min(most, int(real.sum()))
    model = Model(n, centre, np.array(rest, np.float64), axes[:, :k], values[:k], values[:k] / np.trace(v) if k else values[:0], 0.0)
    return model._replace(identity_error=identity_error(distinct, model)) if k else model


def identity_error(distinct: DataFrame, model: Model) -> float:
    """The largest entry by which the whitened vectors' covariance differs from the identity."""
    k = len(model.values)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            if batch.num_rows:
                white = projected(matrix(batch.column("x")) - model.centre, model)
                once += white.sum(axis=0)
                twice += white.T @ white
        values = np.concatenate((once, twice.ravel()))
        yield pa.record_batch([pa.array(range(len(values)), pa.int32()), pa.array(values)], names=["place", "v"])

    found = distinct.mapInArrow(frugal(work), "place int, v double").groupBy("place").agg(F.sum("v").alias("v")).collect()
    total = np.array([r["v"] for r in sorted(found, key=lambda r: r["place"])]) / model.n
    mean, twice = total[:k], total[k:].reshape(k, k)
    return float(np.abs(twice - np.outer(mean, mean) - np.eye(k)).max())


def whiten(rows: DataFrame, work: Workspace, vector: str = "embedding", most: int = COMPONENTS) -> tuple[DataFrame, Model | None]:
    """The usable rows with deviation and whitened (one value per component), and the fitted model.

    ``deviation`` is the sum over dimensions of (n x - S)^2, S being the sum of
    the distinct vectors. Names that ``rows`` has already get underscores in front.
    """
    x = free_name(rows, "x")
    sized = work.write(rows.filter(usable(F.col(vector))).withColumn(x, whole(F.col(vector))), "whole")
    widths = sized.groupBy(F.size(x).alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    width = widths["width"] if widths else 0
    fitting = sized.filter(F.size(x) == width)
    model = fit(fitting.select(F.col(x).alias("x")), width, work, most)
    schema = StructType([*rows.schema.fields])
    schema.add(free_name(rows, "deviation"), LongType()).add(free_name(rows, "whitened"), ArrayType(DoubleType()))
    names = schema.names

    def deviations(z: np.ndarray) -> list[int | None]:
        far = max(int(np.abs(z).max()), 1) * model.n * 2
        if far * far * z.shape[1] < 1 << 62:
            y = z * model.n - model.rest.astype(np.int64)
            return (y * y).sum(axis=1).tolist()
        y = z.astype(object) * model.n - np.array([int(r) for r in model.rest], object)
        return [v if v < 1 << 63 else None for v in (y * y).sum(axis=1).tolist()]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.values)
        for batch in batches:
            if not batch.num_rows:
                continue
            z = matrix(batch.column(batch.num_columns - 1)) - model.centre
            white = projected(z, model)
            cuts = pa.array(np.arange(len(z) + 1, dtype=np.int32) * k)
            yield pa.record_batch(
                [*batch.columns[:-1], pa.array(deviations(z), pa.int64()), pa.ListArray.from_arrays(cuts, white.ravel())],
                names=names,
            )

    if model is None:
        return rows.sparkSession.createDataFrame([], schema), None
    return fitting.mapInArrow(frugal(apply), schema), model
