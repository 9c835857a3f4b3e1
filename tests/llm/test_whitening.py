"""Whitening against exact fractions and against its definition."""

from fractions import Fraction
from math import floor, isfinite, nan

import numpy as np
import pytest

from starloom.llm import whitening
from starloom.llm.queries import op12_polarised_whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x string, whitened string, deviation string"


def exact(vectors):
    """n, sums and covariance of the distinct whole-number vectors, as fractions."""
    x = sorted({tuple(floor(64 * float(np.float32(c))) + 1_000_000 for c in v) for v in vectors})
    n, sums = len(x), [sum(c) for c in zip(*x)]
    centred = [[Fraction(c) - Fraction(s, n) for c, s in zip(v, sums)] for v in x]
    d = len(sums)
    return x, n, sums, [[sum(v[i] * v[j] for v in centred) / n for j in range(d)] for i in range(d)]


@pytest.fixture
def rows():
    rng = np.random.default_rng(6)
    base = rng.normal(size=(90, 20)) @ rng.normal(size=(20, 20)) + rng.normal(size=20) * 50
    rows = [(i, [float(c) for c in v], 1) for i, v in enumerate(base)]
    rows += [(7, rows[7][1], 2), (None, rows[8][1], None), (500, rows[9][1], 1)] + [(600 + i, rows[3][1], 1) for i in range(30)]
    odd = [None, [], [nan] * 20, [None] + [0.0] * 19, [float("inf")] * 20, [1.0] * 19]
    return rows, rows + [(900 + i, v, 1) for i, v in enumerate(odd)]


def stored(spark, rows, path):
    spark.createDataFrame([(*r, "own", "own", "own") for r in rows], SCHEMA).write.parquet(f"{path}/embeddings.parquet")
    return str(path)


def test_query_equals_definition(spark, rows, tmp_path):
    good, all_rows = rows
    got = op12_polarised_whitening(spark, stored(spark, all_rows, tmp_path)).toPandas()
    _, n, sums, v = exact([r[1] for r in good])
    v = np.array([[float(c) for c in row] for row in v])
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1][:16], axes[:, ::-1][:, :16]
    assert len(got) == 16 * len(good) and set(got.n) == {n} and got.identity_error.max() < 1e-9
    signs = {}
    for vec_id, vector, _ in good:
        mine = got[got.vec_id.isna() if vec_id is None else got.vec_id == vec_id]
        x = [floor(64 * float(np.float32(c))) + 1_000_000 for c in vector]
        assert set(mine.deviation) == {sum((n * c - s) ** 2 for c, s in zip(x, sums))}
        want = np.array([float(Fraction(c) - Fraction(s, n)) for c, s in zip(x, sums)]) @ axes / np.sqrt(values)
        for c, w, e in zip(mine.component, mine.whitened, mine.explained):
            sign = signs.setdefault(c, np.sign(w * want[c - 1]))
            assert w == pytest.approx(sign * want[c - 1], rel=1e-7, abs=1e-7)
            assert e == pytest.approx(values[c - 1] / np.trace(v), rel=1e-9)


def test_squares_give_the_exact_covariance():
    rng = np.random.default_rng(7)
    for big in (1, 10**9):
        z = rng.integers(-50, 50, (40, 5)) * big
        rest = z.sum(axis=0, dtype=object).tolist()
        got = whitening.covariance(40, rest, whitening.square_sums(z))
        mean = [Fraction(s, 40) for s in rest]
        for i in range(5):
            for j in range(5):
                want = sum((Fraction(int(r[i])) - mean[i]) * (Fraction(int(r[j])) - mean[j]) for r in z) / 40
                assert got[i, j] == float(want)


def test_small_variance_beside_a_large_one(spark, work):
    rng = np.random.default_rng(8)
    scale = np.array([1e6, 1e3, 1.0, 1.0])
    rows = [(i, [float(c) for c in rng.normal(size=4) * scale], 1, "", "", "") for i in range(400)]
    found, model = whitening.whiten(spark.createDataFrame(rows, SCHEMA), work)
    assert found.columns[-2:] == ["_deviation", "_whitened"] and len(model.values) == 4
    assert model.identity_error < 1e-4
    white = np.array([r["_whitened"] for r in found.toPandas().to_dict("records")])
    assert np.abs(np.cov(white.T, bias=True) - np.eye(4)).max() < 1e-4


@pytest.mark.parametrize("vectors", [[], [None], [[1.0, 2.0]], [[1.0, 2.0]] * 5])
def test_tables_without_spread(spark, tmp_path, vectors):
    path = stored(spark, [(i, v, 1) for i, v in enumerate(vectors)], tmp_path)
    frame = op12_polarised_whitening(spark, path)
    assert frame.columns[:2] == ["vec_id", "component"] and frame.count() == 0


def test_huge_entries_and_few_components(spark, tmp_path):
    path = stored(spark,
                  [(1, [1e30, 0.0], 1), (2, [-1e30, 0.0], 1), (3, [0.0, 0.0], 1)], tmp_path)
    got = op12_polarised_whitening(spark, path).collect()
    assert [(r["component"], r["n"]) for r in got] == [(1, 3)] * 3
    assert {r["deviation"] for r in got if r["vec_id"] != 3} == {None}
    assert all(isfinite(r["whitened"]) for r in got)
