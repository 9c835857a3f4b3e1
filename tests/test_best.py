"""Exact top-N lists and what they leave out."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.operators import best, blocks
from starloom.sources.workspace import Workspace


def frame(spark, key, vectors):
    return spark.createDataFrame([(k, [float(x) for x in v]) for k, v in vectors.items()], f"{key} long, f array<double>")


def direct(w, h, n, skip=()):
    out = {}
    for u, x in w.items():
        scored = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in h.items() if (u, i) not in skip)
        out[u] = [i for s, i in scored if np.isfinite(s)][:n]
    return out


def lists(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["user"], r["rank"])):
        out.setdefault(r["user"], []).append(r["item"])
    return out


@pytest.fixture
def tables():
    """Item lengths of a long tail, equal vectors, zero vectors, negative scores."""
    rng = np.random.default_rng(11)
    h = {i * 7 % 1009: rng.normal(size=3) * 50 / (1 + k) for k, i in enumerate(range(300))}
    keys = list(h)
    for a, b in zip(keys[5:40:5], keys[100:107]):
        h[b] = h[a]
    h[2000], h[2001], h[2002] = np.zeros(3), np.full(3, np.nan), np.array([np.inf, 0, 0])
    w = {u: rng.normal(size=3) for u in range(40)} | {77: np.zeros(3), 78: np.full(3, np.nan), 79: -np.abs(rng.normal(size=3))}
    return w, h


@pytest.mark.parametrize("budget", [0, 1 << 20])
def test_lists_equal_sorting(spark, work, monkeypatch, tables, budget):
    monkeypatch.setattr(blocks, "ROW_BLOCK", 8)
    monkeypatch.setattr(blocks, "COL_BLOCK", 16)
    monkeypatch.setattr(blocks, "BROADCAST_BYTES", budget)
    w, h = tables
    fine = {i: v for i, v in h.items() if np.isfinite(v).all()}
    users, items = frame(spark, "user", w), frame(spark, "item", h)
    want = direct(w, fine, 5)
    want.pop(78)
    want.pop(79, None) if not want[79] else None
    assert lists(best.top_n_per_user(users, items, 3, 5, work)) == {u: x for u, x in want.items() if x}
    rated = [(u, i) for u in w for i in want.get(u, [])[:3]] + [(3, i) for i in h if i != 2000] + [(0, 424242), (999, 0)]
    rated += rated[:50]
    table = spark.createDataFrame(rated, "user long, item long")
    got = lists(best.top_n_per_user(users, items, 3, 5, Workspace(spark, "rated"), table))
    again = direct(w, fine, 5, set(rated))
    again.pop(78)
    assert got == {u: x for u, x in again.items() if x} and got[3] == [2000]


@pytest.mark.parametrize("budget", [0, 1 << 20])
def test_short_vectors_are_skipped(spark, work, monkeypatch, budget):
    monkeypatch.setattr(blocks, "ROW_BLOCK", 10)
    monkeypatch.setattr(blocks, "COL_BLOCK", 20)
    monkeypatch.setattr(blocks, "BROADCAST_BYTES", budget)
    rng = np.random.default_rng(12)
    h = {i: np.abs(rng.normal(size=4)) * (100.0 if i % 25 == 0 else 1.0) for i in range(1000)}
    w = {u: np.abs(rng.normal(size=4)) + 0.2 for u in range(20)}
    found, _, cols, _, length = best.found_first(frame(spark, "user", w), frame(spark, "item", h), 4, 6, work)
    assert cols.count() == 50
    seen = found.groupBy("r_block").agg(F.max("products").alias("p"), F.max("next").alias("next")).collect()
    # Forty long vectors fill two blocks of fifty; nothing behind them is multiplied or shuffled.
    assert all(r["p"] <= 3 and r["next"] <= max(3, length) for r in seen)
    assert lists(best.top_n_per_user(frame(spark, "user", w), frame(spark, "item", h), 4, 6, Workspace(spark, "all"))) == direct(w, h, 6)


def test_user_with_a_million_ratings(spark, work):
    n = 1_000_100
    items = spark.range(n).select(F.col("id").alias("item"), F.array((F.col("id") + 1) / n, F.lit(0.5)).alias("f"))
    users = spark.createDataFrame([(1, [1.0, 0.0]), (2, [-1.0, 0.0])], "user long, f array<double>")
    rated = spark.range(100, n).select(F.lit(1).cast("bigint").alias("user"), F.col("id").alias("item"))
    got = best.top_n_per_user(users, items, 2, 3, work, rated)
    assert lists(got) == {1: [99, 98, 97], 2: [0, 1, 2]}
    assert "map<" not in got._jdf.queryExecution().toString().lower()


def test_delta_codes_round_trip():
    rng = np.random.default_rng(3)
    for top in (10, 1000, 10**6, 2**31 - 1):
        cells = np.unique(rng.integers(0, top, 50))
        assert best.delta_decoded(*best.delta_coded(cells)).tolist() == cells.tolist()
    assert len(best.delta_decoded(*best.delta_coded(np.zeros(0, np.int64)))) == 0
