"""Rounds of the component search end with the stars, and near copies keep every link."""

from pyspark.sql import functions as F

from starloom.llm import common, hamming
from starloom.sources.workspace import Workspace


def test_stars_need_no_round(spark, tmp_path):
    work = Workspace(spark, "stars")
    edges = spark.createDataFrame([(1, 5), (1, 7), (2, 9), (9, 2), (4, 4), (None, 3)], "a long, b long")
    found = common.components(edges, work, "x")
    assert {tuple(r) for r in found.collect()} == {(1, 1), (5, 1), (7, 1), (2, 2), (9, 2)}
    # A round would have stored its large step, then its small one and taken the first table away.
    assert spark.read.parquet(work.path("x-0")).count() == 3


def test_chains_and_joined_stars(spark):
    chain = [(i, i + 1) for i in range(100, 140)] + [(1, 9), (2, 9), (2, 8)]
    found = common.components(spark.createDataFrame(chain, "a long, b long"), Workspace(spark, "chain"), "x")
    assert {tuple(r) for r in found.collect()} == {(i, 100) for i in range(100, 141)} | {(i, 1) for i in (1, 2, 8, 9)}


def test_links_missed_by_proposals_join_roots(spark):
    """Pairs propose 1-2 and 2-3 and 2-4; only 1-3 and 2-4 are links, so two roots meet in one family."""
    work = Workspace(spark, "across")
    near = list(range(100))
    values = {1: near, 2: list(range(500, 600)), 3: near[:95], 4: list(range(500, 599)), 5: list(range(900, 910))}
    sets = spark.createDataFrame([(v, len(x), x) for v, x in values.items()], "v long, n long, values array<bigint>")
    pairs = spark.createDataFrame([(1, 2), (2, 3), (2, 4)], "a long, b long")
    roots = spark.createDataFrame([(2, 2), (4, 2)], "node long, root long")
    assert {tuple(r) for r in hamming.between_roots(pairs, roots).collect()} == {(1, 2), (2, 3)}
    more = hamming.across(pairs, roots, sets, 80, work)
    assert {(min(r["a"], r["b"]), max(r["a"], r["b"])) for r in more.collect()} == {(1, 3)}
