"""Steps whose shuffles, memory or tasks must not grow faster than their input."""

import math
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.operators import als, blocks, content, dsgd, factors, gradient
from starloom.plans import queries
from starloom.sources import readers
from starloom.sources.workspace import Workspace
from starloom.streaming import ratings


def pairs(n=400):
    return [(7 * i % 31, 11 * i % 53, (i % 10 + 1) / 2) for i in range(n)]


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange ") - plan.count("BroadcastExchange ")


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_given_ratings_are_evaluated_once(spark, work, rating_table):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(r):
        seen.add(1)
        return r

    table = rating_table(sorted(set(pairs()))).withColumn("rating", counted("rating"))
    gradient.train_gradient(table, 2, 0.01, 0.5, 2, work)
    assert seen.value == len(set(pairs()))


@pytest.mark.parametrize("key", ["user", "item"])
def test_gradient_sums_shuffle_the_ratings_once(spark, work, rating_table, no_broadcast, key):
    data = gradient.CentredRatings(rating_table(pairs()), work)
    current = {k: work.write(factors.start_factors(data.by(k), k, 2), f"{k}-0") for k in ("user", "item")}
    other = {"user": "item", "item": "user"}[key]
    sums = gradient.gradient_sums(data.by(other), current["user"], current["item"], key, 2)
    assert exchanges(sums) == 3  # the ratings with one vector, and both vector tables
    both = data.by(key).join(current["user"].withColumnRenamed("f", "w"), "user").join(
        current["item"].withColumnRenamed("f", "h"), "item"
    )
    want = {}
    for r in both.collect():
        error = r["rating"] - sum(a * b for a, b in zip(r["w"], r["h"]))
        theirs = r["h"] if key == "user" else r["w"]
        g = want.setdefault(r[key], [0.0, 0.0, 0.0])
        for at, x in enumerate((error * theirs[0], error * theirs[1], error * error)):
            g[at] += x
    got = {r[key]: [r["g0"], r["g1"], r["sse"]] for r in sums.collect()}
    assert set(got) == set(want)
    assert all(got[k] == pytest.approx(want[k]) for k in want)


@pytest.mark.parametrize("by", ["user", "item"])
def test_bias_travels_with_a_vector(spark, work, rating_table, no_broadcast, by):
    table = work.write(rating_table([(1, 1, 4), (1, 2, 2), (2, 1, 1), (None, 1, 5)]), "table")
    users = work.write(spark.createDataFrame([(1, [0.5]), (2, [9.0]), (3, [1.0])], "user long, f array<double>"), "users")
    items = work.write(spark.createDataFrame([(1, [1.0]), (2, [1.0])], "item long, f array<double>"), "items")
    bias = work.write(gradient.biases(table.where("user = 1"), by), "bias")
    asked = work.write(spark.createDataFrame([(1, 1), (1, 2), (2, 1), (2, 2), (3, 1), (4, 1)], "user long, item long"), "asked")
    scores = gradient.predict_with_bias(asked, users, items, bias, 1, by)
    assert exchanges(scores) <= 5  # was 6: all pairs were shuffled for the bias, too
    got = {(r["user"], r["item"]): r["score"] for r in scores.collect()}
    shift = {"user": lambda u, i: 3.0 if u == 1 else 0.0, "item": lambda u, i: {1: 4.0, 2: 2.0}[i]}[by]
    vector = {1: 0.5, 2: 9.0, 3: 1.0}
    assert got == {(u, i): min(max(vector[u] + shift(u, i), 0.5), 5.0) for u, i in [(1, 1), (1, 2), (2, 1), (2, 2), (3, 1)]}


def test_cells_hold_a_bounded_number_of_ratings(spark, work):
    table = spark.range(3_000_000).select(
        (F.col("id") % 50_021).alias("user"), (F.col("id") % 7_919).alias("item"), F.lit(1.0).alias("rating")
    )
    routed = als.RoutedRatings(work.write(table, "table"), "user", work)
    assert routed.cells.groupBy("cell").count().agg(F.max("count")).first()[0] < 300_000


def test_large_pair_files_get_more_tasks(spark, work):
    spark.range(60).select(F.col("id") + 1, F.col("id") % 7 + 1).repartition(40).write.csv(work.path("pairs"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10")
    try:
        pairs = readers.read_implicit_pairs(spark, work.path("pairs"), partitions=8)
        assert pairs.rdd.getNumPartitions() > 40
        assert sorted(map(tuple, pairs.collect())) == [(i, i % 7) for i in range(60)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def weights(spark, rows, work):
    table = spark.createDataFrame(rows, "id long, text string")
    return {(r["id"], r["token"]): r["weight"] for r in content.tfidf_weights(table, work).collect()}


def test_tokens_are_counted_in_their_row(spark, work):
    texts = work.write(spark.createDataFrame([(1, "red Red nut"), (2, "nut"), (3, ""), (4, None)], "id long, text string"), "texts")
    got = content.tfidf_weights(texts, work)
    assert exchanges(got) == 1  # was 2: counts and vectors were shuffled by text
    red, nut = 2 * (math.log(5 / 2) + 1), math.log(5 / 3) + 1
    length = math.hypot(red, nut)
    want = {(1, "red"): red / length, (1, "nut"): nut / length, (2, "nut"): 1.0}
    assert {(r["id"], r["token"]): r["weight"] for r in got.collect()} == pytest.approx(want)


def test_rows_of_one_id_are_one_text(spark, work):
    rows = [(1, "aa bb"), (1, "aa cc"), (None, "aa"), (None, "bb bb"), (2, "dd"), (3, None)]
    whole = [(1, "aa bb aa cc"), (None, "aa bb bb"), (2, "dd"), (3, None), (4, ""), (5, "")]
    got, want = weights(spark, rows, work), weights(spark, whole, Workspace(spark, "whole"))
    assert got == pytest.approx(want) and (None, "bb") in got


def test_dsgd_moves_ratings_in_packs(spark, rating_table, monkeypatch):
    rows = sorted(set(pairs()))
    table, found = rating_table(rows), []
    for size, ids in ((1 << 15, 1 << 13), (7, 3)):
        monkeypatch.setattr(dsgd, "PACK", size)
        monkeypatch.setattr(dsgd, "PACK_IDS", ids)
        run = dsgd.DsgdRun(table, 2, 0.05, Workspace(spark, "packs"), 2, variant="weighted", more=[(3, 0.1)])
        assert run.packs.count() <= -(-len(rows) // size) + 4  # whole packs and the last of each of four blocks
        assert run.user.count() <= -(-run.n["user"] // ids) + 2
        assert run.laid.select("user", "item", "rating").subtract(run.train.select("user", "item", "rating")).isEmpty()
        sse, n = run.epoch([0.02, 0.03])
        assert n == len(rows) == run.laid.count()
        vectors = [{r[key]: list(r["f"]) for r in run.factors(key, m).collect()} for key in ("user", "item") for m in (0, 1)]
        found.append((sse, *run.rmses(run.packs), *run.rmses(run.train)))
        for m in (0, 1):
            w, h = vectors[m], vectors[2 + m]
            errors = [(r - sum(a * b for a, b in zip(w[u], h[i]))) ** 2 for u, i, r in rows]
            assert found[-1][1 + m] == pytest.approx(math.sqrt(sum(errors) / len(errors)))
    assert found[0] == pytest.approx(found[1])


def test_dsgd_errors_leave_out_null_ratings(spark, work):
    schema = "user bigint, item bigint, rating double, ts bigint"
    train = spark.createDataFrame([(u, i, 3.0, 0) for u in range(4) for i in range(4)], schema)
    run = dsgd.DsgdRun(train, 2, 0.05, work, 2)
    test = [(1, 1, 4.0, 0), (1, 2, None, 0), (2, 2, 1.0, 0)]
    known = run.rmse(run.dense(spark.createDataFrame([r for r in test if r[2] is not None], schema)))
    assert run.rmse(run.dense(spark.createDataFrame(test, schema))) == pytest.approx(known)
    assert run.rmse(run.dense(spark.createDataFrame([], schema))) is None


def test_dsgd_stores_null_where_a_null_rating_was_trained(spark, work):
    rows = [(1, 1, None, 0), (2, 2, 4.0, 0), (3, 3, 2.0, 0), (3, 1, 3.0, 1)]
    run = dsgd.DsgdRun(spark.createDataFrame(rows, "user bigint, item bigint, rating double, ts bigint"), 2, 0.05, work, 1)
    run.epoch(0.02)
    w, h = ({r[key]: list(r["f"]) for r in run.factors(key).collect()} for key in ("user", "item"))
    assert w[1] == h[1] == w[3] == [None, None] and None not in w[2] + h[2] + h[3]
    assert run.rmse(run.packs) == pytest.approx(abs(4 - w[2][0] * h[2][0] - w[2][1] * h[2][1]))


def test_stored_ratings_are_not_shuffled_for_a_batch(spark, work, no_broadcast):
    names = "event_id long, user long, item long, rating double, ts timestamp"
    rows = [(i, i % 50, i % 37, (i % 10 + 1) / 2, datetime(2024, 1, 1 + i % 28)) for i in range(2000)]
    base = spark.createDataFrame(rows[:1500], names)
    ledger = ratings.RatingLedger.begin(base, work.path("ledger"))
    batch = spark.createDataFrame(rows[1500:] + rows[:20], names)
    plan = ledger.known(batch, 0, 1)._jdf.queryExecution().executedPlan().toString()
    scan = plan[: plan.index("Bucketed: true")].splitlines()[-1]
    above = plan[: plan.index(scan)].splitlines()
    joins = [n for n, line in enumerate(above) if "ShuffledHashJoin" in line]
    assert joins and not any("Exchange" in line or "Sort " in line for line in above[joins[-1] :])
    # The same rows as without the buckets.
    plain = ratings.RatingLedger(spark, work.path("ledger"))
    assert sorted(ledger.known(batch, 0, 1).collect()) == sorted(plain.known(batch, 0, 1).collect())
    assert ledger.known(batch, 0, 1).count() == batch.join(base, ["user", "item"], "left_semi").select("user", "item").distinct().count()


@pytest.mark.parametrize("include_self", [False, True])
def test_vectors_meet_in_rounds_without_a_shuffle(spark, work, monkeypatch, include_self):
    rng = np.random.default_rng(5)
    table = np.round(rng.normal(size=(200, 3)), 1)
    table[7], table[9], table[11] = table[3], table[3], 0.0
    vectors = spark.createDataFrame([(7 * i, x.tolist()) for i, x in enumerate(table)], "id long, f array<double>")
    unit = table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-300)
    scores = np.round(unit @ unit.T, 6)
    want = set()
    for i in range(200):
        others = sorted((-scores[i, j], 7 * j) for j in range(200) if include_self or j != i)
        want |= {(7 * i, j, k + 1) for k, (_, j) in enumerate(others[:4])}
    monkeypatch.setattr(blocks, "ROW_BLOCK", 10)
    monkeypatch.setattr(blocks, "BROADCAST_BYTES", 2_000)  # was a shuffle of every block to every other one
    found = blocks.top_cosine(vectors, 3, 4, work, include_self=include_self)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInPandas best") == 1 and "SortMergeJoin" not in plan
    assert exchanges(found) == 1  # the best of the last round and those of the others
    rounds = [r for r in range(1, 9) if spark.sparkContext._jvm.java.io.File(work.path(f"round-{r}")).exists()]
    assert rounds == [1, 2, 3]
    stored = sum(spark.read.parquet(work.path(f"round-{r}")).select(F.sum(F.size("id"))).first()[0] for r in rounds)
    assert stored < 3 * 200 * 4  # later rounds begin with the floors of earlier ones
    got = [tuple(r) for r in found.select("id", "other", "rank").collect()]
    assert len(got) == len(want) and set(got) == want


def test_solved_vectors_of_a_grid_are_stored_once(spark, work, rating_table):
    train = work.write(rating_table(sorted(set(pairs()))).drop("ts"), "table")
    known = work.write(train.select("user", "item").union(spark.createDataFrame([(99, 1)], "user long, item long")), "all")
    grid = als.AlsGrid(train, known, work)
    grid.start([(2, 0.1), (3, 0.5)])
    first = {r["user"]: list(r["f"]) for r in grid.factors["user"].collect()}
    for key in ("user", "item", "user", "item"):
        grid.half_step(key)
    stored = [r["user"] for r in spark.read.parquet(work.path("user-3")).collect()]
    assert stored == [99]  # was a second copy of every vector, from a join with those before
    users = {r["user"]: list(r["f"]) for r in grid.factors["user"].collect()}
    assert set(users) == set(first) and users[99] == first[99][:2] + first[99][:3]
    for m, (rank, lam) in enumerate([(2, 0.1), (3, 0.5)]):
        run, curve = als.train_als(train, rank, 2, lam, Workspace(spark, "alone"))
        alone = {r["user"]: list(r["f"]) for r in run.factors["user"].collect()}
        at = slice(0, 2) if m == 0 else slice(2, 5)
        assert all(users[u][at] == pytest.approx(alone[u], rel=1e-6, abs=1e-9) for u in alone)
        assert grid.train_rmses()[m] == pytest.approx(curve[-1][1])


def test_predictions_meet_in_rounds_without_a_shuffle(spark, work, monkeypatch):
    rng = np.random.default_rng(6)
    w, h = rng.normal(size=(50, 3)), rng.normal(size=(70, 3))
    users = spark.createDataFrame([(2 * k, x.tolist()) for k, x in enumerate(w)], "user long, f array<double>")
    items = spark.createDataFrame([(3 * k, x.tolist()) for k, x in enumerate(h)], "item long, f array<double>")
    monkeypatch.setattr(blocks, "ROW_BLOCK", 8)
    monkeypatch.setattr(blocks, "COL_BLOCK", 10)
    monkeypatch.setattr(blocks, "BROADCAST_BYTES", 700)  # was a shuffle of every block to every other one
    found = blocks.all_predictions(users, items, 3, work)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInPandas multiply") == 4 and "SortMergeJoin" not in plan
    got = {(r["user"], r["item"]): r["predict"] for r in found.collect()}
    want = w @ h.T
    assert len(got) == found.count() == 50 * 70
    assert all(got[2 * a, 3 * b] == pytest.approx(want[a, b]) for a in range(50) for b in range(70))


def test_spark_als_keeps_its_tables_off_the_heap(spark, tmp_path):
    rows = [(n, 7 * n % 31, 11 * n % 53, 1 + n % 50) for n in range(400)]
    lines = spark.createDataFrame([(n, i, 1, float(q)) for n, _, i, q in rows], "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double")
    lines.withColumn("l_shipdate", F.to_date(F.lit("2024-01-01"))).write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = spark.createDataFrame([(n, u) for n, u, _, _ in rows], "o_orderkey long, o_custkey long")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    before = set(spark.sparkContext._jsc.getPersistentRDDs())
    result = queries.QUERIES["mllib_als"](spark, str(tmp_path))
    kept = spark.sparkContext._jsc.getPersistentRDDs()
    levels = [kept[k].getStorageLevel() for k in kept if k not in before]
    assert len(levels) >= 2  # the vectors of both sides
    assert all(level.useDisk() and not level.useMemory() for level in levels)
    assert result.first()["n"] == len({(u, i) for _, u, i, _ in rows})
