"""Training operators against plain NumPy, one rating at a time."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from starloom.functions.hashing import unit_vector
from starloom.operators import als, dsgd, factors, gradient
from starloom.plans.training import Settings, fit, full_grid, passes
from starloom.sources.workspace import Workspace

RANK = 3


def triples(n_users=12, n_items=9, share=0.5, seed=1):
    rng = np.random.default_rng(seed)
    cells = [(u * 3 - 5, i * 7 + 2) for u in range(n_users) for i in range(n_items) if rng.random() < share]
    return [(u, i, rng.integers(1, 11) / 2) for u, i in cells]


def collected(table, key):
    return {r[key]: np.array(r["f"]) for r in table.collect()}


def start(ratings, key, rank=RANK):
    return collected(factors.start_factors(ratings, key, rank), key)


def als_by_hand(rows, w, h, lam, iterations, rank=RANK):
    w, h = dict(w), dict(h)
    for _ in range(iterations):
        for mine, fixed, at, other in ((w, h, 0, 1), (h, w, 1, 0)):
            for key in mine:
                own = [r for r in rows if r[at] == key]
                if own:
                    x = np.array([fixed[r[other]] for r in own])
                    y = np.array([r[2] for r in own])
                    mine[key] = np.linalg.solve(x.T @ x + lam * np.eye(rank), x.T @ y)
    return w, h


@pytest.mark.parametrize("route", ["joined", "routed"])
def test_als_equals_numpy(spark, work, rating_table, route):
    rows = triples()
    table = rating_table(rows)
    run, curve = als.train_als(table, RANK, 2, 0.3, work, route=route)
    w, h = als_by_hand(rows, start(table, "user"), start(table, "item"), 0.3, 2)
    for key, want in (("user", w), ("item", h)):
        got = collected(run.factors[key], key)
        assert got.keys() == want.keys()
        for k in want:
            np.testing.assert_allclose(got[k], want[k], rtol=1e-9)
    rmse = np.sqrt(np.mean([(r - w[u] @ h[i]) ** 2 for u, i, r in rows]))
    assert curve[-1][1] == pytest.approx(rmse)


def test_busy_user_is_split_over_cells(spark, work, rating_table):
    rows = [(1, i, (i % 10) / 2 + 0.5) for i in range(200)] + triples()
    table = rating_table(rows)
    items = work.write(factors.start_factors(table, "item", RANK), "items")
    routed = als.RoutedRatings(table, "user", work, cell_rows=16)
    assert routed.cells.where("split").select("cell").distinct().count() > 1
    assert routed.cells.count() == len(rows)
    got = collected(routed.half_step(items, RANK, 0.1, "step"), "user")
    want = collected(als.joined_half_step(table, items, "user", RANK, 0.1), "user")
    assert got.keys() == want.keys()
    for k in want:
        np.testing.assert_allclose(got[k], want[k], rtol=1e-9)


def test_als_objective_never_rises(spark, work, rating_table):
    rows, lam = triples(seed=4), 0.5
    table = rating_table(rows)
    run = als.AlsRun(table, RANK, lam, work)
    values = []
    for key in ("user", "item", "user", "item"):
        run.half_step(key)
        w, h = collected(run.factors["user"], "user"), collected(run.factors["item"], "item")
        error = sum((r - w[u] @ h[i]) ** 2 for u, i, r in rows)
        values.append(error + lam * sum(v @ v for v in [*w.values(), *h.values()]))
    assert all(b <= a + 1e-9 for a, b in zip(values, values[1:]))


def test_routes_agree_on_any_number_of_partitions(spark, rating_table):
    table = rating_table(triples(seed=8))
    seen = []
    for partitions in (1, 4, 16):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            for route in ("joined", "routed"):
                seen.append(als.train_als(table, 2, 2, 0.1, Workspace(spark, "n"), route=route)[1][-1][1])
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert seen == pytest.approx([seen[0]] * 6)


def test_unrated_ids_keep_their_vector(spark, work, rating_table):
    train = rating_table([(1, 1, 4), (2, 1, 3)])
    test = rating_table([(3, 9, 5), (1, 1, 2)])
    run, curve = als.train_als(train, 2, 1, 0.1, work, test)
    assert collected(run.factors["user"], "user")[3] == pytest.approx(start(test, "user", 2)[3])
    w, h = collected(run.factors["user"], "user"), collected(run.factors["item"], "item")
    assert curve[0][2] == pytest.approx(abs(2 - w[1] @ h[1]))


def test_singular_system_without_ridge(spark, work, rating_table):
    table = rating_table([(1, 1, 4), (2, 1, 3)])
    run, _ = als.train_als(table, 3, 1, 0.0, work)
    w, h = collected(run.factors["user"], "user"), collected(run.factors["item"], "item")
    assert all(np.isfinite(v).all() for v in [*w.values(), *h.values()])
    assert w[1] @ h[1] == pytest.approx(4, abs=1e-6)


def test_rank_one_single_pair(spark, work, rating_table):
    run, curve = als.train_als(rating_table([(7, 7, 3)]), 1, 2, 0.0, work)
    assert curve[-1][1] == pytest.approx(0, abs=1e-9)


def test_empty_train_set(spark, work, rating_table):
    run, curve = als.train_als(rating_table([]), 2, 1, 0.1, work)
    assert run.factors["user"].count() == 0 and curve[0][1] is None


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 4), st.floats(0.5, 5)), max_size=40), st.booleans())
def test_waves_equal_one_by_one(updates, item_first):
    rng = np.random.default_rng(3)
    w, h = rng.random((6, 2)), rng.random((5, 2))
    reg_w, reg_h = rng.random(6) * 0.1, rng.random(5) * 0.1
    a, b = w.copy(), h.copy()
    rows = np.array([u for u, _, _ in updates], dtype=int)
    cols = np.array([i for _, i, _ in updates], dtype=int)
    values = np.array([r for _, _, r in updates], dtype=float)
    got = dsgd.sgd_block(rows, cols, values, a, b, 0.01, reg_w, reg_h, item_first)
    sse = 0.0
    for u, i, r in updates:
        e = r - w[u] @ h[i]
        sse += e * e
        new_h = h[i] - 0.01 * (-2 * e * w[u] + 2 * reg_h[i] * h[i])
        w[u] = w[u] - 0.01 * (-2 * e * (new_h if item_first else h[i]) + 2 * reg_w[u] * w[u])
        h[i] = new_h
    np.testing.assert_allclose(a, w, rtol=1e-9)
    np.testing.assert_allclose(b, h, rtol=1e-9)
    assert got == pytest.approx(sse)


def test_chain_of_a_busy_user_equals_waves():
    rng = np.random.default_rng(4)
    rows = np.where(rng.random(300) < 0.5, 0, rng.integers(1, 60, 300))
    cols = rng.integers(0, 80, 300)
    wave = dsgd.wave_numbers(rows, cols)
    sizes = np.bincount(wave)
    assert (sizes < dsgd.THIN).any() and (sizes >= dsgd.THIN).any()
    values, results = rng.random(300) * 5, []
    for order in (np.arange(300), rng.permutation(300)):  # stored rows may come in any order
        w, h = np.full((60, 3), 0.5), np.full((80, 3), 0.4)
        reg = np.full(80, 0.05)
        dsgd.sgd_block(rows[order], cols[order], values[order], w, h, 0.02, reg, reg, wave=wave[order])
        results.append((w, h))
    w, h = np.full((60, 3), 0.5), np.full((80, 3), 0.4)
    for u, i, r in zip(rows, cols, values):
        e = r - w[u] @ h[i]
        w[u], h[i] = w[u] - 0.02 * (0.1 * w[u] - 2 * e * h[i]), h[i] - 0.02 * (0.1 * h[i] - 2 * e * w[u])
    for got in results:
        np.testing.assert_allclose(got[0], w, rtol=1e-9)
        np.testing.assert_allclose(got[1], h, rtol=1e-9)


def test_train_error_comes_from_the_sums(spark, work, rating_table):
    table = rating_table(triples(20, 15, 0.6))
    for route in ("joined", "routed"):
        run = als.AlsRun(table, RANK, 0.1, Workspace(spark, route), route=route)
        for key in ("user", "item", "user"):
            run.half_step(key)
            assert run.train_rmse() == pytest.approx(run.rmse(run.train), rel=1e-9)


def sgd_by_hand(rows, w, h, blocks, step, lam, variant):
    users, items = sorted(w), sorted(h)
    n_w = {u: sum(r[0] == u for r in rows) for u in users}
    n_h = {i: sum(r[1] == i for r in rows) for i in items}
    size_u, size_i = -(-len(users) // blocks), -(-len(items) // blocks)
    w, h, sse = dict(w), dict(h), 0.0
    for shift in range(blocks):
        for u, i, r in rows:
            rb, cb = users.index(u) // size_u, items.index(i) // size_i
            if (cb - rb) % blocks != shift:
                continue
            target = 5.0 if variant == "implicit" else r
            e = target - w[u] @ h[i]
            sse += e * e
            lw, lh = (lam / n_w[u], lam / n_h[i]) if variant == "weighted" else (lam, lam)
            new_h = h[i] - step * (-2 * e * w[u] + 2 * lh * h[i])
            w[u] = w[u] - step * (-2 * e * (new_h if variant == "implicit" else h[i]) + 2 * lw * w[u])
            h[i] = new_h
    return w, h, sse


@pytest.mark.parametrize("variant", ["plain", "weighted", "implicit"])
def test_dsgd_equals_sequential(spark, work, rating_table, variant):
    rows = triples(seed=7)
    if variant != "implicit":
        rows = [rows[k] for k in np.random.default_rng(0).permutation(len(rows))]
    table = rating_table(rows)
    run = dsgd.DsgdRun(table, RANK, 0.05, work, 3, variant=variant)
    sse, n = run.epoch(0.02)
    make = factors.implicit_start_factors if variant == "implicit" else factors.start_factors
    w, h, want_sse = sgd_by_hand(
        rows, collected(make(table, "user", RANK), "user"), collected(make(table, "item", RANK), "item"), 3, 0.02, 0.05, variant
    )
    assert n == len(rows) and sse == pytest.approx(want_sse)
    for key, want in (("user", w), ("item", h)):
        got = collected(run.factors(key), key)
        for k in want:
            np.testing.assert_allclose(got[k], want[k], rtol=1e-9)


def test_every_rating_is_in_one_stratum(spark, work, rating_table):
    rows = triples()
    run = dsgd.DsgdRun(rating_table(rows), 2, 0.01, work, 4)
    per = {r["stratum"]: r["count"] for r in run.laid.groupBy("stratum").count().collect()}
    assert sum(per.values()) == len(rows) and set(per) <= set(range(4))
    assert [run.epoch(0.01, [s])[1] for s in range(4)] == [per.get(s, 0) for s in range(4)]


def test_more_blocks_than_users(spark, work, rating_table):
    run = dsgd.DsgdRun(rating_table([(1, 1, 4), (2, 2, 3), (2, 1, 5)]), 2, 0.01, work, 8)
    assert run.epoch(0.01)[1] == 3


def test_sgd_needs_ratings(spark, work, rating_table):
    with pytest.raises(ValueError):
        dsgd.DsgdRun(rating_table([]), 2, 0.01, work, 2)


def test_blocks_of_any_size_pass_in_batches(spark, work, rating_table):
    rows = [(u, i, (u * i) % 9 / 2 + 0.5) for u in range(40) for i in range(30)]
    table, got = rating_table(rows), []
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for records in ("10000", "7"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", records)
        run = dsgd.DsgdRun(table, RANK, 0.05, Workspace(spark, "batches"), 2)
        assert run.epoch(0.02)[1] == len(rows)
        got.append((collected(run.factors("user"), "user"), collected(run.factors("item"), "item")))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    for one, other in zip(*got):
        for k in one:
            np.testing.assert_allclose(one[k], other[k], rtol=1e-9)


def test_cuts_by_rating(spark, work):
    rng = np.random.default_rng(2)
    for n_ids, p, fan in ((300, 7, 4), (300, 7, 1024), (5, 8, 1024), (1, 3, 4), (1025, 4, 1024)):
        n = rng.zipf(1.5, n_ids).clip(0, 5000)
        n[n_ids // 2] = n.sum() // 3 + 1
        counts = work.write(spark.createDataFrame([(i + 1, int(c)) for i, c in enumerate(n)], "user bigint, n bigint"), f"c{n_ids}{fan}")
        before, dsgd_fan, dsgd.FAN = np.cumsum(n) - n, dsgd.FAN, fan
        try:
            cuts = dsgd.cuts_by_rating(counts, "user", n_ids, p)
        finally:
            dsgd.FAN = dsgd_fan
        want = (before * p // n.sum()).tolist()
        assert [sum(cut <= i + 1 for cut in cuts) for i in range(n_ids)] == want
        got = counts.select("user", factors.block_by_cuts(counts["user"], cuts).alias("b")).orderBy("user").collect()
        assert [r["b"] for r in got] == want


def test_balanced_blocks_on_skewed_ratings(spark, work, rating_table):
    """Counts of users and of items fall with the id, independently: equal runs of ids
    overfill a block, cuts by ratings do not. Sides that depend on each other may still do."""
    rng = np.random.default_rng(3)
    rows = [(u, i, 3) for u in range(60) for i in range(60) if rng.random() < 1 / (1 + u / 8) / (1 + i / 8)]
    sizes = {}
    for cuts in ("ids", "ratings"):
        run = dsgd.DsgdRun(rating_table(rows), 2, 0.01, Workspace(spark, cuts), 4, cuts=cuts)
        sizes[cuts] = [r["count"] for r in run.laid.groupBy("stratum", "rb").count().collect()]
        assert run.epoch(0.01)[1] == len(rows)
    assert max(sizes["ratings"]) <= 2 * len(rows) / 16 < max(sizes["ids"])


def test_dsgd_models_share_a_pass(spark, work, rating_table):
    table, sizes, steps = rating_table(triples(20, 15, 0.6)), [(2, 0.05), (4, 0.5), (3, 0.01)], [0.02, 0.01, 0.03]
    run = dsgd.DsgdRun(table, *sizes[0], Workspace(spark, "many"), 3, more=sizes[1:])
    run.epoch(steps)
    run.epoch(steps)
    errors = run.rmses(run.train)
    for m, (size, step) in enumerate(zip(sizes, steps)):
        alone = dsgd.DsgdRun(table, *size, Workspace(spark, "alone"), 3)
        alone.epoch(step)
        assert alone.epoch(step)[0] == pytest.approx(run.losses(4, 6, m)[0])
        assert errors[m] == pytest.approx(alone.rmse(alone.train))
        for key in ("user", "item"):
            one, other = collected(alone.factors(key), key), collected(run.factors(key, m), key)
            for k in one:
                np.testing.assert_allclose(one[k], other[k], rtol=1e-9)


def test_als_models_share_a_pass(spark, work, rating_table):
    """Small cells cut the busy user over several, whose sums are then combined."""
    rows = triples(20, 15, 0.6) + [(999, i * 7 + 2, 2.5) for i in range(15)]
    table, sizes = rating_table(rows), [(2, 0.1), (4, 0.1), (2, 0.7), (3, 0.3)]
    grid = als.AlsGrid(table, table, work, cell_rows=9)
    assert grid.routed["user"].cells.where("split").count()
    for group in (sizes, sizes[:1]):
        grid.start(group)
        for _ in range(2):
            grid.half_step("user")
            grid.half_step("item")
        got = list(zip(grid.train_rmses(), grid.rmses(grid.train)))
        for (rank, lam), (from_sums, from_join) in zip(group, got):
            alone = als.AlsRun(table, rank, lam, Workspace(spark, "alone"))
            alone.iterate()
            alone.iterate()
            assert from_sums == pytest.approx(alone.train_rmse()) and from_join == pytest.approx(from_sums)


def test_grid_passes_are_bounded():
    runs = full_grid("sgd") + full_grid("als")
    groups = passes(runs)
    assert sorted(n for kind in groups for group in kind for n in group) == list(range(len(runs)))
    assert len(groups) == 2 and all(sum(runs[n].rank for n in group) <= 120 for kind in groups for group in kind)


def test_dsgd_curve_falls(spark, work, rating_table):
    table = rating_table(triples(20, 15, 0.6))
    _, curve = dsgd.train_dsgd(table, 4, 3, 0.01, dsgd.constant(0.01), work, blocks=2)
    train = [c[1] for c in curve]
    assert len(train) == 4 and all(b < a for a, b in zip(train, train[1:]))


def test_partial_epochs_continue(spark, work, rating_table):
    table = rating_table(triples())
    whole = dsgd.DsgdRun(table, 2, 0.01, Workspace(spark, "whole"), 2)
    whole.epoch(0.01)
    run, _ = dsgd.train_dsgd(table, 2, 2, 0.01, dsgd.constant(0.01), work, blocks=2, strata_per_iteration=1)
    a, b = collected(whole.factors("user"), "user"), collected(run.factors("user"), "user")
    for k in a:
        np.testing.assert_allclose(a[k], b[k])


def test_shuffled_strata_still_cover_all(spark, work, rating_table):
    rows = triples()
    run, curve = dsgd.train_dsgd(rating_table(rows), 2, 1, 0.01, dsgd.constant(0.01), work, blocks=3, seed=1)
    assert run.losses(1, 3)[1] == len(rows) and curve[1][1] < curve[0][1]


def test_step_schedules():
    assert dsgd.decaying(0.1)(1) == pytest.approx(0.09)
    assert dsgd.power_law(5500, 0.8)(0) == pytest.approx(5500**-0.8)
    assert dsgd.constant(0.001)(9) == 0.001


def test_gradient_training_reduces_loss(spark, work, rating_table):
    _, log = gradient.train_gradient(rating_table(triples()), 2, 0.01, 0.5, 4, work, print_every=2)
    assert [it for it, _, _ in log] == [2, 4] and log[1][1] < log[0][1]


def test_squared_loss_option(spark, work, rating_table):
    table = rating_table(triples())
    users, items = (work.write(factors.start_factors(table, k, 2), k) for k in ("user", "item"))
    got = gradient.loss(table, users, items, 2, 0.1, squared=True).first()["loss"]
    w, h = collected(users, "user"), collected(items, "item")
    error = np.mean([(r - w[u] @ h[i]) ** 2 for u, i, r in triples()])
    assert got == pytest.approx(0.5 * error + 0.05 * sum(v @ v for v in [*w.values(), *h.values()]))


def test_missing_vectors_are_filled(spark, rating_table):
    table = rating_table([(1, 1, 4), (2, 1, 3)])
    half = factors.start_factors(table.where("user = 1"), "user", 2)
    got = collected(factors.with_missing(half, table, "user", 2), "user")
    want = collected(table.select("user").distinct().withColumn("f", unit_vector("u", table["user"], 2)), "user")
    assert got.keys() == want.keys() and all((got[k] == want[k]).all() for k in want)


@pytest.mark.parametrize("bad", [{"iterations": 0}, {"rank": 0}, {"rank": 2.5}, {"model": "svd"}])
def test_settings_are_checked(bad):
    with pytest.raises(ValueError):
        Settings(**bad)


def test_grids_are_complete():
    assert len(full_grid("sgd")) == 27 and len(full_grid("als")) == 9


def test_model_accessors(spark, work, rating_table):
    model = fit(rating_table(triples()), Settings("als", 2, 2, 0.1), work, rating_table(triples(share=0.2)))
    assert model.train_rmse == model.curve_table().orderBy("iteration").collect()[-1]["train_rmse"]
    assert model.test_rmse > 0
