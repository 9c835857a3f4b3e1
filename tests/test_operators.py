"""Edge cases and invariants of the relational operators."""

import itertools

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.functions import scores, text
from starloom.functions.vectors import dot
from starloom.operators import best as best_scores
from starloom.operators import blocks, catalogue, content, fuzzy, index, ratings, split
from starloom.sources.workspace import Workspace


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_latest_breaks_equal_times_by_the_next_column(spark):
    events = spark.createDataFrame(
        [(1, 1, 2.0, 5, 1), (1, 1, 4.0, 5, 2), (1, 1, 3.0, 4, 9)], "user long, item long, rating double, ts long, seq long"
    )
    assert rows(ratings.latest_per_pair(events, "ts", "seq"), "rating", "seq") == [(4.0, 2)]


def test_late_event_does_not_replace_a_newer_one(spark, rating_table):
    stored = spark.createDataFrame([(1, 1, 4.0, 100), (2, 1, 1.0, 100)], "user long, item long, rating double, ts long")
    late = spark.createDataFrame([(1, 1, 1.0, 50), (2, 1, 5.0, 150), (3, 3, 2.0, 1)], stored.schema)
    assert rows(ratings.upsert(stored, late, "ts"), "user", "rating") == [(1, 4.0), (2, 5.0), (3, 2.0)]


def test_repeated_pair_leaves_a_map_task_once(spark):
    events = spark.range(1000).select(
        (F.col("id") % 1).alias("user"), (F.col("id") % 1).alias("item"), F.col("id").cast("double").alias("rating"), F.col("id").alias("ts")
    )
    latest = ratings.latest_per_pair(events, "ts")
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert rows(latest, "rating") == [(999.0,)]


def test_histogram_counts_off_grid_values_as_votes_only(rating_table):
    got = ratings.star_histogram(rating_table([(1, 1, 0), (2, 1, 5.5), (3, 1, 5), (4, 1, 4.5)]))
    by_star = {r["star"]: (r["votes"], r["n"], r["ratio"]) for r in got.collect()}
    assert by_star[5] == (4, 2, 50.0) and by_star[1] == (4, 0, 0.0)
    assert sum(n for _, n, _ in by_star.values()) == 2


def test_profile_of_an_unrated_item(spark, rating_table):
    items = spark.createDataFrame([(1, "a"), (2, "b")], "item long, title string")
    got = {r["item"]: r for r in ratings.item_profiles(items, rating_table([(1, 1, 4)])).collect()}
    assert got[2]["votes"] == 0 and got[2]["average"] is None and got[2]["band"] is None and got[2]["stars_3"] == 0
    assert got[1]["band"] == 4


@pytest.mark.parametrize("average, band", [(0.2, 0), (0.5, 1), (1.49, 1), (1.5, 2), (4.49, 4), (4.5, 5)])
def test_star_bands(spark, average, band):
    assert spark.range(1).select(scores.star_band(F.lit(average)).alias("b")).first()["b"] == band


def test_top_rated_needs_more_than_the_threshold(spark, rating_table):
    items = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "item long, title string")
    table = rating_table([(u, i, 3) for u in range(3) for i in (1, 3)] + [(1, 2, 5)])
    assert [r["item"] for r in ratings.top_rated(table, items, more_than=2).collect()] == [1, 3]
    assert ratings.top_rated(table, items, more_than=3).count() == 0


def test_stats_of_an_empty_table(rating_table):
    row = ratings.rating_stats(rating_table([])).first()
    assert row["n_users"] == 0 and row["n_items"] == 0 and row["mean_rating"] is None


def test_dense_ids_of_gaps_and_negative_ids(spark, work):
    table = spark.createDataFrame([(-5,), (1000000007,), (3,), (3,), (-5,)], "user long")
    ids, n = index.dense_ids(table, "user", work)
    assert n == 3 and rows(ids, "raw_id", "dense_id") == [(-5, 1), (3, 2), (1000000007, 3)]
    dense = index.to_dense(table, "user", ids)
    assert rows(index.to_raw(dense, "user", ids), "user") == rows(table, "user")


def test_unmapped_ids(spark, work):
    ids, _ = index.dense_ids(spark.createDataFrame([(7,)], "user long"), "user", work)
    table = spark.createDataFrame([(1,), (2,)], "user long")
    assert {r["user"] for r in index.to_raw(table, "user", ids).collect()} == {7, None}
    assert {r["user"] for r in index.to_raw(table, "user", ids, default=0).collect()} == {7, 0}


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_index_is_gap_free_on_any_layout(spark, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = spark.range(5000).select(F.xxhash64("id").alias("key"))
        indexed, n = index.with_index(df, ["key"], Workspace(spark, "index"), "x", start=1)
        got = [r["idx"] for r in indexed.orderBy("key").collect()]
        assert n == 5000 and got == list(range(1, 5001))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_index_of_nothing(spark, work):
    indexed, n = index.with_index(spark.range(0), ["id"], work, "none")
    assert n == 0 and indexed.count() == 0


def test_folds_are_disjoint_and_complete(spark, work):
    got = split.folds(spark.range(23), ["id"], 5, work)
    assert sorted(r["count"] for r in got.groupBy("fold").count().collect()) == [4, 4, 5, 5, 5]
    assert got.select("id").distinct().count() == 23 and got.agg(F.max("fold")).first()[0] == 5


def by_hand_holdout(data, start, stop, cap):
    taken, seen, out = 0, {}, {}
    for user, ts in sorted(data, key=lambda d: d[1]):
        seen[user] = seen.get(user, 0) + 1
        hit = (cap <= 0 or taken < cap) and start <= seen[user] <= stop
        taken += hit
        out[ts] = hit
    return out


@pytest.mark.parametrize("start, stop, cap", [(1, 2, 0), (2, 3, 4), (1, 10, 7)])
def test_holdout_equals_a_scan(spark, work, start, stop, cap):
    data = [((n * 7) % 5 if n % 3 else 0, n) for n in range(60)]
    table = spark.createDataFrame(data, "user long, ts long")
    got = {r["ts"]: r["in_test"] for r in split.holdout(table, ["ts"], start, stop, work, cap).collect()}
    assert got == by_hand_holdout(data, start, stop, cap)


def test_hash_split_ignores_layout(rating_table):
    table = rating_table([(u, i, 3) for u in range(40) for i in range(25)])
    a = rows(split.hash_split(table), "user", "item", "in_train")
    b = rows(split.hash_split(table.repartition(7)), "user", "item", "in_train")
    assert a == b and 0.75 < np.mean([t for _, _, t in a]) < 0.85


def test_random_split_covers_everything(rating_table):
    table = rating_table([(u, 1, 3) for u in range(200)])
    train, test = split.random_split(table)
    assert train.count() + test.count() == 200


def test_seen_in_needs_both_sides(rating_table, work):
    train = rating_table([(1, 1, 3), (2, 2, 3)])
    test = rating_table([(1, 2, 3), (1, 3, 3), (3, 1, 3)])
    assert rows(split.seen_in(test, train, work), "user", "item") == [(1, 2)]


def test_bridge_of_null_and_empty_lists(spark):
    items = spark.createDataFrame([(1, "a|b"), (2, None), (3, "")], "item long, genres string")
    assert rows(catalogue.bridge(items, "genres", "genre"), "item", "genre") == [(1, "a"), (1, "b"), (3, "")]


def test_exact_genre_match(spark):
    items = spark.createDataFrame([(1, "War|Drama"), (2, "Star Wars")], "item long, genres string")
    assert rows(catalogue.items_of_genre(items, "War"), "item") == [(1,), (2,)]
    assert rows(catalogue.items_of_genre(items, "War", exact=True), "item") == [(1,)]


def test_unknown_dates_are_left_out(spark):
    items = spark.createDataFrame([(1, "None"), (2, ""), (3, None), (4, "2001-01-01"), (5, "2001-01-01")], "item long, release_date string")
    assert [r["item"] for r in catalogue.newest_items(items).collect()] == [4, 5]


def test_new_users_follow_the_largest_id(spark, work):
    users = spark.createDataFrame([(4,), (9,)], "user long")
    names = spark.createDataFrame([("b",), ("a",)], "username string")
    assert rows(catalogue.number_new_users(users, names, work), "user", "username") == [(10, "a"), (11, "b")]
    none = users.limit(0)
    assert rows(catalogue.number_new_users(none, names, Workspace(spark, "n")), "user") == [(1,), (2,)]


def test_best_columns_against_sorting():
    rng = np.random.default_rng(5)
    for n, width in itertools.product((1, 3, 8), (1, 5, 8)):
        scores_ = np.round(rng.random((6, width)), 1)
        scores_[rng.random((6, width)) < 0.2] = -np.inf
        r, c = blocks.best_columns(scores_, np.arange(width), n)
        for row in range(6):
            want = sorted((-s, k) for k, s in enumerate(scores_[row]) if np.isfinite(s))[:n]
            assert sorted(c[r == row]) == sorted(k for _, k in want)


def vector_table(spark, key, n, rank, seed):
    rng = np.random.default_rng(seed)
    values = {k * 3 + 1: rng.random(rank) for k in range(n)}
    return values, spark.createDataFrame([(k, v.tolist()) for k, v in values.items()], f"{key} long, f array<double>")


@pytest.mark.parametrize("small", [True, False])
def test_predictions_over_many_blocks(spark, work, monkeypatch, small):
    monkeypatch.setattr(blocks, "ROW_BLOCK", 4)
    monkeypatch.setattr(blocks, "COL_BLOCK", 5)
    if not small:
        monkeypatch.setattr(blocks, "BROADCAST_BYTES", 0)
    w, users = vector_table(spark, "user", 11, 3, 1)
    h, items = vector_table(spark, "item", 13, 3, 2)
    got = {(r["user"], r["item"]): r["predict"] for r in blocks.all_predictions(users, items, 3, work).collect()}
    assert len(got) == 11 * 13 and all(got[u, i] == pytest.approx(w[u] @ h[i]) for u, i in got)
    rated = spark.createDataFrame([(u, i) for u in w for i in list(h)[: (u % 13) + 1]], "user long, item long")
    best = best_scores.top_n_per_user(users, items, 3, 4, Workspace(spark, "top"), rated).collect()
    skip = {(r["user"], r["item"]) for r in rated.collect()}
    for u in w:
        want = sorted((-(w[u] @ h[i]), i) for i in h if (u, i) not in skip)[:4]
        assert [r["item"] for r in sorted(best, key=lambda r: r["rank"]) if r["user"] == u] == [i for _, i in want]


@pytest.mark.parametrize("small", [True, False])
def test_similar_texts_over_many_blocks(spark, work, monkeypatch, small):
    monkeypatch.setattr(content, "TEXT_BLOCK", 3)
    monkeypatch.setattr(content, "RARE_MEETINGS", 2)
    monkeypatch.setattr(content, "SLICE", 4)
    if not small:
        monkeypatch.setattr(content, "BROADCAST_BYTES", 0)
    words = ["red", "blue", "bolt", "ring", "gear", "cog", "ök"]
    rng = np.random.default_rng(2)
    data = [(n * 2, " ".join(rng.choice(words, size=rng.integers(1, 6)))) for n in range(25)] + [(99, ""), (101, "x")]
    texts = spark.createDataFrame(data, "id long, text string")
    weights = {}
    for r in content.tfidf_weights(texts, Workspace(spark, "w")).collect():
        weights.setdefault(r["id"], {})[r["token"]] = r["weight"]
    got = {}
    for r in content.similar_items(texts, 4, work).collect():
        got.setdefault(r["id"], []).append((r["rank"], r["other"], r["score"]))
    ids = [n for n, _ in data]
    for a in ids:
        found = []
        for b in ids:
            score = round(sum(x * weights.get(b, {}).get(t, 0) for t, x in weights.get(a, {}).items()), 6)
            if a != b:
                found.append((-score, b))
        want = [(b, -s) for s, b in sorted(found)[:4]]
        assert [(b, s) for _, b, s in sorted(got.get(a, []))] == want
    assert [b for _, b, _ in sorted(got[99])] == ids[:4]
    # idf counts the texts without tokens: n is 27, not 25.
    holders = [n for n, text in data if "red" in text.split()]
    one = next((n for n, text in data if set(text.split()) == {"red", "ring"}), None)
    if one is not None:
        df = {t: sum(t in text.split() for _, text in data) for t in ("red", "ring")}
        raw = {t: dict(data)[one].split().count(t) * (math.log(28 / (1 + df[t])) + 1) for t in df}
        assert weights[one]["red"] == pytest.approx(raw["red"] / math.hypot(*raw.values())) and holders


def test_common_text_is_compared_once(spark, work):
    texts = spark.createDataFrame([(n, "red ring") for n in range(500)] + [(900, "red bolt")], "id long, text string")
    got = content.similar_items(texts, 3, work)
    assert got.count() == 501 * 3
    assert rows(got.where("id = 0"), "other") == [(1,), (2,), (3,)]
    assert rows(got.where("id = 900"), "other") == [(0,), (1,), (2,)]


def test_cosine_of_zero_vectors(spark, work):
    table = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, [2.0, 0.0])], "id long, f array<double>")
    got = {(r["id"], r["other"]): r["score"] for r in blocks.top_cosine(table, 2, 2, work).collect()}
    assert got[2, 3] == 1.0 and got[1, 2] == 0.0


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, last[j] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_close_titles_miss_nothing(spark, work):
    rng = np.random.default_rng(9)
    titles = {"".join(rng.choice(list("abc "), size=rng.integers(1, 12))) for _ in range(100)}
    for _ in range(25):  # long titles, some with a good share of letters changed
        base = rng.choice(list("abcd "), size=rng.integers(15, 45))
        for _ in range(4):
            changed = base.copy()
            at = rng.random(len(base)) < rng.random() * 0.5
            changed[at] = rng.choice(list("abcd "), size=at.sum())
            titles.add("".join(changed[: rng.integers(len(base) // 2, len(base) + 1)]))
    titles = sorted(titles)
    wanted = titles[::2] + ["a", "ab", "star wars", "star wers"]
    got = fuzzy.close_titles(
        spark.createDataFrame([(t,) for t in wanted], "title string"),
        spark.createDataFrame([(t,) for t in titles], "title string"), work, n=5,
    ).collect()
    for a in set(wanted):
        found = sorted((-round(1 - levenshtein(a, b) / max(len(a), len(b)), 6), b) for b in titles)
        want = [b for s, b in found if -s >= 0.6][:5]
        assert [r["title"] for r in sorted(got, key=lambda r: r["rank"]) if r["wanted"] == a] == want


def test_titles_one_letter_apart(spark, work):
    one = spark.createDataFrame([("Heat",)], "title string")
    many = spark.createDataFrame([("Meat",), ("Heat",), ("Alien",)], "title string")
    assert [r["title"] for r in fuzzy.close_titles(one, many, work).orderBy("rank").collect()] == ["Heat", "Meat"]
    with pytest.raises(ValueError):
        fuzzy.close_titles(one, many, work, cutoff=0.3)


def test_distinct_counts(rating_table):
    table = rating_table([(u % 50, u % 7, 3) for u in range(700)])
    assert tuple(ratings.distinct_counts(table).first()) == (50, 7)
    assert abs(ratings.distinct_counts(table, approximate=True).first()["n_users"] - 50) <= 5


def test_dot_with_and_without_a_known_rank(spark):
    v = F.array(F.lit(1.0), F.lit(-2.0), F.lit(0.5))
    row = spark.range(1).select(dot(v, v).alias("a"), dot(v, v, 3).alias("b")).first()
    assert row["a"] == row["b"] == 5.25


def test_feature_text_of_nulls(spark):
    items = spark.createDataFrame([(1, None, None), (2, "War|Drama", "PG")], "item long, genres string, mpaa string")
    got = dict(rows(content.item_text(items), "id", "text"))
    assert got[1].strip() == "" and got[2] == "War Drama PG"


def test_tokens_have_two_letters(spark):
    got = spark.range(1).select(text.tokens(F.lit("A é Été, x_1 42! b")).alias("t")).first()["t"]
    assert got == ["été", "x_1", "42"]
