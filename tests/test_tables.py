"""Sources, sinks, table layouts and streams."""

import datetime

import pytest
from pyspark.sql import functions as F

from starloom.operators.ratings import latest_per_pair
from starloom.plans.shapes import Shapes
from starloom.plans.training import Settings, run_all, train_job
from starloom.sources import readers, tables, workspace, writers
from starloom.streaming import ratings as stream


def test_quoted_titles_survive(spark, work):
    movies = spark.createDataFrame([(1, 'Say "Hi", again', "War|Drama"), (2, "Plain", None)], readers.MOVIE_FILE)
    writers.write_csv(movies, work.path("movies"))
    assert sorted(readers.read_delimited(spark, work.path("movies"), readers.MOVIE_FILE).collect()) == sorted(movies.collect())


def test_bad_row_fails_unless_kept(spark, work):
    spark.createDataFrame([("userId,movieId,rating,timestamp",), ("1,2,3.5,4",), ("x,2,3.5,4",)], "v string").coalesce(1).write.text(work.path("t"))
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        readers.read_ratings(spark, work.path("t")).collect()
    kept = readers.read_delimited(spark, work.path("t"), readers.RATING_FILE, keep_bad_rows=True).cache()
    good, bad = readers.split_bad_rows(kept)
    assert good.count() == 1 and [r[0] for r in bad.collect()] == ["x,2,3.5,4"]


def test_epoch_seconds(spark, work):
    spark.createDataFrame([("1\t2\t3\t881250949",)], "v string").write.text(work.path("u"))
    row = readers.read_tab_ratings(spark, work.path("u")).select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).first()
    assert row[0] == "1997-12-04 15:55:49"


@pytest.mark.parametrize(
    "day, month", [(datetime.date(2023, 1, 31), "2022-10"), (datetime.date(2024, 3, 1), "2023-12"), (datetime.date(2022, 12, 15), "2022-09")]
)
def test_source_month(spark, day, month):
    assert spark.range(1).select(tables.source_month(F.lit(day))).first()[0] == month


def test_one_busy_day_is_kept_whole(spark, work):
    rows = spark.range(5000).select("id", F.when(F.col("id") % 50 == 0, F.lit("2024-01-02")).otherwise("2024-01-01").cast("timestamp").alias("ts"))
    stored = tables.partition_by_date(rows, "ts", work.path("days"))
    assert {str(r["day"]): r["count"] for r in stored.groupBy("day").count().collect()} == {"2024-01-01": 4900, "2024-01-02": 100}
    plan = stored.where("day = date'2024-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_publishing_an_empty_table_is_refused(spark, work):
    run = tables.RunFolder(spark, work.path("runs"), "a")
    run.write(spark.range(3), "matrix", "users")
    run.publish("matrix", "users")
    later = tables.RunFolder(spark, work.path("runs"), "b")
    later.write(spark.range(0), "matrix", "users")
    with pytest.raises(ValueError):
        later.publish("matrix", "users")
    assert later.latest("users").count() == 3
    later.write(spark.range(5), "matrix", "users")
    later.publish("matrix", "users")
    assert run.latest("users").count() == 5
    with pytest.raises(ValueError):
        run.path("other", "x")


def test_workspace_uses_the_configured_folder(spark, work):
    folder = workspace.shared_folder(spark)
    assert spark.conf.get("spark.checkpoint.dir").rstrip("/") == folder and work.root.startswith(folder)
    work.write(spark.range(2), "gone")
    work.discard("gone")
    with pytest.raises(Exception):
        spark.read.parquet(work.path("gone")).count()


def test_bucketed_table_groups_without_a_shuffle(spark, work):
    table = work.write_bucketed(spark.range(100).select((F.col("id") % 8).cast("int").alias("cell"), "id"), "b", "cell", 4)
    plan = table.groupBy("cell").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and table.count() == 100


def test_removed_workspace(spark):
    work = workspace.Workspace(spark, "gone")
    work.write_bucketed(spark.range(10), "b", "id", 2)
    (table,) = work.tables
    work.remove()
    assert not spark.catalog.tableExists(table)
    with pytest.raises(Exception):
        spark.read.parquet(work.path("b")).count()


def test_training_takes_the_newest_rating(spark, work):
    rows = [(1, 1, 1.0, 1), (1, 1, 5.0, 2), (2, 1, 3.0, 1)]
    ratings = spark.createDataFrame(rows, "user long, item long, rating double, ts long")
    run = run_all(spark, ratings, Settings("als", 1, 3, 0.001), work.path("runs"), "r1")
    best = {r["user"]: r["predict"] for r in run.latest("predictions").collect()}
    assert best[1] == pytest.approx(5, abs=0.1) and best[2] == pytest.approx(3, abs=0.1)


def test_full_run_publishes_raw_ids(spark, work, rating_table):
    ratings = rating_table([(10, 100, 4), (10, 300, 2), (20, 100, 5), (35, 300, 1)])
    run = run_all(spark, ratings, Settings("als", 2, 2, 0.1), work.path("runs"), "r1")
    predictions = run.latest("predictions").collect()
    assert {(r["user"], r["movie"]) for r in predictions} == {(u, m) for u in (10, 20, 35) for m in (100, 300)}
    assert run.latest("users").count() == 3


def test_sgd_job_writes_factor_files(spark, work, rating_table):
    ratings = rating_table([(u, i, (u + i) % 5 + 0.5) for u in range(10) for i in range(8)])
    train_job(ratings, Settings("sgd", 2, 1, 0.01, 0.01, blocks=2), work.path("model"), work)
    back = readers.read_json_lines(spark, work.path("model") + "/user_matrix/*", readers.USER_FACTOR_FILE)
    assert sorted(r["user"] for r in back.collect()) == list(range(10))
    assert all(len(r["array"]) == 2 for r in back.collect())


def test_relational_table_is_replaced(spark, work):
    writers.replace_table(spark.range(5), "replace_me", work.path("t1"))
    writers.replace_table(spark.range(2), "replace_me", work.path("t1"))
    assert readers.read_table(spark, "replace_me", ["id"]).count() == 2
    spark.sql("DROP TABLE replace_me")


EVENT = "event_id long, ts timestamp, user long, item long, rating double"


def event(n, second, user, item, rating):
    return n, datetime.datetime(2024, 1, 1, 0, 0, second), user, item, rating


def drain(spark, work, log, name):
    events = stream.read_event_stream(spark, work.path("in"), spark.createDataFrame([], EVENT).schema, 1)
    stream.upsert_stream(events, log, work.path(f"check-{name}")).awaitTermination()


def test_stream_upsert_late_event_and_restart(spark, work):
    log = stream.RatingLog(spark, work.path("log"))
    spark.createDataFrame([event(1, 30, 1, 1, 4.0), event(2, 10, 2, 2, 2.0)], EVENT).coalesce(1).write.mode("append").parquet(work.path("in"))
    drain(spark, work, log, "a")
    spark.createDataFrame([event(3, 20, 1, 1, 1.0), event(4, 40, 2, 2, 5.0)], EVENT).coalesce(1).write.mode("append").parquet(work.path("in"))
    drain(spark, work, log, "a")
    want = [(1, 1, 4.0), (2, 2, 5.0)]
    assert sorted(tuple(r) for r in log.current().select("user", "item", "rating").collect()) == want
    log.write_batch(spark.createDataFrame([event(3, 20, 1, 1, 1.0), event(4, 40, 2, 2, 5.0)], EVENT), 1)  # a replayed batch
    assert log.current().count() == 2
    compacted = log.compact(work.path("compact"))
    assert sorted(tuple(r) for r in compacted.current().select("user", "item", "rating").collect()) == want
    # A stream with a new checkpoint starts at batch 0 again and must not touch the base.
    spark.createDataFrame([event(5, 50, 3, 3, 3.0)], EVENT).coalesce(1).write.parquet(work.path("later"))
    events = stream.read_event_stream(spark, work.path("later"), spark.createDataFrame([], EVENT).schema, 1)
    stream.upsert_stream(events, compacted, work.path("check-new")).awaitTermination()
    assert sorted(tuple(r) for r in compacted.current().select("user", "item", "rating").collect()) == [*want, (3, 3, 3.0)]


def test_landing_keeps_columns_of_all_files(spark, work):
    spark.createDataFrame([(1, 2)], "a int, b int").write.parquet(work.path("raw/green_1"))
    spark.createDataFrame([(3, 4, "x")], "a int, b int, extra string").write.parquet(work.path("raw/green_2"))
    landed = tables.land_by_type(spark, work.path("raw"), "green", work.path("landed"))
    assert sorted(tuple(r) for r in landed.select("a", "b", "extra").collect()) == [(1, 2, None), (3, 4, "x")]


def test_stream_equals_batch(spark, work):
    shapes = Shapes(spark, "/root/testdata/sf0.001")
    shapes.rating_stream_rows.repartition(3).write.parquet(work.path("in"))
    schema = shapes.rating_stream_rows.schema
    events = stream.read_event_stream(spark, work.path("in"), schema, 1)
    stream.item_stats_stream(events, work.path("out"), work.path("check")).awaitTermination()
    got = {r["item"]: (r["n_ratings"], round(r["sum_rating"], 6)) for r in stream.current_item_stats(spark, work.path("out")).collect()}
    want = {r["item"]: (r["n_ratings"], round(r["sum_rating"], 6)) for r in stream.item_stats(shapes.rating_stream_rows).collect()}
    assert got == want
    assert latest_per_pair(shapes.rating_stream_rows, "ts", "event_id").count() == 739


def figures(ledger):
    return {r["item"]: (r["n_ratings"], r["sum_rating"], r["stars_1"], r["stars_5"]) for r in ledger.item_stats().collect()}


def test_ledger_takes_replaced_ratings_back(spark, work):
    base = spark.createDataFrame([event(-1, 5, 1, 1, 1.0), event(-1, 5, 2, 1, 5.0)], EVENT)
    ledger = stream.RatingLedger.begin(base, work.path("ledger"))
    assert figures(ledger) == {1: (2, 6.0, 1, 1)}
    batch = spark.createDataFrame([event(1, 30, 1, 1, 5.0), event(2, 20, 1, 1, 2.0), event(3, 1, 2, 1, 1.0), event(4, 9, 3, 2, 1.0)], EVENT)
    ledger.write_batch(batch, 0, run=7)
    want = {1: (2, 10.0, 0, 2), 2: (1, 1.0, 1, 0)}  # the late event 3 changes nothing
    assert figures(ledger) == want
    ledger.write_batch(batch, 0, run=7)  # the same batch again, then in a later run
    ledger.write_batch(batch, 3, run=8)
    assert figures(ledger) == want
    ledger.write_batch(spark.createDataFrame([event(9, 50, 3, 2, 4.5)], EVENT), 1, run=8)
    assert figures(ledger)[2] == (1, 4.5, 0, 1)
    compacted = ledger.compact(work.path("compacted"))
    assert figures(compacted) == figures(ledger) and compacted.current().count() == 3
    empty = stream.RatingLedger.begin(base.limit(0), work.path("empty"))
    empty.write_batch(batch, 0, run=1)
    assert figures(empty) == {1: (2, 6.0, 1, 1), 2: (1, 1.0, 1, 0)}


def test_tables_of_a_run_are_published_together(spark, work):
    old = tables.RunFolder(spark, work.path("runs"), "a")
    for name in ("users", "items"):
        old.write(spark.range(3), "matrix", name)
    old.publish_set(("matrix", "users"), ("matrix", "items"))
    later = tables.RunFolder(spark, work.path("runs"), "b")
    later.write(spark.range(5), "matrix", "users")
    with pytest.raises(Exception):  # the run ends before its second table is there
        later.publish_set(("matrix", "users"), ("matrix", "items"))
    assert {n: t.count() for n, t in later.latest_set("users", "items").items()} == {"users": 3, "items": 3}
    later.write(spark.range(5), "matrix", "items")
    later.publish_set(("matrix", "users"), ("matrix", "items"))
    assert {n: t.count() for n, t in old.latest_set("users", "items").items()} == {"users": 5, "items": 5}
    later.publish("matrix", "users")
    assert old.latest("items").count() == 5  # the newest line that names it


def test_document_in_parts_needs_all_of_them(spark, work):
    pairs = spark.range(1000).selectExpr("concat('k ', id) AS key", "id AS value").repartition(5)
    writers.write_json_document(pairs, work.path("doc"))
    back = readers.read_json_document(spark, work.path("doc"), "BIGINT")
    assert back.count() == 1000 and back.where("key = 'k 7'").first()["value"] == 7
    spark.createDataFrame([('{"x":1}',)], "value string").write.mode("append").text(work.path("doc/entries"))
    with pytest.raises(ValueError):
        readers.read_json_document(spark, work.path("doc"), "BIGINT")
