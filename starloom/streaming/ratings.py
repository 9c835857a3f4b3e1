"""Ratings arriving as a stream."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from starloom.operators.ratings import PAIR, STARS, latest_per_pair

NEWEST = ("ts", "event_id")
# The run number of a compacted base; those of streams are the times they started.
BASE = -1


def read_event_stream(spark: SparkSession, glob: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(glob)


class RatingLog:
    """A rating table kept as a base plus one folder of changes per micro-batch.

    A micro-batch is reduced to its newest row per pair and written to its own
    folder below its run's: each start of a stream is a run of its own, whether
    its checkpoint is old or new, so nothing already stored is rewritten. A
    batch that is replayed in a later run is stored again; readers merge by
    newest row, so every event counts once, the order in which batches arrive
    does not matter, and a late event loses against a newer one. ``compact``
    folds the changes into a new base, which lies apart from all runs.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def write_batch(self, batch: DataFrame, batch_id: int, run: int = 0) -> None:
        latest_per_pair(batch, *NEWEST).write.mode("overwrite").parquet(batch_folder(self.root, run, batch_id))

    def stored(self) -> DataFrame:
        """All rows, with the ``run`` and ``batch`` that wrote them."""
        return self.spark.read.parquet(self.root)

    def current(self) -> DataFrame:
        return latest_per_pair(self.stored().drop("run", "batch"), *NEWEST)

    def compact(self, target: str) -> "RatingLog":
        """Write the merged table as the base of a new log."""
        self.current().write.mode("overwrite").parquet(batch_folder(target, BASE, 0))
        return RatingLog(self.spark, target)


class RatingLedger(RatingLog):
    """A rating log whose changes say what they replace, so that item figures
    follow updates: a new rating comes in, the pair's old one goes out.

    The base is a table bucketed by pair: a micro-batch is shuffled to its
    buckets and looked up there, so the stored ratings are read, not shuffled.
    A ledger opened by its folder alone looks pairs up by plain joins.

    A micro-batch keeps the rows that are newer than what is known of their
    pair, each with the rating it replaces; only pairs of the batch are looked
    up. Rows and replaced ratings are one write, so figures and table never
    part. A batch that is run again, in the same run or a later one, finds its
    own rows known and counts once. Batches of one ledger run one at a time.
    """

    def __init__(self, spark: SparkSession, root: str, base: str | None = None):
        super().__init__(spark, root)
        self.base = base

    @classmethod
    def begin(cls, base: DataFrame, root: str) -> "RatingLedger":
        """A new ledger from a table of ratings, which may be empty."""
        spark, table = base.sparkSession, f"ledger_{uuid.uuid4().hex}"
        rows = latest_per_pair(base, *NEWEST).withColumn("old", F.lit(None).cast("double"))
        # As many buckets as tasks of a shuffle: the rows lie in them already.
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        writer = rows.write.mode("overwrite").bucketBy(buckets, *PAIR).format("parquet")
        writer.option("path", batch_folder(root, BASE, 0)).saveAsTable(table)
        return cls(spark, root, table)

    def stored(self) -> DataFrame:
        if self.base is None:
            return super().stored()
        # An empty base has buckets, but no file that tells the columns.
        columns = self.spark.table(self.base).schema.add("run", "long").add("batch", "long")
        return self.spark.read.schema(columns).parquet(self.root)

    def known(self, rows: DataFrame, batch_id: int, run: int) -> DataFrame:
        """What is stored of the pairs of ``rows`` but by this batch: the newest row of each."""
        pairs = rows.select(*PAIR)
        others = self.stored().where(~((F.col("run") == run) & (F.col("batch") == batch_id)))
        if self.base is None or run == BASE:
            found = others.drop("run", "batch", "old").join(pairs, PAIR, "left_semi")
        else:
            # Pairs of the batch are held by bucket, stored ratings pass by unsorted.
            stored = self.spark.table(self.base).drop("old").join(pairs.hint("shuffle_hash"), PAIR, "left_semi")
            changes = others.where(F.col("run") != BASE).drop("run", "batch", "old").join(pairs, PAIR, "left_semi")
            found = stored.unionByName(changes)
        return latest_per_pair(found, *NEWEST)

    def write_batch(self, batch: DataFrame, batch_id: int, run: int = 0) -> None:
        rows = latest_per_pair(batch, *NEWEST)
        known = self.known(rows, batch_id, run)
        seen = known.select(*PAIR, F.col("rating").alias("old"), F.struct(*NEWEST).alias("seen"))
        newer = F.col("seen").isNull() | (F.struct(*NEWEST) > F.col("seen"))
        rows = rows.join(seen, PAIR, "left").where(newer).drop("seen")
        rows.write.mode("overwrite").parquet(batch_folder(self.root, run, batch_id))

    def current(self) -> DataFrame:
        return super().current().drop("old")

    def compact(self, target: str) -> "RatingLedger":
        return RatingLedger.begin(self.current(), target)

    def item_stats(self) -> DataFrame:
        """Count, sum and star counts per item over the current table, from the
        changes alone: one aggregate with partial sums, no row is ranked."""

        def signed(value) -> Column:
            return F.sum(value(F.col("rating")) - value(F.col("old")))

        stars = [
            signed(lambda r, s=s: F.coalesce(r.isin(s - 0.5, float(s)), F.lit(False)).cast("bigint")).alias(f"stars_{s}") for s in STARS
        ]
        return self.stored().groupBy("item").agg(
            signed(lambda r: r.isNotNull().cast("bigint")).alias("n_ratings"),
            signed(lambda r: F.coalesce(r, F.lit(0.0))).alias("sum_rating"),
            *stars,
        )


def batch_folder(root: str, run: int, batch_id: int) -> str:
    return f"{root}/run={run}/batch={batch_id}"


def upsert_stream(events: DataFrame, log: RatingLog, checkpoint: str) -> StreamingQuery:
    """Drain the rating events into the log; rerunning continues where it stopped."""
    run = time.time_ns()
    return (
        events.writeStream.foreachBatch(lambda batch, batch_id: log.write_batch(batch, batch_id, run))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def item_stats(events: DataFrame) -> DataFrame:
    """Running count, sum and star counts per item. State is one row per item."""
    rating = F.col("rating")
    stars = [F.count_if(rating.isin(s - 0.5, float(s))).alias(f"stars_{s}") for s in STARS]
    return events.groupBy("item").agg(F.count("rating").alias("n_ratings"), F.sum("rating").alias("sum_rating"), *stars)


def item_stats_stream(events: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Write the items each micro-batch changed to a folder of this run and batch."""
    run = time.time_ns()

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(batch_folder(root, run, batch_id))

    return (
        item_stats(events)
        .writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current_item_stats(spark: SparkSession, root: str) -> DataFrame:
    """The newest version of every item's figures: of the latest run, and there of the latest batch."""
    figures = F.struct("n_ratings", "sum_rating", *[f"stars_{s}" for s in STARS])
    newest = F.max_by(figures, F.struct("run", "batch")).alias("s")
    return spark.read.parquet(root).groupBy("item").agg(newest).select("item", "s.*")


__all__ = ["PAIR", "RatingLedger", "RatingLog", "current_item_stats", "item_stats", "item_stats_stream", "read_event_stream", "upsert_stream"]
