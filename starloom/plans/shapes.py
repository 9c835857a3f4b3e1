"""The tables of a rating product, derived from the sample warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.ratings import latest_per_pair


class Shapes:
    """Reads one folder of parquet tables; every property is a lazy DataFrame."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @property
    def rating_events(self) -> DataFrame:
        """user, item, rating on the half-star grid, ts, and the line's keys."""
        lines = self.table("lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate")
        orders = self.table("orders").select("o_orderkey", "o_custkey")
        rating = ((F.floor((F.col("l_quantity") - 1) / 5) + 1) * F.lit(0.5)).cast("double")
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("o_custkey").alias("user"),
            F.col("l_partkey").alias("item"),
            rating.alias("rating"),
            F.col("l_shipdate").alias("ts"),
            F.col("l_orderkey").alias("ok"),
            F.col("l_linenumber").cast("bigint").alias("ln"),
        )

    @property
    def ratings(self) -> DataFrame:
        """The latest rating of every (user, item)."""
        return latest_per_pair(self.rating_events, "ts", "ok", "ln").select("user", "item", "rating", "ts")

    @property
    def movies(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("item"),
            F.col("p_name").alias("title"),
            F.concat_ws("|", F.replace("p_name", F.lit(" "), F.lit("|")), "p_type").alias("genres"),
            F.col("p_brand").alias("mpaa"),
        )

    @property
    def dated_movies(self) -> DataFrame:
        """Movies with a release date as text; '' where the date is unknown."""
        first = self.table("lineitem").groupBy(F.col("l_partkey").alias("item")).agg(
            F.min("l_shipdate").alias("first")
        )
        sizes = self.table("part").select(F.col("p_partkey").alias("item"), "p_size")
        known = (F.col("p_size") <= 45) & F.col("first").isNotNull()
        date = F.when(known, F.date_format("first", "yyyy-MM-dd")).otherwise("")
        return self.movies.join(sizes, "item").join(first, "item", "left").select(
            *self.movies.columns, date.alias("release_date")
        )

    @property
    def tags(self) -> DataFrame:
        return self.table("events").select(
            F.col("user_id").alias("user"),
            F.get_json_object("props", "$.k").cast("bigint").alias("item"),
            F.col("event_type").alias("tag"),
            "ts",
            "event_id",
        )

    @property
    def rating_stream_rows(self) -> DataFrame:
        return to_stream_ratings(self.table("events"))

    @property
    def vectors(self) -> DataFrame:
        return self.table("embeddings").select(
            F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("f")
        )


def to_stream_ratings(events: DataFrame) -> DataFrame:
    """Rating submissions from the event log; works on static and streaming input."""
    return events.select(
        F.col("user_id").alias("user"),
        F.get_json_object("props", "$.k").cast("bigint").alias("item"),
        F.least(F.greatest("value", F.lit(0.5)), F.lit(5.0)).alias("rating"),
        F.col("ts").cast("timestamp").alias("ts"),
        "event_id",
    )
