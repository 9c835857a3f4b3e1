"""Writing tables, factors and predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True) -> None:
    df.write.mode("overwrite").option("header", header).option("sep", sep).option("escape", '"').csv(path)


def parquet_to_csv(spark: SparkSession, source: str, target: str) -> None:
    write_csv(spark.read.parquet(source), target)


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_factors(factors: DataFrame, key: str, name: str, path: str) -> None:
    """Factor table as JSON lines with the columns ``name`` and ``array``."""
    write_json_lines(factors.select(F.col(key).alias(name), F.col("f").alias("array")), path)


def write_json_document(pairs: DataFrame, path: str) -> None:
    """A dictionary (key, value) as JSON objects of one entry each, a line per
    entry, in as many files as there are tasks. The manifest, written last,
    says how many entries belong to the document."""
    entry = F.to_json(F.create_map(F.col("key").cast("string"), "value"))
    lines = f"{path}/entries"
    pairs.select(entry.alias("value")).write.mode("overwrite").text(lines)
    pairs.sparkSession.read.text(lines).agg(F.count("*").alias("entries")).write.mode("overwrite").json(f"{path}/manifest")


def write_predictions(predictions: DataFrame, path: str, fmt: str = "csv", buckets: int | None = None) -> None:
    """Prediction table (user, movie, predict). With ``buckets``, rows are laid
    out in folders by user so that a look-up of one user opens one folder."""
    writer = predictions.write
    if buckets:
        bucket = F.pmod(F.xxhash64("user"), F.lit(buckets))
        predictions = predictions.withColumn("user_bucket", bucket).hint("rebalance", "user_bucket")
        writer = predictions.write.partitionBy("user_bucket")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.mode("overwrite").format(fmt).save(path)


def replace_table(df: DataFrame, name: str, path: str | None = None) -> None:
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def replace_jdbc_table(df: DataFrame, url: str, name: str, properties: dict[str, str] | None = None) -> None:
    df.write.mode("overwrite").jdbc(url, name, properties=properties or {})


def append_table(df: DataFrame, name: str) -> None:
    df.write.mode("append").format("parquet").saveAsTable(name)


def load_timestamped(rows: DataFrame, columns: list[str], path: str, mode: str = "overwrite") -> None:
    """Load rows with the given text columns parsed as timestamps, as one job.
    Later increments use ``mode='append'`` on the same path."""
    for c in columns:
        rows = rows.withColumn(c, F.to_timestamp(c))
    rows.write.mode(mode).parquet(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("overwrite").parquet(path)
