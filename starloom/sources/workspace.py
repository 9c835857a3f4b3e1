"""Tables written by a running job: they cut lineage and survive lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

FOLDER_KEY = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Where the setting is missing, a local master (tests) gets a folder of its
    own for the life of the session; a cluster has to name one.
    """
    folder = spark.conf.get(FOLDER_KEY, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {FOLDER_KEY} to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="starloom-")
        spark.conf.set(FOLDER_KEY, folder)
    return folder.rstrip("/")


class Workspace:
    """A private sub-folder of the shared folder for the tables of one run."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/starloom/{label}-{uuid.uuid4().hex}"
        self.tables: list[str] = []

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
        """Write ``df`` once and return the stored table.

        Parquet rather than ``checkpoint()``: one pass instead of two, columnar
        reads afterwards, and file sizes that let the planner decide about
        broadcasts on facts.
        """
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(self.path(name))
        return self.read(df, name)

    def read(self, like: DataFrame, name: str) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(self.path(name))

    def write_bucketed(self, df: DataFrame, name: str, column: str, buckets: int, placed: bool = False) -> DataFrame:
        """Write ``df`` as a table bucketed by ``column``, one file per bucket:
        later joins and groupings by that column need no shuffle. ``placed``
        rows come from such a table and are not shuffled."""
        table = f"starloom_{uuid.uuid4().hex}"
        (
            (df if placed else df.repartition(buckets, column))
            .write.mode("overwrite")
            .bucketBy(buckets, column)
            .option("path", self.path(name))
            .format("parquet")
            .saveAsTable(table)
        )
        self.tables.append(table)
        return self.spark.table(table)

    def discard(self, name: str) -> None:
        """Delete a table that nothing refers to any more."""
        self._delete(self.path(name))

    def remove(self) -> None:
        """Delete everything, once the run's results are stored elsewhere."""
        for table in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self.tables.clear()
        self._delete(self.root)

    def _delete(self, place: str) -> None:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(place)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
