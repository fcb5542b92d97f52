"""Shared folder for tables that outlive one task."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Spark's setting to remove the shuffle files of a query when it ends.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own. On a
    cluster a machine-local folder would be lost with the machine, so the
    setting is required there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None and spark.sparkContext.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", folder)
    if folder is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Cuts the lineage: later steps neither repeat the work nor depend on the
    executors that did it. Computes ``df`` once, unlike an eager checkpoint.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries that end in here leave no shuffle files, which else stay until the driver collects garbage."""
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREED)
        else:
            spark.conf.set(FREED, before)


class Shelf:
    """Stored tables of one task, the newest of each name: a table takes the place of the one before it.

    Nothing may read a table after its successor is put or after it is dropped.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths, self.tables = spark, {}, {}

    def put(self, name: str, df: DataFrame, buckets: int = 0, by: str = "") -> DataFrame:
        """``df`` written and read back, in ``buckets`` by the column ``by`` if any: joins by it move no row of this table."""
        path = scratch_path(self.spark, name)
        with freed_shuffles(self.spark):
            if buckets:
                table = path.rpartition("/")[2].replace("-", "_")
                df.write.format("parquet").option("path", path).bucketBy(buckets, by).saveAsTable(table)
                kept = self.spark.table(table)
            else:
                df.write.parquet(path)
                kept = self.spark.read.schema(df.schema).parquet(path)
        self.drop(name)
        self.paths[name] = path
        if buckets:
            self.tables[name] = table
        return kept

    def drop(self, *names: str) -> None:
        for name in names:
            if name in self.tables:
                self.spark.sql(f"DROP TABLE `{self.tables.pop(name)}`")
            if name in self.paths:
                place = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
                place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)
