"""Folders that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path below the cluster's ``spark.checkpoint.dir``, or the checkpoint folder that was set on the context.

    A local folder is chosen only where neither is set and Spark runs in one process (tests, a
    laptop); on a cluster that is an error, as executors would not see each other's files.
    """
    context = spark.sparkContext
    top = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not top:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        top = "file://" + tempfile.mkdtemp(prefix="placeweave-")
        spark.conf.set("spark.checkpoint.dir", top)
    return f"{top.rstrip('/')}/placeweave-{name}-{uuid.uuid4().hex}"


#: Bytes of an Arrow batch, which is what a Python worker holds at a time; Spark's default is eight times as much.
BATCH_BYTES, SMALL_BATCH, DEFAULTS = "spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20), ("67108864b", "67108864", "64MB")


def small_batches(spark: SparkSession) -> None:
    """Send texts to Python in small batches, unless the session says otherwise than Spark's default."""
    if spark.conf.get(BATCH_BYTES, DEFAULTS[0]) in DEFAULTS:
        spark.conf.set(BATCH_BYTES, SMALL_BATCH)


def written(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """The rows as a Parquet table in the shared folder: cuts lineage, survives lost executors."""
    spark, path = df.sparkSession, path or shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables that one job needs on its way: written to the shared folder, deleted when the job is done.

    What the job returns must not read them any more.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> "Scratch":
        return self

    def written(self, df: DataFrame, name: str) -> DataFrame:
        self.paths.append(shared_dir(self.spark, name))
        return written(df, name, self.paths[-1])

    def drop(self) -> None:
        """Delete the tables written so far."""
        while self.paths:
            remove(self.spark, self.paths.pop())

    def __exit__(self, *_) -> None:
        self.drop()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a shared path through the file system that holds it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
