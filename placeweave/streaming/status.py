"""The queue's status log as a stream: the latest state per key, and calls per month."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.relational import first_per_key


def read_log(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 16) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def usage_by_month(log: DataFrame, at: str = "ts") -> DataFrame:
    """Calls per calendar month and status, for a sink in update or complete mode; the state is a row for each of them."""
    return log.groupBy(F.date_trunc("month", at).alias("since"), "status").agg(F.count("*").alias("n"))


def upsert_latest(target: str, key: str = "queue_key", at: str = "ts"):
    """A ``foreachBatch`` function that keeps the latest row per key in versioned snapshots under ``target``.

    A batch that is run again writes the same version, so the sink is exactly-once.
    """

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rest = [F.col(c) for c in batch.columns if c not in (key, at)]
        old = spark.read.parquet(f"{target}/v{number - 1:08d}") if number else batch.limit(0)
        merged = first_per_key(old.unionByName(batch), [key], F.col(at).desc(), *rest)
        merged.write.mode("overwrite").parquet(f"{target}/v{number:08d}")

    return step
