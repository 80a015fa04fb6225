"""Exact deduplication by content sort, with DataFrame functions only.

Sampled splitters deal rows out in ranges of their normalised bytes, each range is sorted
externally, and equal texts lie next to each other; comparing each row's whole text with its
neighbour's marks where a group begins.  A text with very many copies would fill one range, so
texts that occur often (found by counting 64-bit hashes, combined before the shuffle) carry a
salt from their identifier beside the text in the range key: their copies lie in several runs,
and only the one row per run and text that each run yields is compared again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: A text counts as frequent from this many rows, or this part of all rows if that is more; so
#: there are at most 1 / FREQUENT_SHARE frequent texts, and the broadcast of their hashes is bounded.
FREQUENT_ROWS, FREQUENT_SHARE = 256, 1e-5
#: Runs into which a frequent text's rows are dealt.
SALTS = 64
#: Characters of a text in the key of the range partitioning.
HEAD = 64


def deduplicate(docs: DataFrame, text: str = "text", key: str = "doc_id", keep: str = "min", normalise=None) -> DataFrame:
    """All rows and columns of ``docs`` and, for the group of equal texts a row is in:
    keep_id, group_size, kept, text_sha256 (of the normalised text).

    ``keep``: whether the smallest ("min") or largest ("max") identifier of a group stays.
    ``normalise``: a Column function applied to the text first; by default none.  A null text is
    empty.  Rows that repeat both identifier and text count each, but only one is kept.  A null
    identifier stays only where a group has no other.  An empty table gives no rows.  Columns of
    ``docs`` named like the added ones are replaced.
    """
    plain = F.coalesce(F.col(text), F.lit(""))
    norm: Column = normalise(plain) if normalise else plain
    docs = docs.drop("keep_id", "group_size", "kept", "text_sha256")
    spark = docs.sparkSession

    hashes = docs.select(F.xxhash64(norm).alias("__hash")).groupBy("__hash").agg(F.count("*").alias("__n"))
    rows = docs.count()
    frequent = hashes.filter(F.col("__n") >= max(FREQUENT_ROWS, int(rows * FREQUENT_SHARE))).select("__hash")
    salted = (
        docs.withColumn("__text", norm)
        .withColumn("__hash", F.xxhash64("__text"))
        .join(F.broadcast(frequent.withColumn("__often", F.lit(True))), "__hash", "left")
        .withColumn("__salt", F.when(F.col("__often"), F.pmod(F.xxhash64(key, F.lit(1)), F.lit(SALTS))).otherwise(F.lit(0)))
        .drop("__hash")
    )
    # RangePartitioning by that key already clusters the window below, so nothing is shuffled twice.
    # Splitters are sampled to the driver, so the range key is the text's beginning and a hash of the
    # rest; equal texts have equal keys, and what is compared with the neighbour is the whole text.
    keyed = salted.withColumns({"__head": F.substring("__text", 1, HEAD), "__hash": F.xxhash64("__text")})
    ranged = keyed.repartitionByRange("__head", "__hash", "__salt")  # the window sorts each range, externally
    first = F.col(key).asc_nulls_last() if keep == "min" else F.col(key).desc_nulls_last()
    run = W.partitionBy("__head", "__hash", "__salt", "__text")
    runs = (
        ranged.withColumn("__rank", F.row_number().over(run.orderBy(first)))
        .withColumn("keep_id", F.first(key).over(run.orderBy(first)))
        .withColumn("group_size", F.count("*").over(run.orderBy(first).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
        .withColumn("text_sha256", F.sha2(F.col("__text").cast("binary"), 256))
    )
    # One row per run of a frequent text; equal texts of different runs are compared whole again.
    pick = F.min if keep == "min" else F.max
    heads = salted.filter("__often").groupBy("__text", "__salt").agg(pick(key).alias("__id"), F.count("*").alias("__n"))
    stitched = (
        heads.groupBy("__text").agg(pick("__id").alias("__keep"), F.sum("__n").alias("__size"))
        .select(F.sha2(F.col("__text").cast("binary"), 256).alias("text_sha256"), "__keep", "__size")
    )
    # Bounded like ``frequent``: a hash, an identifier and a count for each.
    joined = runs.join(F.broadcast(stitched), "text_sha256", "left")
    often = F.col("__size").isNotNull()
    keep_id = F.when(often, F.col("__keep")).otherwise(F.col("keep_id"))
    return joined.select(
        *docs.columns,
        keep_id.alias("keep_id"),
        F.when(often, F.col("__size")).otherwise(F.col("group_size")).alias("group_size"),
        # The rows of one identifier share a salt, so one row at most passes both tests.
        ((F.col("__rank") == 1) & F.col(key).eqNullSafe(keep_id)).alias("kept"),
        "text_sha256",
    )
