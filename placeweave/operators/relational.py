"""Small relational operators that the others are built from."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def require_columns(df: DataFrame, columns: list[str], name: str = "table") -> DataFrame:
    """``df`` with just these columns, by name; an error that names what is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{name} lacks the columns {missing}")
    return df.select(*[F.col(f"`{c}`") for c in columns])


def first_per_key(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row per key, the first in the given order; the order should leave no ties."""
    w = W.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order)
    return df.withColumn("__first", F.row_number().over(w)).filter("__first = 1").drop("__first")


def once_only(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key occurs exactly once; a null key counts like any other.

    Counted by an aggregate that is combined before the shuffle, so a key with very many rows is no
    burden, and joined back, where Spark can split skewed partitions.
    """
    names = [f"__k{i}" for i in range(len(keys))]
    single = df.groupBy(*[F.col(f"`{k}`").alias(n) for k, n in zip(keys, names)]).agg(F.count("*").alias("__n")).filter("__n = 1").drop("__n")
    on = reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(n)) for k, n in zip(keys, names)])
    return df.join(single, on, "left_semi")


def lookup_dedupe(df: DataFrame, mode: str = "strict") -> DataFrame:
    """A lookup without null keys and without keys that occur twice (``strict``), or that name two
    UPRNs (``by_uprn``, which keeps one row of a key)."""
    df = df.filter("key is not null")
    if mode == "strict":
        return once_only(df, ["key"])
    single = df.groupBy("key").agg(F.countDistinct("UPRN").alias("__n")).filter("__n = 1").select("key")
    return df.join(single, "key", "left_semi").dropDuplicates(["key"])


def majority(df: DataFrame, keys: list[str], value: str, count: str = "n", total: str | None = None) -> DataFrame:
    """The commonest non-null value per key with its count, ties to the smallest value; optionally the
    number of rows with a value."""
    votes = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias(count))
    best = votes.groupBy(*keys).agg(
        F.min(F.struct((-F.col(count)).alias("c"), F.col(value).alias("v"))).alias("b"), F.sum(count).alias(total or "__total"))
    out = best.select(*keys, F.col("b.v").alias(value), (-F.col("b.c")).alias(count), total or "__total")
    return out if total else out.drop("__total")


def union_all(*frames: DataFrame) -> DataFrame:
    """UNION ALL by name; columns that a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def left_latest(left: DataFrame, right: DataFrame, key: str, *order: Column) -> DataFrame:
    """Left join on a key with at most one right row per key."""
    return left.join(first_per_key(right.filter(F.col(key).isNotNull()), [key], *order), key, "left")
