"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, written


def components(edges: DataFrame, name: str = "components", scratch: Scratch | None = None) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v): the smallest node that it reaches.

    Both steps take minima of neighbours, combined before the shuffle; a node with very many
    neighbours is joined with its one minimum, a join whose large side Spark can split.  The number
    of rounds grows with the logarithm of the longest path; each round's edges are written to the
    shared folder, and deleted after the next.  The result is a table of ``scratch``, if given.
    """
    old, new = Scratch(edges.sparkSession), Scratch(edges.sparkSession)
    now = old.written(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
    before = None
    while (state := now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()) != before:
        before = state
        # Large star: larger neighbours of a node are tied to the smallest of its neighbours and itself.
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: smaller neighbours and the node itself are tied to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        tied = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = new.written(tied.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), name)
        old.drop()
        old, new = new, old
    found = now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
    found = scratch.written(found, name) if scratch else written(found, name)
    old.drop()
    return found
