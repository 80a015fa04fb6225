"""Preference pairs: one prompt, and two completions with masks.

The chosen and the rejected conversation of a pair are compared turn by turn; the turns that both
begin with are rendered once, as the prompt, and what follows is rendered as two completions.
Only what an assistant says in a completion is trained on; its spans are given as character ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How a turn is rendered.
OPEN, CLOSE = "<|{}|>\n", "<|end|>\n"
SPAN = "array<struct<start:bigint,end:bigint>>"


def _escaped(text: Column) -> Column:
    """Text in which no marker can be forged."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def _head(turn: Column) -> Column:
    return F.concat(F.lit("<|"), _escaped(turn["role"]), F.lit("|>\n"))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _escaped(t["text"]), F.lit(CLOSE))), "")


def _spans(turns: Column) -> Column:
    """Character ranges of the assistant's words, with the closing marker, in the rendered turns."""
    size = F.transform(turns, lambda t: F.struct(
        F.length(_head(t)).cast("bigint").alias("head"),
        (F.length(_escaped(t["text"])) + len(CLOSE)).cast("bigint").alias("body"),
        F.coalesce(t["role"] == "assistant", F.lit(False)).alias("own"),
    ))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(SPAN).alias("spans"))
    return F.aggregate(size, start, lambda acc, t: F.struct(
        (acc["at"] + t["head"] + t["body"]).alias("at"),
        F.when(t["own"], F.concat(acc["spans"], F.array(F.struct(
            (acc["at"] + t["head"]).alias("start"), (acc["at"] + t["head"] + t["body"]).alias("end")))))
        .otherwise(acc["spans"]).alias("spans"),
    ), lambda acc: acc["spans"])


def format_pairs(turns: DataFrame) -> DataFrame:
    """One row per pair from ``turns`` (pair_id, side: chosen or rejected, turn, role, text).

    Columns: pair_id, n_prefix (turns in the prompt), prompt, chosen, rejected, and chosen_spans and
    rejected_spans (what is trained on).  Turns are ordered by turn, role and text, nulls first, so
    ties and repeated turns have one order; two turns are equal if role and text are.  A side
    without turns has a null completion and the prompt is then empty.  Turns without a pair or side
    belong to no pair and are left out; an empty table gives no rows.  A conversation is one record:
    it is gathered whole, as it is written.
    """
    turn = F.struct("turn", "role", "text")
    of = lambda side: F.array_sort(F.collect_list(F.when(F.col("side") == side, turn)))
    pairs = (
        turns.filter(F.col("pair_id").isNotNull() & F.col("side").isin("chosen", "rejected"))
        .groupBy("pair_id").agg(of("chosen").alias("__a"), of("rejected").alias("__b"))
    )
    both = F.least(F.size("__a"), F.size("__b"))
    a, b = (lambda i: F.get("__a", i)), (lambda i: F.get("__b", i))
    differ = F.filter(
        F.when(both > 0, F.sequence(F.lit(0), both - 1)).otherwise(F.array().cast("array<int>")),
        lambda i: ~(a(i)["role"].eqNullSafe(b(i)["role"]) & a(i)["text"].eqNullSafe(b(i)["text"])),
    )
    pairs = pairs.withColumn("n_prefix", F.coalesce(F.get(differ, F.lit(0)), both))
    rest = lambda c: F.when(F.size(c) > 0, F.slice(c, F.col("n_prefix") + 1, F.size(c)))
    pairs = pairs.withColumns({"__c": rest("__a"), "__r": rest("__b")})
    return pairs.select(
        "pair_id", "n_prefix",
        _rendered(F.slice("__a", F.lit(1), F.col("n_prefix"))).alias("prompt"),
        _rendered(F.col("__c")).alias("chosen"), _rendered(F.col("__r")).alias("rejected"),
        _spans(F.col("__c")).alias("chosen_spans"), _spans(F.col("__r")).alias("rejected_spans"),
    )
