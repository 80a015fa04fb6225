"""Quality rules with risk-controlled thresholds, with DataFrame functions only.

Each rule rejects a text when one of its measures reaches a cutoff.  The cutoffs are not set by
hand.  For each stratum, a quarter of the good texts and all bad ones lay out a path of rule sets,
each stricter than the one before: next comes the measure and cutoff that catch most further bad
texts for each good one lost, reached through its milder cutoffs.  The other good texts then test
the sets along that path: the number that a set rejects, by all its rules together, is tested
against the allowed rate with an exact binomial tail.  The path does not depend on those texts, so
it is a fixed sequence: it is walked up to the first set that fails, and the last set that passed
is used, at a level divided by the number of strata alone.  With the stated confidence no stratum
loses more than the allowed share.  Strata with too few labels to be shown anything on their own
are tested together, as one; if they are too few even so, they keep all that the base rules keep.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import written

#: Base rules.
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
#: Allowed share of good texts rejected in a stratum, by all its rules together; confidence.
RISK, DELTA = 0.02, 0.05
#: Share of the good texts that lay out the path; the others test it.
DESIGN = 0.25
#: Candidate cutoffs: measure -> values in per cent.
GRID = [1, 2, 3, 5, 8, 10, 15, 20, 30, 40, 50, 60]
MEASURES = ("symbols", "shouting", "dup_lines", "repeats", "capitals")
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
SPACE = "[\\x20\\x09-\\x0D]"


def _less(text: str, chars: str) -> Column:
    """Code points of a text that are among ``chars``."""
    return F.length(text) - F.length(F.translate(F.col(text), chars, ""))


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed and the
    measures (``m_*``, per cent).  A null text has no words.  Whole texts, one pass, no shuffle."""
    docs = docs.drop(*COUNTS)
    blank = " \t\n\x0b\x0c\r"
    text = "__text"
    rows = docs.withColumn(text, F.coalesce("text", F.lit("")))
    words = F.filter(F.split(text, f"{SPACE}+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, blank, "")) > 0)
    rows = rows.withColumn("__words", words).withColumn("__lines", lines)
    n = F.size("__words")
    # A hash of each window; the 64 bits make a chance match within one text negligible.
    hashes = F.when(
        n >= WINDOW,
        F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get("__words", i + k) for k in range(WINDOW)])),
    ).otherwise(F.array().cast("array<bigint>"))
    rows = rows.withColumn("__hashes", hashes)
    distinct = F.size(F.array_distinct("__hashes"))
    # Windows sorted by hash; a window counts if a neighbour in that order has the same hash.
    pairs = F.array_sort(F.transform("__hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("__pairs", F.when(distinct < F.size("__hashes"), pairs))
    near = lambda x, j: F.get("__pairs", j)["h"].eqNullSafe(x["h"])
    hit = F.filter(F.col("__pairs"), lambda x, j: near(x, j + 1) | near(x, j - 1))
    rows = rows.withColumn("__hits", F.array_sort(F.transform(hit, lambda x: x["i"])))
    # Words covered by the windows found: up to the next window's start, five at most.
    last = F.lit(1 << 30)
    covered = F.aggregate(
        F.transform("__hits", lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get("__hits", j + 1), last) - p)),
        F.lit(0), lambda a, x: a + x,
    )
    rows = rows.select(
        *docs.columns,
        n.cast("long").alias("n_words"),
        F.length(F.translate(text, blank, "")).cast("long").alias("word_chars"),
        _less(text, "#*$%&|<>").cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("__lines").alias("__n_lines"),
        _less(text, "!?").alias("__shouts"),
        (F.length(text) - F.length(F.regexp_replace(text, "\\p{Lu}", ""))).alias("__capitals"),
    )
    share = lambda a, b: F.coalesce(F.try_divide(100.0 * a, b), F.lit(0.0))
    return rows.select(
        *docs.columns, *COUNTS[:-1],
        ((F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))).alias("base_failed"),
        share(F.col("n_symbols"), F.col("word_chars")).alias("m_symbols"),
        share(F.col("__shouts"), F.col("n_words")).alias("m_shouting"),
        share(F.col("n_dup_lines"), F.col("__n_lines")).alias("m_dup_lines"),
        share(F.col("n_repeat_words"), F.col("n_words")).alias("m_repeats"),
        share(F.col("__capitals"), F.col("word_chars")).alias("m_capitals"),
    )


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p), by summing exact log terms."""
    if n == 0:
        return 1.0
    logs = [
        math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
        for i in range(k + 1)
    ]
    top = max(logs)
    return min(1.0, math.exp(top) * sum(math.exp(x - top) for x in logs))


def _walk(levels: np.ndarray, bad: np.ndarray, design: np.ndarray, test: np.ndarray, risk: float, level: float) -> dict:
    """{measure: cutoff}: the last rule set of the path that passes.

    One row per combination of the measures' levels (how many cutoffs each has reached), with its
    numbers of bad texts and of good texts for the path and for the tests.
    """
    n, rules, alive = int(test.sum()), {}, np.ones(len(levels), dtype=bool)
    while True:
        steps = []
        for m in range(len(MEASURES)):
            for k in range(1, rules.get(m, len(GRID) + 1)):
                hit = alive & (levels[:, m] >= k)
                # Each good text lost weighs as ten bad ones caught; ties go to the mildest cutoff.
                steps.append((bad[hit].sum() - 10 / DESIGN * design[hit].sum(), k, m))
        gain, strictest, m = max(steps, default=(0, 0, 0))
        if gain <= 0:
            break
        for k in range(rules.get(m, len(GRID) + 1) - 1, strictest - 1, -1):
            left = alive & (levels[:, m] < k)
            if binomial_tail(n - int(test[left].sum()), n, risk) > level:
                return {MEASURES[i]: GRID[j - 1] for i, j in rules.items()}
            rules[m], alive = k, left
    return {MEASURES[i]: GRID[j - 1] for i, j in rules.items()}


def _group(own: list, stratum: str) -> Column:
    """The position of a row's stratum in ``own``; their number for all others."""
    return F.coalesce(*[F.when(F.col(stratum).eqNullSafe(F.lit(v)), i) for i, v in enumerate(own)], F.lit(len(own)))


def cutoffs(labelled: DataFrame, stratum: str = "lang", risk: float = RISK, delta: float = DELTA, key: str = "doc_id") -> tuple[list, list[dict]]:
    """(strata with rules of their own, their {measure: cutoff} and at last that of all others).

    ``labelled`` has measures, ``stratum``, ``quality`` (1 good, 0 bad) and ``key``, whose hash deals
    the good texts.  Only counts per stratum and combination of levels reach the driver.  Texts that
    the base rules reject are left out, as the cutoffs decide on the others only.
    """
    bad = F.col("quality") == 0
    design = ~bad & (F.pmod(F.xxhash64(F.lit("quality"), key), F.lit(1000)) < int(1000 * DESIGN))
    rows = labelled.filter(~F.col("base_failed") & F.col("quality").isin(0, 1))
    # With fewer good texts no test can succeed, so the number of strata collected is bounded by
    # the number of labelled rows over this.
    least = lambda tests: math.log(delta / tests) / math.log1p(-risk)
    sizes = rows.groupBy(F.col(stratum).alias("v")).agg(F.count_if(~bad & ~design).alias("n")).filter(F.col("n") >= least(1)).collect()
    sizes = sorted(sizes, key=lambda r: (-r["n"], str(r["v"])))
    most = max((t for t, r in enumerate(sizes, 1) if r["n"] >= least(t + 1)), default=0)
    own = [r["v"] for r in sizes[:most]]
    levels = [sum((F.col(f"m_{m}") >= c).cast("int") for c in GRID).alias(f"l_{m}") for m in MEASURES]
    cells = rows.select(_group(own, stratum).alias("g"), *levels, bad.alias("bad"), design.alias("design"))
    cells = cells.groupBy("g", *[f"l_{m}" for m in MEASURES]).agg(
        F.count_if("bad"), F.count_if("design"), F.count_if(~F.col("bad") & ~F.col("design"))
    ).collect()
    chosen = []
    for g in range(len(own) + 1):
        table = np.array([r[1:] for r in cells if r["g"] == g], dtype=np.int64).reshape(-1, len(MEASURES) + 3)
        chosen.append(_walk(table[:, :-3], table[:, -3], table[:, -2], table[:, -1], risk, delta / (len(own) + 1)))
    return own, chosen


def verdict(own: list, chosen: list[dict], stratum: str = "lang") -> Column:
    """Whether the chosen cutoffs keep a row (base rules apart)."""
    out = F.lit(True)
    for g, rules in enumerate(chosen):
        here = _group(own, stratum) == g
        for m, c in rules.items():
            out = out & ~(here & (F.col(f"m_{m}") >= c))
    return out


def judge(
    docs: DataFrame, labels: DataFrame, carry: list[str] | None = None, stratum: str = "lang", risk: float = RISK, delta: float = DELTA
) -> DataFrame:
    """The columns ``carry`` of ``docs`` (all if None) with the counts, base_failed and kept.

    Cutoffs come from ``labels`` (doc_id, quality).  Labels without quality or document count for
    nothing; an identifier labelled good and bad counts as good, and equal texts count once.  Without usable labels only the
    base rules reject.  Rows that repeat an identifier are judged each.  An empty table gives no rows.  The measures are taken once and written to
    the shared folder, as both the choice of cutoffs and the verdict read them.
    """
    carry = docs.columns if carry is None else carry
    docs = docs.drop("kept")
    carry = [c for c in carry if c in docs.columns and c not in COUNTS]
    found = measured(docs).withColumnRenamed(stratum, "__stratum")
    own = [F.col("__stratum" if c == stratum else c).alias(c) for c in carry]
    rows = written(
        found.select(*own, F.col("doc_id").alias("__id"), F.xxhash64("text").alias("__vote"), "__stratum", *COUNTS, *[f"m_{m}" for m in MEASURES]), "quality"
    )
    label = labels.groupBy(F.col("doc_id").alias("__id")).agg(F.max("quality").alias("__quality"))
    known = rows.join(label.filter("__quality in (0, 1)"), "__id")
    # Copies of a text are no independent witnesses: equal texts of a stratum have one vote, good if any is.
    votes = known.groupBy("__vote", "__stratum", "base_failed", *[f"m_{m}" for m in MEASURES]).agg(F.max("__quality").alias("quality"))
    own, chosen = cutoffs(votes, "__stratum", risk, delta, "__vote")
    kept = ~F.col("base_failed") & verdict(own, chosen, "__stratum")
    return rows.select(*carry, *COUNTS, kept.alias("kept"))
