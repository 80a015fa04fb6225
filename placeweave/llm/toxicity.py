"""Toxicity scores from a factorization machine over hashed terms.

A text's terms are its distinct words and their beginnings of four and five letters, hashed.  The
terms that tell the labels apart best (by the log-likelihood ratio, over a bounded sample of
labelled rows) are the model's features; a factorization machine learns a weight for each and, by
vectors whose products stand for pairs, what two terms say together, which a linear model misses.
Every whole text is scored on the executors.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .shared import small_batches

#: The sample: at most so many rows of either label are learnt from (those with the smallest hashes
#: of their identifiers), so its size does not grow with the corpus.
MAX_TOXIC, MAX_CLEAN = 4_000, 8_000
BUCKETS, FEATURES, RANK, STEPS, RATE, DECAY, SEED = 1 << 20, 1024, 8, 300, 0.1, 1e-6, 7
#: From this score a text counts as toxic.
CUT = 0.3
#: Words whose features a worker remembers.
WORDS_KEPT = 100_000
WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5)


def terms(word: str) -> list[int]:
    """The buckets of a word's terms."""
    found = [zlib.crc32(word.encode())]
    found += [zlib.crc32(b"^" + word[:n].encode()) for n in PREFIXES if len(word) > n]
    return [x % BUCKETS for x in found]


@dataclass
class Model:
    """Bias, and for each feature's bucket a weight and a vector."""

    bias: float
    buckets: np.ndarray
    weights: np.ndarray
    vectors: np.ndarray

    def scores(self, features: list[np.ndarray]) -> np.ndarray:
        """Probabilities of label 1 for texts given as arrays of feature numbers."""
        out = np.empty(len(features))
        for i, f in enumerate(features):
            v = self.vectors[f]
            s = v.sum(axis=0)
            out[i] = self.bias + self.weights[f].sum() + 0.5 * float((s * s).sum() - (v * v).sum())
        return 1.0 / (1.0 + np.exp(-np.clip(out, -30, 30)))


def telling(docs: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """The buckets, in order, that tell the labels apart best; ``docs`` without the others give the same ones."""
    n, n1 = len(labels), int(labels.sum())
    if n1 == 0 or n1 == n:
        return np.empty(0, "int64")
    df1, df0 = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for d, y in zip(docs, labels):
        (df1 if y else df0)[d] += 1
    used = np.flatnonzero(df1 + df0 >= 3)
    df1, df0 = df1[used], df0[used]

    def part(a: np.ndarray, total: float, share: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(a > 0, a * np.log(a / (total * share)), 0.0)

    share = (df1 + df0) / n
    ratio = 2 * (part(df1, n1, share) + part(df0, n - n1, share) + part(n1 - df1, n1, 1 - share) + part(n - n1 - df0, n - n1, 1 - share))
    best = np.lexsort((used, -ratio))[:FEATURES]
    return np.sort(used[best[ratio[best] > 10]])


def fit(docs: list[np.ndarray], labels: np.ndarray, prior: float | None = None) -> Model:
    """Learn from texts as arrays of distinct buckets; ``prior``: the share of label 1 among all rows.

    Without rows of both labels the model is the smoothed share of label 1, which rejects nothing without any row.
    """
    n, n1 = len(labels), int(labels.sum())
    if n1 == 0 or n1 == n:
        p = (n1 + 0.5) / (n + 2.0)
        return Model(math.log(p / (1 - p)), np.empty(0, "int64"), np.empty(0), np.empty((0, RANK)))
    prior = n1 / n if prior is None else prior
    best = telling(docs, labels)
    place = np.full(BUCKETS, -1, "int32")
    place[best] = np.arange(len(best))
    x = np.zeros((n, len(best)), "float32")
    for i, d in enumerate(docs):
        at = place[d]
        x[i, at[at >= 0]] = 1
    y = labels.astype("float32")
    weight = np.where(y == 1, prior / n1, (1 - prior) / (n - n1)).astype("float32")
    rng = np.random.default_rng(SEED)
    params = [np.array([math.log(prior / (1 - prior))], "float32"), np.zeros(len(best), "float32"),
              rng.normal(0, 0.01, (len(best), RANK)).astype("float32")]
    means, squares = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, STEPS + 1):
        b, w, v = params
        s = x @ v
        z = b[0] + x @ w + 0.5 * ((s * s).sum(axis=1) - x @ (v * v).sum(axis=1))
        g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * weight
        gx = x.T @ g
        grads = [np.array([g.sum()]), gx + DECAY * w, x.T @ (g[:, None] * s) - v * gx[:, None] + DECAY * v]
        for p, m, q, d in zip(params, means, squares, grads):
            m += 0.1 * (d - m)
            q += 0.001 * (d * d - q)
            p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(q / (1 - 0.999**step)) + 1e-8)
    return Model(float(params[0][0]), best, params[1].astype("float64"), params[2].astype("float64"))


def held_out(doc_id: str = "doc_id") -> Column:
    """crc32 of the identifier as text, modulo 4, is 2; false for a null identifier."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic), without the held-out rows.

    Labels other than 0 and 1 and labels without a document count for nothing; an identifier with
    both labels counts as toxic.  A null text has no terms.  Every row of an identifier that ``docs`` repeats
    is learnt from, up to ``MAX_TOXIC + MAX_CLEAN`` rows in all, toxic ones first.
    """
    known = labels.filter("toxic in (0, 1) and doc_id is not null").filter(~held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    sample = known.filter("toxic = 1").orderBy(*order).limit(MAX_TOXIC).unionByName(
        known.filter("toxic = 0").orderBy(*order).limit(MAX_CLEAN))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id")

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for text in batch["text"]:
                buckets = {t for w in set(WORD.findall(text.lower())) for t in terms(w)}
                found.append(np.array(sorted(buckets), dtype="<u4").tobytes())
            yield pd.DataFrame({"doc_id": batch["doc_id"], "toxic": batch["toxic"], "terms": found})

    def narrow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if got := [batch for batch in batches if len(batch)]:
            whole = pd.concat(got)
            found = [np.frombuffer(t, "<u4") for t in whole["terms"]]
            kept = np.zeros(BUCKETS, bool)
            kept[telling(found, whole["toxic"].to_numpy("int64"))] = True
            yield whole.assign(terms=[d[kept[d]].tobytes() for d in found])

    # Identifiers that documents repeat give more rows; no more than the sample's bound are taken.  One task leaves
    # only the features in them, so that the driver's share is small.
    schema = "doc_id long, toxic int, terms binary"
    found = rows.mapInPandas(extract, schema)
    best = found.orderBy(F.col("toxic").desc(), *order, F.xxhash64("terms")).limit(MAX_TOXIC + MAX_CLEAN)
    got = sorted(best.coalesce(1).mapInPandas(narrow, schema).collect(), key=lambda r: (r["doc_id"], bytes(r["terms"])))
    total = sum(counts.values())
    return fit([np.frombuffer(r["terms"], "<u4").astype("int64") for r in got], np.array([r["toxic"] for r in got], "int64"),
               counts.get(1, 0) / total if total and 0 < counts.get(1, 0) < total else None)


def scorer(model: Model):
    """A Column function: the score of a whole text, 0 to 1; null texts count as empty."""
    place = {int(b): i for i, b in enumerate(model.buckets)}
    cache: dict[str, tuple[int, ...]] = {}

    @pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            if len(cache) > WORDS_KEPT:
                cache.clear()
            features = []
            for text in texts:
                words = set(WORD.findall(text.lower())) if text else set()
                for w in [w for w in words if w not in cache]:
                    cache[w] = tuple(place[t] for t in terms(w) if t in place)
                found = {f for w in words if (hit := cache[w]) for f in hit}
                features.append(np.fromiter(sorted(found), "int64", len(found)))
            yield pd.Series(model.scores(features))

    return score


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with held_out, score and predicted (1 from ``CUT``); columns of these names are replaced.

    Each row is scored by its whole text alone; null texts count as empty.  Other columns stay, rows that repeat an
    identifier are scored each, and an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    score = scorer(train(docs, labels))
    rows = docs.drop("held_out", "score", "predicted").withColumns({"held_out": held_out(), "score": score(F.col("text"))})
    return rows.withColumn("predicted", (F.col("score") >= CUT).cast("int"))
