"""Training-corpus pipeline: toxicity, quality rules, exact dedup, near-duplicate join, packing.

Each stage takes (spark, docs, sf_dir), where docs has the columns of ``documents``, and works on
every row that its predecessor kept.  ``run`` writes each stage's rows to the shared folder and
reads them again, which cuts lineage and survives lost executors.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeweave.llm import exact_dedup, ngram_join, packing, quality_rules, toxicity
from placeweave.llm.shared import written


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def _own(docs: DataFrame, added: list[str], judge: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The columns of ``docs`` of the rows that ``judge`` leaves; its own columns of the names that it adds are kept aside."""
    aside = {c: f"__own_{c}" for c in docs.columns if c in added}
    return judge(docs.withColumnsRenamed(aside)).select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model of ``labels`` scores under its cut; null texts count as empty, an empty table gives no rows."""
    return _own(docs, ["held_out", "score", "predicted"], lambda d: toxicity.judge(d, _labels(spark, sf_dir)).filter("predicted = 0"))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the cutoffs learnt from ``labels``; null and short texts do not."""
    return _own(docs, [*quality_rules.COUNTS, "kept"], lambda d: quality_rules.judge(d, _labels(spark, sf_dir)).filter("kept"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, that with the smallest identifier."""
    return _own(docs, ["keep_id", "group_size", "kept", "text_sha256"], lambda d: exact_dedup.deduplicate(d).filter("kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest identifier of each group of linked documents stays; rows without identifier stay."""
    found = ngram_join.join(docs).filter("doc_id is not null and doc_id <> component_id")
    return ngram_join.without(docs, found.select(F.col("doc_id").alias("id")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in windows of 2048 ids; a null text is its end id alone."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", keep_quality),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("packing", pack),
]

#: Scores and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
