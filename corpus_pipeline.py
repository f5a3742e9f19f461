"""From raw documents to token ids, in five stages.

Every stage works on all rows that the one before kept, is written as Parquet and read again:

1. ``toxicity``: documents that the weakly supervised classifier rejects go.
2. ``near_dedup``: of every group of near duplicates (5-word shingles, similarity 0.8) the document with the
   smallest id stays.
3. ``decontamination``: documents that hold a benchmark item, up to the error budget, go.
4. ``secrets``: live-looking secrets are masked in the text, and ``n_chars`` follows.
5. ``bpe``: texts become token ids; one row of counts and digests per document.

Documents without an id pass every stage on their own; null texts stay null until they are encoded.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom.llm.bpe import bpe_digests
from trendloom.llm.decontaminate import without_leaks
from trendloom.llm.near_dup import one_per_group
from trendloom.llm.queries import table, vocabulary
from trendloom.llm.secrets import without_live_secrets
from trendloom.llm.toxicity import without_toxic
from trendloom.session import materialize


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_per_group(docs, width=5, threshold=(4, 5))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = without_live_secrets(docs)
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe_digests(docs.select("doc_id", "text"), vocabulary()).drop("text")


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("bpe", bpe),
]

# Stages 1 and 3 are a trained model and an approximate search, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
