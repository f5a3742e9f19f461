"""One query per operator, over the whole of its table and with production parameters."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom.llm import (
    bpe, decontaminate, fingerprints, language, licenses, near_dup, negatives, repair, secrets, sharding, toxicity,
    token_files, warc,
)
from trendloom.llm.oracle import ORACLE
from trendloom.session import scratch_path

__all__ = ["ORACLE", "QUERIES"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.benchmark_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(secrets.secret_scan(table(spark, sf_dir, "documents")))


def op5_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.kd_shards(table(spark, sf_dir, "documents"), shards=16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages")).drop("intact")


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_report(table(spark, sf_dir, "documents"))


def op8_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), width=3, threshold=(85, 100))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.bpe_digests(docs, vocabulary()).drop("text")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0,
                                    label=negatives.mined_label())


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = repair.damaged(table(spark, sf_dir, "conversations"))
    return repair.conversation_audits(rows, dropped=F.col("dropped"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    with open(vocabulary("byte_bpe_50k.json"), encoding="utf-8") as f:
        token_files.write_tokens(table(spark, sf_dir, "documents"), path, f.read())
    return token_files.token_digests(spark, path)


QUERIES = {
    "op1_licenses": op1_licenses,
    "op2_decontaminate": op2_decontaminate,
    "op3_language": op3_language,
    "op4_secrets": op4_secrets,
    "op5_kd_shards": op5_kd_shards,
    "op6_warc": op6_warc,
    "op7_fingerprints": op7_fingerprints,
    "op8_minhash_forest": op8_minhash_forest,
    "op9_toxicity": op9_toxicity,
    "op10_bpe": op10_bpe,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_token_files": op13_token_files,
}
