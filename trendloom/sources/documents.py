"""Small JSON documents as rows: year series, manifest, ground truth."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom.schemas import GROUND_TRUTH, MANIFEST, YEAR_SERIES


def read_series(spark: SparkSession, path: str) -> DataFrame:
    """Year series as ``(series, year, n)``."""
    doc = spark.read.schema(YEAR_SERIES).option("multiLine", "true").json(path)
    return doc.select(F.explode("years").alias("series", "points")) \
        .select("series", F.explode("points").alias("year", "n")) \
        .select("series", F.col("year").cast("int"), "n")


def read_expected(spark: SparkSession, path: str, series: str = "slice_all") -> DataFrame:
    """One series as ``(year, expected)``."""
    return read_series(spark, path).where(F.col("series") == series) \
        .select("year", F.col("n").alias("expected"))


def read_manifest_files(spark: SparkSession, path: str) -> DataFrame:
    """Listed files as ``(path, bytes, sha256)``."""
    doc = spark.read.schema(MANIFEST).option("multiLine", "true").json(path)
    return doc.select(F.explode("files").alias("path", "f")).select("path", "f.bytes", "f.sha256")


def read_manifest_list(spark: SparkSession, path: str) -> DataFrame:
    """The file list written by ``write_manifest``."""
    return spark.read.schema("path string, bytes bigint, sha256 string").json(f"{path}/files")


def read_ground_truth(spark: SparkSession, path: str) -> DataFrame:
    """Entries as ``(name, year, note)``, whichever of the two year fields a list uses."""
    doc = spark.read.schema(GROUND_TRUTH).option("multiLine", "true").json(path)
    return doc.select(F.inline("entries").alias("name", "plain_year", "hype_year", "note")) \
        .select("name", F.coalesce("plain_year", "hype_year").alias("year"), "note")


def refresh_series(saved: DataFrame, local: DataFrame, local_series: str = "slice_embeddable",
                   remote: DataFrame | None = None) -> DataFrame:
    """Frozen series stay, the locally computed one is replaced.

    ``remote`` (a forced refresh) replaces the frozen series too.
    """
    kept = saved.where(F.col("series") != local_series) if remote is None else remote
    fresh = local.select(F.lit(local_series).alias("series"), "year", F.col("n").cast("bigint"))
    return kept.select("series", "year", "n").unionByName(fresh)
