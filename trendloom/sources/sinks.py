"""Writers. Every file is bounded in rows, and the commit protocol makes each write atomic."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows per stored file.
WORK_ROWS = 25_000
PREPRINT_ROWS = 100_000


def _spread(df: DataFrame, folder: str) -> DataFrame:
    """Rows of one folder meet in few tasks; an oversized folder is split over several."""
    return df.hint("rebalance", F.col(folder))


def write_works(works: DataFrame, path: str, mode: str = "errorifexists", rows: int = WORK_ROWS,
                shape: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Year folders of bounded zstd files; ``publication_year`` also stays inside the files.

    ``shape`` makes the works from other rows that have their ``publication_year``: these are then what is moved and
    sorted into folders, and the wider works exist only on their way into the files.
    """
    if shape:
        works = shape(_spread(works, "publication_year").sortWithinPartitions("publication_year")) \
            .withColumn("year", F.col("publication_year"))
    else:
        works = _spread(works.withColumn("year", F.col("publication_year")), "year")
    works.write.mode(mode).partitionBy("year").option("compression", "zstd") \
        .option("maxRecordsPerFile", rows).parquet(path)


def write_preprints(preprints: DataFrame, path: str, mode: str = "errorifexists",
                    rows: int = PREPRINT_ROWS) -> None:
    """Set folders of bounded zstd files; ``preprints`` carries its ``set``."""
    _spread(preprints, "set").write.mode(mode).partitionBy("set") \
        .option("compression", "zstd").option("maxRecordsPerFile", rows).parquet(path)


def write_sample(sample: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A development sample as one file: its size is bounded by the rows asked for.

    The shuffle keeps the drawing itself parallel; ``coalesce`` would run it in a single task.
    """
    sample.repartition(1).write.mode(mode).option("compression", "zstd").parquet(path)


def write_document(doc: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A one-row frame as a JSON document."""
    to_document(doc).write.mode(mode).text(path)


def to_document(doc: DataFrame) -> DataFrame:
    return doc.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def series_document(series: DataFrame, slice_id: str, source: str) -> DataFrame:
    """``(series, year, n)`` rows as the one-row series document; bounded by series and years."""
    points = series.groupBy("series").agg(F.map_from_entries(F.sort_array(F.collect_list(
        F.struct(F.col("year").cast("string").alias("year"), "n")))).alias("points"))
    return points.agg(F.map_from_entries(F.sort_array(F.collect_list(
        F.struct("series", F.map_entries("points").alias("p"))))).alias("m")) \
        .select(F.lit(slice_id).alias("slice_id"), F.lit(source).alias("source"),
                F.transform_values("m", lambda _, p: F.map_from_entries(p)).alias("years"))


def manifest_document(years: DataFrame, query: Column, slice_id: str, fetched_on: str,
                      code_version: str, source: str) -> DataFrame:
    """The head of the manifest as one row, bounded by the number of years."""
    by_year = F.map_from_entries(F.sort_array(F.collect_list(F.struct(
        F.col("year").cast("string").alias("year"),
        F.struct("rows", "files", "bytes", "expected", "gap").alias("v")))))
    return years.agg(F.sum("rows").alias("rows_total"), by_year.alias("years")).select(
        F.lit(slice_id).alias("slice_id"), F.lit(fetched_on).alias("fetched_on"),
        F.lit(code_version).alias("code_version"), F.lit(source).alias("source"),
        query.alias("query"), "rows_total", "years")


def write_manifest(head: DataFrame, files: DataFrame, path: str) -> None:
    """The head as a document and the file list beside it as JSON lines.

    The number of files grows with the corpus, so the list is never gathered into one row.
    """
    write_document(head, f"{path}/head")
    files.select("path", "bytes", "sha256").write.json(f"{path}/files")
