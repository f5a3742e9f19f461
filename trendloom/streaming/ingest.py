"""Incremental ingest: every landed file is read once, and a rerun continues where it stopped.

The stream checkpoint holds the position, and the file sink's commit log, or the batch's own folders where two
tables are written, make each micro-batch appear exactly once, whatever fails in between.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from trendloom.operators.normalize import preprints_from_oai, works_from_raw
from trendloom.operators.quality import gap_of
from trendloom.schemas import RAW_PREPRINT, RAW_WORK
from trendloom.sources.sinks import PREPRINT_ROWS, WORK_ROWS
from trendloom.sources.tables import exists, has_parquet


# A landed file is never too old: beyond this age the source would skip it without a word.
MAX_FILE_AGE = "36500d"
BAD_RECORD = "_corrupt_record"
TRIAL_BYTES = 64 << 20             # a trial run's batches, where nothing else bounds them


def stored_rows(spark: SparkSession, path: str) -> int:
    """Rows of a stored table, from its footers; 0 when nothing is stored."""
    return spark.read.parquet(path).count() if has_parquet(spark, path) else 0


def _run(query: StreamingQuery, stop_after: int | None) -> None:
    """Wait for a stream to use up what has landed, or stop it between batches once about
    ``stop_after`` rows were read; a later run goes on from there."""
    if stop_after is None:
        query.awaitTermination()
        return
    read: dict[int, int] = {}                    # by batch: reports are kept for the last 100 only
    while not query.awaitTermination(0.1):
        read |= {p["batchId"]: p["numInputRows"] for p in query.recentProgress}
        if sum(read.values()) >= stop_after:
            query.stop()
            return


def ingest(spark: SparkSession, landing: str, schema: T.StructType, shape: Callable[[DataFrame], DataFrame],
           out: str, checkpoint: str, folder: str, rows: int, source: str = "json",
           files_per_batch: int | None = None, rejects: str | None = None,
           stop_after: int | None = None, bytes_per_batch: int | None = None, **options: str) -> int:
    """Bring every file that landed since the last run into ``out``; returns the rows added.

    Rows are counted in the stored table. An unreadable record stops the run, unless ``rejects`` names a
    side table: such records then go there, as text beside what could be read of them, and all others into
    ``out``. Both come from one parse and one position: a batch writes its own folder ``ingest=...`` of either table, and a
    batch that runs again, also after a failure between the two writes, writes the same folders again. A table is
    filled either with or without ``rejects``. ``stop_after`` ends a trial run after about that many input rows.

    ``files_per_batch`` or ``bytes_per_batch`` bound what a batch takes in, at least one file; a trial run takes in
    64 MB at a time where neither is given, so it never starts on a whole landing.
    """
    if files_per_batch and bytes_per_batch:
        raise ValueError("bound a batch by files or by bytes, not by both")
    if stop_after is not None and not files_per_batch:
        bytes_per_batch = bytes_per_batch or TRIAL_BYTES

    def stream(mode: str, fields: T.StructType) -> DataFrame:
        reader = spark.readStream.format(source).schema(fields).option("maxFileAge", MAX_FILE_AGE) \
            .option("mode", mode).option("columnNameOfCorruptRecord", BAD_RECORD).options(**options)
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        if bytes_per_batch:
            reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
        return reader.load(landing)
    before = stored_rows(spark, out)
    if exists(spark, out) and exists(spark, f"{out}/_spark_metadata") != (rejects is None):
        raise ValueError(f"{out} was filled {'without' if rejects else 'with'} a side table for rejects")
    if rejects is None:
        writer = shape(stream("FAILFAST", schema)).writeStream.format("parquet").option("compression", "zstd") \
            .option("maxRecordsPerFile", rows).partitionBy(folder)
        _run(writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out), stop_after)
        return stored_rows(spark, out) - before

    def both(batch: DataFrame, number: int) -> None:
        stream_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId")     # kept in the checkpoint
        name = f"ingest={stream_id}-{number}"
        parsed = batch.persist(StorageLevel.DISK_ONLY)
        try:
            good = shape(parsed.where(F.col(BAD_RECORD).isNull()).drop(BAD_RECORD))
            good.write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", rows) \
                .partitionBy(folder).parquet(f"{out}/{name}")
            parsed.where(F.col(BAD_RECORD).isNotNull()).withColumnRenamed(BAD_RECORD, "record") \
                .write.mode("overwrite").parquet(f"{rejects}/{name}")
        finally:
            parsed.unpersist()
    with_bad = stream("PERMISSIVE", T.StructType([*schema.fields, T.StructField(BAD_RECORD, T.StringType())]))
    _run(with_bad.writeStream.foreachBatch(both).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start(), stop_after)
    return stored_rows(spark, out) - before


def ingest_works(spark: SparkSession, landing: str, out: str, checkpoint: str,
                 files_per_batch: int | None = None, rejects: str | None = None,
                 stop_after: int | None = None, bytes_per_batch: int | None = None) -> int:
    """Landed work records to the works table in year folders."""
    def shape(raw: DataFrame) -> DataFrame:
        return works_from_raw(raw).withColumn("year", F.col("publication_year"))
    return ingest(spark, landing, RAW_WORK, shape, out, checkpoint, "year", WORK_ROWS,
                  files_per_batch=files_per_batch, rejects=rejects, stop_after=stop_after, bytes_per_batch=bytes_per_batch)


def ingest_preprints(spark: SparkSession, landing: str, out: str, checkpoint: str, oai_set: str,
                     files_per_batch: int | None = None, rejects: str | None = None,
                     stop_after: int | None = None, bytes_per_batch: int | None = None) -> int:
    """Landed protocol pages of one set to the preprint table in set folders."""
    def shape(records: DataFrame) -> DataFrame:
        return preprints_from_oai(records).withColumn("set", F.lit(oai_set))
    return ingest(spark, landing, RAW_PREPRINT, shape, out, checkpoint, "set", PREPRINT_ROWS, source="xml",
                  files_per_batch=files_per_batch, rejects=rejects, stop_after=stop_after,
                  bytes_per_batch=bytes_per_batch, rowTag="record")


def ingest_progress(stored: DataFrame, expected: DataFrame, limit: float = 0.02) -> DataFrame:
    """Rows per year against the expectation, and whether the year is complete within the limit."""
    held = stored.groupBy(F.col("publication_year").cast("int").alias("year")) \
        .agg(F.count(F.lit(1)).alias("rows"))
    joined = expected.select("year", "expected").join(held, "year", "left").select(
        "year", F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"), "expected")
    gap = gap_of(F.col("rows"), F.col("expected"))
    return joined.withColumn("closed", F.coalesce(gap, F.lit(0.0)) <= limit)


def ingest_total(progress: DataFrame) -> DataFrame:
    """One row: rows stored, years complete, years expected."""
    return progress.agg(
        F.sum("rows").alias("rows"), F.count_if("closed").alias("closed"),
        F.count(F.lit(1)).alias("years"))
