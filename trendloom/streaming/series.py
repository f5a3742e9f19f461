"""Year series kept up to date from partial counts of every micro-batch.

Counts are sums, so the counts of the files that are new since the last refresh are all a refresh has to make:
they are written beside those of earlier batches, under the number of their batch, and the series is the sum of
all parts. A batch that runs again after a failure writes the same folder again, so it counts once. Parts are small:
years times series.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.operators.filters import SliceSpec, has_text, is_embeddable
from trendloom.schemas import WORKS
from trendloom.sources.tables import has_parquet
from trendloom.streaming.ingest import MAX_FILE_AGE

LOCAL_SERIES = "slice_embeddable"
PART = "series string, year int, n bigint"


def partial_series(works: DataFrame, spec: SliceSpec, strip_blank: bool = False) -> DataFrame:
    """``(series, year, n)`` of the four reference series and the embeddable works, from one scan; only the embeddable
    series is of all years, with a row where it is zero."""
    ours, years = spec.predicate(), spec.years()
    series = {
        "corpus_all": years,
        "corpus_articles": years & spec.kinds(),
        "slice_all": years & ours,
        "slice_with_abstract": years & ours & has_text(),
        LOCAL_SERIES: is_embeddable(strip_blank),
    }
    counted = works.groupBy(F.col("publication_year").cast("int").alias("year")) \
        .agg(*[F.count_if(pred).alias(name) for name, pred in series.items()])
    return counted.unpivot("year", list(series), "series", "n") \
        .where((F.col("n") > 0) | (F.col("series") == LOCAL_SERIES)).select("series", "year", "n")


def merged_series(spark: SparkSession, parts: str) -> DataFrame:
    """The series of everything counted so far: ``(series, year, n)``."""
    if not has_parquet(spark, parts):
        return spark.createDataFrame([], PART)
    return spark.read.schema(PART).parquet(f"{parts}/batch=*").groupBy("series", "year").agg(F.sum("n").alias("n"))


def refresh_series(spark: SparkSession, stored: str, parts: str, checkpoint: str, spec: SliceSpec,
                   strip_blank: bool = False, files_per_batch: int | None = None) -> DataFrame:
    """Count the files of the stored works that came since the last refresh, and give the whole series.

    ``checkpoint`` holds the position in ``stored``; no file is read by two refreshes.
    """
    def keep(batch: DataFrame, number: int) -> None:
        partial_series(batch, spec, strip_blank).coalesce(1).write.mode("overwrite").parquet(f"{parts}/batch={number}")
    reader = spark.readStream.schema(T.StructType([*WORKS.fields, T.StructField("year", T.IntegerType())])) \
        .option("maxFileAge", MAX_FILE_AGE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    reader.parquet(stored).drop("year").writeStream.foreachBatch(keep) \
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return merged_series(spark, parts)
