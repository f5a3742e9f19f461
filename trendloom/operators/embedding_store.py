"""A stored table of vectors whose keys never move: year folders, bucketed by id and text.

Layout: ``path/model/year=Y/v=N``, each a Parquet table in ``buckets`` buckets of ``(id, text_hash)``. A run takes one
year at a time, so it reads that year's works and that year's keys alone. Of the works only ids and hashes are
shuffled, into the buckets of the store, where the stored keys already lie; texts move only if they
have no vector yet, again straight into their bucket, so every task writes one bucket. How many works were met
and how many vectors written is observed in the tasks that write, without another pass over either.

``v=N`` are versions of a year. Runs append to the newest complete one; ``compact`` writes the next one with the
vectors of present texts alone and then drops the old one. A run or compaction that dies leaves the newest
complete version as it was, or with whole files of an append that are valid vectors.

A work without a year lies in ``year=none``, one without an id is left out. Works that share id and text get one vector. A work whose year
changes is embedded again in its new year, and ``compact`` drops the old vector.
"""
from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.operators.embed import BATCH_SIZE, CHUNK_SIZE, SEPARATOR, Encoder, embed, embedding_inputs
from trendloom.schemas import EMBEDDING_DIM
from trendloom.session import materialize
from trendloom.sources.tables import _locate, exists

BUCKETS = 64
KEY = ["id", "text_hash"]
YEAR = "publication_year"
_ROW = T.StructType([T.StructField("id", T.StringType()), T.StructField("text_hash", T.StringType()),
                     T.StructField("embedding", T.ArrayType(T.FloatType()))])


def _model_folder(path: str, model: str) -> str:
    return f"{path}/{quote(model, safe='')}"


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under a path; none if it is not there."""
    fs, target = _locate(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory()) if fs.exists(target) else []


def _version(spark: SparkSession, year_folder: str) -> int:
    """The newest version of a year that was written to its end; 0 is also that of an empty year."""
    numbers = [int(n.removeprefix("v=")) for n in _folders(spark, year_folder) if n.startswith("v=")]
    return max((n for n in numbers if exists(spark, f"{year_folder}/v={n}/_SUCCESS")), default=0)


def _drop(spark: SparkSession, folder: str) -> None:
    fs, target = _locate(spark, folder)
    fs.delete(target, True)


def _year_name(year: int | None) -> str:
    return f"year={'none' if year is None else int(year)}"


def _of_year(year: int | None) -> Column:
    return F.col(YEAR).isNull() if year is None else F.col(YEAR) == year


def years_of(works: DataFrame) -> list[int | None]:
    """The years of the works, null included, from that one column; bounded by the number of years."""
    return sorted((r[0] for r in works.select(YEAR).distinct().collect()), key=lambda y: (y is not None, y))


@contextmanager
def bucketed(spark: SparkSession, folder: str, buckets: int, chunk_size: int = CHUNK_SIZE) -> Iterator[str]:
    """The folder as a table that Spark knows to be bucketed. Only the session's catalogue learns of it, for as long as
    the block runs; the files stay."""
    name = f"trendloom_vectors_{uuid.uuid4().hex}"
    location = folder.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({', '.join(f'{f.name} {f.dataType.simpleString()}' for f in _ROW)}) USING parquet "
              f"OPTIONS (compression 'zstd', maxRecordsPerFile '{int(chunk_size)}') "
              f"CLUSTERED BY ({', '.join(KEY)}) INTO {int(buckets)} BUCKETS LOCATION '{location}'")
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _buckets(spark: SparkSession, path: str, wanted: int) -> int:
    """The store's number of buckets, settled by its first run: another number would misplace keys."""
    settled = f"{path}/_buckets"
    if not exists(spark, settled):
        spark.range(1).select(F.lit(str(int(wanted))).alias("value")).coalesce(1).write.text(settled)
    return int(spark.read.text(settled).first()[0])


def _hashed(works: DataFrame, separator: str) -> DataFrame:
    """``id, text, text_hash`` of the works that can be embedded and found again by an id."""
    return embedding_inputs(works, separator).where(F.col("id").isNotNull()) \
        .withColumn("text_hash", F.sha2("text", 256))


def input_keys(inputs: DataFrame, buckets: int) -> DataFrame:
    """``id, text_hash, works`` of the inputs, each key once and in the task that holds its bucket. Repeats meet
    pre-aggregated, so a key of very many rows is no more than a row per task there."""
    return inputs.groupBy(*KEY).agg(F.count(F.lit(1)).alias("works")).repartition(buckets, *KEY)


def missing_keys(keys: DataFrame, stored: DataFrame, seen: Observation) -> DataFrame:
    """Keys without a vector. Stored keys are read where they lie; only the inputs' were shuffled.

    ``seen`` learns the works, their keys and the missing ones, above the join: an observation below it is lost where
    Spark finds a side empty.
    """
    held = stored.select(*KEY).distinct().withColumn("__held", F.lit(True))
    missing = F.col("__held").isNull()
    return keys.hint("merge").join(held.hint("merge"), KEY, "left").observe(
        seen, F.sum("works").alias("works"), F.count(F.lit(1)).alias("keys"), F.count_if(missing).alias("missing")) \
        .where(missing).select(*KEY)


def embed_year(works: DataFrame, path: str, encoder_factory: Callable[[], Encoder], model: str, year: int | None,
               dim: int = EMBEDDING_DIM, separator: str = SEPARATOR, buckets: int = BUCKETS,
               chunk_size: int = CHUNK_SIZE, batch_size: int = BATCH_SIZE, job: str | None = None) -> tuple[int, int]:
    """Embed what one year lacks; returns the works that can be embedded and the vectors written."""
    spark = works.sparkSession
    buckets = _buckets(spark, path, buckets)
    folder = f"{_model_folder(path, model)}/{_year_name(year)}"
    inputs = _hashed(works.where(_of_year(year)), separator)
    with bucketed(spark, f"{folder}/v={_version(spark, folder)}", buckets, chunk_size) as name:
        # Observed where each key is a single row of a result task, so the sums are exact however often a lost
        # executor makes earlier stages run again.
        seen = Observation()
        missing = materialize(missing_keys(input_keys(inputs, buckets), spark.table(name), seen), "vectors-missing")
        met = seen.get["works"] or 0
        if not seen.get["missing"]:
            return met, 0
        # The stored answer has a known size: texts are shuffled to meet it only where it is too large to send around.
        texts = inputs.join(missing, KEY, "left_semi").select(*KEY, "text")
        if met > seen.get["keys"]:                     # repeats of a text fall together before they are shuffled
            texts = texts.distinct()
        written = Observation()
        vectors = embed(texts.repartition(buckets, *KEY), encoder_factory, dim, batch_size, model=job or f"{model}/{uuid.uuid4().hex}")
        vectors.select(*_ROW.names).observe(written, F.count(F.lit(1)).alias("n")).write.insertInto(name)
        return met, written.get["n"]


def embed_into_store(works: DataFrame, path: str, encoder_factory: Callable[[], Encoder], model: str,
                     dim: int = EMBEDDING_DIM, years: Sequence[int | None] | None = None,
                     separator: str = SEPARATOR, buckets: int = BUCKETS, chunk_size: int = CHUNK_SIZE,
                     batch_size: int = BATCH_SIZE) -> tuple[int, int]:
    """Embed whatever the store at ``path`` lacks, year by year; returns the works that can be embedded and the vectors
    written. ``years`` limits the run to some years; each is committed on its own, so an interrupted run loses one year at
    most. An empty table is an error, as is one without anything to embed."""
    job = f"{model}/{uuid.uuid4().hex}"                # one load per worker for all years of this run
    done = [embed_year(works, path, encoder_factory, model, year, dim, separator, buckets, chunk_size, batch_size, job)
            for year in (years_of(works) if years is None else years)]
    met = sum(m for m, _ in done)
    if not met:
        raise ValueError("no work with a non-blank abstract in English: nothing to embed")
    return met, sum(w for _, w in done)


def read_store(spark: SparkSession, path: str, model: str, years: Sequence[int | None] | None = None) -> DataFrame:
    """``id, text_hash, embedding`` of all years, or of those given, from their newest versions."""
    base = _model_folder(path, model)
    names = _folders(spark, base) if years is None else [_year_name(y) for y in years]
    found = [f"{base}/{n}/v={_version(spark, f'{base}/{n}')}" for n in names if n.startswith("year=")]
    found = [f for f in found if exists(spark, f)]
    return spark.read.schema(_ROW).parquet(*found) if found else spark.createDataFrame([], _ROW)


def compact(works: DataFrame, path: str, model: str, separator: str = SEPARATOR,
            chunk_size: int = CHUNK_SIZE) -> tuple[int, int]:
    """Drop vectors of earlier texts and of works that are gone; returns the vectors kept and dropped.

    Vectors stay in their buckets: only the keys of the works are shuffled. Every year is replaced on its own, by a
    new version that counts from the moment it is complete.
    """
    spark = works.sparkSession
    base, kept, dropped = _model_folder(path, model), 0, 0
    buckets = _buckets(spark, path, BUCKETS)
    for name in (n for n in _folders(spark, base) if n.startswith("year=")):
        year = None if name == "year=none" else int(name.removeprefix("year="))
        now = _version(spark, f"{base}/{name}")
        old, new = f"{base}/{name}/v={now}", f"{base}/{name}/v={now + 1}"
        _drop(spark, new)                              # what a compaction that died has left
        present = input_keys(_hashed(works.where(_of_year(year)), separator), buckets)
        rows = Observation()
        with bucketed(spark, old, buckets) as source, bucketed(spark, new, buckets, chunk_size) as sink:
            stored = spark.table(source)
            before = stored.count()                    # from the footers
            stored.hint("merge").join(present.hint("merge"), KEY, "left_semi") \
                .dropDuplicates(KEY).observe(rows, F.count(F.lit(1)).alias("n")).write.insertInto(sink)
        now_kept = rows.get["n"]
        kept, dropped = kept + now_kept, dropped + before - now_kept
        for version in _folders(spark, f"{base}/{name}"):
            if version.startswith("v=") and int(version.removeprefix("v=")) <= now:
                _drop(spark, f"{base}/{name}/{version}")
    return kept, dropped
