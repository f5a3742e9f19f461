"""Batch text embedding with a user-supplied encoder.

An encoder factory is a picklable function without arguments that loads the model and returns
``encode(list[str]) -> 2-D float array``. It is called once per Python worker, and only when
that worker has rows to encode.
"""
from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.functions.arrays import bind
from trendloom.functions.text import strip
from trendloom.operators.filters import embeddable
from trendloom.schemas import EMBEDDING_DIM
from trendloom.session import materialize
from trendloom.sources.tables import exists

# Model input convention and batch sizes.
SEPARATOR = "[SEP]"
BATCH_SIZE = 32
CHUNK_SIZE = 5000

Encoder = Callable[[list[str]], object]


def input_text(title: Column, abstract: Column, separator: str = SEPARATOR) -> Column:
    """Stripped title, separator, stripped abstract; a missing title is empty."""
    return F.concat(strip(F.coalesce(title, F.lit(""))), F.lit(separator), strip(abstract))


def embedding_inputs(works: DataFrame, separator: str = SEPARATOR) -> DataFrame:
    """``(id, text)`` of every work that can be embedded."""
    return embeddable(works).select(
        "id", input_text(F.col("title"), F.col("abstract"), separator).alias("text"))


def unit_length(v: Column) -> Column:
    """The vector scaled to length one; a zero vector stays as it is."""
    def scale(pair: Column) -> Column:
        return F.transform(pair["v"], lambda x: F.when(
            pair["norm"] > 0, x.cast("double") / pair["norm"]).otherwise(x.cast("double"))
            .cast("float"))
    norm = F.sqrt(F.aggregate(v, F.lit(0.0),
                              lambda acc, x: acc + x.cast("double") * x.cast("double")))
    return bind(F.struct(v.alias("v"), norm.alias("norm")), scale)


def l2_normalize(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """Unit vectors, so Euclidean order equals cosine order."""
    return vectors.withColumn(column, unit_length(F.col(column)))


def embed(texts: DataFrame, encoder_factory: Callable[[], Encoder], dim: int = EMBEDDING_DIM,
          batch_size: int = BATCH_SIZE, normalize: bool = True, model: str | None = None) -> DataFrame:
    """Embed ``(id, text, ...)``; other columns pass through, ``text`` is replaced by ``embedding``.

    Rows stream through the worker in Arrow batches and the model sees ``batch_size`` texts at a
    time. A worker process holds one encoder, that of ``model``: tasks and later calls with the same
    name share it, another name takes its place.
    """
    kept = [f for f in texts.schema.fields if f.name != "text"]
    schema = T.StructType(kept + [T.StructField("embedding", T.ArrayType(T.FloatType()))])
    names = [f.name for f in kept]
    name = model or uuid.uuid4().hex
    slot = "trendloom-encoder"

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import sys

        import numpy as np
        import pandas as pd
        for pdf in batches:
            if pdf.empty:
                continue
            held = sys.modules.get(slot)               # lives as long as the worker process
            if held is None or held[0] != name:
                sys.modules.pop(slot, None)            # the old model goes before the new one comes
                held = sys.modules[slot] = (name, encoder_factory())
            encoder, text = held[1], pdf["text"].tolist()
            vectors = np.concatenate([
                np.asarray(encoder(text[i:i + batch_size]), dtype="float64")
                for i in range(0, len(text), batch_size)])
            if vectors.shape != (len(pdf), dim):
                raise ValueError(f"encoder gave {vectors.shape}, expected {(len(pdf), dim)}")
            if normalize:
                norms = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
                vectors = vectors / np.where(norms > 0, norms, 1.0)
            out = pdf[names].reset_index(drop=True)
            out["embedding"] = pd.Series(list(vectors.astype("float32")), dtype="object")
            yield out
    return texts.mapInPandas(encode, schema)


def pending_inputs(works: DataFrame, done: DataFrame | None, model: str,
                   separator: str = SEPARATOR) -> DataFrame:
    """Inputs without a stored vector for the same id, text and model."""
    inputs = embedding_inputs(works, separator).withColumns({
        "text_hash": F.sha2("text", 256), "model": F.lit(model)})
    if done is None:
        return inputs
    # Ids and hashes alone decide what is missing; the stored answer has a known size, so the texts
    # are only shuffled where it is too large to send around.
    missing = materialize(
        inputs.select("id", "text_hash").join(
            done.where(F.col("model") == model).select("id", "text_hash"), ["id", "text_hash"], "left_anti"),
        "embed-missing")
    return inputs.join(missing.distinct(), ["id", "text_hash"], "left_semi")


def stored_embeddings(spark: SparkSession, path: str) -> DataFrame | None:
    """The embedding table at ``path`` or None when nothing is stored yet."""
    schema = T.StructType([
        T.StructField("id", T.StringType()), T.StructField("text_hash", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("embedding", T.ArrayType(T.FloatType()))])
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else None


def current_embeddings(works: DataFrame, stored: DataFrame, model: str, separator: str = SEPARATOR) -> DataFrame:
    """One vector per work that can be embedded: the stored one of its present text. Vectors of earlier texts
    stay in the table and are left out here."""
    now = embedding_inputs(works, separator).select("id", F.sha2("text", 256).alias("text_hash"))
    return stored.where(F.col("model") == model).join(now.distinct(), ["id", "text_hash"], "left_semi") \
        .dropDuplicates(["id", "text_hash"])


def embed_corpus(works: DataFrame, path: str, encoder_factory: Callable[[], Encoder], model: str,
                 dim: int = EMBEDDING_DIM, separator: str = SEPARATOR,
                 waves: Sequence[Column] = (), chunk_size: int = CHUNK_SIZE,
                 batch_size: int = BATCH_SIZE) -> int:
    """Embed whatever is not stored yet, append it at ``path``, return the number of embedded works.

    A row counts as done when its id, text and model are stored, so a changed text is embedded
    again and an interrupted run continues. ``waves`` are row conditions, best on a folder column
    such as the year so that each reads only its part; every wave is one committed job, which
    bounds what an interruption can cost. A last pass covers all rows no wave has matched. Files
    hold at most ``chunk_size`` rows.
    """
    spark = works.sparkSession
    job = f"{model}/{uuid.uuid4().hex}"               # one load per worker for all waves of this run
    inputs = embedding_inputs(works, separator)
    if inputs.isEmpty():
        raise ValueError("no work with a non-blank abstract in English: nothing to embed")
    for part in [works.where(wave) for wave in waves] + [works]:
        pending = pending_inputs(part, stored_embeddings(spark, path), model, separator)
        vectors = embed(pending, encoder_factory, dim, batch_size, model=job)
        vectors.write.mode("append").option("compression", "zstd") \
            .option("maxRecordsPerFile", chunk_size).parquet(path)
    return inputs.count()
