"""Checksums of stored files in pieces: memory is bounded by one piece, whatever the size of a file."""
from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PIECE_BYTES = 8 << 20
LINE_BYTES = 4 << 10      # longer lines travel in pieces, so a batch of rows stays small
_DIGESTS = "path string, bytes long, sha256 string"
_BOM = b"\xef\xbb\xbf"
_URI = re.compile(r"([A-Za-z][A-Za-z0-9+.-]*):(//[^/]*)?(/.*)", re.S)


def _open(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a listed path and the place in it; listings give ``file:/x`` and unescaped names."""
    parts = _URI.fullmatch(path)
    if not parts:
        return fs.LocalFileSystem(), path
    scheme, host, place = parts.groups()
    return fs.FileSystem.from_uri(f"{scheme}:{host or '//'}{quote(place)}")


def sha256_of(path: str, piece: int = PIECE_BYTES) -> tuple[int, str]:
    """Bytes and SHA-256 of one file."""
    system, place = _open(path)
    digest, size = hashlib.sha256(), 0
    with system.open_input_stream(place, compression=None) as stream:
        while data := stream.read(piece):
            digest.update(data)
            size += len(data)
    return size, digest.hexdigest()


def file_digests(files: DataFrame, piece: int = PIECE_BYTES) -> DataFrame:
    """``(path, bytes, sha256)`` of listed files (``list_files``), whose contents Spark does not load.

    Spark deals files to tasks by their size. A file that is not as long as listed is an error, as it changed meanwhile.
    """
    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, length in zip(batch["path"], batch["length"]):
                size, value = sha256_of(path, piece)
                if size != length:
                    raise ValueError(f"{path} has {size} bytes, listed with {length}")
                rows.append((path, size, value))
            yield pd.DataFrame(rows, columns=["path", "bytes", "sha256"])
    return files.select("path", F.col("length")).mapInPandas(digest, _DIGESTS)


def read_digests(files: DataFrame) -> DataFrame:
    """``(path, bytes, sha256)`` of listed files of any size, on any file system Spark reads.

    Local and mounted files are read in place, others by Spark's readers. There only small files and names that these
    would unpack (``.gz`` and the like) are read as one value each, so the latter must stay under 2 GB.
    """
    spark = files.sparkSession
    local = F.col("path").startswith("file:")
    far = files.where(~local).select("path", "length").collect()             # the listing is on the driver already
    if not far:
        return file_digests(files)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop
    codecs = hadoop.io.compress.CompressionCodecFactory(spark._jsparkSession.sessionState().newHadoopConf())
    whole = {r.path for r in far if r.length <= LINE_BYTES or codecs.getCodec(hadoop.fs.Path(r.path))}
    found = file_digests(files.where(local))
    if whole:
        found = found.unionByName(_listed(spark, "binaryFile", sorted(whole)).select(
            "path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256")))
    lines = [r.path for r in far if r.path not in whole]
    return found.unionByName(line_digests(spark, lines)) if lines else found


def _listed(spark: SparkSession, kind: str, paths: list[str], **options: str) -> DataFrame:
    """Exactly these files: no name is a pattern, no folder a column."""
    return spark.read.format(kind).options(recursiveFileLookup="true", __globPaths__="false", **options).load(paths)


def line_digests(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``(path, bytes, sha256)`` of uncompressed files, read by Spark as the bytes between line feeds.

    A file is split and read by many tasks; its lines then meet in one, in their order, as SHA-256 has no other. The
    reader does not tell whether the last line is ended, and drops a byte order mark: the size shows both. A file that
    is not as long as listed is an error.
    """
    line = F.concat(F.col("value").cast("binary"), F.lit(b"\n"))
    cut = F.transform(F.sequence(F.lit(0), F.floor((F.length("line") - 1) / LINE_BYTES).cast("int")),
                      lambda i: F.substring("line", i * LINE_BYTES + 1, F.lit(LINE_BYTES)))
    pieces = _listed(spark, "text", paths, lineSep="\n") \
        .select("_metadata.file_path", "_metadata.file_size", "_metadata.file_block_start", line.alias("line")) \
        .select("file_path", "file_size", "file_block_start", F.explode(cut).alias("piece")) \
        .withColumn("at", F.monotonically_increasing_id())

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, size, total, last, states = None, 0, 0, b"", ()

        def done() -> pa.RecordBatch:
            short = size - total
            if short not in (-1, 0, len(_BOM) - 1, len(_BOM)):
                raise ValueError(f"{path} has {total} bytes, listed with {size}")
            state = states[short > 0]
            state.update(last if short in (0, len(_BOM)) else b"")
            return pa.RecordBatch.from_pydict({"path": [unquote(path)], "bytes": [size], "sha256": [state.hexdigest()]})
        for batch in batches:
            runs, start = pc.run_end_encode(batch.column("file_path")), 0
            for name, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
                if name != path:
                    if path is not None:
                        yield done()
                    path, size, total, last = name, batch.column("file_size")[start].as_py(), 0, b""
                    states = hashlib.sha256(), hashlib.sha256(_BOM)
                data = b"".join((last, *batch.column("piece")[start:end].to_pylist()))
                total += len(data) - len(last)
                last = data[-1:]                      # held back: the last line feed may not be there
                for state in states:
                    state.update(memoryview(data)[:-1])
                start = end
        if path is not None:
            yield done()
    return pieces.repartition("file_path").sortWithinPartitions("file_path", "file_block_start", "at") \
        .select("file_path", "file_size", "piece").mapInArrow(digest, _DIGESTS)
