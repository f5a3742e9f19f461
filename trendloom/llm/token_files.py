"""Token ids of documents as ORC files.

Every whole text is encoded with the tokenizers library, an end id is appended, and the documents lie in
ascending id order over the files. ORC keeps the ids in integer run-length encoding inside stripes, with a row
index of every ``STRIDE`` documents (least and greatest document id and position) and Bloom filters on the
document ids, so a stripe is a unit of parallel reading, and looking up documents or a span of token
positions skips whole files, stripes and row groups by their metadata.

A file row is ``doc_id, part, local_start, n_tokens, ids``; ``part`` numbers the sorted ranges, ``local_start`` counts the ids
before the document in its range. A small table of ranges beside the files holds what stands before each range, so the
position of a document in the whole corpus is one addition, and no pass over the ids numbers them.

Texts are sorted into ranges and encoded once, on their way into the files. Chunks
between white space are encoded once per worker and remembered (bounded): a chunk with the blank before it is
encoded alike wherever it stands, except beside special tokens, so texts with these go to the library whole. Plain
words, and the punctuation after them, are single pieces of the vocabulary's pattern and go straight to the
library's merges.

Null and empty texts hold the end id alone. Rows without an id come first; rows that repeat an id are in the order
they are read in, and they spread over ranges. An empty table gives
files without rows. Other columns are ignored.
"""
from __future__ import annotations

import re
import zlib
from array import array
from codecs import charmap_decode
from collections.abc import Callable, Iterator
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trendloom.llm.bpe import byte_symbols
from trendloom.llm.common import own_cache, sent_if_small

END = 2
STRIPE_BYTES = 32 << 20
STRIDE = 1000                # documents of one row-index entry
KEEP_CHUNKS = 400_000        # entries of each of the two generations a worker keeps
KEEP_CHARS = 16_000_000      # characters of each
_BATCH_CHARS = 1 << 22       # text encoded at a time

# The white space at which the vocabulary's pattern cuts.
_RARE_WHITE = "\\t\\x0b-\\r\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_WHITE = f" \\n{_RARE_WHITE}"
_CHUNK = re.compile(f" ?[^{_WHITE}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+")
_OTHER_WHITE = re.compile(f"[{_RARE_WHITE}]")
_PLAIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\u0391-\u03a1\u03a3-\u03ce\u0400-\u0481]+)([.,;:!?]*)")
_ID = attrgetter("id")
_ALONE = "\n\n"              # marks a chunk with neither blank nor line end before it; regular texts hold no empty line


class _Memory:
    """Ids of chunks met lately, in two generations: when the young one is full it becomes the old one, so
    chunks in use stay and the memory is bounded by ``KEEP_CHUNKS`` and ``KEEP_CHARS``."""

    def __init__(self, make: Callable[[str], bytes]) -> None:
        self.make, self.young, self.old, self.chars = make, {}, {}, 0

    def all(self, chunks: list[str]) -> list[bytes]:
        """The ids of each of ``chunks``."""
        if len(self.young) >= KEEP_CHUNKS or self.chars >= KEEP_CHARS:
            self.young, self.old, self.chars = {}, self.young, 0
        young, old, make = self.young, self.old.get, self.make
        found = list(map(young.get, chunks))
        for at, ids in enumerate(found):
            if ids is None:
                chunk = chunks[at]
                found[at] = young[chunk] = old(chunk) or make(chunk)
                self.chars += len(chunk)
        return found


class ChunkEncoder:
    """The library behind a bounded memory of chunks, in which each stands without its blank or behind a mark."""

    def __init__(self, vocabulary: str) -> None:
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_str(vocabulary)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.symbols = "".join(byte_symbols())
        self.tokenize = self.library.model.tokenize
        self.newline = self._ids("\n")
        self.marks: dict[str, bytes] = {}
        self.chunks = _Memory(self._marked)

    def _ids(self, text: str) -> bytes:
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        """Ids of letters that the vocabulary's pattern does not cut, or of a blank and letters."""
        symbols = piece.replace(" ", self.symbols[32]) if piece.isascii() else charmap_decode(piece.encode(), "strict", self.symbols)[0]
        found = self.tokenize(symbols)
        return array("I", map(_ID, found)).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        plain = _PLAIN.fullmatch(chunk)
        if not plain:
            return self._ids(chunk)
        word, marks = plain.groups()
        return self._piece(word) + self._marks(marks)

    def _marked(self, chunk: str) -> bytes:
        """A chunk as it is remembered: alone, after a line end that is encoded with it, or after a blank."""
        if chunk.startswith(_ALONE):
            return self._chunk(chunk[len(_ALONE):])
        return self.newline + self._chunk(chunk[1:]) if chunk[0] == "\n" else self._after_blank(chunk)

    def _after_blank(self, word: str) -> bytes:
        """A chunk without its blank; the word before punctuation is often known."""
        plain = _PLAIN.fullmatch(word)
        if not plain:
            return self._ids(" " + word)
        letters, marks = plain.groups()
        if not marks:
            return self._piece(" " + letters)
        return (self.chunks.young.get(letters) or self.chunks.old.get(letters) or self._piece(" " + letters)) + self._marks(marks)

    def _marks(self, marks: str) -> bytes:
        if marks not in self.marks:
            if len(self.marks) > 1000:
                self.marks.clear()
            self.marks[marks] = self._ids(marks)
        return self.marks[marks]

    def _regular(self, text: str) -> bool:
        """Whether single blanks and single line ends between words are all the white space."""
        return not ("  " in text or " \n" in text or "\n " in text or "\n\n" in text or text[:1] in " \n"
                    or text[-1] in " \n" or _OTHER_WHITE.search(text))

    def _regular_texts(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of regular texts: each chunk of the batch is looked up once, and its ids are dealt to its places."""
        marked = [_ALONE + text.replace("\n", " \n") for text in texts]
        parts = pc.split_pattern(pa.array(marked, pa.large_string()), " ")
        places = parts.values.dictionary_encode()
        known = self.chunks.all(places.dictionary.to_numpy(zero_copy_only=False).tolist())
        ends = np.cumsum([0, *map(len, known)], dtype=np.int32) // 4
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.Array.from_buffers(
            pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(known))])).take(places.indices)
        cuts = (4 * lists.offsets.to_numpy()[parts.offsets.to_numpy()]).tolist()
        dealt = memoryview(lists.values.buffers()[1]).cast("B")
        return (bytes(dealt[a:b]) for a, b in zip(cuts, cuts[1:]))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out, regular = [], []
        for at, text in enumerate(texts):
            if not text or any(s in text for s in self.special):
                out.append(self._ids(text) if text else b"")
            elif self._regular(text):
                out.append(b"")
                regular.append(at)
            else:
                out.append(b"".join(self.chunks.all([_ALONE + chunk for chunk in _CHUNK.findall(text)])))
        if regular:
            for at, ids in zip(regular, self._regular_texts([texts[i] for i in regular])):
                out[at] = ids
        return out


_loaded: dict[int, ChunkEncoder] = {}


def _encoder(vocabulary: str) -> ChunkEncoder:
    """One encoder per worker; another vocabulary takes its place."""
    own_cache("token_files", _loaded.clear)
    key = hash(vocabulary)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = ChunkEncoder(vocabulary)
    return _loaded[key]


def encoded(docs: DataFrame, vocabulary: str, end: int = END, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids`` with the end id; ``vocabulary`` is the content of a vocabulary file, sent to every worker."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.concat_arrays([part for part, _ in _lists(texts, sent.value, end)])
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), ids(F.col(text)).alias("ids"))


def _lists(texts: pa.Array, vocabulary: str, end: int) -> Iterator[tuple[pa.ListArray, int]]:
    """The id lists of a batch in pieces of bounded text, each with the place of its first row."""
    encoder, last = _encoder(vocabulary), array("I", [end]).tobytes()

    def made(some: list[str]) -> pa.ListArray:
        found = encoder.encode(some)
        offsets = np.concatenate([[0], np.cumsum([len(f) // 4 + 1 for f in found])]).astype(np.int32)
        data = last.join(found) + last if found else b""
        values = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(data)])
        return pa.ListArray.from_arrays(pa.array(offsets), values)
    some, size, first = [], 0, 0
    for at, text in enumerate(texts):
        some.append(text.as_py() or "")
        size += len(some[-1])
        if size >= _BATCH_CHARS:
            yield made(some), first
            some, size, first = [], 0, at + 1
    yield made(some), first


def _numbered(vocabulary, end: int) -> Callable:
    """Encodes a sorted stream of ``doc_id, part, text`` and counts the ids before each document."""
    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for batch in batches:
            for ids, first in _lists(batch.column("text"), vocabulary.value, end):
                sizes = ids.value_lengths().to_numpy().astype(np.int64)
                starts = at + np.cumsum(sizes) - sizes
                at += int(sizes.sum())
                rows = batch.slice(first, len(ids))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), rows.column("part"), pa.array(starts), pa.array(sizes.astype(np.int32)), ids],
                    ["doc_id", "part", "local_start", "n_tokens", "ids"])
    return stream


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end: int = END, id_col: str = "doc_id",
                 text: str = "text", stripe_bytes: int = STRIPE_BYTES, stride: int = STRIDE) -> None:
    """Write the token files of all documents to ``path/tokens`` and their ranges to ``path/ranges``."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(vocabulary)
    ordered = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text")) \
        .withColumn("place", F.monotonically_increasing_id()) \
        .repartitionByRange("doc_id", "place").sortWithinPartitions("doc_id", "place") \
        .select("doc_id", F.spark_partition_id().alias("part"), "text")
    ordered.mapInArrow(_numbered(sent, end), "doc_id long, part int, local_start long, n_tokens int, ids array<int>") \
        .write.option("compression", "lz4").option("orc.stripe.size", stripe_bytes).option("orc.row.index.stride", stride) \
        .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", 0.01) \
        .option("orc.rows.between.memory.checks", 200).orc(f"{path}/tokens")
    sizes = spark.read.orc(f"{path}/tokens").groupBy("part").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("n_tokens").alias("tokens"),
        F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"))
    # One row per range, so this window is bounded by the number of shuffle partitions.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0))) \
        .coalesce(1).write.parquet(f"{path}/ranges")


def read_ranges(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/ranges")


def _placed(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    narrow = sent_if_small(ranges.select("part", "base"), 32)
    return rows.join(narrow, "part").select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of all documents, read stripe by stripe."""
    return _placed(spark.read.orc(f"{path}/tokens"), read_ranges(spark, path))


def read_documents(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The given documents; stripes and row groups without them are skipped by Bloom filter and row index."""
    rows = spark.read.orc(f"{path}/tokens").where(F.col("doc_id").isin(doc_ids))
    return _placed(rows, read_ranges(spark, path))


def read_span(spark: SparkSession, path: str, start: int, stop: int) -> DataFrame:
    """The documents with an id at a position from ``start`` up to but not including ``stop``; all other ranges and row
    groups are skipped by their row index."""
    ranges = read_ranges(spark, path)
    met = ranges.where((F.col("base") < stop) & (F.col("base") + F.col("tokens") > start))
    first, low, last, high = met.agg(F.min("part"), F.min("base"), F.max("part"), F.max("base")).first()
    rows = spark.read.orc(f"{path}/tokens")
    if first is None or start >= stop:
        return _placed(rows.where("false"), ranges)
    part, at = F.col("part"), F.col("local_start")
    rows = rows.where(part.between(first, last)).where((part > first) | (at + F.col("n_tokens") > start - low)) \
        .where((part < last) | (at < stop - high))
    return _placed(rows, ranges)


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of the ids as read back from the files."""
    @F.arrow_udf("struct<n: long, crc: long>")
    def digest(lists: pa.Array) -> pa.Array:
        values = memoryview(lists.values.buffers()[1] or b"").cast("B")
        skip, ends = lists.values.offset, lists.offsets.to_pylist()
        return pa.StructArray.from_arrays(
            [pa.array([b - a for a, b in zip(ends, ends[1:])], pa.int64()),
             pa.array([zlib.crc32(values[4 * (a + skip):4 * (b + skip)]) for a, b in zip(ends, ends[1:])], pa.int64())], ["n", "crc"])
    read = read_tokens(spark, path).withColumn("d", digest("ids"))
    return read.select("doc_id", "start", F.col("d.n").alias("n_tokens"), F.col("d.crc").alias("ids_crc32"))
