"""BPE encoding and decoding with a public vocabulary file.

A word is a doubly linked list of symbols and a heap of mergeable pairs ordered by merge rank, then
place. A popped pair that no longer stands in the list (one side merged away or changed) is stale
and skipped, so a word of n symbols costs O(n log n) and no list is rebuilt per merge. Decoding
joins the vocabulary strings of the ids.

Text is read as the vocabulary file says: special tokens are cut out of the raw text first, the rest
is NFC, lower case (letter by letter), split into words, and every word becomes byte symbols whose
last one carries the word-end mark. White space only separates, so each blank-free chunk of a text is
encoded on its own; workers keep a bounded dictionary of chunks they have seen. Every row is
encoded whole and on its own: nothing is shuffled, and a lost task is simply run again.

Null and empty texts give no tokens; every other column, whatever its name, is left as it is.
"""
from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.llm.common import own_cache

_WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_PYTHON_ONLY_WHITE = regex.compile("[\\x1c-\\x1f]")      # str.split cuts here, the vocabulary does not
_CHUNK = regex.compile(f"[^{_WHITE}]+")
KEEP_CHUNKS = 200_000        # entries of each of the two generations a worker keeps


def byte_symbols() -> list[str]:
    """The printable stand-in of every byte: printable Latin-1 stays, the others follow from 256 on."""
    stays = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b) if b in stays else chr(next(others)) for b in range(256)]


class WordBpe:
    """Encoder and decoder of one vocabulary file of the word-end kind."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str,
                 special: dict[str, int], pattern: str) -> None:
        self.special = special
        self.first = [vocab[s] for s in byte_symbols()]
        self.last = [vocab[s + suffix] for s in byte_symbols()]
        self.strings = {i: s for s, i in (vocab | special).items()}
        self.rank_of = {vocab[a] << 16 | vocab[b]: rank for rank, (a, b) in enumerate(merges)}
        self.joined = [vocab[a + b] for a, b in merges]
        self.pattern = regex.compile(pattern)
        self.cut = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) \
            if special else None
        self.seen: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    @classmethod
    def from_json(cls, text: str) -> WordBpe:
        spec = json.loads(text)
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        return cls(spec["model"]["vocab"], merges, spec["model"]["end_of_word_suffix"],
                   {t["content"]: t["id"] for t in spec["added_tokens"]},
                   split.replace("\\s", _WHITE))

    def word_ids(self, word: str) -> list[int]:
        """Ids of one word. A heap entry is ``rank * n + place``; ``live`` holds the rank of the pair
        that starts at each place now, so an entry of another rank is stale."""
        data = word.encode()
        ids = [self.first[b] for b in data]
        ids[-1] = self.last[data[-1]]
        n = len(ids)
        if n == 1:
            return ids
        rank_of, joined = self.rank_of, self.joined
        live = [rank_of.get(a << 16 | b, -1) for a, b in zip(ids, ids[1:])]
        heap = [rank * n + i for i, rank in enumerate(live) if rank >= 0]
        if not heap:
            return ids
        live.append(-1)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heapq.heapify(heap)
        while heap:
            rank, i = divmod(heapq.heappop(heap), n)
            if live[i] != rank:
                continue
            j = right[i]
            new = ids[i] = joined[rank]
            ids[j] = live[j] = live[i] = -1
            k = right[i] = right[j]
            if k < n:
                left[k] = i
                rank = rank_of.get(new << 16 | ids[k], -1)
                if rank >= 0:
                    live[i] = rank
                    heapq.heappush(heap, rank * n + i)
            h = left[i]
            if h >= 0:
                rank = live[h] = rank_of.get(ids[h] << 16 | new, -1)
                if rank >= 0:
                    heapq.heappush(heap, rank * n + h)
        return [i for i in ids if i >= 0]

    def _chunk(self, chunk: str) -> bytes:
        """A chunk not seen lately. Two generations: when the young one is full it becomes the old
        one, so chunks in use stay and the memory is bounded."""
        entry = self.old.get(chunk)
        if entry is None:
            words = self.pattern.findall(chunk)
            if len(words) == 1 and len(words[0]) == len(chunk):
                entry = array("I", self.word_ids(chunk)).tobytes()
            else:
                entry = b"".join([self.seen.get(w) or self._chunk(w) for w in words])
        if len(self.seen) >= KEEP_CHUNKS:
            self.old, self.seen = self.seen, {}
        self.seen[chunk] = entry
        return entry

    def _segments(self, text: str) -> Iterator[bytes]:
        """Ids as bytes, chunk by chunk."""
        at = 0
        for hit in self.cut.finditer(text) if self.cut else ():
            yield from self._plain(text[at:hit.start()])
            yield array("I", [self.special[hit[0]]]).tobytes()
            at = hit.end()
        yield from self._plain(text[at:] if at else text)

    def _plain(self, text: str) -> Iterator[bytes]:
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        text = text.replace("Σ", "σ").lower()              # no special form at the end of a word
        chunks = _CHUNK.findall(text) if _PYTHON_ONLY_WHITE.search(text) else text.split()
        for chunk in chunks:
            yield self.seen.get(chunk) or self._chunk(chunk)

    def encode(self, text: str) -> array:
        ids = array("I")
        ids.frombytes(b"".join(self._segments(text)))
        return ids

    def decode(self, ids) -> str:
        return " ".join(map(self.strings.__getitem__, ids))

    def digests(self, text: str) -> tuple[int, str, str]:
        """Tokens, and the SHA-256 of the ids and of the decoded text."""
        ids = self.encode(text)
        return (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(),
                hashlib.sha256(self.decode(ids).encode()).hexdigest())


_loaded: dict[str, WordBpe] = {}


def _worker_bpe(path: str) -> WordBpe:
    """One encoder per Python worker; another vocabulary takes its place."""
    own_cache("bpe", _loaded.clear)
    if path not in _loaded:
        _loaded.clear()
        with open(path, encoding="utf-8") as f:
            _loaded[path] = WordBpe.from_json(f.read())
    return _loaded[path]


def bpe_encode(text: Column, vocabulary: str) -> Column:
    """Token ids of a text column; ``vocabulary`` is a path every worker has."""
    @F.pandas_udf("array<int>")
    def encode(texts: pd.Series) -> pd.Series:
        bpe = _worker_bpe(vocabulary)
        return pd.Series([bpe.encode(t).tolist() for t in texts])
    return encode(F.coalesce(text, F.lit("")))


def bpe_decode(ids: Column, vocabulary: str) -> Column:
    """The text of a column of token ids; null stays null."""
    @F.pandas_udf("string")
    def decode(lists: pd.Series) -> pd.Series:
        bpe = _worker_bpe(vocabulary)
        return pd.Series([None if x is None else bpe.decode(x) for x in lists], dtype=object)
    return decode(ids)


def bpe_digests(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids_sha256`` (little-endian unsigned 32-bit ids) and
    ``decoded_sha256``; columns of these names are replaced. Ids and decoded texts are built and
    hashed inside the task, so the rows stay small however long the texts are."""
    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(texts: pd.Series) -> pd.DataFrame:
        bpe = _worker_bpe(vocabulary)
        return pd.DataFrame([bpe.digests(t) for t in texts],
                            columns=["n_tokens", "ids_sha256", "decoded_sha256"])
    made = docs.withColumn("__bpe", digests(F.coalesce(F.col(text), F.lit(""))))
    return made.withColumns({c: F.col(f"__bpe.{c}") for c in
                             ("n_tokens", "ids_sha256", "decoded_sha256")}).drop("__bpe")
