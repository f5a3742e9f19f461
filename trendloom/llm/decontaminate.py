"""Benchmark decontamination by pigeonhole edit matching.

Both sides are normalised (lower case, everything but letters and digits becomes one blank). A test item of
``m`` characters may be found with up to ``k = floor(error_rate * m)`` edits. It is split into ``k + 1``
pieces: k edits cannot touch all of them, so every true place holds at least one piece unchanged. One pass of an
Aho-Corasick automaton over a text finds all pieces of all items; each hit gives the window in which
the whole item could stand, overlapping windows are joined, and Myers' bit-parallel distance is
computed over them (one machine integer of ``m`` bits per text character, so linear in the window).

The search is a map over whole texts: no shuffle, no pairs of documents, one answer row per
(document, item) found. Items go out in blocks of at most ``BLOCK_CHARS`` characters, one pass and one stored
table per block, so neither the driver nor a task ever holds more of a benchmark than that.

Null texts, and items that are null or empty after normalising, match nothing. An item longer than a
text by more than ``k`` cannot match it. Repeated items (same id and text) give one row; items that share
an id or have none are told apart by their text and give a row each; rows without an id keep a null id. Columns of other names are ignored.
"""
from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import reduce

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.session import materialize

ERROR_RATE = 0.07            # pieces then have 14 characters or so, which unrelated texts seldom share
BLOCK_CHARS = 1_000_000
_OTHER = re.compile(r"[\W_]+")
FOUND = "array<struct<item: long, distance: int, start: int, stop: int>>"


def normal(text: str | None) -> str:
    return _OTHER.sub(" ", (text or "").lower()).strip()


def pieces_of(item: str, budget: int) -> list[tuple[int, str]]:
    """``budget + 1`` pieces with their offsets, lengths equal to within one."""
    n = min(budget + 1, len(item))
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def letter_masks(item: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def myers(masks: dict[str, int], m: int, text: str, budget: int) -> tuple[int, int] | None:
    """The least edit distance (at most ``budget``) of the item to any substring, and where that ends."""
    full, high = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best, at = full, 0, m, budget + 1, -1
    get = masks.get
    for i, c in enumerate(text):
        eq = get(c, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        ph = minus | (full & ~(xh | plus))
        mh = plus & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
            if score < best:
                best, at = score, i + 1
        ph <<= 1
        plus = full & ((mh << 1) | ~(xv | ph))
        minus = ph & xv
    return None if at < 0 else (best, at)


class Matcher:
    """Finds the items of one block in normalised texts."""

    def __init__(self, items: Iterable[tuple[int | None, str]], error_rate: float = ERROR_RATE) -> None:
        self.items = [(i, normal(t)) for i, t in sorted(set(items), key=repr) if normal(t)]
        self.budgets = [int(error_rate * len(t)) for _, t in self.items]
        self.masks = [letter_masks(t) for _, t in self.items]
        self.backward = [letter_masks(t[::-1]) for _, t in self.items]
        places: dict[str, list[tuple[int, int]]] = {}
        for n, (_, item) in enumerate(self.items):
            for offset, piece in pieces_of(item, self.budgets[n]):
                places.setdefault(piece, []).append((n, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, at in places.items():
            self.automaton.add_word(piece, (len(piece), at))
        self.automaton.make_automaton()

    def _windows(self, text: str) -> dict[int, list[tuple[int, int]]]:
        """Per item the joined windows in which it could stand."""
        starts: dict[int, set[int]] = {}
        for end, (length, places) in self.automaton.iter(text):
            for n, offset in places:
                starts.setdefault(n, set()).add(end + 1 - length - offset)
        windows = {}
        for n, diagonals in starts.items():
            m, k = len(self.items[n][1]), self.budgets[n]
            joined: list[tuple[int, int]] = []
            for d in sorted(diagonals):
                lo, hi = max(0, d - k), min(len(text), d + m + k)
                if hi - lo < m - k:
                    continue
                if joined and lo <= joined[-1][1]:
                    joined[-1] = (joined[-1][0], hi)
                else:
                    joined.append((lo, hi))
            windows[n] = joined
        return windows

    def find(self, text: str) -> list[tuple[int | None, int, int, int]]:
        """``(item, distance, start, stop)`` of the best place of every item found; items are told apart by id and text."""
        if not self.items:
            return []
        found = []
        for n, windows in self._windows(text).items():
            item_id, item = self.items[n]
            best = None
            at = text.find(item)
            if at >= 0:
                best = (0, at, at + len(item))
            else:
                for lo, hi in windows:
                    hit = myers(self.masks[n], len(item), text[lo:hi], self.budgets[n] if best is None else best[0] - 1)
                    if hit:
                        stop = lo + hit[1]
                        back = text[max(lo, stop - len(item) - hit[0]):stop][::-1]
                        start = stop - (myers(self.backward[n], len(item), back, hit[0]) or (0, len(item)))[1]
                        best = (hit[0], start, stop)
            if best:
                found.append((item_id, *best))
        return found


def blocks_of(items: DataFrame, id_col: str, text: str, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of bounded size; the driver holds one block at a time."""
    block, size = [], 0
    listed = items.select(F.col(id_col).cast("long").alias("i"), F.col(text).alias("t")).where("t is not null")
    for row in listed.distinct().toLocalIterator():
        block.append((row["i"], row["t"]))
        size += len(row["t"])
        if size >= block_chars:
            yield block
            block, size = [], 0
    if block:
        yield block


def _searcher(block: list[tuple[int, str]], error_rate: float):
    @F.pandas_udf(FOUND)
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(block, error_rate)
        for texts in batches:
            yield pd.Series([[dict(zip(("item", "distance", "start", "stop"), f)) for f in matcher.find(normal(t))]
                             for t in texts], dtype=object)
    return search


def find_items(docs: DataFrame, block: list[tuple[int, str]], id_col: str, text: str, error_rate: float) -> DataFrame:
    """``id, item_id, distance, start, stop`` of one block."""
    found = _searcher(block, error_rate)(F.col(text))
    return docs.select(F.col(id_col).alias("id"), F.explode(found).alias("f")) \
        .select("id", F.col("f.item").alias("item_id"), "f.distance", "f.start", "f.stop")


def benchmark_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text",
                    item_col: str = "item_id", item_text: str = "text", error_rate: float = ERROR_RATE,
                    block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per input row and item that it holds: id, ``item_id``, ``distance`` (edits) and the
    place in the normalised text."""
    spark = docs.sparkSession
    tables = [materialize(find_items(docs, block, id_col, text, error_rate), "leaks")
              for block in blocks_of(items, item_col, item_text, block_chars)]
    if not tables:
        tables = [spark.createDataFrame([], "id long, item_id long, distance int, start int, stop int")
                  .withColumn("id", F.col("id").cast(docs.schema[id_col].dataType))]
    return reduce(DataFrame.unionByName, tables).withColumnRenamed("id", id_col)


def without_leaks(docs: DataFrame, items: DataFrame, text: str = "text", item_col: str = "item_id",
                  item_text: str = "text", error_rate: float = ERROR_RATE,
                  block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents that hold none of the items, with all their columns, by plain filters."""
    clean, waiting = docs, None
    for block in blocks_of(items, item_col, item_text, block_chars):
        if waiting is not None:
            clean = materialize(clean.where(F.size(waiting) == 0), "leak-free")
        waiting = _searcher(block, error_rate)(F.col(text))
    return clean if waiting is None else clean.where(F.size(waiting) == 0)
