"""Hard-negative mining with exact integer scores from residue arithmetic.

Vectors are scaled to integers, ``floor(scale * x)``, and a score is the integer inner product. Products of two
blocks are taken modulo several small primes: the residues, from ``-(p - 1) / 2`` on, are so small that a float32
matrix product of ``WIDTH`` columns is exact, so every prime is one fast GEMM. Chinese remaindering in mixed
radix with symmetric digits then gives the signed scores; a pair of blocks takes as many primes as its
longest vectors can need.

Anchors are a stated query set, searched against all rows in blocks: they go out in waves of at most
``WAVE`` components, and one wave is two passes over the rows. The first keeps every anchor's best rows of
its own label (its positives), the second, for each positive, the best rows of other labels inside
the score window below it. A task holds the best few of each anchor only and gives them out at its end; the
tasks' answers meet in one ranking per anchor. No row is left out: what a task keeps is exactly what could
still be among the first.

Higher scores come first, ties by smaller id, rows without an id last. Rows with a null label, a null vector or
a null or non-finite component take no part, nor do rows whose squared integer length reaches 2**62, as
their scores may leave the range of a long. Vectors of different length have no score with each other; empty
vectors score 0. A row is never a positive or negative of an anchor of its own id; other repeated rows
count each, repeated anchors (same id, label and vector) once. An empty table gives no rows; other
columns are ignored.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.operators.ranking import top_per_group
from trendloom.session import scratch_path

WIDTH = 64                   # columns of one float32 product
WAVE = 4_000_000             # components of the anchors sent out at a time
ANCHORS, ROWS = 512, 4096    # sides of a block of scores
LIMIT = 2.0 ** 62            # squared length that a vector must stay below
_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


@lru_cache(maxsize=None)
def primes(width: int = WIDTH) -> tuple[int, ...]:
    """Odd primes whose residues multiply exactly over ``width`` columns in float32, largest first."""
    top = 2 * math.isqrt((1 << 24) // width) + 1
    sieve = np.ones(top + 1, bool)
    sieve[:2] = False
    for p in range(2, math.isqrt(top) + 1):
        if sieve[p]:
            sieve[p * p::p] = False
    return tuple(int(p) for p in np.nonzero(sieve)[0][:0:-1])


def moduli(bound: int) -> list[int]:
    """The fewest of the primes whose product exceeds ``2 * bound``, so that all of -bound..bound differ."""
    chosen, product = [], 1
    for p in primes():
        chosen.append(p)
        product *= p
        if product > 2 * bound:
            break
    return chosen


def symmetric(x: np.ndarray, p: int) -> np.ndarray:
    """Residues between ``-(p - 1) / 2`` and ``(p - 1) / 2``."""
    r = np.mod(x, p)
    return np.where(r > p // 2, r - p, r)


class Block:
    """Integer vectors of one length with their ids and labels."""

    def __init__(self, slots: np.ndarray, ids: np.ndarray, known: np.ndarray, labels: np.ndarray,
                 vectors: np.ndarray) -> None:
        self.slots, self.ids, self.known, self.labels, self.vectors = slots, ids, known, labels, vectors
        self.longest = float((vectors * vectors).sum(axis=1).max(initial=0.0))
        self._residues: dict[int, np.ndarray] = {}

    def residues(self, p: int) -> np.ndarray:
        if p not in self._residues:
            self._residues[p] = symmetric(self.vectors, p).astype(np.float32)
        return self._residues[p]

    def part(self, at: np.ndarray) -> Block:
        return Block(self.slots[at], self.ids[at], self.known[at], self.labels[at], self.vectors[at])


def scores(a: Block, b: Block) -> np.ndarray:
    """Exact inner products of all vectors of ``a`` with all of ``b``."""
    bound = int(math.sqrt(a.longest) * math.sqrt(b.longest) * (1 + 1e-9)) + 1
    total, product = None, 1
    for p in moduli(bound):
        ra, rb = a.residues(p), b.residues(p)
        found = np.zeros((len(ra), len(rb)), np.int64)
        for at in range(0, ra.shape[1], WIDTH):
            found += (ra[:, at:at + WIDTH] @ rb[:, at:at + WIDTH].T).astype(np.int64)
        if total is None:
            total = symmetric(found, p)
        else:
            digit = symmetric((found - total) % p * pow(product, -1, p), p)
            total = total + product * digit
        product *= p
    return total


class Best:
    """The first ``k`` offers of every slot, by score, then id."""

    def __init__(self, slots: int, k: int) -> None:
        self.k = k
        self.n = np.zeros(slots, np.int64)
        self.score, self.id = np.zeros((2, slots, k), np.int64)
        self.known = np.zeros((slots, k), bool)

    def floor(self, slots: np.ndarray) -> np.ndarray:
        """The score an offer must reach to be among the first."""
        return np.where(self.n[slots] == self.k, self.score[slots, -1], -(1 << 62))

    def offer(self, slots: np.ndarray, score: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        if not len(slots):
            return
        touched = np.unique(slots)
        row, place = np.nonzero(np.arange(self.k) < self.n[touched, None])
        held = touched[row]
        slot = np.concatenate([held, slots])
        score = np.concatenate([self.score[held, place], score])
        ids = np.concatenate([self.id[held, place], ids])
        known = np.concatenate([self.known[held, place], known])
        order = np.lexsort((ids, ~known, -score, slot))
        slot, score, ids, known = slot[order], score[order], ids[order], known[order]
        first = np.searchsorted(slot, touched)
        rank = np.arange(len(slot)) - np.repeat(first, np.diff([*first, len(slot)]))
        keep = rank < self.k
        slot, rank = slot[keep], rank[keep]
        self.score[slot, rank], self.id[slot, rank], self.known[slot, rank] = score[keep], ids[keep], known[keep]
        self.n[touched] = np.bincount(np.searchsorted(touched, slot), minlength=len(touched))

    def filled(self) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """Slots, scores and ids of all offers held."""
        slot, place = np.nonzero(np.arange(self.k) < self.n[:, None])
        return slot, self.score[slot, place], pa.array(self.id[slot, place], mask=~self.known[slot, place])


def blocks_of(ids: pa.Array, labels: pa.Array, vectors: pa.ListArray, scale: float) -> Iterator[Block]:
    """One block per vector length, of the rows whose length stays below the limit."""
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else sizes
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    names = ids.fill_null(0).to_numpy(zero_copy_only=False)
    kinds = labels.to_numpy(zero_copy_only=False)
    for size in np.unique(sizes):
        at = np.nonzero(sizes == size)[0]
        q = np.floor(scale * values[starts[at][:, None] + np.arange(size)])
        with np.errstate(over="ignore", invalid="ignore"):
            fits = (q * q).sum(axis=1) < LIMIT
        at, q = at[fits], q[fits]
        if len(at):
            yield Block(at, names[at], known[at], kinds[at], q)


def cut(block: Block, size: int) -> Iterator[Block]:
    for at in range(0, len(block.ids), size):
        yield block.part(np.arange(at, min(at + size, len(block.ids))))


class Wave:
    """Anchors of bounded size, as blocks by vector length; ``slots`` number them within the wave."""

    def __init__(self, ids: pa.Array, labels: pa.Array, vectors: pa.ListArray, scale: float) -> None:
        self.ids = ids.to_numpy(zero_copy_only=False)
        self.scale = scale
        self.by_size: dict[int, list[Block]] = {}
        for block in blocks_of(ids, labels, vectors, scale):
            self.by_size[block.vectors.shape[1]] = list(cut(block, ANCHORS))

    def pairs(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Block, Block]]:
        """Every block of anchors with every block of rows of the same vector length."""
        for batch in batches:
            for whole in blocks_of(*batch.columns, self.scale):
                for rows in cut(whole, ROWS):
                    for anchors in self.by_size.get(rows.vectors.shape[1], ()):
                        yield anchors, rows

    def best_of_label(self, batches: Iterator[pa.RecordBatch], k: int) -> Best:
        """The best rows of each anchor's own label."""
        best = Best(len(self.ids), k)
        for anchors, rows in self.pairs(batches):
            for label in np.intersect1d(anchors.labels, rows.labels):
                a, b = anchors.part(anchors.labels == label), rows.part(rows.labels == label)
                s = scores(a, b)
                near = (s >= best.floor(a.slots)[:, None]) & ~(b.known & (b.ids == a.ids[:, None]))
                x, y = np.nonzero(near)
                best.offer(a.slots[x], s[x, y], b.ids[y], b.known[y])
        return best

    def best_in_window(self, batches: Iterator[pa.RecordBatch], positives: np.ndarray, counts: np.ndarray,
                       low: int, k: int) -> Best:
        """For each anchor's positive scores ``positives[anchor, j]``, ``j < counts[anchor]``, the best rows of other
        labels from ``low`` hundredths of that score up to it; slot ``anchor * width + j``."""
        width = positives.shape[1]
        best = Best(len(self.ids) * width, k)
        for anchors, rows in self.pairs(batches):
            s = scores(anchors, rows)
            other = (rows.labels != anchors.labels[:, None]) & ~(rows.known & (rows.ids == anchors.ids[:, None]))
            for j in range(width):
                slot = anchors.slots * width + j
                top = positives[anchors.slots, j]
                least = np.where(counts[anchors.slots] > j, np.maximum(window_floor(top, low), best.floor(slot)), top + 1)
                x, y = np.nonzero(other & (s >= least[:, None]) & (s <= top[:, None]))
                best.offer(slot[x], s[x, y], rows.ids[y], rows.known[y])
        return best


def window_floor(score: np.ndarray, low: int) -> np.ndarray:
    """The least integer ``n`` with ``low * score <= 100 * n``, without leaving the range of a long."""
    whole, rest = score // 100, score % 100
    return low * whole - (-low * rest // 100)


def usable(rows: DataFrame, id_col: str, label: Column, vector: str) -> DataFrame:
    """``id, label, vector`` of the rows that take part."""
    return rows.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
                       F.col(vector).alias("vector")).where("label is not null and vector is not null") \
        .where(~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))


def waves_of(anchors: DataFrame, scale: float, wave: int) -> Iterator[Wave]:
    """The anchors in waves; the driver holds one at a time."""
    kept, size = [], 0
    for row in anchors.toLocalIterator():
        kept.append(row)
        size += len(row["vector"]) + 16
        if size >= wave:
            yield _wave(kept, scale)
            kept, size = [], 0
    if kept:
        yield _wave(kept, scale)


def _wave(rows: list, scale: float) -> Wave:
    ids, labels, vectors = zip(*rows)
    return Wave(pa.array(ids, pa.int64()), pa.array(labels, pa.int64()), pa.array(vectors, pa.list_(pa.float64())), scale)


def hard_negatives(rows: DataFrame, anchors: Column, id_col: str = "vec_id", label: Column | str = "label",
                   vector: str = "embedding", scale: float = 256.0, low: int = 80, positives: int = 5,
                   negatives: int = 5, wave: int = WAVE) -> DataFrame:
    """For every anchor (rows where the column ``anchors`` over ``id`` holds) and each of its first ``positives`` rows of
    the same label, the first ``negatives`` rows of other labels that score at least ``low`` hundredths of
    the positive and at most as much: ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``."""
    spark = rows.sparkSession
    all_rows = usable(rows, id_col, F.col(label) if isinstance(label, str) else label, vector)
    picked = all_rows.where(anchors).dropDuplicates()
    path, written = scratch_path(spark, "negatives"), False
    order = [F.desc("score"), F.asc_nulls_last("id")]
    for one in waves_of(picked, scale, wave):
        sent = spark.sparkContext.broadcast(one)

        def of_label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            slot, score, ids = sent.value.best_of_label(batches, positives).filled()
            yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(score), ids], ["slot", "score", "id"])
        near = top_per_group(all_rows.mapInArrow(of_label, "slot long, score long, id long"), "slot", order, positives)
        counts = np.zeros(len(one.ids), np.int64)
        held = np.zeros((2, len(one.ids), positives), np.int64)
        known = np.zeros((len(one.ids), positives), bool)
        for r in near.toLocalIterator():                        # a few rows per anchor of the wave
            j = r["rank"] - 1
            held[0, r["slot"], j], known[r["slot"], j] = r["score"], r["id"] is not None
            held[1, r["slot"], j] = r["id"] or 0
            counts[r["slot"]] = max(counts[r["slot"]], j + 1)
        found = spark.sparkContext.broadcast((held, known, counts))

        def in_window(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            (top, name), given, n = found.value
            best = sent.value.best_in_window(batches, top, n, low, negatives)
            slot, score, ids = best.filled()
            anchor, j = np.divmod(slot, positives)
            yield pa.RecordBatch.from_arrays(
                [pa.array(slot), pa.array(sent.value.ids[anchor]), pa.array(name[anchor, j], mask=~given[anchor, j]),
                 pa.array(top[anchor, j]), pa.array(score), ids],
                ["slot", "anchor_id", "positive_id", "positive_score", "score", "id"])
        far = all_rows.mapInArrow(in_window, "slot long, anchor_id long, positive_id long, positive_score long, "
                                             "score long, id long")
        top_per_group(far, "slot", order, negatives) \
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")) \
            .write.mode("append").parquet(path)
        written = True
        sent.unpersist()
        found.unpersist()
    return spark.read.schema(_RESULT).parquet(path) if written else spark.createDataFrame([], _RESULT)


def mined_label(id_col: str = "vec_id", label: str = "label", every: int = 7, labels: int = 10) -> Column:
    """The label, moved on by one where the id is a multiple of ``every``."""
    kind = F.col(label).cast("long")
    return F.when(F.coalesce(F.col(id_col) % every == 0, F.lit(False)), (kind + 1) % labels).otherwise(kind)
