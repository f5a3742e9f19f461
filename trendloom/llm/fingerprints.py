"""Document fingerprints: a bottom-k sketch of the word-shingle hashes of a text.

The sketch is the ``k`` smallest distinct hashes. It is mergeable (the ``k`` smallest of two sketches'
union sketch the union of the texts), and estimates the number of distinct shingles, resemblance and
containment. All of it is array functions inside one row, so no shingle is ever shuffled; before
sorting, only hashes below a bound that is expected to leave four times ``k`` are kept, and a row where that bound
leaves too few sorts all of them, so the sketch is always exact.

A text with fewer words than a shingle is one shingle; a text without words, empty or null has an
empty sketch, which resembles only another empty one. Words are runs between white space, lower-cased.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendloom.functions.arrays import bind

WIDTH, K = 5, 128
_BITS = 48                       # hash bits kept; twelve hex digits each in the printed form
_DIGITS = _BITS // 4
_ROOM = 4


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), "")


def shingle_hashes(text: Column, width: int = WIDTH) -> Column:
    """Hashes of all shingles in order, as non-negative longs of 48 bits."""
    def hashed(*parts: Column) -> Column:
        return F.shiftrightunsigned(F.xxhash64(*parts), 64 - _BITS)

    def shingles(ws: Column) -> Column:
        whole = F.when(F.size(ws) > 0, F.array(hashed(F.array_join(ws, " ")))) \
            .otherwise(F.array().cast("array<bigint>"))
        each = F.transform(F.sequence(F.lit(0), F.size(ws) - width),
                           lambda i: hashed(*[F.get(ws, i + j) for j in range(width)]))
        return F.when(F.size(ws) < width, whole).otherwise(each)
    return bind(words_of(text), shingles)


def bottom_k(hashes: Column, k: int = K) -> Column:
    """The ``k`` smallest distinct hashes, ascending."""
    def smallest(hs: Column) -> Column:
        bound = (F.lit(float(1 << _BITS)) * (_ROOM * k) / F.greatest(F.size(hs), F.lit(1))).cast("long")
        few = F.array_distinct(F.filter(hs, lambda h: h < bound))
        return bind(few, lambda f: F.slice(F.sort_array(
            F.when(F.size(f) >= k, f).otherwise(F.array_distinct(hs))), F.lit(1), F.lit(k)))
    return bind(hashes, smallest)


def sketch_text(text: Column, width: int = WIDTH, k: int = K) -> Column:
    return bottom_k(shingle_hashes(text, width), k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of two texts."""
    return F.slice(F.sort_array(F.array_union(a, b)), F.lit(1), F.lit(k))


def distinct_shingles(sketch: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    kth = F.get(sketch, F.lit(k - 1)).cast("double")
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")) \
        .otherwise(F.lit(k - 1) * F.lit(float(1 << _BITS)) / (kth + 1))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of common shingles (0 to 1): of the ``k`` smallest of the union, those in both."""
    both_empty = (F.size(a) == 0) & (F.size(b) == 0)
    return F.when(both_empty, F.lit(1.0)).otherwise(bind(merge(a, b, k), lambda u: F.size(
        F.array_intersect(F.array_intersect(u, a), b)) / F.size(u)))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of ``a``'s shingles that ``b`` has (0 to 1); 1 for an empty ``a``."""
    union = distinct_shingles(merge(a, b, k), k)
    shared = resemblance(a, b, k) * union
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(
        F.least(F.lit(1.0), shared / distinct_shingles(a, k)))


def printed(sketch: Column) -> Column:
    """The sketch as text: twelve hex digits per hash, ascending."""
    return F.array_join(F.transform(sketch, lambda h: F.lower(F.lpad(F.hex(h), _DIGITS, "0"))), "")


def _place(key: Column, cuts: list[int]) -> Column:
    """How many of the ascending ``cuts`` are at or below the key, by halving."""
    edges = F.array(*[F.lit(c) for c in cuts]).cast("array<bigint>")

    def halved(at: Column, step: int) -> Column:
        return bind(at, lambda p: p + F.when(
            F.get(edges, p + (step - 1)) <= key, F.lit(step)).otherwise(F.lit(0)))
    at = F.lit(0)
    for power in reversed(range(len(cuts).bit_length())):
        at = halved(at, 1 << power)
    return at


def with_next(docs: DataFrame, key: str, columns: list[str], per_task: int = 4) -> DataFrame:
    """``docs`` with ``next_<column>`` of the row that follows by the whole-number column ``key``; the
    first row follows the last.

    Keys are cut into ranges at approximate quantiles, which are keys of the data, so each range's
    first key is known without another look. Rows move once, to their range; the first row of a
    range also goes to the range before it. The number of ranges follows the shuffle partitions, and
    the driver holds that many keys. Equal keys are ordered by the listed columns; null keys come first.
    """
    n = per_task * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.withColumn("__key", F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))))
    seen = keyed.agg(F.min("__key").alias("least"), F.percentile_approx(
        "__key", [i / n for i in range(1, n)], 20 * n).alias("cuts")).first()
    cuts = sorted({c for c in seen["cuts"] or [] if c > seen["least"]})
    starts = F.array(*[F.lit(c) for c in [seen["least"], *cuts]]).cast("array<bigint>")

    def homes(at: Column) -> Column:
        own = F.struct(at.alias("range"), F.lit(False).alias("copy"))
        before = F.when(at > 0, at - 1).otherwise(F.lit(len(cuts)))
        return F.when(F.get(starts, at) == F.col("__key"), F.array(
            own, F.struct(before.alias("range"), F.lit(True).alias("copy")))).otherwise(F.array(own))
    dealt = keyed.withColumn("__home", F.explode(bind(_place(F.col("__key"), cuts), homes)))
    follow = Window.partitionBy("__home.range").orderBy("__home.copy", "__key", *columns)
    return dealt.withColumns({f"next_{c}": F.lead(c).over(follow) for c in columns}) \
        .where(~F.col("__home.copy")).drop("__home", "__key")


def edited_text(text: Column, following: Column) -> Column:
    """The text whose last half (code points, rounded down) is replaced by as many from the start of
    the following text, or by all of it."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.left(text, n - half), F.left(following, half))


def fingerprint_report(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: its sketch, that of its edited text, and how much it resembles the
    edited text and the next document."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    paired = with_next(rows.withColumn("sketch", sketch_text(F.col("text"))), "id", ["text", "sketch"])
    edited = paired.withColumn("edited", edited_text(F.col("text"), F.col("next_text")))
    sketched = edited.withColumn("edited_sketch", sketch_text(F.col("edited")))
    return sketched.select(
        F.col("id").alias(id_col), F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"), printed(F.col("sketch")).alias("fingerprint"),
        printed(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"))
