"""A stored ordered index: the keys of a table in one total order, sorted once and written in ranges.

Every range lies in its own folder, and a small table beside them holds each range's number of rows, the rows before
it and its first key. A page, a chunk or the place of a given key is then found in that table, and only the
folder that holds it is read: nothing is sorted again. Only the order columns and the key are stored.
"""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LOCAL = (1 << 33) - 1       # monotonically_increasing_id keeps the row's place in its low 33 bits
_AT, _RANGE, _KEY = "__at", "__range", "__key"
KEYS_PER_FILE = 5_000_000


def write_index(df: DataFrame, order: Iterable[str], path: str, key: str = "id", keys_per_file: int = KEYS_PER_FILE) -> None:
    """Index ``df`` by ``order``, then ``key``, nulls first; the key must be unique, null counting as a value.

    Read order is the last sort key, so even many copies of a wrong key spread over ranges before they are refused.
    """
    spark, total, place = df.sparkSession, [*dict.fromkeys([*order, key])], "__place"
    df.select(*total).withColumn(place, F.monotonically_increasing_id()) \
        .repartitionByRange(*total, place).withColumn(_RANGE, F.spark_partition_id()) \
        .sortWithinPartitions(_RANGE, *total, place) \
        .withColumn(_AT, F.monotonically_increasing_id().bitwiseAND(F.lit(_LOCAL))).drop(place) \
        .write.partitionBy(_RANGE).option("compression", "zstd").option("maxRecordsPerFile", keys_per_file) \
        .parquet(f"{path}/keys")
    keys = _stored_keys(spark, path, [df.schema[c] for c in total])
    if not keys.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        raise ValueError(f"{key} is not unique, so places in the order would not add up")
    # One row per range, so this window is bounded by the number of shuffle partitions.
    before = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    keys.groupBy(_RANGE).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*total)).alias("first")) \
        .withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).coalesce(1).write.parquet(f"{path}/ranges")


def _stored_keys(spark: SparkSession, path: str, fields: list[T.StructField]) -> DataFrame:
    own = [T.StructField(_AT, T.LongType()), T.StructField(_RANGE, T.IntegerType())]
    return spark.read.schema(T.StructType([*fields, *own])).parquet(f"{path}/keys")


class OrderedIndex:
    """An index written by ``write_index``. Rows are numbered from 0."""

    def __init__(self, spark: SparkSession, path: str, key: str = "id") -> None:
        self.key, self.ranges = key, spark.read.parquet(f"{path}/ranges")
        fields = self.ranges.schema["first"].dataType.fields
        self.order = [f.name for f in fields]
        self.keys = _stored_keys(spark, path, fields)
        self.rows: int = self.ranges.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    def numbered(self, name: str = "row_index") -> DataFrame:
        """The order columns and the number of every row."""
        return self._numbered(self.keys, name)

    def _numbered(self, keys: DataFrame, name: str) -> DataFrame:
        bases = F.broadcast(self.ranges.select(_RANGE, "base"))       # one row per range
        return keys.join(bases, _RANGE).select(*self.order, (F.col("base") + F.col(_AT)).alias(name))

    def between(self, start: int, stop: int, name: str = "row_index") -> DataFrame:
        """Rows ``start`` up to but not including ``stop``; other ranges are not read."""
        met = self.ranges.where((F.col("base") < stop) & (F.col("base") + F.col("n") > start))
        first, low, last, high = met.agg(F.min(_RANGE), F.min("base"), F.max(_RANGE), F.max("base")).first()
        if first is None or start >= stop:
            return self._numbered(self.keys.where("false"), name)
        inside = self.keys.where(F.col(_RANGE).between(first, last)) \
            .where((F.col(_RANGE) > first) | (F.col(_AT) >= start - low)) \
            .where((F.col(_RANGE) < last) | (F.col(_AT) < stop - high))
        return self._numbered(inside, name)

    def page(self, df: DataFrame, page: int, per_page: int = 40) -> DataFrame:
        """The rows of ``df`` on one page, in order; a page past the end becomes the last one, one before the start the
        first. Rows that came after the index was written are on no page."""
        page = max(0, min(page, max(1, -(-self.rows // per_page)) - 1))
        picked = self.between(page * per_page, (page + 1) * per_page).select(F.col(self.key).alias(_KEY))
        found = df.join(F.broadcast(picked), F.col(self.key).eqNullSafe(F.col(_KEY)), "left_semi")    # per_page keys
        return found.select(*df.columns).orderBy(*self.order)

    def place_of(self, **values: object) -> int:
        """How many rows stand before the given order columns and key, which need not be in the index; the page to
        open on is this by the page size."""
        wanted = self._struct(values)
        start = self.ranges.where(F.col("first") <= wanted).agg(F.max(F.struct("base", _RANGE)).alias("r")).select("r.*").first()
        if start[_RANGE] is None:
            return 0
        inside = self.keys.where(F.col(_RANGE) == start[_RANGE]).where(F.struct(*self.order) < wanted)
        return start["base"] + inside.count()

    def _struct(self, values: dict[str, object]) -> Column:
        types = self.ranges.schema["first"].dataType
        return F.struct(*[F.lit(values[c]).cast(types[c].dataType).alias(c) for c in self.order])
