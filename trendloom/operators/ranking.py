"""Dense ranks, per-group top lists and row numbers that never gather a table in one task."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendloom.operators.ordered_index import OrderedIndex, write_index
from trendloom.session import materialize, scratch_path

_LOCAL_BITS = 33          # monotonically_increasing_id keeps the row's place in its low 33 bits


def top_per_group(df: DataFrame, group: str | list[str], order: list[Column], k: int,
                  rank: str = "rank") -> DataFrame:
    """The first ``k`` rows per group. The constant bound lets every map task cut its own input
    to ``k`` rows per group before the shuffle, so a group with a third of all rows is harmless."""
    keys = [group] if isinstance(group, str) else group
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def with_row_index(df: DataFrame, *order: str, name: str = "row_index") -> DataFrame:
    """Number all rows 0..n-1 in the given order; equal keys keep the order they are read in.

    Rows are range-partitioned and sorted, written once, and the size of every range gives the
    offset of the next. Read order is the last sort key, so many copies of one key spread over
    several ranges.
    """
    place, at = "__read_order", "__place"
    ranged = (
        df.withColumn(place, F.monotonically_increasing_id())
        .repartitionByRange(*order, place)
        .sortWithinPartitions(*order, place)
        .withColumn(at, F.monotonically_increasing_id())
        .drop(place)
    )
    stored = materialize(ranged, "row-index")
    part = F.shiftright(F.col(at), _LOCAL_BITS)
    sizes = stored.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("size"))
    # One row per shuffle partition, so this window and the broadcast are bounded by that number.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    local = F.col(at).bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    return (
        stored.withColumn("part", part)
        .join(F.broadcast(offsets), "part")
        .withColumn(name, F.col("offset") + local)
        .drop("part", "offset", at)
    )


def _index(df: DataFrame, order: list[str], key: str) -> OrderedIndex:
    path = scratch_path(df.sparkSession, "ordered-index")
    write_index(df, order, path, key)
    return OrderedIndex(df.sparkSession, path, key)


def with_chunks(df: DataFrame, chunk_size: int = 5000, key: str = "id") -> DataFrame:
    """Number fixed-size chunks of the rows sorted by key, which must be unique. Only keys are sorted and
    stored; other columns meet them by key."""
    numbered = _index(df, [key], key).numbered() \
        .withColumn("chunk", F.floor(F.col("row_index") / chunk_size).cast("int"))
    if df.columns == [key]:
        return numbered
    numbered = numbered.withColumnRenamed(key, "__key")
    return df.join(numbered, F.col(key).eqNullSafe(F.col("__key"))).drop("__key")


def with_pages(df: DataFrame, order: list[str], per_page: int = 40, key: str = "id") -> DataFrame:
    """``(*order, key, page)`` of every row in the total order ``order``, then ``key``; pages from 0."""
    numbered = _index(df, order, key).numbered()
    return numbered.withColumn("page", F.floor(F.col("row_index") / per_page)).drop("row_index")


def page_of(df: DataFrame, order: list[str], page: int, per_page: int = 40, key: str = "id") -> DataFrame:
    """One page of a result; a page past the end becomes the last one.

    The order is made total by ``key``, which must be unique, so all pages together are the result,
    each row once. This sorts the keys for a single page; to turn pages, write the index once and
    ask it (``ordered_index``).
    """
    return _index(df, order, key).page(df, page, per_page)
