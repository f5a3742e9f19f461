"""Exact, reproducible samples that do not depend on how the data is partitioned.

A row's place in the sample order is the MD5 of key, stratum and seed, so any engine can repeat
the draw. Instead of sorting everything, a histogram over the leading hex digits finds the one
bucket in which each stratum's quota ends, only the keys of that bucket are ranked, and the wide
rows are then picked by a plain filter. Rows that share the key at which a quota ends are drawn the same
way once more, in the order of a digest of the whole row; rows equal in every column are one row
with a count. So no task ever holds the copies of a key, and the same rows come from any layout.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendloom.operators.ranking import with_row_index
from trendloom.session import materialize

SAMPLE_SEED = 11


def _bucket(digits: int) -> Column:
    return F.substring("__hash", 1, digits)


def _proportional(rows: int) -> Callable[[Column, Column], Column]:
    """A stratum's share of ``rows``, rounded half to even and at most its size."""
    def quota(size: Column, total: Column) -> Column:
        share = F.bround(F.lit(rows).cast("double") * size / total, 0).cast("bigint")
        return F.least(size, share)
    return quota


def stratum_quotas(works: DataFrame, stratum: str, rows: int) -> DataFrame:
    """Rows to draw per stratum: ``(stratum, size, quota)``."""
    sizes = works.groupBy(stratum).agg(F.count(F.lit(1)).alias("size"))
    total = sizes.agg(F.sum("size")).scalar()
    return sizes.withColumn("quota", _proportional(rows)(F.col("size"), total))


def _cutoffs(keyed: DataFrame, key: str, with_quota: Callable[[DataFrame], DataFrame],
             digits: int) -> DataFrame:
    """Per stratum the last hash and key that are drawn, and how many copies of that key.

    ``with_quota`` adds ``quota`` to rows with ``__stratum, size, total``. ``keyed`` holds ``__stratum``, the key and ``__hash``. Both windows run over the histogram:
    at most ``16**digits`` rows per stratum.
    """
    stratum = Window.partitionBy("__stratum")
    so_far = stratum.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    histogram = materialize(
        keyed.groupBy("__stratum", _bucket(digits).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n")), "sample-histogram")
    total = histogram.agg(F.sum("n")).scalar()
    last_bucket = (
        with_quota(histogram.withColumns({
            "size": F.sum("n").over(stratum), "total": total,
            "before": F.coalesce(F.sum("n").over(so_far), F.lit(0))}))
        .where((F.col("before") < F.col("quota")) & (F.col("quota") <= F.col("before") + F.col("n")))
        .select(F.col("__stratum").alias("__s"), F.col("bucket").alias("__b"),
                (F.col("quota") - F.col("before")).alias("rest"))
    )
    # One row per stratum, stored so that its true size is known: the keys then meet it in a
    # broadcast join chosen by that size and are not shuffled.
    last_bucket = materialize(last_bucket, "last-buckets")
    edge = keyed.withColumn("bucket", _bucket(digits)).join(
        last_bucket, F.col("__stratum").eqNullSafe(F.col("__s")) & (F.col("bucket") == F.col("__b")))
    by_hash = Window.partitionBy("__s").orderBy("__hash", key) \
        .rowsBetween(Window.unboundedPreceding, -1)
    return (
        edge.groupBy("__s", "bucket", "__hash", key, "rest")
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("before", F.coalesce(F.sum("copies").over(by_hash), F.lit(0)))
        .where((F.col("before") < F.col("rest"))
               & (F.col("rest") <= F.col("before") + F.col("copies")))
        .select("__s", F.col("bucket").alias("__cut_bucket"), F.col("__hash").alias("__cut_hash"),
                F.col(key).alias("__cut_key"), (F.col("rest") - F.col("before")).alias("__keep"),
                "copies")
    )


def _draw(works: DataFrame, stratum: str | None, key: str,
          quota: Callable[[Column, Column], Column], seed: int, digits: int) -> DataFrame:
    """Rows up to each stratum's cut-off; ``stratum`` None draws from the table as a whole."""
    group = F.col(stratum) if stratum else F.lit(0)
    parts = [F.col(key).cast("string"), F.lit(str(seed))]
    if stratum:
        parts.insert(1, F.col(stratum).cast("string"))
    hashed = F.md5(F.concat_ws("|", *parts))
    keyed = works.select(group.alias("__stratum"), key, hashed.alias("__hash"))
    cutoffs = materialize(_cutoffs(keyed, key, lambda h: h.withColumn(
        "quota", quota(F.col("size"), F.col("total"))), digits), "sample-cutoffs")
    split_copies = not cutoffs.where(F.col("copies") > F.col("__keep")).isEmpty()
    located = works.withColumn("__hash", hashed).withColumn("__bucket", _bucket(digits))
    if stratum:            # one row per stratum; Spark checks the stored size before it broadcasts
        located = located.join(cutoffs, F.col(stratum).eqNullSafe(F.col("__s")))
    else:                  # a single row, so plain constants do
        cut_row = cutoffs.first()
        if cut_row is None:
            return works.limit(0)
        located = located.withColumns({
            f.name: F.lit(cut_row[f.name]).cast(f.dataType) for f in cutoffs.schema.fields})
    order = (F.col("__bucket"), F.col("__hash"), F.col(key))
    cut = (F.col("__cut_bucket"), F.col("__cut_hash"), F.col("__cut_key"))
    below = F.struct(*order) < F.struct(*cut)
    at = F.struct(*order) == F.struct(*cut)
    if not split_copies:
        return located.where(below | at).select(*works.columns)
    # Several rows share the last key and only some fit: draw among them by their digests.
    names = works.columns
    tied = located.where(at).withColumn("__row", F.md5(F.to_json(F.struct(*names))))
    keep = cutoffs.select(F.col("__s").alias("__k"), F.col("__keep").cast("bigint").alias("quota"))
    ends = materialize(_cutoffs(
        tied.select(F.col("__s").alias("__stratum"), "__row", F.col("__row").alias("__hash")), "__row",
        lambda h: h.join(keep, h["__stratum"].eqNullSafe(keep["__k"])).drop("__k"), digits), "sample-ends") \
        .select(F.col("__s").alias("__e"), F.col("__cut_key").alias("__last"), F.col("__keep").alias("__room"))
    placed = tied.join(ends, F.col("__s").eqNullSafe(F.col("__e")))
    equal = placed.where(F.col("__row") == F.col("__last")).groupBy("__e", "__room") \
        .agg(F.count(F.lit(1)).alias("n"), F.first(F.struct(*names)).alias("row"))
    some = equal.select("row", F.explode(F.sequence(F.lit(1), F.least("n", "__room").cast("int")))).select("row.*")
    before = placed.where(F.col("__row") < F.col("__last")).select(*names)
    return located.where(below).select(*names).unionByName(before).unionByName(some)


def stratified_sample(works: DataFrame, rows: int = 40_000, stratum: str = "publication_year",
                      key: str = "id", seed: int = SAMPLE_SEED, digits: int = 4) -> DataFrame:
    """A sample of about ``rows`` rows, proportional over the strata and exact in each."""
    return _draw(works, stratum, key, _proportional(rows), seed, digits)


def uniform_sample(works: DataFrame, n: int = 200, key: str = "id", seed: int = 42,
                   digits: int = 4) -> DataFrame:
    """Exactly ``n`` rows (or all, when there are fewer)."""
    return _draw(works, None, key, lambda size, total: F.least(size, F.lit(n)), seed, digits)


def systematic_sample(works: DataFrame, limit: int = 4000, key: str = "id") -> DataFrame:
    """Every ``max(1, N // limit)``-th row in key order, at most ``limit`` of them.

    Only keys are sorted and numbered; the wide rows are read once, against the picked keys.
    Keys must be unique, as ids of works are.
    """
    index = with_row_index(works.select(key), key)
    total = index.agg(F.count(F.lit(1))).scalar()
    step = F.greatest(F.lit(1), F.floor(total / F.lit(limit)))
    picked = index.where(
        (F.pmod(F.col("row_index"), step) == 0) & (F.col("row_index") < step * F.lit(limit)))
    # stored, so Spark chooses the join by the true size of the picked keys
    return works.join(materialize(picked.select(key), "sample-keys"), key, "left_semi")
