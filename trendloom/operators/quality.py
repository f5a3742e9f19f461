"""Coverage against a reference series, acceptance report, manifest and shape rules."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.functions.numbers import ratio, round_exact
from trendloom.operators.counts import duplicate_count, key_counts, labelled
from trendloom.operators.filters import in_date_years
from trendloom.session import materialize
from trendloom.sources.digests import PIECE_BYTES, file_digests, read_digests

# Acceptance thresholds.
MIN_ROWS = 100_000
MIN_ABSTRACT_SHARE = 0.70
MAX_GAP = 0.02


def gap_of(actual: Column, expected: Column) -> Column:
    """``abs(actual - expected) / expected``; null without an expectation."""
    return ratio(F.abs(actual - expected), F.when(expected != 0, expected))


def year_counts(works: DataFrame) -> DataFrame:
    return works.groupBy(F.col("publication_year").cast("int").alias("year")) \
        .agg(F.count(F.lit(1)).alias("actual"))


def coverage_gap(actual: DataFrame, expected: DataFrame, how: str = "full_outer") -> DataFrame:
    """Actual against expected counts per year: ``(year, actual, expected, gap)``.

    ``how`` picks the side: ``left`` keeps the years we have, ``right`` the years expected.
    """
    joined = actual.select("year", "actual").join(
        expected.select("year", "expected"), "year", how)
    filled = joined.select(
        "year", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("actual", "expected")])
    return filled.withColumn("gap", gap_of(F.col("actual"), F.col("expected")))


def gap_years(coverage: DataFrame, limit: float = MAX_GAP) -> DataFrame:
    """Years whose gap exceeds the limit."""
    return coverage.where(F.col("gap") > limit)


def preprint_link(works: DataFrame, preprints: DataFrame) -> DataFrame:
    """One row: distinct preprint ids the works name, and how many of them we hold."""
    named = works.where(F.col("arxiv_id") != "").select(F.col("arxiv_id").alias("id")).distinct()
    held = preprints.select("id", F.lit(True).alias("held")).distinct()
    return named.join(held, "id", "left").agg(
        F.count("held").alias("matched"), F.count(F.lit(1)).alias("total"))


def linked_preprints(works: DataFrame, preprints: DataFrame) -> DataFrame:
    """The distinct preprint ids that occur on both sides."""
    named = works.where(F.col("arxiv_id") != "").select(F.col("arxiv_id").alias("id")).distinct()
    return named.join(preprints.select("id").distinct(), "id", "left_semi")


def _check(order: int, name: str, ok: Column, value: Column) -> Column:
    return F.struct(F.lit(order).alias("no"), F.lit(name).alias("check"),
                    F.coalesce(ok, F.lit(False)).alias("ok"), value.cast("double").alias("value"))


def acceptance(works: DataFrame, expected: DataFrame, preprints: DataFrame | None = None,
               manifest: DataFrame | None = None, sample: DataFrame | None = None,
               year_start: int = 2010, year_end: int = 2025, min_rows: int = MIN_ROWS,
               min_abstract: float = MIN_ABSTRACT_SHARE, max_gap: float = MAX_GAP) -> DataFrame:
    """The acceptance report as ``(no, check, ok, value)`` rows.

    ``expected`` is ``(year, expected)``, ``preprints`` the deduplicated corpus, ``manifest`` the
    output of ``manifest_check``, ``sample`` the stored sample. A missing part fails its check;
    purely informative rows are always ok. Everything passes when all rows are ok.
    """
    info = F.lit(True)
    # Works are scanned twice: counts by year, and counts by key; both are stored, as several checks read them.
    by_year = materialize(works.groupBy(F.col("publication_year").cast("int").alias("year")).agg(
        F.count(F.lit(1)).alias("actual"), F.count("abstract").alias("a"),
        F.count_if(F.col("publication_date").isNull()).alias("no_date")), "accepted-years")
    keys = materialize(key_counts(works, None if preprints is None else preprints.select("id")), "accepted-keys")
    base = by_year.agg(
        F.coalesce(F.sum("actual"), F.lit(0)).alias("n"), F.coalesce(F.sum("a"), F.lit(0)).alias("a"),
        F.coalesce(F.sum("no_date"), F.lit(0)).alias("no_date"),
        F.coalesce(F.sum(F.when(F.col("year").isNull(), F.col("actual"))), F.lit(0)).alias("no_year"))
    share = ratio(F.col("a"), F.col("n"))
    parts = [
        base.select(F.inline(F.array(
            _check(1, "works", F.col("n") >= min_rows, F.col("n")),
            _check(2, "abstract_share", share >= min_abstract, share),
            _check(3, "undated", (F.col("no_date") == 0) & (F.col("no_year") == 0),
                   F.col("no_date") + F.col("no_year"))))),
        keys.select(F.inline(F.array(
            _check(4, "duplicate_ids", F.col("duplicate_ids") == 0, F.col("duplicate_ids")),
            _check(5, "shared_dois", info, F.col("shared_dois"))))),
        coverage_gap(by_year.select("year", "actual"), expected, "right")
        .agg(F.coalesce(F.max("gap"), F.lit(0.0)).alias("worst"))
        .select(F.inline(F.array(
            _check(6, "worst_gap", F.col("worst") <= max_gap, F.col("worst"))))),
    ]
    if preprints is not None:
        dated = F.coalesce(F.col("created") != "", F.lit(False))
        pre = preprints.agg(
            F.count_if(~dated).alias("undated"),
            F.count_if(dated & in_date_years("created", year_start, year_end)).alias("ours"))
        parts += [
            pre.select(F.inline(F.array(
                _check(7, "undated_preprints", F.col("undated") == 0, F.col("undated")),
                _check(9, "preprints_in_range", info, F.col("ours"))))),
            keys.select(F.inline(F.array(
                _check(8, "duplicate_preprints", F.col("duplicate_preprints") == 0, F.col("duplicate_preprints")),
                _check(10, "linked_preprints", info, F.col("matched")),
                _check(11, "named_preprints", info, F.col("named"))))),
        ]
    else:
        parts.append(base.select(F.inline(F.array(
            _check(7, "preprints", F.lit(False), F.lit(0))))))
    if manifest is not None:
        parts.append(manifest.agg(F.count_if(F.col("status") != "ok").alias("bad")).select(
            F.inline(F.array(_check(12, "manifest_problems", F.col("bad") == 0, F.col("bad"))))))
    else:
        parts.append(base.select(F.inline(F.array(
            _check(12, "manifest_problems", F.lit(False), F.lit(None))))))
    if sample is not None:
        parts.append(sample.agg(F.count(F.lit(1)).alias("n")).select(
            F.inline(F.array(_check(13, "sample", F.col("n") > 0, F.col("n"))))))
    else:
        parts.append(base.select(F.inline(F.array(_check(13, "sample", F.lit(False), F.lit(0))))))
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def accepted(report: DataFrame) -> DataFrame:
    """One row: whether every check holds, and how many do not."""
    return report.agg(F.every("ok").alias("accepted"), F.count_if(~F.col("ok")).alias("failed"))


def manifest_files(files: DataFrame, root: str) -> DataFrame:
    """``(path, bytes, sha256)`` of a ``binaryFile`` listing, paths relative to ``root``.

    Files of any size, on any file system Spark reads: none is loaded whole.
    """
    return read_digests(files).select(_relative(root), "bytes", "sha256")


def streamed_manifest(files: DataFrame, root: str, piece: int = PIECE_BYTES) -> DataFrame:
    """The same rows by pyarrow's file systems alone, in pieces of the given size."""
    return file_digests(files, piece).select(_relative(root), "bytes", "sha256")


def _relative(root: str) -> Column:
    return F.substring_index("path", root.rstrip("/") + "/", -1).alias("path")


def rows_per_file(table: DataFrame) -> DataFrame:
    """Rows of every file of a stored table, from the footers: no column is read."""
    return table.groupBy(F.col("_metadata.file_path").alias("path")) \
        .agg(F.count(F.lit(1)).alias("rows"))


def manifest_years(table: DataFrame, expected: DataFrame, digits: int = 4) -> DataFrame:
    """Per year folder rows, files, bytes and the gap to the expected count.

    ``table`` is read with its ``year`` folder column.
    """
    per_file = table.groupBy(
        F.col("year"), F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("size")).agg(F.count(F.lit(1)).alias("rows"))
    years = per_file.groupBy("year").agg(
        F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"))
    return years.join(expected.select("year", "expected"), "year", "left").select(
        "year", "rows", "files", "bytes", F.coalesce("expected", F.lit(0)).alias("expected"),
        round_exact(gap_of(F.col("rows"), F.coalesce("expected", F.lit(0))), digits).alias("gap"))


def manifest_check(saved: DataFrame, found: DataFrame) -> DataFrame:
    """Saved against found ``(path, sha256)``: ``ok``, ``missing``, ``changed`` or ``extra``."""
    a = saved.select("path", F.col("sha256").alias("want"), F.lit(True).alias("listed"))
    b = found.select("path", F.col("sha256").alias("have"), F.lit(True).alias("present"))
    status = F.when(F.col("present").isNull(), "missing").when(F.col("listed").isNull(), "extra") \
        .when(F.col("want").eqNullSafe(F.col("have")), "ok").otherwise("changed")
    return a.join(b, "path", "full_outer").select("path", status.alias("status"))


def shape_rules(df: DataFrame, rules: dict[str, Column],
                required: dict[str, list[str]] | None = None,
                at_least: dict[str, int] | None = None) -> DataFrame:
    """Violations per rule as ``(rule, violations)``, from one pass over ``df``.

    ``rules`` hold per row; ``required`` lists values a column must contain; ``at_least`` is a
    bound the largest value of a column must reach; the table itself must not be empty.
    """
    aggregates = {name: F.count_if(~F.coalesce(rule, F.lit(False))) for name, rule in rules.items()}
    aggregates["not_empty"] = F.when(F.count(F.lit(1)) > 0, 0).otherwise(1)
    for column, values in (required or {}).items():
        for value in values:
            aggregates[f"{column}_has_{value}"] = F.when(
                F.count_if(F.col(column) == value) > 0, 0).otherwise(1)
    for column, bound in (at_least or {}).items():
        aggregates[f"{column}_reaches_{bound}"] = F.when(
            F.coalesce(F.max(column) >= bound, F.lit(False)), 0).otherwise(1)
    counted = df.agg(*[c.alias(f"r{i}") for i, c in enumerate(aggregates.values())])
    names = F.create_map(*[x for i, name in enumerate(aggregates)
                           for x in (F.lit(f"r{i}"), F.lit(name))])
    rows = labelled(counted, "r", "violations", [f"r{i}" for i in range(len(aggregates))])
    return rows.select(names[F.col("r")].alias("rule"), "violations")


def embedding_check(vectors: DataFrame, dim: int, tolerance: float = 1e-3) -> DataFrame:
    """One row: size, vectors of a wrong dimension, not of unit length, and duplicate ids."""
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0),
                              lambda acc, x: acc + x.cast("double") * x.cast("double")))
    base = vectors.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~F.coalesce(F.size("embedding") == dim, F.lit(False))).alias("wrong_dim"),
        F.count_if(~F.coalesce(F.abs(norm - 1) <= tolerance, F.lit(False))).alias("not_unit"))
    duplicates = duplicate_count(vectors.withColumn("id", F.col("id").cast("string")), "id")
    return base.select("*", duplicates.scalar().alias("duplicate_ids"))
