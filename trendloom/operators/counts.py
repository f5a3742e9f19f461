"""Counting operators. All are partial-plus-final hash aggregates, so one hot key stays cheap."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.functions.arrays import drop_blank
from trendloom.functions.numbers import ratio
from trendloom.operators.filters import SliceSpec, has_text, is_embeddable, is_weak_topic


def labelled(df: DataFrame, label: str, value: str, columns: list[str],
             dtype: str = "bigint") -> DataFrame:
    """Turn the columns of a one-row frame into ``(label, value)`` rows."""
    return df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias(label), F.col(c).cast(dtype).alias(value)) for c in columns])))


def works_by_year(works: DataFrame, spec: SliceSpec) -> DataFrame:
    """Yearly counts of the four reference series as ``(series, year, n)``, from one scan."""
    ours = spec.predicate()
    series = {
        "corpus_all": F.lit(True),
        "corpus_articles": spec.kinds(),
        "slice_all": ours,
        "slice_with_abstract": ours & has_text(),
    }
    counted = works.where(spec.years()).groupBy(F.col("publication_year").cast("int").alias("year")) \
        .agg(*[F.count_if(pred).alias(name) for name, pred in series.items()])
    return counted.unpivot("year", list(series), "series", "n").where(F.col("n") > 0) \
        .select("series", "year", "n")


def embeddable_by_year(works: DataFrame, strip_blank: bool = False) -> DataFrame:
    """Works per year that reach the embedding step; years without any stay as zero rows."""
    return works.groupBy(F.col("publication_year").cast("int").alias("year")) \
        .agg(F.count_if(is_embeddable(strip_blank)).alias("n"))


def count_where(works: DataFrame, predicate: Column) -> DataFrame:
    """One row with the number of works under a filter."""
    return works.where(predicate).agg(F.count(F.lit(1)).alias("n"))


def filter_funnel(works: DataFrame, steps: list[tuple[str, Column]]) -> DataFrame:
    """How many works are left after each further filter, as ``(step, label, n)``."""
    total, passed, flags = F.lit(True), [], []
    for _, predicate in steps:
        total = total & predicate
        passed.append(total)
    for i, predicate in enumerate(passed):
        flags.append(F.count_if(predicate).alias(f"s{i}"))
    return works.agg(*flags).select(F.inline(F.array(*[
        F.struct(F.lit(i + 1).alias("step"), F.lit(label).alias("label"),
                 F.col(f"s{i}").alias("n")) for i, (label, _) in enumerate(steps)])))


def slice_funnel(works: DataFrame, spec: SliceSpec) -> DataFrame:
    """The standard funnel: subfield, then years and types, then with abstract."""
    return filter_funnel(works, [
        ("subfield, all years", spec.subfields()),
        ("years and types", spec.years() & spec.kinds()),
        ("with abstract", has_text()),
    ])


def completeness(works: DataFrame, spec: SliceSpec) -> DataFrame:
    """Share of works for which each field check holds, as ``(field, share)``."""
    checks = {
        "has_abstract": has_text(),
        "has_doi": has_text("doi"),
        "has_arxiv_id": has_text("arxiv_id"),
        "placeholder_date": F.coalesce(F.col("date_is_placeholder"), F.lit(False)),
        "is_preprint": F.coalesce(F.col("type") == "preprint", F.lit(False)),
        "has_orgs": F.coalesce(F.size("institution_ids") > 0, F.lit(False)),
        "weak_topic": is_weak_topic(spec.min_topic_score),
    }
    shares = works.agg(*[
        ratio(F.count_if(pred), F.count(F.lit(1))).alias(name) for name, pred in checks.items()])
    return labelled(shares, "field", "share", list(checks), "double")


def top_values(df: DataFrame, value: Column, name: str, k: int) -> DataFrame:
    """The ``k`` most frequent values with counts; null is a value, ties go by value."""
    return df.groupBy(value.alias(name)).agg(F.count(F.lit(1)).alias("n")) \
        .orderBy(F.desc("n"), F.asc_nulls_last(name)).limit(k)


def works_by_type(works: DataFrame) -> DataFrame:
    return works.groupBy("type").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "type")


def abstract_by_year(works: DataFrame) -> DataFrame:
    """Works, works with abstract and their share in percent per year."""
    return (
        works.groupBy(F.col("publication_year").cast("int").alias("year"))
        .agg(F.count(F.lit(1)).alias("works"), F.count_if(has_text()).alias("with_abstract"))
        .withColumn("share_pct", ratio(F.col("with_abstract"), F.col("works")) * 100)
    )


def country_counts(works: DataFrame, per: str = "work", count_null: bool = True) -> DataFrame:
    """Works per country: once per work or once per mention, with or without null as a country."""
    countries = F.col("institution_countries")
    if per == "work":
        countries = F.array_distinct(countries)
    if not count_null:
        countries = drop_blank(countries)
    return works.select(F.explode(countries).alias("country")) \
        .groupBy("country").agg(F.count(F.lit(1)).alias("n"))


def country_top(works: DataFrame, k: int = 20, per: str = "work",
                count_null: bool = True) -> DataFrame:
    return country_counts(works, per, count_null) \
        .orderBy(F.desc("n"), F.asc_nulls_last("country")).limit(k)


def corpus_cells(works: DataFrame) -> DataFrame:
    """Counts of several groupings in one scan: ``(kind, year, id, name, n, with_abstract)``.

    ``year`` rows are by year and type (``id``), ``topic`` rows by topic, its name and year, ``country`` rows once per
    work and country. Every work gives its rows of all groupings at once (an expand), which partial aggregation
    folds before the one shuffle. Null years, types, topics and countries are values of their own.
    """
    year, topic = F.col("publication_year").cast("int"), F.col("primary_topic")
    none = F.lit(None).cast("string")

    def cell(kind: str, y: Column, key: Column, name: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), y.alias("year"), key.alias("id"), name.alias("name"))
    countries = F.transform(F.coalesce(F.array_distinct("institution_countries"), F.array().cast("array<string>")),
                            lambda c: cell("country", F.lit(None).cast("int"), c, none))
    listed = F.concat(F.array(cell("year", year, F.col("type"), none), cell("topic", year, topic["id"], topic["name"])), countries)
    return works.select(F.inline(listed), has_text().alias("text")).groupBy("kind", "year", "id", "name") \
        .agg(F.count(F.lit(1)).alias("n"), F.count_if("text").alias("with_abstract"))


def key_counts(works: DataFrame, preprints: DataFrame | None = None) -> DataFrame:
    """One row of duplicates and links from one scan of each table: ``duplicate_ids, shared_dois, named, matched,
    duplicate_preprints``.

    Ids, DOIs and preprint ids of works, and ids of preprints, are grouped together by kind and key; a
    preprint meets the works that name it as one more count of the same key. Lost ids are keys like any other,
    lost DOIs and links are none.
    """
    kept = F.filter(F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(c).alias("key")) for kind, c in (
        ("id", "id"), ("doi", "doi"), ("link", "arxiv_id"))]), lambda x: (x["kind"] == "id") | (x["key"] != ""))
    keys = works.select(F.inline(kept), F.lit(False).alias("held"))
    if preprints is not None:
        keys = keys.unionByName(preprints.select(F.lit("link").alias("kind"), F.col("id").alias("key"), F.lit(True).alias("held")))
    by_key = keys.groupBy("kind", "key").agg(F.count_if(~F.col("held")).alias("works"), F.count_if("held").alias("held"))

    def extra(kind: str, count: str) -> Column:
        return F.coalesce(F.sum(F.when((F.col("kind") == kind) & (F.col(count) > 0), F.col(count) - 1)), F.lit(0))
    link = (F.col("kind") == "link") & (F.col("works") > 0)
    return by_key.agg(
        extra("id", "works").alias("duplicate_ids"), extra("doi", "works").alias("shared_dois"),
        F.count_if(link).alias("named"), F.count_if(link & (F.col("held") > 0)).alias("matched"),
        extra("link", "held").alias("duplicate_preprints"))


def preprints_by_year(preprints: DataFrame) -> DataFrame:
    """Preprints per year of the first version; undated ones do not count."""
    return preprints.where(F.col("created") != "") \
        .groupBy(F.substring("created", 1, 4).alias("year")) \
        .agg(F.count(F.lit(1)).alias("preprints"))


def preprints_on_work_years(works: DataFrame, preprints: DataFrame) -> DataFrame:
    """The preprint series on the years of the works, zero where there is none."""
    years = works.groupBy(F.col("publication_year").cast("int").alias("year")) \
        .agg(F.count(F.lit(1)).alias("works"))
    pre = preprints_by_year(preprints).withColumn("year", F.col("year").try_cast("int"))
    return years.join(pre, "year", "left").select(
        "year", "works", F.coalesce("preprints", F.lit(0)).cast("bigint").alias("preprints"))


def corpus_totals(works: DataFrame, preprints: DataFrame, shown: int | None = None) -> DataFrame:
    """Works, preprints, with abstract, countries, topics (and the shown share), one per row.

    Distinct counts run as a ``groupBy`` each, so no single task ever holds a set of values.
    """
    base = works.agg(F.count(F.lit(1)).alias("works"), F.count_if(has_text()).alias("with_abstract"))
    countries = country_counts(works).agg(F.count(F.lit(1)).alias("n"))
    topics = works.where(F.col("primary_topic.id") != "") \
        .groupBy("primary_topic.id").agg(F.count(F.lit(1))).agg(F.count(F.lit(1)).alias("n"))
    pre = preprints.agg(F.count(F.lit(1)).alias("n"))
    rows = labelled(base, "total", "n", ["works", "with_abstract"])
    for name, frame in (("preprints", pre), ("countries", countries), ("topics", topics)):
        rows = rows.unionByName(frame.select(F.lit(name).alias("total"), F.col("n").cast("bigint")))
    rows = rows.withColumn("value", F.col("n").cast("double")).drop("n")
    if shown is not None:
        share = base.select(F.lit("shown_pct").alias("total"),
                            (ratio(F.lit(shown), F.col("works")) * 100).alias("value"))
        rows = rows.unionByName(share)
    return rows


def works_summary(works: DataFrame, types: int | None = None) -> DataFrame:
    """One row: size, year range and the shares of non-null abstract, DOI and preprint id; with ``types``
    also the counts of that many most frequent types, as text."""
    n = F.count(F.lit(1))
    summary = works.agg(
        n.alias("n"),
        F.min("publication_year").cast("int").alias("year_min"),
        F.max("publication_year").cast("int").alias("year_max"),
        *[ratio(F.count(c), n).alias(f"share_{c}") for c in ("abstract", "doi", "arxiv_id")])
    if types is None:
        return summary
    frequent = works.groupBy("type").agg(n.alias("k")).orderBy(F.desc("k"), "type").limit(types)
    listed = frequent.agg(F.sort_array(F.collect_list(F.struct((-F.col("k")).alias("order"), "type", "k"))).alias("t"))
    text = F.array_join(F.transform("t", lambda x: F.concat_ws(": ", x["type"], x["k"].cast("string"))), ", ")
    return summary.withColumn("types", listed.select(text).scalar())


def preprints_summary(preprints: DataFrame) -> DataFrame:
    """The same for preprints, by the year of the first version."""
    n = F.count(F.lit(1))
    year = F.when(F.col("created") != "", F.substring("created", 1, 4).try_cast("int"))
    return preprints.agg(
        n.alias("n"), F.min(year).alias("year_min"), F.max(year).alias("year_max"),
        *[ratio(F.count(c), n).alias(f"share_{c}") for c in ("abstract", "doi")])


def duplicate_count(df: DataFrame, key: str, name: str = "duplicates", skip_empty: bool = False) -> DataFrame:
    """One row: rows minus distinct values. A lost (null or empty) key is a value like any other, so a
    corpus of lost ids is full of duplicates; ``skip_empty`` leaves such rows out, for keys that a row
    need not have. Copies meet pre-aggregated."""
    return (
        (df.where(F.col(key) != "") if skip_empty else df).groupBy(key).agg(F.count(F.lit(1)).alias("copies"))
        .agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias(name))
    )


def duplicate_counts(works: DataFrame) -> DataFrame:
    """Duplicate ids (lost ones count) and duplicate DOIs (of works that have one) as ``(key, duplicates)``."""
    frames = [duplicate_count(works, key, skip_empty=key == "doi").select(F.lit(key).alias("key"), "duplicates")
              for key in ("id", "doi")]
    return frames[0].unionByName(frames[1])
