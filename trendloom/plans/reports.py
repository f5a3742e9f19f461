"""The catalogue and the trend index as one-row documents."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.operators.counts import corpus_cells
from trendloom.operators.filters import SliceSpec, catalogue_rows
from trendloom.operators.sampling import systematic_sample
from trendloom.plans.trends import (
    CATALOGUE_MIN_WORKS, CATALOGUE_TOPICS, growth_from_cells,
)
from trendloom.session import materialize

# List lengths of the catalogue.
COUNTRIES_SHOWN = 20
WORKS_SHOWN = 4000
TYPES_SHOWN = 50

# The validation block before any validation has run.
CUTOFF_YEAR = 2021
BASELINE = "самые частые термины"
NEGATIVE_CONTROLS = ("метавселенная", "NFT")


def _one_array(df: DataFrame, order: list[str], value: Column) -> Column:
    """A bounded report list as one sorted array, usable as a scalar in another plan."""
    pairs = F.sort_array(F.collect_list(F.struct(*order, value.alias("value"))))
    return df.agg(F.transform(pairs, lambda x: x["value"])).scalar()


def _counts(df: DataFrame, key: str) -> Column:
    """``(key, n)`` rows as an ordered map from name to count, most frequent first."""
    shaped = df.groupBy(F.coalesce(F.col(key).cast("string"), F.lit("null")).alias("name")) \
        .agg(F.sum("n").alias("n")).withColumn("down", -F.col("n"))
    return F.map_from_entries(_one_array(shaped, ["down", "name"], F.struct("name", "n")))


def catalog_doc(works: DataFrame, preprints: DataFrame, sample: DataFrame, spec: SliceSpec,
                min_works: int = CATALOGUE_MIN_WORKS, top_topics: int = CATALOGUE_TOPICS,
                shown: int = WORKS_SHOWN, growth_digits: int | None = 2, top_types: int = TYPES_SHOWN) -> DataFrame:
    """Years, totals, yearly series, types, countries, topics and sampled works in one row.

    One scan of the works counts years, types, topics and countries together; the counts are written
    once and serve all parts. The sample is read apart from it, by its keys. Every list in the document is
    bounded: by years, or the lengths of its top lists. A null year is in the totals and in no series.
    """
    cells = materialize(corpus_cells(works), "cells")
    first_years = materialize(preprints.groupBy(F.substring("created", 1, 4).alias("created"))
                              .agg(F.count(F.lit(1)).alias("preprints")), "preprint-years")
    pre = first_years.select(F.col("created").try_cast("int").alias("year"), "preprints")

    by_year = cells.where("kind = 'year'")
    countries = cells.where("kind = 'country'").select(F.col("id").alias("country"), "n")
    yearly = by_year.where("year is not null").groupBy("year").agg(F.sum("n").alias("n"), F.sum("with_abstract").alias("a"))
    years = yearly.join(pre, "year", "left").withColumn("p", F.coalesce("preprints", F.lit(0)))
    series = years.agg(F.sort_array(F.collect_list(F.struct("year", "n", "a", "p")))).scalar()
    by_topic = cells.where("kind = 'topic'").select(
        F.col("id").alias("topic_id"), F.col("name").alias("topic_name"), "year", F.col("n").alias("works"))
    topics = growth_from_cells(by_topic, min_works, top_topics, growth_digits)
    topics_listed = topics.select(
        (-F.col("growth")).alias("down"), F.col("topic_id").alias("id"), "name", "works", "growth",
        "series")
    n_topics = by_topic.where(F.col("topic_id") != "").select("topic_id").distinct() \
        .agg(F.count(F.lit(1))).scalar()
    rows = catalogue_rows(systematic_sample(sample, shown))
    totals = {
        "works": by_year.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar(),
        "preprints": first_years.agg(F.coalesce(F.sum("preprints"), F.lit(0))).scalar(),
        "with_abstract": by_year.agg(F.coalesce(F.sum("with_abstract"), F.lit(0))).scalar(),
        "countries": countries.agg(F.count(F.lit(1))).scalar(),
        "topics": n_topics,
    }
    top_countries = countries.orderBy(F.desc("n"), F.asc_nulls_last("country")) \
        .limit(COUNTRIES_SHOWN)
    types = by_year.groupBy(F.col("id").alias("type")).agg(F.sum("n").alias("n")) \
        .orderBy(F.desc("n"), F.asc_nulls_last("type")).limit(top_types)
    one = works.sparkSession.range(1).select(
        series.alias("s"),
        F.struct(*[value.alias(name) for name, value in totals.items()]).alias("totals"),
        _counts(types, "type").alias("by_type"),
        _counts(top_countries, "country").alias("by_country"),
        _one_array(topics_listed, ["down", "id"],
                   F.struct("id", "name", "works", "growth", "series")).alias("topics"),
        _one_array(rows, ["id"], F.struct(
            F.col("title").alias("t"), F.col("year").alias("y"), F.col("kind").alias("k"),
            F.col("topic").alias("tp"), F.col("cited").alias("c"),
            F.col("has_abstract").alias("a"), F.col("org").alias("o"),
            F.col("country").alias("cn"), F.col("link").alias("u"))).alias("works"))
    return one.select(
        F.lit(spec.slice_id).alias("slice_id"), F.lit(spec.direction_name).alias("direction"),
        F.col("s.year").alias("years"), "totals", F.col("s.n").alias("by_year"),
        F.col("s.a").alias("abstract_by_year"), F.col("s.p").alias("preprints_by_year"),
        "by_type", "by_country", "topics", "works")


def index_doc(cards: DataFrame, spec: SliceSpec, index_version: str, built_at: str,
              years: tuple[int, int] | None = None, is_sample: bool = True,
              note: str | None = None) -> DataFrame:
    """The trend index: metadata, direction, ranked cards and the still empty validation block.

    ``cards`` is the output of ``trend_cards`` and as short as its top list.
    """
    columns = [c for c in cards.columns if c not in ("rank", "topic_id")]
    listed = F.transform(
        F.sort_array(F.collect_list(F.struct("rank", F.struct(*columns, "rank").alias("card")))),
        lambda x: x["card"])
    span = F.array(*[F.lit(y) for y in years]) if years else F.array(
        F.min(F.get("series", F.lit(0))["year"]), F.max(F.element_at("series", -1)["year"]))
    no_metric = F.lit(None).cast("double")
    controls = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(None).cast("int").alias("rank"))
                         for name in NEGATIVE_CONTROLS])
    return cards.agg(listed.alias("trends"), span.alias("span")).select(
        F.lit(is_sample).alias("is_sample"), F.lit(note).cast("string").alias("note"),
        F.lit(index_version).alias("index_version"), F.lit(spec.slice_id).alias("slice_id"),
        F.lit(built_at).alias("built_at"),
        F.struct(F.lit(spec.direction_id).alias("id"), F.lit(spec.direction_name).alias("name"),
                 F.col("span").alias("years")).alias("direction"),
        "trends",
        F.struct(
            F.lit(True).alias("is_placeholder"), F.lit(CUTOFF_YEAR).alias("cutoff_year"),
            no_metric.alias("metric"),
            F.struct(F.lit(BASELINE).alias("name"), no_metric.alias("metric")).alias("baseline"),
            controls.alias("negative_controls")).alias("validation"))
