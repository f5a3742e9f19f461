"""Trend metrics: yearly series per topic, normalised by the corpus of the same year."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendloom.functions.arrays import bind, exact_sum
from trendloom.functions.numbers import round_exact
from trendloom.functions.text import short_id
from trendloom.operators.filters import public_link
from trendloom.operators.ranking import top_per_group
from trendloom.session import materialize

# Metric constants, list lengths and thresholds of the published cards.
MIN_WORKS = 400
TOP_CARDS = 15
BEST_WORKS = 6
TOP_NAMES = 5
FLOOR_HEAPS = 64             # heaps per topic from which the floor of its best works is taken
SKETCH_LG_K = 12              # registers of a name sketch, as a power of two
CATALOGUE_MIN_WORKS = 2000
CATALOGUE_TOPICS = 40
NO_SHARE = 0.01
SUMMARY = "Группа работ по теме «%s»."


def with_topic(works: DataFrame) -> DataFrame:
    """Works that have a topic id and a year, with ``topic_id``, ``topic_name``, ``year``."""
    year = F.col("publication_year").cast("int")
    return works.where((F.col("primary_topic.id") != "") & (year != 0)).withColumns({
        "topic_id": F.col("primary_topic.id"), "topic_name": F.col("primary_topic.name"),
        "year": year})


def topic_year_counts(works: DataFrame) -> DataFrame:
    """``(topic_id, topic_name, year, works)``: the one pass over the corpus that all metrics use.

    The name is a grouping key so the pass stays a hash aggregate.
    """
    return with_topic(works).groupBy("topic_id", "topic_name", "year") \
        .agg(F.count(F.lit(1)).alias("works"))


def corpus_by_year(counts: DataFrame) -> DataFrame:
    """Corpus size per year, the base of every share, from the topic counts themselves."""
    return counts.groupBy("year").agg(F.sum("works").alias("base"))


def _year_grid(base: DataFrame) -> Column:
    """All years with their base as one sorted array: a scalar, at most one entry per year."""
    return base.where(F.col("year").isNotNull()) \
        .agg(F.sort_array(F.collect_list(F.struct("year", "base")))).scalar()


def _per_topic(counts: DataFrame) -> DataFrame:
    """One row per topic: total, first year, counts by year and the first non-empty name."""
    yearly = counts.groupBy("topic_id", "year").agg(
        F.sum("works").alias("works"),
        F.min(F.when(F.col("topic_name") != "", F.col("topic_name"))).alias("name"))
    return yearly.groupBy("topic_id").agg(
        F.sum("works").alias("works_total"),
        F.min("year").alias("first_year"),
        F.min_by("name", F.when(F.col("name").isNotNull(), F.col("year"))).alias("name"),
        F.map_from_entries(F.collect_list(F.when(
            F.col("year").isNotNull(), F.struct("year", "works")))).alias("by_year"))


def topic_series(works: DataFrame, share_digits: int | None = 1) -> DataFrame:
    """Per topic the dense series ``(year, works, per_10k)`` over all corpus years.

    The topic-by-year counts, a few rows per topic, are written once; both the yearly base and
    the series start from there, so the corpus itself is scanned a single time.
    """
    counts = materialize(topic_year_counts(works), "topic-years")
    grid = _year_grid(corpus_by_year(counts))

    def point(y: Column) -> Column:
        n = F.coalesce(F.try_element_at(F.col("by_year"), y["year"]), F.lit(0)).cast("bigint")
        share = F.when(y["base"] > 0, round_exact(n / y["base"] * F.lit(10_000.0), share_digits))
        return F.struct(y["year"].alias("year"), n.alias("works"), y["base"].alias("base"),
                        F.coalesce(share, F.lit(0.0)).alias("per_10k"))
    return (
        _per_topic(counts).withColumn("grid", grid)
        .withColumn("series", F.transform("grid", point)).drop("by_year", "grid")
    )


def topic_points(series: DataFrame) -> DataFrame:
    """The series as rows, with its position and the number of years."""
    return series.select("topic_id", "name", F.size("series").alias("n_years"),
                         F.posexplode("series").alias("at", "point")) \
        .select("topic_id", "name", "n_years", "at", "point.*")


def _spans(values: Column, cuts: list[Column]) -> Column:
    """Sums of the pieces of an array between consecutive cuts, as one struct."""
    return F.struct(*[
        exact_sum(F.slice(values, a + 1, F.greatest(F.lit(0), b - a))).alias(f"p{i}")
        for i, (a, b) in enumerate(zip(cuts, cuts[1:]), 1)])


def _or(total: Column, floor: float) -> Column:
    return F.when(total == 0, F.lit(floor)).otherwise(total)


def growth_of(values: Column, floor: float = NO_SHARE) -> Column:
    """Later part over earlier part of a yearly series; an odd year goes to the later part."""
    def parts(v: Column) -> Column:
        n = F.size(v)
        return _spans(v, [F.lit(0), F.floor(n / 2).cast("int"), n])
    return bind(bind(values, parts), lambda p: p["p2"] / _or(p["p1"], floor))


def acceleration_of(values: Column) -> Column:
    """Change of pace: the pace of the last third over the pace of the middle third."""
    def parts(v: Column) -> Column:
        n = F.size(v)
        third = F.greatest(F.lit(1), F.floor(n / 3).cast("int"))
        return _spans(v, [F.lit(0), third, third * 2, n])

    def pace(p: Column) -> Column:
        start, middle = _or(p["p1"], NO_SHARE), _or(p["p2"], NO_SHARE)
        return (p["p3"] / middle) / (middle / start)
    return bind(bind(values, parts), pace)


def topic_metrics(works: DataFrame, min_works: int = MIN_WORKS, share_digits: int | None = 1,
                  growth_digits: int | None = 2, score_digits: int | None = 3) -> DataFrame:
    """Series, growth, acceleration and score of every topic with enough works."""
    shares = F.col("series")["per_10k"]
    return (
        topic_series(works, share_digits).where(F.col("works_total") >= min_works)
        .withColumns({"raw_growth": growth_of(shares), "raw_acceleration": acceleration_of(shares)})
        .select("topic_id", "name", "works_total", "first_year", "series",
                round_exact(F.col("raw_growth"), growth_digits).alias("normalized_growth"),
                round_exact(F.col("raw_acceleration"), growth_digits).alias("acceleration"),
                round_exact(F.least(F.col("raw_growth") / 3, F.lit(1.0)), score_digits)
                .alias("score"))
    )


def topic_name_counts(works: DataFrame) -> DataFrame:
    """Mentions per topic of every org and country, ``(topic_id, kind, value, n)``, in one pass."""
    lists = F.array(*[
        F.struct(F.lit(kind).alias("kind"), F.col(column).alias("names"))
        for kind, column in (("org", "institution_names"), ("country", "institution_countries"))])
    return (
        with_topic(works).select("topic_id", F.inline(lists))
        .select("topic_id", "kind", F.explode("names").alias("value"))
        .where(F.col("value") != "")
        .groupBy("topic_id", "kind", "value").agg(F.count(F.lit(1)).alias("n"))
    )


def topic_top_names(works: DataFrame, k: int = TOP_NAMES) -> DataFrame:
    """The ``k`` most mentioned orgs and countries per topic with ranks."""
    return top_per_group(topic_name_counts(works), ["topic_id", "kind"],
                         [F.desc("n"), F.asc("value")], k)


def name_spread(named: DataFrame) -> DataFrame:
    """Distinct orgs and countries per topic from counted names.

    The always-true test on ``n`` keeps the count in the plan, so this and the top lists read
    the same shuffled data instead of counting twice.
    """
    return named.groupBy("topic_id").agg(*[
        F.count_if((F.col("kind") == kind) & (F.col("n") > 0)).alias(name)
        for kind, name in (("org", "organizations"), ("country", "countries"))])


def topic_diffusion(works: DataFrame) -> DataFrame:
    """Distinct orgs and countries per topic."""
    return name_spread(topic_name_counts(works))


def name_sketches(works: DataFrame, lg_k: int = SKETCH_LG_K) -> DataFrame:
    """HyperLogLog sketches of the distinct orgs and countries, ``(topic_id, year, kind, sketch)``.

    Each is at most about ``2**lg_k`` bytes and merges, so a stored table of them is brought up to date from
    new works alone (``merged_sketches``), and any span of years is estimated without the works.
    """
    lists = F.array(*[
        F.struct(F.lit(kind).alias("kind"), F.col(column).alias("names"))
        for kind, column in (("org", "institution_names"), ("country", "institution_countries"))])
    return (
        with_topic(works).select("topic_id", "year", F.inline(lists))
        .select("topic_id", "year", "kind", F.explode("names").alias("value")).where(F.col("value") != "")
        .groupBy("topic_id", "year", "kind").agg(F.hll_sketch_agg("value", lg_k).alias("sketch"))
    )


def merged_sketches(*parts: DataFrame) -> DataFrame:
    """One sketch per topic, year and kind from several tables of the same ``lg_k``; order and repeats of parts
    do not matter."""
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    return together.groupBy("topic_id", "year", "kind").agg(F.hll_union_agg("sketch").alias("sketch"))


def sketched_diffusion(sketches: DataFrame) -> DataFrame:
    """``topic_diffusion`` from sketches: estimates with a relative standard error of ``1.04 / sqrt(2**lg_k)``
    (1.6 percent by default); a few hundred names are counted as they are."""
    def estimate(kind: str) -> Column:
        return F.hll_sketch_estimate(F.hll_union_agg(F.when(F.col("kind") == kind, F.col("sketch"))))
    return sketches.groupBy("topic_id").agg(estimate("org").alias("organizations"), estimate("country").alias("countries"))


def best_floor(works: DataFrame, k: int = BEST_WORKS) -> DataFrame:
    """``(topic_id, floor)``: a citation count that the ``k`` most cited works of a topic reach, from counts alone.

    The works of a topic are dealt over a few heaps by id; ``k`` heaps hold a work at or above the ``k``-th largest
    of the heaps' maxima. A topic that fills fewer heaps has no floor.
    """
    heaps = with_topic(works).groupBy("topic_id", F.pmod(F.xxhash64("id"), F.lit(FLOOR_HEAPS)).alias("heap")) \
        .agg(F.max(F.coalesce("cited_by_count", F.lit(0))).alias("floor"))
    return top_per_group(heaps, "topic_id", [F.desc("floor"), F.asc("heap")], k) \
        .where(F.col("rank") == k).select("topic_id", "floor")


def topic_best_works(works: DataFrame, k: int = BEST_WORKS) -> DataFrame:
    """The ``k`` most cited works per topic; equal citation counts go by id.

    Only works at or above their topic's floor are sorted with their texts: a handful per topic, and its ties.
    """
    floors = materialize(best_floor(works, k), "floors").withColumnRenamed("topic_id", "__topic")
    rows = with_topic(works).select(
        "topic_id", "id", "title", public_link(F.col("doi"), F.col("id")).alias("url"), "year",
        "venue", F.coalesce("cited_by_count", F.lit(0)).alias("cited_by"))
    high = rows.join(floors, F.col("topic_id") == F.col("__topic"), "left") \
        .where(F.col("cited_by") >= F.coalesce("floor", F.col("cited_by"))).drop("__topic", "floor")
    return top_per_group(high, "topic_id", [F.desc("cited_by"), F.asc("id")], k)


def trend_cards(works: DataFrame, top: int = TOP_CARDS, min_works: int = MIN_WORKS,
                share_digits: int | None = 1, growth_digits: int | None = 2,
                score_digits: int | None = 3, motivation: str | None = None) -> DataFrame:
    """The ranked trend cards.

    Metrics come from the small topic-by-year counts. Only then are organisations, countries
    and best works gathered, for the winning topics alone, so the wide pass shuffles no row of
    any other topic.
    """
    metrics = topic_metrics(works, min_works, share_digits, growth_digits, score_digits)
    winners = materialize(
        metrics.orderBy(F.desc("normalized_growth"), "topic_id").limit(top), "winners")

    hot = works.withColumn("topic_id", F.col("primary_topic.id")) \
        .join(winners.select("topic_id"), "topic_id", "left_semi").drop("topic_id")

    named = topic_name_counts(hot)
    spread = name_spread(named)
    listed = top_per_group(named, ["topic_id", "kind"], [F.desc("n"), F.asc("value")], TOP_NAMES)
    lists = listed.groupBy("topic_id").agg(*[
        F.transform(F.sort_array(F.collect_list(F.when(
            F.col("kind") == kind, F.struct("rank", "value")))), lambda x: x["value"]).alias(name)
        for kind, name in (("org", "top_organizations"), ("country", "top_countries"))])
    best = topic_best_works(hot).groupBy("topic_id").agg(F.sort_array(F.collect_list(F.struct(
        "rank", "title", "url", "year", "venue", "cited_by"))).alias("best"))

    def entry(x: Column) -> Column:
        return F.struct(*[x[c].alias(c) for c in ("title", "url", "year", "venue", "cited_by")])
    case = F.get("best", F.lit(0))
    joined = winners
    for extra in (spread, lists, best):
        joined = joined.join(extra, "topic_id", "left")
    cards = joined.select(
        short_id(F.col("topic_id")).alias("id"), F.col("topic_id"),
        F.col("name").alias("title"),
        F.format_string(SUMMARY, F.coalesce("name", F.lit("None"))).alias("summary"),
        F.lit(motivation).cast("string").alias("motivation"),
        F.lit(True).alias("motivation_is_placeholder"),
        F.struct(*[case[c].alias(c) for c in ("title", "url", "year", "venue", "cited_by")],
                 F.lit(True).alias("is_placeholder")).alias("case_example"),
        F.transform(F.slice("best", 2, BEST_WORKS - 1), entry).alias("sources"),
        "first_year", "works_total",
        F.transform("series", lambda p: F.struct(
            p["year"].alias("year"), p["works"].alias("works"),
            p["per_10k"].alias("per_10k"))).alias("series"),
        F.struct("normalized_growth", "acceleration",
                 F.coalesce("organizations", F.lit(0)).alias("organizations"),
                 F.coalesce("countries", F.lit(0)).alias("countries")).alias("features"),
        "score",
        F.coalesce("top_organizations", F.array().cast("array<string>")).alias("top_organizations"),
        F.coalesce("top_countries", F.array().cast("array<string>")).alias("top_countries"))
    return with_rank(cards, [F.desc("features.normalized_growth"), F.asc("topic_id")])


def with_rank(cards: DataFrame, order: list[Column]) -> DataFrame:
    """Rank 1..n of an already limited list; the window sees at most that many rows."""
    return cards.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def topic_cells(works: DataFrame) -> DataFrame:
    """Counts by topic and year over all works, those without a topic included, written once."""
    cells = works.groupBy(
        F.col("primary_topic.id").alias("topic_id"), F.col("primary_topic.name").alias("topic_name"),
        F.col("publication_year").cast("int").alias("year")).agg(F.count(F.lit(1)).alias("works"))
    return materialize(cells, "topic-cells")


def topic_growth(works: DataFrame, min_works: int = CATALOGUE_MIN_WORKS,
                 top: int = CATALOGUE_TOPICS, growth_digits: int | None = 2) -> DataFrame:
    """The fastest topics by raw counts with their series over all years of the corpus."""
    return growth_from_cells(topic_cells(works), min_works, top, growth_digits)


def growth_from_cells(cells: DataFrame, min_works: int = CATALOGUE_MIN_WORKS,
                      top: int = CATALOGUE_TOPICS, growth_digits: int | None = 2) -> DataFrame:
    """``topic_growth`` from stored cells, for reports that need the cells for more."""
    grid = _year_grid(corpus_by_year(cells))
    counted = F.transform("grid", lambda y: F.coalesce(
        F.try_element_at(F.col("by_year"), y["year"]), F.lit(0)).cast("bigint"))
    values = F.transform("series", lambda n: n.cast("double"))
    return (
        _per_topic(cells.where(F.col("topic_id") != ""))
        .where(F.col("works_total") >= min_works)
        .withColumn("grid", grid).withColumn("series", counted)
        .select("topic_id", "name", F.col("works_total").alias("works"),
                round_exact(growth_of(values, 1.0), growth_digits).alias("growth"), "series")
        .orderBy(F.desc("growth"), "topic_id").limit(top)
    )
