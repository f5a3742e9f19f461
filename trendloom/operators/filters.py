"""Slice definition, row predicates and filtered views."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.functions.text import contains_text, empty_to_null, is_blank, strip

# The labels of a catalogue row, in the language of the catalogue.
UNTITLED = "без заголовка"
KIND_PREPRINT = "препринт"
KIND_OTHER = "статья"
NO_TOPIC = "—"


@dataclass(frozen=True)
class SliceSpec:
    """Which works are ours. Defaults are the standard slice."""
    slice_id: str = "ai-2010-2025"
    direction_id: str = "ai"
    direction_name: str = "искусственный интеллект"
    subfield_ids: tuple[int, ...] = (1702,)
    year_start: int = 2010
    year_end: int = 2025
    types: tuple[str, ...] = ("article", "preprint")
    min_topic_score: float = 0.5

    def years(self) -> Column:
        return F.col("publication_year").between(self.year_start, self.year_end)

    def subfields(self) -> Column:
        return F.col("primary_subfield_id").isin(*self.subfield_ids)

    def kinds(self) -> Column:
        return F.col("type").isin(*self.types)

    def predicate(self, year: int | None = None) -> Column:
        in_time = self.years() if year is None else F.col("publication_year") == year
        return self.subfields() & self.kinds() & in_time


def slice_filter(works: DataFrame, spec: SliceSpec, year: int | None = None) -> DataFrame:
    """Works of the slice, optionally of one year."""
    return works.where(spec.predicate(year))


def has_text(c: str = "abstract") -> Column:
    """Neither null nor empty."""
    return F.coalesce(F.col(c) != "", F.lit(False))


def is_embeddable(strip_blank: bool = True) -> Column:
    """English or unset language with an abstract. Counting leaves blank-only abstracts in
    (``strip_blank=False``), embedding does not."""
    language = F.col("language").isNull() | (F.col("language") == "en")
    return language & (~is_blank(F.col("abstract")) if strip_blank else has_text())


def embeddable(works: DataFrame) -> DataFrame:
    """``(id, title, stripped abstract)`` of the works that can be embedded."""
    return works.where(is_embeddable()).select(
        "id", "title", strip(F.col("abstract")).alias("abstract"))


def is_weak_topic(threshold: float = 0.5) -> Column:
    """Topic score under the threshold; no topic counts as zero."""
    return F.coalesce(F.col("primary_topic.score"), F.lit(0.0).cast("float")) < F.lit(threshold)


def search_title(df: DataFrame, needle: str) -> DataFrame:
    return df.where(contains_text(F.col("title"), needle))


def search_topic(df: DataFrame, needle: str) -> DataFrame:
    """By topic name for works, by the joined categories for preprints."""
    text = F.array_join("categories", " ") if "categories" in df.columns \
        else F.col("primary_topic.name")
    return df.where(contains_text(text, needle))


def in_date_years(date: str, start: int, end: int) -> Column:
    """The year prefix of an ISO date string lies between two years."""
    return F.substring(date, 1, 4).between(str(start), str(end))


def first_matches(df: DataFrame, n: int, key: str = "id") -> DataFrame:
    """The first ``n`` rows by key; only per-task heads travel."""
    return df.orderBy(key).limit(n)


def public_link(doi: Column, work_id: Column, prefix: str = "https://openalex.org/") -> Column:
    """The DOI when there is one, else an address built from the id."""
    return F.coalesce(empty_to_null(doi), F.concat(F.lit(prefix), work_id))


def catalogue_rows(works: DataFrame) -> DataFrame:
    """Short display rows: title, year, kind, topic, citations, abstract flag, first org, link."""
    return works.select(
        "id",
        F.substring(F.coalesce(empty_to_null(F.col("title")), F.lit(UNTITLED)), 1, 160)
        .alias("title"),
        F.col("publication_year").alias("year"),
        F.when(F.col("type") == "preprint", KIND_PREPRINT).otherwise(KIND_OTHER).alias("kind"),
        F.coalesce(empty_to_null(F.col("primary_topic.name")), F.lit(NO_TOPIC)).alias("topic"),
        F.col("cited_by_count").alias("cited"),
        has_text().alias("has_abstract"),
        F.get("institution_names", F.lit(0)).alias("org"),
        F.get("institution_countries", F.lit(0)).alias("country"),
        public_link(F.col("doi"), F.col("id")).alias("link"),
    )


def facet_search(rows: DataFrame, text: str | None = None, kind: str | None = None,
                 topic: str | None = None, country: str | None = None,
                 year_from: int | None = None, with_abstract: bool = False) -> DataFrame:
    """Catalogue rows under every facet that is given; an unset facet adds no condition."""
    conditions = []
    if text and text.strip():
        conditions.append(contains_text(F.col("title"), text.strip()))
    for name, value in (("kind", kind), ("topic", topic), ("country", country)):
        if value:
            conditions.append(F.col(name) == value)
    if year_from is not None:
        conditions.append(F.col("year") >= year_from)
    if with_abstract:
        conditions.append(F.col("has_abstract"))
    for condition in conditions:
        rows = rows.where(condition)
    return rows


def facet_values(rows: DataFrame) -> DataFrame:
    """Distinct non-empty topics and countries as ``(facet, value)``, from one pass."""
    return (
        rows.select(F.inline(F.array(
            F.struct(F.lit("topic").alias("facet"), F.col("topic").alias("value")),
            F.struct(F.lit("country").alias("facet"), F.col("country").alias("value")))))
        .where(F.col("value") != "")
        .distinct()
        .orderBy("facet", "value")
    )
