"""Raw nested records to the two fixed tables, each as one projection; Python code reads landed inverted indexes alone."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.functions.arrays import bind, drop_blank, keep_edges, or_empty
from trendloom.functions.text import (
    collapse, empty_to_null, link_id, restore_landed_text, restore_text, short_id, strip,
)
from trendloom.schemas import PREPRINTS, RAW_WORK, TOPIC, WORKS

_INSTITUTIONS = "struct<id:string,display_name:string,country_code:string>"


def topic_struct(t: Column) -> Column:
    """Topic with a short id; null when the source is missing or has no content."""
    present = t["id"].isNotNull() | t["display_name"].isNotNull() | t["score"].isNotNull()
    return F.when(present, F.struct(
        short_id(t["id"]).alias("id"), t["display_name"].alias("name"),
        t["score"].alias("score"))).cast(TOPIC)


def placeholder_date(date: Column) -> Column:
    """True for a date whose day is unknown, recorded as the first of January."""
    return F.coalesce(F.endswith(date, F.lit("-01-01")), F.lit(False))


def first_institutions(authorships: Column) -> Column:
    """Institutions of all authors, each id once, in order of first mention."""
    mentioned = F.filter(
        F.flatten(F.transform(authorships, lambda a: or_empty(a["institutions"], _INSTITUTIONS))),
        lambda x: empty_to_null(x["id"]).isNotNull())
    numbered = F.transform(mentioned, lambda x, i: F.struct(
        x["id"].alias("id"), i.alias("at"), x["display_name"].alias("name"),
        x["country_code"].alias("country")))
    first = keep_edges(F.sort_array(numbered), "id")
    in_order = F.sort_array(F.transform(first, lambda x: F.struct(
        x["at"].alias("at"), x["id"].alias("id"), x["name"].alias("name"),
        x["country"].alias("country"))))
    return F.transform(in_order, lambda x: F.struct(
        short_id(x["id"]).alias("id"), x["name"].alias("name"), x["country"].alias("country")))


def institution_lists(authorships: Column) -> Column:
    """The three aligned lists ``ids``, ``names``, ``countries`` as one struct."""
    return bind(first_institutions(authorships), lambda xs: F.struct(
        xs["id"].alias("ids"), xs["name"].alias("names"), xs["country"].alias("countries")))


def parsed_index(raw: DataFrame, column: str = "abstract_inverted_index") -> Column:
    """The inverted index as a map. Landed as text it is parsed here, and nowhere if nothing reads the result;
    text that is no index is an error, as in a parsed read."""
    if raw.schema[column].dataType.typeName() != "string":
        return F.col(column)
    return F.from_json(column, RAW_WORK[column].dataType, {"mode": "FAILFAST"})


def restored_abstract(raw: DataFrame, column: str = "abstract_inverted_index") -> Column:
    """The text of the inverted index, be it a map or landed as text."""
    parsed = parsed_index(raw, column)
    if raw.schema[column].dataType.typeName() != "string":
        return restore_text(parsed)
    return restore_landed_text(F.col(column), parsed)


def works_from_raw(raw: DataFrame, old_style_ids: bool = False) -> DataFrame:
    """Nested work records to the ``WORKS`` table, one row each; the inverted index may be text."""
    location = F.col("primary_location")
    subfield = short_id(F.col("primary_topic.subfield.id"))
    authorships = or_empty(F.col("authorships"), f"struct<institutions:array<{_INSTITUTIONS}>>")
    topics = F.transform(F.col("topics"), topic_struct)
    shaped = raw.withColumns({"institutions": institution_lists(authorships), "abstract": restored_abstract(raw)})
    columns = {
        "id": short_id(F.col("id")),
        "doi": F.col("doi"),
        "arxiv_id": link_id(F.col("ids"), location["landing_page_url"], location["pdf_url"],
                            old_style_ids),
        "title": F.col("title"),
        "abstract": F.col("abstract"),
        "publication_year": F.expr("try_cast(publication_year AS SMALLINT)"),
        "publication_date": empty_to_null(F.col("publication_date")),
        "date_is_placeholder": placeholder_date(F.col("publication_date")),
        "type": F.col("type"),
        "language": F.col("language"),
        "is_oa": F.coalesce(F.col("open_access.is_oa"), F.lit(False)),
        "cited_by_count": F.coalesce(F.col("cited_by_count"), F.lit(0)),
        "primary_topic": topic_struct(F.col("primary_topic")),
        "primary_subfield_id": subfield.try_cast("int"),
        "topics": F.coalesce(topics, F.array().cast(WORKS["topics"].dataType)),
        "institution_ids": F.col("institutions.ids"),
        "institution_names": F.col("institutions.names"),
        "institution_countries": F.col("institutions.countries"),
        "author_count": F.size(authorships).try_cast("smallint"),
        "venue": location["source"]["display_name"],
    }
    return shaped.select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in WORKS.fields])


def preprints_from_oai(records: DataFrame) -> DataFrame:
    """Protocol records (``header``, ``metadata``) to ``PREPRINTS``; deleted and empty ones drop."""
    body = F.col("metadata.arXiv")
    live = records.where(
        ~F.col("header._status").eqNullSafe("deleted") & body.isNotNull())
    words = F.split(F.coalesce(collapse(body["categories"]), F.lit("")), " ")
    authors = F.transform(
        or_empty(body["authors"]["author"], "struct<keyname:string,forenames:string>"),
        lambda a: F.concat_ws(" ", empty_to_null(strip(a["forenames"])),
                              empty_to_null(strip(a["keyname"]))))
    shaped = live.select(
        *[collapse(body[name]).alias(name)
          for name in ("id", "created", "updated", "title", "abstract", "doi")],
        drop_blank(words).alias("categories"), drop_blank(authors).alias("authors"))
    extra = {
        "primary_category": F.get(F.col("categories"), F.lit(0)),
        "author_count": F.size("authors").try_cast("smallint"),
    }
    return shaped.select(*[
        extra.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in PREPRINTS.fields])
