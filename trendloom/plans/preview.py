"""Readable preview rows of works and preprints."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.functions.arrays import drop_blank
from trendloom.functions.text import empty_to_null, shorten
from trendloom.operators.counts import completeness, slice_funnel, top_values
from trendloom.operators.filters import UNTITLED, SliceSpec, public_link, slice_filter
from trendloom.operators.sampling import uniform_sample

# Preview widths and the default texts of the record browser.
TITLE_WIDTH = 88
ORG_WIDTH = 74
ABSTRACT_WIDTH = 200
NO_ABSTRACT = "аннотации нет"


def work_snippet(works: DataFrame) -> DataFrame:
    """One preview row per work: shortened title, orgs and abstract, countries, link."""
    return works.select(
        "id",
        shorten(F.coalesce(empty_to_null(F.col("title")), F.lit(UNTITLED)), TITLE_WIDTH)
        .alias("title"),
        "publication_date", "type",
        F.coalesce(empty_to_null(F.col("language")), F.lit("?")).alias("language"),
        "cited_by_count",
        F.col("primary_topic.name").alias("topic"), F.col("primary_topic.score").alias("score"),
        shorten(F.array_join("institution_names", ", "), ORG_WIDTH).alias("orgs"),
        F.array_join(F.array_distinct(drop_blank(F.col("institution_countries"))), ", ")
        .alias("countries"),
        F.coalesce(shorten(empty_to_null(F.col("abstract")), ABSTRACT_WIDTH), F.lit(NO_ABSTRACT))
        .alias("abstract"),
        public_link(F.col("doi"), F.col("id")).alias("link"), "arxiv_id",
    )


def preprint_snippet(preprints: DataFrame, prefix: str = "https://arxiv.org/abs/") -> DataFrame:
    """One preview row per preprint."""
    return preprints.select(
        "id",
        shorten(F.coalesce(empty_to_null(F.col("title")), F.lit(UNTITLED)), TITLE_WIDTH)
        .alias("title"),
        "created", F.coalesce(empty_to_null(F.col("updated")), F.lit("—")).alias("updated"),
        "author_count", F.array_join("categories", " ").alias("categories"),
        shorten(F.coalesce(empty_to_null(F.col("abstract")), F.lit(NO_ABSTRACT)), ABSTRACT_WIDTH)
        .alias("abstract"),
        F.concat(F.lit(prefix), "id").alias("link"),
    )


def slice_probe(works: DataFrame, spec: SliceSpec, n: int = 200,
                seed: int = 42) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A look at a slice before it is used: the funnel over everything, then field completeness
    and the main languages on a uniform sample of the slice."""
    drawn = uniform_sample(slice_filter(works, spec), n, seed=seed)
    return (slice_funnel(works, spec), completeness(drawn, spec),
            top_values(drawn, F.col("language"), "language", 4))
