from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F
from helpers import preprints, topic, works

from trendloom.operators import counts, filters
from trendloom.operators.filters import SliceSpec
from trendloom.plans import preview

SPEC = SliceSpec()


def ids(df):
    return sorted(r["id"] for r in df.collect())


def sample(spark):
    return works(spark, [
        dict(id="1", title="Deep nets", abstract="a b", publication_year=2010, type="article",
             language="en", primary_topic=topic("T1", "Vision", 0.4), primary_subfield_id=1702,
             institution_countries=["RU", "RU", None], institution_ids=["I1"], doi="d",
             cited_by_count=3, institution_names=["A", "B"], publication_date="2010-01-01"),
        dict(id="2", title=None, abstract="   ", publication_year=2010, type="preprint",
             primary_subfield_id=1702, institution_countries=["US"], doi="d", arxiv_id="P1"),
        dict(id="3", title="deep 100%_x", abstract=None, publication_year=2026, type="article",
             language="ru", primary_topic=topic("T2", None, 0.9), primary_subfield_id=1702,
             institution_countries=[], doi=""),
        dict(id="4", title="", abstract="x", publication_year=2025, type="book", language="en",
             primary_topic=topic("T1", "Vision", 0.5), primary_subfield_id=1707, arxiv_id="P9"),
    ])


def test_slice_filter_single_year_and_range(spark):
    df = sample(spark)
    assert ids(filters.slice_filter(df, SPEC)) == ["1", "2"]
    assert ids(filters.slice_filter(df, SPEC, 2026)) == ["3"]


def test_embeddable_keeps_english_and_unset_and_strips(spark):
    rows = works(spark, [
        dict(id="a", abstract="  padded text \n", language="en"), dict(id="b", abstract="x"),
        dict(id="c", abstract=None, language="en"), dict(id="d", abstract=" 　", language="en"),
        dict(id="e", abstract="text", language="ru"), dict(id="f", abstract="t", language="id")])
    out = {r.id: r.abstract for r in filters.embeddable(rows).collect()}
    assert out == {"a": "padded text", "b": "x"}


def test_embeddable_count_keeps_blank_abstracts_unless_told(spark):
    df = sample(spark)
    loose = dict(counts.embeddable_by_year(df).collect())
    strict = dict(counts.embeddable_by_year(df, strip_blank=True).collect())
    assert loose == {2010: 2, 2026: 0, 2025: 1} and strict == {2010: 1, 2026: 0, 2025: 1}


def test_searches_are_case_insensitive_and_literal(spark):
    df = sample(spark)
    assert ids(filters.search_title(df, "DEEP")) == ["1", "3"]
    assert ids(filters.search_title(df, "%_")) == ["3"]
    assert ids(filters.search_topic(df, "vis")) == ["1", "4"]
    pre = preprints(spark, [dict(id="p", categories=["cs.LG", "stat.ML"]), dict(id="q")])
    assert ids(filters.search_topic(pre, "lg STAT")) == ["p"]


def test_catalogue_rows_and_facets(spark):
    rows = {r.id: r for r in filters.catalogue_rows(sample(spark)).collect()}
    assert rows["2"].title == rows["4"].title == filters.UNTITLED
    assert (rows["2"].kind, rows["1"].kind) == (filters.KIND_PREPRINT, filters.KIND_OTHER)
    assert (rows["1"].org, rows["1"].country, rows["3"].country) == ("A", "RU", None)
    assert (rows["2"].topic, rows["3"].topic) == (filters.NO_TOPIC, filters.NO_TOPIC)
    assert (rows["1"].link, rows["3"].link) == ("d", "https://openalex.org/3")
    assert (rows["2"].has_abstract, rows["3"].has_abstract) == (True, False)
    page = filters.catalogue_rows(sample(spark))
    assert ids(filters.facet_search(page)) == ["1", "2", "3", "4"]
    assert ids(filters.facet_search(page, text=" deep ", with_abstract=True)) == ["1"]
    assert ids(filters.facet_search(page, topic="Vision", year_from=2011)) == ["4"]
    facets = [tuple(r) for r in filters.facet_values(page).collect()]
    assert facets == [("country", "RU"), ("country", "US"), ("topic", "Vision"), ("topic", "—")]


def test_year_series_come_from_one_pass(spark):
    rows = {(r.series, r.year): r.n for r in counts.works_by_year(sample(spark), SPEC).collect()}
    assert rows == {("corpus_all", 2010): 2, ("corpus_all", 2025): 1, ("corpus_articles", 2010): 2,
                    ("slice_all", 2010): 2, ("slice_with_abstract", 2010): 2}


def test_funnel_and_completeness(spark):
    df = sample(spark)
    assert [r.n for r in counts.slice_funnel(df, SPEC).orderBy("step").collect()] == [3, 2, 2]
    shares = dict(counts.completeness(df, SPEC).collect())
    assert shares["weak_topic"] == 0.5          # score 0.4 and no topic; 0.5 is not below 0.5
    assert shares["has_doi"] == 0.5 and shares["has_orgs"] == 0.25
    assert shares["has_abstract"] == 0.75


def test_country_counts_per_work_and_per_mention(spark):
    df = sample(spark)
    assert dict(counts.country_counts(df).collect()) == {"RU": 1, None: 1, "US": 1}
    assert dict(counts.country_counts(df, "mention", False).collect()) == {"RU": 2, "US": 1}
    assert [r.country for r in counts.country_top(df, 2).collect()] == ["RU", "US"]


def test_lost_ids_are_duplicates_and_lost_dois_are_not(spark):
    lost = works(spark, [dict(id=i, doi=i) for i in (None, None, "", "", "x")])
    assert dict(counts.duplicate_counts(lost).collect()) == {"id": 2, "doi": 0}
    assert dict(counts.duplicate_counts(sample(spark)).collect()) == {"id": 0, "doi": 1}
    twice = sample(spark).unionByName(sample(spark))
    assert dict(counts.duplicate_counts(twice).collect()) == {"id": 4, "doi": 3}


def test_totals_and_summaries(spark):
    df = sample(spark)
    pre = preprints(spark, [dict(id="p", created="2010-05-01", abstract="a"), dict(id="q", created="")])
    totals = dict(counts.corpus_totals(df, pre, shown=1).collect())
    assert totals == {"works": 4, "preprints": 2, "with_abstract": 3, "countries": 3, "topics": 2,
                      "shown_pct": 25.0}
    row = counts.works_summary(df).collect()[0]
    assert (row.year_min, row.year_max, row.share_doi) == (2010, 2026, 0.75)
    row = counts.preprints_summary(pre).collect()[0]
    assert (row.year_min, row.share_abstract) == (2010, 0.5)
    years = {r.year: r.preprints for r in counts.preprints_on_work_years(df, pre).collect()}
    assert years == {2010: 1, 2025: 0, 2026: 0}
    assert [r.type for r in counts.works_by_type(df).collect()] == ["article", "book", "preprint"]
    top = counts.top_values(df, F.col("language"), "language", 2).collect()
    assert [tuple(r) for r in top] == [("en", 2), ("ru", 1)]
    share = {r.year: r.share_pct for r in counts.abstract_by_year(df).collect()}
    assert share == {2010: 100.0, 2026: 0.0, 2025: 100.0}


def test_counting_agrees_with_plain_python(spark):
    df = sample(spark)
    expected = Counter(r.type for r in df.collect())
    assert {r.type: r.n for r in counts.works_by_type(df).collect()} == expected


def test_preview_rows(spark):
    rows = {r.id: r for r in preview.work_snippet(sample(spark)).collect()}
    assert (rows["1"].orgs, rows["1"].countries) == ("A, B", "RU")
    assert rows["3"].abstract == preview.NO_ABSTRACT and rows["2"].language == "?"
    pre = preprints(spark, [dict(id="p", title="T " * 60, updated=None, categories=["a", "b"])])
    row = preview.preprint_snippet(pre).collect()[0]
    assert row.title.endswith(" [...]") and len(row.title) <= 88
    assert (row.updated, row.categories, row.link) == ("—", "a b", "https://arxiv.org/abs/p")


def test_slice_probe(spark):
    funnel, fields, languages = preview.slice_probe(sample(spark), SPEC)
    assert [r.n for r in funnel.orderBy("step").collect()] == [3, 2, 2]
    assert dict(fields.collect())["has_doi"] == 1.0
    assert [tuple(r) for r in languages.collect()] == [("en", 1), (None, 1)]
