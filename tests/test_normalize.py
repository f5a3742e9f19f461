from __future__ import annotations

import pytest
from helpers import raw

from trendloom.operators.normalize import preprints_from_oai, works_from_raw
from trendloom.schemas import PREPRINTS, WORKS, conforms
from trendloom.sources.tables import (
    land_raw_works, parse_records, read_landed_works, read_raw_preprints, read_raw_works,
)

NAMESPACES = ("http://www.openarchives.org/OAI/2.0/", "http://arxiv.org/OAI/arXiv/")


def oai_record(fields=None, authors=None, header="", status=None, namespaces=("", "")):
    """One protocol record from a list of fields; values are inserted as XML, ``None`` for no metadata."""
    outer, inner = (f' xmlns="{n}"' if n else "" for n in namespaces)
    marked = f' status="{status}"' if status else ""
    head = f"<header{marked}>{header}</header>"
    if fields is None and authors is None:
        return f"<record{outer}>{head}</record>"
    names = "".join("<author>" + "".join(f"<{k}>{v}</{k}>" for k, v in a.items()) + "</author>"
                    for a in authors or [])
    body = "".join(f"<{k}>{v}</{k}>" for k, v in (fields or {}).items())
    listed = f"<authors>{names}</authors>" if authors is not None else ""
    return f"<record{outer}>{head}<metadata><arXiv{inner}>{body}{listed}</arXiv></metadata></record>"


def parsed(spark, *records):
    xml = spark.createDataFrame([(r,) for r in records], "record string")
    return {r.id: r for r in preprints_from_oai(parse_records(xml)).collect()}


def normalized(spark, **fields):
    return works_from_raw(raw(spark, [fields])).collect()[0]


def test_works_have_the_declared_schema(spark):
    assert conforms(works_from_raw(raw(spark, [])), WORKS)


def test_placeholder_date(spark):
    assert normalized(spark, publication_date="2015-01-01").date_is_placeholder is True
    assert normalized(spark, publication_date="2015-03-12").date_is_placeholder is False
    row = normalized(spark, publication_date="")
    assert (row.date_is_placeholder, row.publication_date) == (False, None)


def test_institutions_once_in_order_of_mention(spark):
    def inst(i, name="n", country="c"):
        return (i, name, country)
    row = normalized(spark, authorships=[
        ([inst("o/I2", "Two", "RU"), inst("o/I1", "One", None)],), (None,),
        ([inst("o/I2", "Other", "US"), inst(None), inst(""), inst("o/I3", None, "FR")],)])
    assert row.institution_ids == ["I2", "I1", "I3"]
    assert row.institution_names == ["Two", "One", None]
    assert row.institution_countries == ["RU", None, "FR"]
    assert row.author_count == 3


def test_missing_parts_get_defaults(spark):
    row = normalized(spark)
    assert (row.is_oa, row.cited_by_count, row.author_count) == (False, 0, 0)
    assert (row.topics, row.institution_ids, row.institution_names) == ([], [], [])
    assert row.primary_topic is None and row.primary_subfield_id is None and row.venue is None


def test_topics_subfield_and_venue(spark):
    t = ("https://o/T1", "Name", 0.5, ("https://o/subfields/1702",))
    row = normalized(spark, primary_topic=t, topics=[t], publication_year=2020,
                     primary_location=(None, None, ("Journal",)))
    assert tuple(row.primary_topic) == ("T1", "Name", 0.5)
    assert [tuple(x) for x in row.topics] == [("T1", "Name", 0.5)]
    assert (row.primary_subfield_id, row.venue, row.publication_year) == (1702, "Journal", 2020)


def test_out_of_range_numbers_become_null(spark):
    assert normalized(spark, publication_year=99999).publication_year is None


def test_preprints_have_the_declared_schema(spark):
    xml = spark.createDataFrame([(oai_record({"id": "a"}),)], "record string")
    assert conforms(preprints_from_oai(parse_records(xml)), PREPRINTS)


@pytest.mark.parametrize("namespaces", [("", ""), NAMESPACES])
def test_every_field_of_a_record(spark, namespaces):
    row = parsed(spark, oai_record(
        {"id": "2406.7", "created": "2024-06-01", "updated": "2024-07-02", "doi": "10.9/z",
         "title": "One", "categories": "cs.LG", "abstract": "Two"}, [{"keyname": "Q"}],
        namespaces=namespaces))["2406.7"]
    assert (row.created, row.updated, row.doi) == ("2024-06-01", "2024-07-02", "10.9/z")
    assert (row.title, row.abstract, row.primary_category) == ("One", "Two", "cs.LG")
    assert (row.authors, row.author_count) == (["Q"], 1)


def test_a_record_of_an_id_alone(spark):
    row = parsed(spark, oai_record({"id": "x"}))["x"]
    assert (row.categories, row.primary_category, row.authors, row.author_count) == ([], None, [], 0)
    assert {row.created, row.updated, row.doi, row.title, row.abstract} == {None}


def test_deleted_and_empty_records_are_left_out(spark):
    kept = parsed(spark, oai_record({"id": "gone"}, status="deleted"), oai_record(),
                  oai_record(status="deleted"), oai_record({"id": "here"}))
    assert set(kept) == {"here"}


@pytest.mark.parametrize("xml, text", [
    ("a\n   b\t c", "a b c"), ("x &lt; y &amp; z", "x < y & z"), ("<![CDATA[p < q]]>", "p < q"),
    ("&#233;t&#xe9;", "été"), ("  edge  ", "edge")])
def test_blanks_entities_and_character_data(spark, xml, text):
    row = parsed(spark, oai_record({"id": "t", "title": xml, "abstract": xml}))["t"]
    assert (row.title, row.abstract) == (text, text)


@pytest.mark.parametrize("author, name", [
    ({"keyname": "B", "forenames": "A"}, "A B"), ({"keyname": "B"}, "B"),
    ({"keyname": " B ", "forenames": " A "}, "A B"), ({"keyname": "  "}, None),
    ({"forenames": "A"}, "A"), ({}, None)])
def test_author_names(spark, author, name):
    row = parsed(spark, oai_record({"id": "n"}, [author]))["n"]
    assert row.authors == ([name] if name else [])


@pytest.mark.parametrize("listed, categories", [
    ("a.B", ["a.B"]), ("a.B c.D  e", ["a.B", "c.D", "e"]), ("  ", []), ("", [])])
def test_categories_in_order_and_the_first_is_primary(spark, listed, categories):
    row = parsed(spark, oai_record({"id": "c", "categories": listed}))["c"]
    assert row.categories == categories
    assert row.primary_category == (categories[0] if categories else None)


def test_pages_from_files(spark, tmp_path):
    for page in range(3):
        records = "".join(oai_record({"id": f"{page}-{i}"}, namespaces=NAMESPACES) for i in range(4))
        (tmp_path / f"{page}.xml").write_text(
            f"<?xml version='1.0'?><OAI-PMH><ListRecords>{records}</ListRecords></OAI-PMH>", encoding="utf-8")
    rows = preprints_from_oai(read_raw_preprints(spark, str(tmp_path))).collect()
    assert {r.id for r in rows} == {f"{p}-{i}" for p in range(3) for i in range(4)}


def test_xml_is_parsed_once(spark):
    xml = spark.createDataFrame([(oai_record({"id": "x"}),)], "record string")
    plan = preprints_from_oai(parse_records(xml))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_xml") == 1


def test_restoring_stays_in_the_jvm(spark):
    plan = works_from_raw(raw(spark, []))._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "InPandas" not in plan


INDEX_LINES = ['{"id": "u/1", "abstract_inverted_index": {"b": [1, 3], "a": [0], "c": [2, 3]}, "cited_by_count": 3}',
               '{"id": "u/2", "abstract_inverted_index": {}}', '{"id": "u/3", "abstract_inverted_index": null}', '{"id": "u/4"}',
               '{"id": "u/5", "abstract_inverted_index": {"say \\"ü\\" {": [7], "z": null, "": [2]}}',
               '{"id": "u/6", "abstract_inverted_index": {"x": []}, "title": "t"}']


@pytest.fixture
def landed(spark, tmp_path):
    (tmp_path / "in.json").write_text("\n".join(INDEX_LINES), encoding="utf-8")
    land_raw_works(spark, str(tmp_path / "in.json"), str(tmp_path / "landed"))
    return read_landed_works(spark, str(tmp_path / "landed"))


def test_landed_text_index_normalises_like_the_parsed_one(spark, tmp_path, landed):
    direct = works_from_raw(read_raw_works(spark, str(tmp_path / "in.json"))).orderBy("id").collect()
    assert works_from_raw(landed).orderBy("id").collect() == direct
    assert [r.abstract for r in direct] == ["a b c c", None, None, None, ' say "ü" {', None]


def test_index_is_neither_read_nor_parsed_unless_asked_for(spark, landed):
    plan = works_from_raw(landed).select("id", "arxiv_id", "institution_ids")._jdf.queryExecution().executedPlan().toString()
    assert "inverted_index" not in plan and "from_json" not in plan.lower() and "jsontostructs" not in plan.lower()
    whole = works_from_raw(landed)._jdf.queryExecution().optimizedPlan().toString().lower()
    assert whole.count("from_json") == 1


def test_broken_records_stop_the_landing(spark, tmp_path):
    (tmp_path / "bad.json").write_text('{"id": "u/1", "abstract_inverted_index": {"a": [0]\n', encoding="utf-8")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|FAILED_READ"):
        land_raw_works(spark, str(tmp_path / "bad.json"), str(tmp_path / "never"))
