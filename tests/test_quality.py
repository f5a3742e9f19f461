from __future__ import annotations

import gzip
import hashlib
import json

import pandas as pd
import pytest
from contract.queries import QUERIES
from helpers import preprints, works
from pyspark.sql import functions as F

from trendloom.operators import counts, quality
from trendloom.operators.filters import SliceSpec
from trendloom.plans import reports
from trendloom.sources import documents, sinks, tables


def years(spark, rows, name):
    return spark.createDataFrame(rows, f"year int, {name} bigint")


def test_coverage_gap_covers_both_sides(spark):
    actual = years(spark, [(2010, 90), (2011, 100), (2013, 5)], "actual")
    expected = years(spark, [(2010, 100), (2011, 100), (2012, 10), (2013, 0)], "expected")
    full = {r.year: (r.actual, r.expected, r.gap) for r in
            quality.coverage_gap(actual, expected).collect()}
    assert full == {2010: (90, 100, 0.1), 2011: (100, 100, 0.0), 2012: (0, 10, 1.0),
                    2013: (5, 0, None)}
    assert sorted(r.year for r in quality.coverage_gap(actual, expected, "left").collect()) == [
        2010, 2011, 2013]
    over = quality.gap_years(quality.coverage_gap(actual, expected))
    assert sorted(r.year for r in over.collect()) == [2010, 2012]


def test_preprint_link_counts_distinct_keys(spark):
    w = works(spark, [dict(id=str(i), arxiv_id=a) for i, a in enumerate(["p", "p", "q", "", None])])
    p = preprints(spark, [dict(id="p"), dict(id="z")])
    assert tuple(quality.preprint_link(w, p).collect()[0]) == (1, 2)
    assert [r.id for r in quality.linked_preprints(w, p).collect()] == ["p"]


def test_acceptance_report(spark):
    w = works(spark, [dict(id="1", abstract="a", publication_year=2010, publication_date="x", doi="d"),
                      dict(id="2", abstract="a", publication_year=2010, doi="d")])
    p = preprints(spark, [dict(id="p", created="2010-01-01"), dict(id="q", created="1999-01-01")])
    expected = years(spark, [(2010, 2)], "expected")
    clean = spark.createDataFrame([("f", "ok")], "path string, status string")
    report = quality.acceptance(w, expected, p, clean, w, min_rows=2)
    rows = {r.check: (r.ok, r.value) for r in report.collect()}
    assert rows["works"] == (True, 2.0) and rows["undated"] == (False, 1.0)
    assert rows["shared_dois"] == (True, 1.0) and rows["worst_gap"] == (True, 0.0)
    assert rows["preprints_in_range"] == (True, 1.0) and rows["manifest_problems"] == (True, 0.0)
    assert tuple(quality.accepted(report).collect()[0]) == (False, 1)
    bare = {r.check: r.ok for r in quality.acceptance(w, expected, min_rows=3).collect()}
    assert not any(bare[c] for c in ("works", "preprints", "manifest_problems", "sample"))


def test_manifest_of_real_files(spark, fresh, tmp_path):
    w = works(spark, [dict(id=str(i), publication_year=2010 + i % 2) for i in range(10)])
    path = fresh("slice")
    sinks.write_works(w, path, rows=3)
    files = quality.manifest_files(tables.list_files(spark, path), str(tmp_path))
    for row in files.collect():
        content = (tmp_path / row.path).read_bytes()
        assert (row.bytes, row.sha256) == (len(content), hashlib.sha256(content).hexdigest())
    expected = years(spark, [(2010, 5), (2011, 4)], "expected")
    stored = tables.read_works_partitioned(spark, path)
    got = {r.year: r for r in quality.manifest_years(stored, expected).collect()}
    assert (got[2010].rows, got[2010].gap, got[2011].gap) == (5, 0.0, 0.25)
    assert got[2010].files >= 2 and got[2010].bytes > 0
    assert sum(r.rows for r in quality.rows_per_file(stored).collect()) == 10

    out = fresh("manifest")
    head = sinks.manifest_document(quality.manifest_years(stored, expected), F.struct(
        F.lit(1).alias("per_page")), "s", "2026-01-01", "abc", "src")
    sinks.write_manifest(head, files, out)
    saved = documents.read_manifest_list(spark, out)
    assert {r.status for r in quality.manifest_check(saved, files).collect()} == {"ok"}
    text = spark.read.text(f"{out}/head").collect()[0][0]
    assert json.loads(text)["rows_total"] == 10 and json.loads(text)["years"]["2011"]["rows"] == 5


@pytest.fixture
def small_values(spark):
    """A session in which no file over 8 KB can be read as one value."""
    name = "spark.sql.sources.binaryFile.maxLength"
    spark.conf.set(name, "8192")
    yield
    spark.conf.unset(name)


ODD = {"a b.parquet": bytes(range(256)) * 400, "year=2010/x%20y.parquet": b"ended\n" * 5000,
       "year=2011/[a]{b}.parquet": b"x" * 100_001 + b"\n" + b"y" * 8192, "cr.parquet": b"\r\n\r" * 9000,
       "mark.parquet": b"\xef\xbb\xbf" + b"z" * 9000, "mark_ended.parquet": b"\xef\xbb\xbf" + b"z\n" * 9000,
       "only_mark.parquet": b"\xef\xbb\xbf", "line.parquet": b"\n", "zero.parquet": bytes(70_000),
       "packed.gz": gzip.compress(b"abc" * 9), "none.parquet": b""}


@pytest.mark.parametrize("store", ["", "viewfs://manifest/in"])
def test_manifest_of_files_larger_than_a_value(spark, small_values, tmp_path, store):
    for name, content in ODD.items():
        file = tmp_path / "in" / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(content)
    spark.conf.set("fs.viewfs.mounttable.manifest.link./in", f"file://{tmp_path}/in")
    root = store or f"{tmp_path}/in"
    files = quality.manifest_files(tables.list_files(spark, root, pattern="*"), root)
    assert {r.path: (r.bytes, r.sha256) for r in files.collect()} == {
        k: (len(v), hashlib.sha256(v).hexdigest()) for k, v in ODD.items() if v}


def test_manifest_of_a_file_that_changes_is_an_error(spark, tmp_path):
    (tmp_path / "a.parquet").write_bytes(bytes(100_000))
    spark.conf.set("fs.viewfs.mounttable.shorter.link./in", f"file://{tmp_path}")
    root = "viewfs://shorter/in"
    files = quality.manifest_files(tables.list_files(spark, root), root)
    (tmp_path / "a.parquet").write_bytes(bytes(50_000))
    with pytest.raises(Exception, match="bytes, listed with 100000"):
        files.collect()


@pytest.fixture
def small_tables(tmp_path):
    """A folder of three driver tables, of which documents are over 8 KB."""
    text = [hashlib.sha256(bytes([i])).hexdigest() * 4 for i in range(60)]
    docs = pd.DataFrame({"doc_id": range(60), "text": text, "lang": "en", "source": "s", "n_chars": 256})
    for name, df in (("documents", docs), ("pages", docs.head(2)), ("labels", docs.tail(2))):
        df.to_parquet(tmp_path / f"{name}.parquet")
    assert (tmp_path / "documents.parquet").stat().st_size > 8192
    return str(tmp_path)


@pytest.mark.parametrize("name", ["manifest_check", "manifest_saved"])
def test_manifest_queries_load_no_file_whole(spark, small_values, small_tables, name):
    assert dict(QUERIES[name](spark, small_tables).collect()) == {
        "documents.parquet": "ok", "pages.parquet": "changed", "labels.parquet": "extra", "gone.parquet": "missing"}


def test_acceptance_loads_no_file_whole(spark, small_values, small_tables):
    report = {r.check: r.value for r in QUERIES["acceptance"](spark, small_tables).collect()}
    assert (report["works"], report["manifest_problems"], report["preprints_in_range"]) == (60, 3, 60)


def test_manifest_differences(spark):
    saved = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "path string, sha256 string")
    found = spark.createDataFrame([("a", "1"), ("b", "x"), ("d", "4")], "path string, sha256 string")
    got = {r.path: r.status for r in quality.manifest_check(saved, found).collect()}
    assert got == {"a": "ok", "b": "changed", "c": "missing", "d": "extra"}


def test_manifest_document_of_the_stored_format(spark, tmp_path):
    doc = {"slice_id": "s", "query": {"years": [2010, 2025]}, "rows_total": 5,
           "years": {"2010": {"rows": 5, "files": 1, "bytes": 9, "expected": 5, "gap": 0.0}},
           "files": {"raw/a.parquet": {"bytes": 9, "sha256": "x"},
                     "raw/b.parquet": {"bytes": 8, "sha256": "y"}}}
    (tmp_path / "manifest.json").write_text(json.dumps(doc, indent=2))
    rows = documents.read_manifest_files(spark, str(tmp_path / "manifest.json")).collect()
    assert sorted(map(tuple, rows)) == [("raw/a.parquet", 9, "x"), ("raw/b.parquet", 8, "y")]


def test_ground_truth_shape(spark, tmp_path):
    entries = [{"name": "NFT", "hype_year": 2021, "note": "n"}, {"name": "", "hype_year": 1990}]
    (tmp_path / "truth.json").write_text(json.dumps({"note": "x", "entries": entries}, indent=1))
    df = documents.read_ground_truth(spark, str(tmp_path / "truth.json"))
    rules = quality.shape_rules(
        df, {"name": F.col("name") != "", "year": F.col("year").between(2001, 2029),
             "note": F.col("note") != ""},
        required={"name": ["NFT", "metaverse"]}, at_least={"year": 2025})
    assert dict(rules.collect()) == {"name": 1, "year": 1, "note": 1, "not_empty": 0,
                                     "name_has_NFT": 0, "name_has_metaverse": 1,
                                     "year_reaches_2025": 1}


@pytest.mark.parametrize("vectors, expected", [
    ([("a", [0.6, 0.8]), ("a", [1.0, 0.0])], (2, 0, 0, 1)),
    ([("a", [1.0]), ("b", [2.0, 0.0]), ("c", None)], (3, 2, 2, 0)),
])
def test_embedding_check(spark, vectors, expected):
    df = spark.createDataFrame(vectors, "id string, embedding array<float>")
    assert tuple(quality.embedding_check(df, 2).collect()[0]) == expected


def scanned(spark, df):
    """The same rows, and a count of how often they are all read."""
    rows, n = spark.sparkContext.accumulator(0), df.count()

    def count(batches):
        for batch in batches:
            rows.add(batch.num_rows)
            yield batch
    return df.mapInArrow(count, df.schema), lambda: rows.value / n


def mixed_works(spark):
    return works(spark, [dict(
        id=None if i % 11 == 0 else f"W{i % 25}", doi=["", None, f"d{i % 7}"][i % 3], arxiv_id=["", None, f"p{i % 9}"][i % 3],
        abstract="a" if i % 4 else None, publication_year=None if i % 10 == 9 else 2010 + i % 3, type=[f"t{i % 5}", None][i % 13 == 0],
        primary_topic=(f"T{i % 4}", f"n{i % 2}", 0.5) if i % 6 else None,
        institution_countries=[["RU", "RU", None], [], None, ["DE"]][i % 4]) for i in range(60)])


def test_keys_of_all_kinds_in_one_scan(spark):
    w = mixed_works(spark)
    p = preprints(spark, [dict(id=x) for x in ("p2", "p5", "p5", None, None, "", "zz")])
    counted, scans = scanned(spark, w)
    got = counts.key_counts(counted, p).collect()[0].asDict()
    assert scans() == 1
    one = lambda df: df.collect()[0][0]                                             # noqa: E731
    named = {r.arxiv_id for r in w.collect() if r.arxiv_id}
    assert got == {"duplicate_ids": one(counts.duplicate_count(w, "id")), "shared_dois": one(counts.duplicate_count(w, "doi", skip_empty=True)),
                   "named": len(named), "matched": len(named & {"p2", "p5", "zz"}), "duplicate_preprints": one(counts.duplicate_count(p, "id"))}
    assert set(counts.key_counts(works(spark, [])).collect()[0]) == {0}


def test_cells_of_all_groupings_in_one_scan(spark):
    w = mixed_works(spark)
    counted, scans = scanned(spark, w)
    cells = counts.corpus_cells(counted).collect()
    assert scans() == 1
    countries = {r.id: r.n for r in cells if r.kind == "country"}
    assert countries == {r.country: r.n for r in counts.country_counts(w).collect()}
    by_year = {(r.year, r.id): (r.n, r.with_abstract) for r in cells if r.kind == "year"}
    assert by_year == {(r[0], r[1]): (r[2], r[3]) for r in w.groupBy("publication_year", "type").agg(
        F.count(F.lit(1)), F.count("abstract")).collect()}
    topics = {(r.id, r.name, r.year): r.n for r in cells if r.kind == "topic"}
    assert topics == {tuple(r[:3]): r[3] for r in w.groupBy("primary_topic.id", "primary_topic.name", "publication_year").count().collect()}


def test_acceptance_scans_works_twice(spark):
    counted, scans = scanned(spark, mixed_works(spark))
    p = preprints(spark, [dict(id="p2", created="2010-01-01"), dict(id="p2")])
    report = {r.check: r.value for r in quality.acceptance(counted, years(spark, [(2010, 20), (2012, 5)], "expected"), p).collect()}
    assert scans() == 2
    assert report["works"] == 60 and report["linked_preprints"] == 1 and report["duplicate_preprints"] == 1
    empty = {r.check: r.ok for r in quality.acceptance(works(spark, []), years(spark, [], "expected"), p, min_rows=0).collect()}
    assert empty["works"] and empty["duplicate_ids"] and not empty["abstract_share"]


def test_catalogue_bounds_types_and_treats_null_years_alike(spark):
    w = mixed_works(spark)
    counted, scans = scanned(spark, w)
    sample = works(spark, [dict(id="s", publication_year=2010)])
    doc = reports.catalog_doc(counted, preprints(spark, []), sample, SliceSpec(), min_works=1, top_types=2).collect()[0]
    assert scans() == 1
    assert doc["years"] == [2010, 2011, 2012] and doc["totals"]["works"] == 60 and sum(doc["by_year"]) == 54
    assert len(doc["by_type"]) == 2 and all(len(t["series"]) == 3 for t in doc["topics"])


def test_streamed_digests_of_odd_files(spark, tmp_path):
    contents = {"empty.bin": b"", "a b%20ü.bin": b"x" * 1000, "exact.bin": bytes(range(256)) * 4, "sub/long.bin": b"ab" * 5000}
    for name, content in contents.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(content)
    listed = tables.list_files(spark, str(tmp_path), pattern="*.bin")
    got = {r.path: (r.bytes, r.sha256) for r in quality.streamed_manifest(listed, str(tmp_path), 256).collect()}
    assert got == {n: (len(c), hashlib.sha256(c).hexdigest()) for n, c in contents.items() if c}      # empty: not listed


def test_streamed_digest_of_a_file_beyond_two_gigabytes(spark, tmp_path):
    """A sparse file, which ``sha2`` of its content could not take."""
    size, piece = (2 << 30) + 12345, bytes(1 << 20)
    with open(tmp_path / "big.bin", "wb") as f:
        f.truncate(size)
    row = quality.streamed_manifest(tables.list_files(spark, str(tmp_path), pattern="*.bin"), str(tmp_path)).first()
    expected, left = hashlib.sha256(), size
    while left:
        expected.update(piece[:left])
        left -= min(left, len(piece))
    assert (row.bytes, row.sha256) == (size, expected.hexdigest())


def test_a_file_that_changed_since_it_was_listed_is_an_error(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"abc")
    listed = tables.list_files(spark, str(tmp_path), pattern="*.bin").withColumn("length", F.col("length") + 1)
    with pytest.raises(Exception, match="listed with"):
        quality.streamed_manifest(listed, str(tmp_path)).collect()
