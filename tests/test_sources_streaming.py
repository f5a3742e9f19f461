from __future__ import annotations

import json
import shutil
from datetime import datetime, timezone
from pathlib import Path

import pytest
from helpers import preprints, raw, works
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from trendloom import session
from trendloom.operators import counts
from trendloom.operators.filters import SliceSpec
from trendloom.plans import reports
from trendloom.schemas import PREPRINTS, WORKS, conforms
from trendloom.sources import documents, sinks, tables
from trendloom.streaming import ingest, series


def some_works(spark, n=10):
    return works(spark, [dict(id=f"W{i}", publication_year=2010 + i % 3, title=f"t{i}",
                              institution_names=["a", None]) for i in range(n)])


def test_works_sink_and_scan(spark, fresh):
    df, path = some_works(spark), fresh("works")
    sinks.write_works(df, path, rows=2)
    back = tables.read_works(spark, path)
    assert conforms(back, WORKS)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    assert tables.read_works_year(spark, path, 2011).count() == 3
    plan = tables.read_works_year(spark, path, 2011)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    with pytest.raises(ValueError):
        tables.read_works_year(spark, path, 1999)


def test_single_file_and_missing_source(spark, fresh):
    path = fresh("sample")
    sinks.write_sample(some_works(spark), path)
    assert tables.read_works(spark, path).count() == 10
    with pytest.raises(FileNotFoundError):
        tables.read_works(spark, fresh("nothing"))


def test_resolution_prefers_the_full_slice(spark, fresh):
    full, sample = fresh("full"), fresh("sample")
    with pytest.raises(FileNotFoundError):
        tables.resolve_works(spark, full, sample)
    sinks.write_sample(some_works(spark, 2), sample)
    assert tables.resolve_works(spark, full, sample)[1] == "sample"
    with pytest.raises(ValueError):
        tables.resolve_works(spark, full, sample, 2010)
    sinks.write_works(some_works(spark), full)
    df, label = tables.resolve_works(spark, full, sample)
    assert (df.count(), label) == (10, "full slice")
    assert tables.resolve_works(spark, full, sample, 2010)[1] == "year 2010"


def test_preprints_of_all_sets_without_repeats(spark, fresh):
    def rows(ids, title):
        return preprints(spark, [dict(id=i, created="2018-07-09", title=title) for i in ids])
    path = fresh("pre")
    both = rows("12", "from cs").withColumn("set", F.lit("cs")).unionByName(
        rows("23", "from stat").withColumn("set", F.lit("stat")))
    sinks.write_preprints(both, path)
    out = tables.read_preprints(spark, path)
    assert conforms(out, PREPRINTS)
    assert {r.id: r.title for r in out.collect()} == {
        "1": "from cs", "2": "from cs", "3": "from stat"}
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_series_document_round_trip_and_refresh(spark, fresh):
    series = spark.createDataFrame([("slice_all", 2010, 5), ("slice_all", 2011, 6),
                                    ("slice_embeddable", 2010, 1)], "series string, year int, n bigint")
    path = fresh("series")
    sinks.write_document(sinks.series_document(series, "s", "src"), path)
    text = spark.read.text(path).collect()[0][0]
    assert json.loads(text)["years"]["slice_all"] == {"2010": 5, "2011": 6}
    back = documents.read_series(spark, path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, series.collect()))
    assert dict(documents.read_expected(spark, path).collect()) == {2010: 5, 2011: 6}
    local = spark.createDataFrame([(2010, 9)], "year int, n bigint")
    fresh_rows = {(r.series, r.year): r.n for r in documents.refresh_series(back, local).collect()}
    assert fresh_rows == {("slice_all", 2010): 5, ("slice_all", 2011): 6,
                          ("slice_embeddable", 2010): 9}
    remote = spark.createDataFrame([("slice_all", 2010, 7)], "series string, year int, n bigint")
    assert documents.refresh_series(back, local, remote=remote).count() == 2


def test_works_ingest_resumes_and_repeats_nothing(spark, fresh):
    landing, out, mark = fresh("landing"), fresh("out"), fresh("mark")
    first = raw(spark, [dict(id=f"x/W{i}", publication_year=2010) for i in range(4)])
    first.repartition(2).write.mode("append").json(landing)
    assert ingest.ingest_works(spark, landing, out, mark, files_per_batch=1) == 4
    assert ingest.ingest_works(spark, landing, out, mark) == 0
    raw(spark, [dict(id="x/W9", publication_year=2011)]).write.mode("append").json(landing)
    assert ingest.ingest_works(spark, landing, out, mark) == 1
    held = tables.read_works(spark, out)
    assert sorted(r.id for r in held.collect()) == ["W0", "W1", "W2", "W3", "W9"]
    expected = spark.createDataFrame([(2010, 4), (2011, 2), (2012, 1)], "year int, expected bigint")
    progress = ingest.ingest_progress(held, expected)
    assert {r.year: (r.rows, r.closed) for r in progress.collect()} == {
        2010: (4, True), 2011: (1, False), 2012: (0, False)}
    assert tuple(ingest.ingest_total(progress).collect()[0]) == (5, 1, 3)


def test_preprint_ingest_reads_pages(spark, fresh, tmp_path):
    landing = tmp_path / "pages"
    landing.mkdir()
    record = ("<record><header/><metadata><arXiv><id>{0}</id><created>2020-01-01</created>"
              "<title>T {0}</title></arXiv></metadata></record>")
    gone = '<record><header status="deleted"/></record>'
    (landing / "a.xml").write_text(f"<l>{record.format(1)}{gone}</l>")
    out, mark = fresh("out"), fresh("mark")
    ingest.ingest_preprints(spark, str(landing), out, mark, "cs")
    (landing / "b.xml").write_text(f"<l>{record.format(2)}</l>")
    ingest.ingest_preprints(spark, str(landing), out, mark, "cs")
    assert sorted((r.id, r.title) for r in tables.read_preprints(spark, out).collect()) == [
        ("1", "T 1"), ("2", "T 2")]


def test_probe_stops_after_the_limit(spark):
    assert tables.probe(some_works(spark), 3).count() == 3


def test_catalogue_document_is_json_of_the_expected_shape(spark, fresh):
    w = works(spark, [dict(id=f"W{i}", publication_year=2010 + i % 2, type="article", abstract="a",
                           primary_topic=("T1", "One", 0.9), institution_countries=["RU", None],
                           institution_names=["Org"], cited_by_count=i) for i in range(6)])
    p = preprints(spark, [dict(id="p", created="2011-02-03")])
    doc = reports.catalog_doc(w, p, w, SliceSpec(), min_works=1, shown=3)
    path = fresh("doc")
    sinks.write_document(doc, path)
    data = json.loads(spark.read.text(path).collect()[0][0])
    assert data["years"] == [2010, 2011] and data["by_year"] == [3, 3]
    assert data["preprints_by_year"] == [0, 1]
    assert data["totals"] == {"works": 6, "preprints": 1, "with_abstract": 6, "countries": 2,
                              "topics": 1}
    assert data["by_type"] == {"article": 6} and data["by_country"] == {"RU": 6, "null": 6}
    assert data["topics"] == [{"id": "T1", "name": "One", "works": 6, "growth": 1.0, "series": [3, 3]}]
    assert [x["c"] for x in data["works"]] == [0, 2, 4]
    assert set(data["works"][0]) == {"t", "y", "k", "tp", "c", "a", "o", "cn", "u"}


def test_scratch_folder_comes_from_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_path(spark, "x").startswith(folder)


def land(spark, folder, *rows):
    raw(spark, list(rows)).write.mode("append").json(folder)


def test_files_from_long_ago_are_ingested(spark, fresh):
    landing, out, mark = fresh("landing"), fresh("out"), fresh("mark")
    land(spark, landing, dict(id="a", publication_year=2020))
    assert ingest.ingest_works(spark, landing, out, mark) == 1
    land(spark, fresh("old"), dict(id="b", publication_year=2020))
    tables.set_file_times(spark, fresh("old"), datetime(1999, 1, 1, tzinfo=timezone.utc))
    for f in Path(fresh("old")).glob("part-*"):
        shutil.copy2(f, landing)
    assert ingest.ingest_works(spark, landing, out, mark) == 1
    assert {r.id for r in tables.read_works(spark, out).collect()} == {"a", "b"}


def test_rows_added_are_counted_beyond_a_hundred_batches(spark, fresh):
    landing, out, mark = Path(fresh("landing")), fresh("out"), fresh("mark")
    landing.mkdir()
    for i in range(104):
        (landing / f"{i}.json").write_text('{"id": "W%d", "publication_year": 2020}' % i)
    assert ingest.ingest_works(spark, str(landing), out, mark, files_per_batch=1) == 104


def test_a_trial_run_stops_and_the_next_one_goes_on(spark, fresh):
    landing, out, mark = Path(fresh("landing")), fresh("out"), fresh("mark")
    landing.mkdir()
    for i in range(40):
        (landing / f"{i}.json").write_text('{"id": "W%d", "publication_year": 2020}' % i)
    first = ingest.ingest_works(spark, str(landing), out, mark, files_per_batch=1, stop_after=3)
    assert 3 <= first < 40
    assert first + ingest.ingest_works(spark, str(landing), out, mark) == 40


def test_a_trial_run_is_bounded_by_bytes_where_files_are_not(spark, fresh, monkeypatch):
    landing, out, mark = Path(fresh("landing")), fresh("out"), fresh("mark")
    landing.mkdir()
    lines = "".join('{"id": "W%d", "publication_year": 2020}\n' % i for i in range(50))
    for i in range(30):
        (landing / f"{i}.json").write_text(lines)
    monkeypatch.setattr(ingest, "TRIAL_BYTES", 2 * len(lines))           # two files a batch
    first = ingest.ingest_works(spark, str(landing), out, mark, stop_after=60)
    assert 60 <= first < 30 * 50 and first % 100 == 0
    assert first + ingest.ingest_works(spark, str(landing), out, mark, bytes_per_batch=10 * len(lines)) == 1500
    with pytest.raises(ValueError):
        ingest.ingest_works(spark, str(landing), out, mark, files_per_batch=1, bytes_per_batch=1)


def test_unreadable_records_go_to_a_side_table_or_stop_the_run(spark, fresh):
    landing, out, rejects = Path(fresh("landing")), fresh("out"), fresh("rejects")
    landing.mkdir()
    (landing / "x.json").write_text('{"id": "W1", "publication_year": 2020}\n{"id": "W2", "publica\n')
    assert ingest.ingest_works(spark, str(landing), out, fresh("m1"), rejects=rejects) == 1
    assert [r.id for r in tables.read_works(spark, out).collect()] == ["W1"]
    assert [r.record for r in spark.read.parquet(rejects).collect()] == ['{"id": "W2", "publica']
    with pytest.raises(Exception, match="FAILED_READ_FILE|MALFORMED"):
        ingest.ingest_works(spark, str(landing), fresh("out2"), fresh("m2"))


def test_a_year_filter_skips_folders(spark, fresh):
    sinks.write_works(some_works(spark, 30), fresh("works"))
    one = tables.read_works(spark, fresh("works")).where(F.col("publication_year") == 2011)
    assert one.count() == 10
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull" in plan and "2011" in plan


def test_preprint_keys_are_those_of_the_first_copies(spark, fresh):
    rows = [dict(id="a", created="2020", updated="2", title="x"), dict(id="a", created="2019", updated="1", title="y"),
            dict(id="b", created=None, updated=None), dict(id="c", created="2018", updated="1", title="z")]
    df = preprints(spark, rows).withColumn("set", F.when(F.col("title") == "x", "cs").otherwise("math"))
    sinks.write_preprints(df.unionByName(df), fresh("pre"))
    keys = tables.read_preprint_keys(spark, fresh("pre"))
    whole = tables.read_preprints(spark, fresh("pre"))
    assert sorted(map(tuple, keys.collect()), key=str) == sorted(
        map(tuple, whole.select("id", "created").collect()), key=str)
    assert dict(keys.collect())["a"] == "2020"
    schema = keys._jdf.queryExecution().executedPlan().toString()
    assert "abstract" not in schema and "title" not in schema


def test_no_temporary_folder_where_executors_are_separate(monkeypatch):
    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Session:
        conf = Conf({"spark.master": "local-cluster[2,1,1024]"})
    with pytest.raises(RuntimeError):
        session.scratch_dir(Session())


SERIES_SPEC = SliceSpec(subfield_ids=(1, 2), year_start=2010, year_end=2020)


def series_works(spark, years, start=0):
    return works(spark, [dict(id=f"W{start + i}", publication_year=y, type=["article", "book"][i % 2], language=["en", None, "de"][i % 3],
                              abstract=[None, "a", " "][i % 3], primary_subfield_id=i % 4) for i, y in enumerate(years)])


def recounted(df):
    both = counts.works_by_year(df, SERIES_SPEC).unionByName(
        counts.embeddable_by_year(df).select(F.lit("slice_embeddable").alias("series"), "year", F.col("n").cast("bigint")))
    return sorted(map(tuple, both.collect()), key=str)


def test_series_grow_by_what_is_new_and_old_files_are_not_read(spark, fresh):
    first, second = series_works(spark, [2010, 2011, 2011, 2009, None] * 4), series_works(spark, [2011, 2012, None] * 5, 100)
    out, parts, seen = fresh("out"), fresh("parts"), fresh("seen")
    sinks.write_works(first, out)
    got = series.refresh_series(spark, out, parts, seen, SERIES_SPEC, files_per_batch=1)
    assert sorted(map(tuple, got.collect()), key=str) == recounted(first)
    for old in Path(out).glob("year=*"):
        shutil.rmtree(old)
    sinks.write_works(second, out, mode="append")
    both = recounted(first.unionByName(second))
    for _ in range(2):                                                  # the second refresh finds nothing new
        got = series.refresh_series(spark, out, parts, seen, SERIES_SPEC)
        assert sorted(map(tuple, got.collect()), key=str) == both


def test_a_batch_that_was_written_but_not_committed_counts_once(spark, fresh):
    df = series_works(spark, [2010, 2011, 2012] * 5)
    out, parts, seen = fresh("out"), fresh("parts"), fresh("seen")
    sinks.write_works(df, out)
    series.refresh_series(spark, out, parts, seen, SERIES_SPEC, files_per_batch=1)
    last = max((p for p in Path(seen, "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    last.unlink()
    Path(seen, "commits", f".{last.name}.crc").unlink(missing_ok=True)
    got = series.refresh_series(spark, out, parts, seen, SERIES_SPEC, files_per_batch=1)
    assert sorted(map(tuple, got.collect()), key=str) == recounted(df)


def test_no_batch_gives_an_empty_series(spark, fresh):
    assert series.merged_series(spark, fresh("parts")).collect() == []


def test_one_position_serves_works_and_rejects(spark, fresh, monkeypatch):
    landing, out, mark, rejects = Path(fresh("landing")), fresh("out"), fresh("mark"), fresh("rejects")
    landing.mkdir()

    def land_lines(name, *ids):
        (landing / name).write_text("".join('{"id": "W%s", "publication_year": 2020}\n' % i for i in ids) + '{"id": "broken %s\n' % name)

    def held():
        return (sorted(r.id for r in tables.read_works(spark, out).collect()),
                sorted(r.record for r in spark.read.parquet(rejects).collect()))
    land_lines("a.json", 1, 2)
    assert ingest.ingest_works(spark, str(landing), out, mark, rejects=rejects) == 2
    land_lines("b.json", 3)
    calls, write = [], DataFrameWriter.parquet

    def fails_once(self, path, *args, **more):
        if path.startswith(rejects) and not calls:
            calls.append(path)
            raise RuntimeError("lost between the two writes")
        return write(self, path, *args, **more)
    monkeypatch.setattr(DataFrameWriter, "parquet", fails_once)
    with pytest.raises(Exception, match="lost between"):
        ingest.ingest_works(spark, str(landing), out, mark, rejects=rejects)
    assert calls and held()[1] == ['{"id": "broken a.json']
    ingest.ingest_works(spark, str(landing), out, mark, rejects=rejects)
    assert held() == (["W1", "W2", "W3"], ['{"id": "broken a.json', '{"id": "broken b.json'])
    assert ingest.ingest_works(spark, str(landing), out, mark, rejects=rejects) == 0
    assert not Path(f"{mark}-rejects").exists()
    one = tables.read_works(spark, out).where("publication_year = 2020")
    assert "PartitionFilters: [isnotnull" in one._jdf.queryExecution().executedPlan().toString() and one.count() == 3


def test_a_table_keeps_its_way_of_being_filled(spark, fresh):
    landing = fresh("landing")
    land(spark, landing, dict(id="a", publication_year=2020))
    ingest.ingest_works(spark, landing, fresh("plain"), fresh("m1"))
    with pytest.raises(ValueError, match="without"):
        ingest.ingest_works(spark, landing, fresh("plain"), fresh("m2"), rejects=fresh("r"))
    ingest.ingest_works(spark, landing, fresh("both"), fresh("m3"), rejects=fresh("r"))
    with pytest.raises(ValueError, match="with a side"):
        ingest.ingest_works(spark, landing, fresh("both"), fresh("m4"))
