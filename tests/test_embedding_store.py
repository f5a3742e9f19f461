from __future__ import annotations

import pytest
from helpers import works
from pyspark.sql import Observation
from pyspark.sql import functions as F

from trendloom.operators import embedding_store as store
from trendloom.sources.tables import exists

YEARS = [2020, 2021, None]


def corpus(spark, n, suffix="", copies=1):
    rows = [dict(id=f"W{i}", title=f"t{i}", abstract=f"abstract {i}{suffix}", language="en",
                 publication_year=YEARS[i % 3]) for i in range(n)]
    blank = dict(id="blank", abstract=" ", language="en", publication_year=2030)
    lost = dict(id=None, title="t", abstract="a", language="en", publication_year=2020)
    return works(spark, rows * copies + [blank, lost])


def lengths():
    def load():
        return lambda texts: [[float(len(t)), 1.0] for t in texts]
    return load


def run(w, path, model="m", **more):
    return store.embed_into_store(w, path, lengths(), model, 2, **{"buckets": 4, **more})


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_a_rerun_writes_what_is_missing_and_counts_all(spark, fresh):
    path = fresh("store")
    assert run(corpus(spark, 10), path) == (10, 10)
    assert run(corpus(spark, 12), path) == (12, 2)
    assert run(corpus(spark, 12), path) == (12, 0)
    assert run(corpus(spark, 12), path, "an/other") == (12, 12)
    assert ids(store.read_store(spark, path, "m")) == sorted(f"W{i}" for i in range(12))


def test_repeated_works_get_one_vector(spark, fresh):
    path = fresh("store")
    assert run(corpus(spark, 4, copies=50).repartition(5), path) == (200, 4)
    assert ids(store.read_store(spark, path, "m")) == ["W0", "W1", "W2", "W3"]


def test_years_are_separate_and_other_bucket_numbers_do_not_matter(spark, fresh):
    path = fresh("it's a store")
    assert run(corpus(spark, 9), path, years=[2021]) == (3, 3)
    assert run(corpus(spark, 9), path, years=[None], buckets=64) == (3, 3)
    assert run(corpus(spark, 9), path, buckets=7) == (9, 3)
    assert ids(store.read_store(spark, path, "m", [2021])) == ["W1", "W4", "W7"]
    assert ids(store.read_store(spark, path, "m", [1999])) == [] == ids(store.read_store(spark, path, "none"))


def test_compaction_keeps_present_texts_only(spark, fresh):
    path = fresh("store")
    run(corpus(spark, 6), path)
    assert run(corpus(spark, 6, "!"), path) == (6, 6)
    assert store.read_store(spark, path, "m").count() == 12
    assert store.compact(corpus(spark, 5, "!"), path, "m") == (5, 7)
    assert store.compact(corpus(spark, 5, "!"), path, "m") == (5, 0)
    assert ids(store.read_store(spark, path, "m")) == [f"W{i}" for i in range(5)]
    assert run(corpus(spark, 6, "!"), path) == (6, 1)                 # appends go to the new version


def test_a_compaction_that_died_changes_nothing(spark, fresh):
    path = fresh("store")
    run(corpus(spark, 6), path)
    half = f"{path}/m/year=2020/v=1"
    store.read_store(spark, path, "m", [2021]).limit(1).write.parquet(half)
    store._drop(spark, f"{half}/_SUCCESS")
    assert store.read_store(spark, path, "m").count() == 6 and run(corpus(spark, 6), path) == (6, 0)
    assert store.compact(corpus(spark, 6), path, "m") == (6, 0)
    assert store.read_store(spark, path, "m").count() == 6 and not exists(spark, f"{path}/m/year=2020/v=0")


def test_an_encoder_that_fails_leaves_the_store_as_it_was(spark, fresh):
    path = fresh("store")
    run(corpus(spark, 6), path)

    def broken():
        raise RuntimeError("no model")
    with pytest.raises(Exception, match="no model"):
        store.embed_into_store(corpus(spark, 9), path, broken, "m", 2, buckets=4)
    assert run(corpus(spark, 9), path) == (9, 3)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("trendloom_vectors")]


def test_stored_keys_are_not_shuffled_and_other_years_not_read(spark, fresh):
    path = fresh("store")
    run(corpus(spark, 9), path)
    inputs = store._hashed(corpus(spark, 9).where(F.col("publication_year") == 2020), "|")
    with store.bucketed(spark, f"{path}/m/year=2020/v=0", 4) as name:
        missing = store.missing_keys(store.input_keys(inputs, 4), spark.table(name), Observation())
        plan = missing._jdf.queryExecution().executedPlan().toString()
        stored = plan[plan.index("FileScan"):]
        side = plan[plan.rindex("Sort [", 0, plan.index("FileScan")):plan.index("FileScan")]     # the stored keys' way to the join
        read = {part for f in missing.inputFiles() for part in f.split("/") if part.startswith("year=")}
        assert missing.count() == 3
    assert "Exchange" not in side and "Bucketed: true" in stored
    assert read == {"year=2020"}


def test_nothing_to_embed_is_an_error(spark, fresh):
    with pytest.raises(ValueError):
        run(corpus(spark, 0).where("id = 'blank'"), fresh("store"))
    with pytest.raises(ValueError):
        run(corpus(spark, 0).limit(0), fresh("store"))
