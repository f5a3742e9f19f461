from __future__ import annotations

import pytest
from helpers import works
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trendloom.operators import embed


def factory(log):
    """An encoder that notes every text and every load in files under ``log``."""
    def load():
        import os
        import uuid
        open(os.path.join(log, f"load-{uuid.uuid4().hex}"), "w").close()

        def encode(texts):
            with open(os.path.join(log, f"call-{uuid.uuid4().hex}"), "w") as f:
                f.write("\n".join(texts))
            return [[float(len(t)), 1.0] for t in texts]
        return encode
    return load


@pytest.fixture
def log(tmp_path):
    folder = tmp_path / "log"
    folder.mkdir()
    return folder


def encoded(log):
    return sorted(t for f in log.glob("call-*") for t in f.read_text().split("\n"))


def corpus(spark, n, suffix=""):
    return works(spark, [dict(id=f"W{i}", title=f"t{i}", abstract=f"abstract {i}{suffix}",
                              language="en") for i in range(1, n + 1)])


BLANKS = st.text(st.sampled_from(" \t\n\u3000"), max_size=3)
INNER = st.text(st.characters(codec="utf-8", exclude_categories=["Z", "C"]), min_size=1, max_size=8)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.none() | st.builds("".join, st.tuples(BLANKS, INNER, BLANKS)),
                          st.builds("".join, st.tuples(BLANKS, INNER, BLANKS, INNER, BLANKS))),
                min_size=10, max_size=30), st.sampled_from([embed.SEPARATOR, " | "]))
def test_input_text_is_both_parts_stripped(spark, rows, separator):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, t string, a string")
    made = df.orderBy("i").select(embed.input_text(F.col("t"), F.col("a"), separator)).collect()
    assert [r[0] for r in made] == [(t or "").strip() + separator + a.strip() for t, a in rows]


def test_each_text_is_encoded_once_and_a_rerun_encodes_nothing(spark, log, fresh):
    path, w = fresh("emb"), corpus(spark, 5)
    assert embed.embed_corpus(w, path, factory(str(log)), "m", 2, chunk_size=2) == 5
    assert len(encoded(log)) == 5 == len(set(encoded(log)))
    loads = len(list(log.glob("load-*")))
    assert embed.embed_corpus(w, path, factory(str(log)), "m", 2) == 5
    assert len(encoded(log)) == 5 and len(list(log.glob("load-*"))) == loads


def test_only_missing_texts_are_encoded(spark, log, fresh):
    path = fresh("emb")
    embed.embed_corpus(corpus(spark, 2), path, factory(str(log)), "m", 2)
    assert embed.embed_corpus(corpus(spark, 4), path, factory(str(log)), "m", 2,
                              waves=[F.col("id") == "W3"]) == 4
    assert encoded(log) == [f"t{i}[SEP]abstract {i}" for i in range(1, 5)]


def test_changed_text_or_model_is_encoded_again(spark, log, fresh):
    path = fresh("emb")
    embed.embed_corpus(corpus(spark, 2), path, factory(str(log)), "m", 2)
    assert embed.embed_corpus(corpus(spark, 2, "!"), path, factory(str(log)), "m", 2) == 2
    assert embed.embed_corpus(corpus(spark, 2), path, factory(str(log)), "other", 2) == 2
    assert len(encoded(log)) == 6


def test_one_load_per_worker_over_all_waves(spark, log, fresh):
    waves = [F.col("id") == f"W{i}" for i in range(1, 5)]
    embed.embed_corpus(corpus(spark, 8).repartition(1), fresh("emb"), pid_factory(str(log)), "m", 2, waves=waves)
    loads = [f.name.split("-")[1] for f in log.glob("load-*")]
    assert len(loads) == len(set(loads)) > 0


def pid_factory(log):
    """An encoder that notes the process of every load."""
    def load():
        import os
        import uuid
        open(os.path.join(log, f"load-{os.getpid()}-{uuid.uuid4().hex}"), "w").close()
        return lambda texts: [[float(len(t)), 1.0] for t in texts]
    return load


def test_current_vectors_are_those_of_the_present_text(spark, log, fresh):
    path = fresh("emb")
    embed.embed_corpus(corpus(spark, 3), path, factory(str(log)), "m", 2)
    now = corpus(spark, 3, "!")
    embed.embed_corpus(now, path, factory(str(log)), "m", 2)
    stored = embed.stored_embeddings(spark, path)
    assert stored.count() == 6
    assert sorted(r.id for r in embed.current_embeddings(now, stored, "m").collect()) == ["W1", "W2", "W3"]


def test_texts_are_not_shuffled_to_find_what_is_missing(spark, log, fresh):
    path = fresh("emb")
    embed.embed_corpus(corpus(spark, 3), path, factory(str(log)), "m", 2)
    pending = embed.pending_inputs(corpus(spark, 4), embed.stored_embeddings(spark, path), "m")
    assert pending.count() == 1
    plan = pending._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_nothing_to_embed_is_an_error(spark, log, fresh):
    w = works(spark, [dict(id="1", abstract=" ", language="en"), dict(id="2", abstract="x", language="ru")])
    with pytest.raises(ValueError):
        embed.embed_corpus(w, fresh("emb"), factory(str(log)), "m", 2)


def test_vectors_follow_their_ids_and_have_unit_length(spark, log):
    texts = spark.createDataFrame([(str(i), "x" * i) for i in range(1, 80)], "id string, text string")
    rows = embed.embed(texts.repartition(3), factory(str(log)), 2, batch_size=7).collect()
    assert len(rows) == 79
    for r in rows:
        n = int(r.id)
        norm = (n * n + 1) ** 0.5
        assert r.embedding == pytest.approx([n / norm, 1 / norm], rel=1e-6)
    assert max(len(f.read_text().split("\n")) for f in log.glob("call-*")) <= 7


def test_wrong_dimension_is_an_error(spark, log):
    texts = spark.createDataFrame([("1", "x")], "id string, text string")
    with pytest.raises(Exception, match="expected"):
        embed.embed(texts, factory(str(log)), 3).collect()


def test_unit_length_leaves_zero_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "embedding array<float>")
    got = [r.embedding for r in embed.l2_normalize(df).collect()]
    assert got[0] == pytest.approx([0.6, 0.8]) and got[1] == [0.0, 0.0]
