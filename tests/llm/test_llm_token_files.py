from __future__ import annotations

import random
import zlib
from array import array

import public_tokenizers
import pyarrow.orc
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trendloom.llm import token_files

ODD = ["", " ", "  a  b ", "a\n b\n\nc \n d", "it's I'LL we've 12３½ x_y", "<|endoftext|>", "x  <|endoftext|>  y", "日本語 text　x",
       "😀👍🏽 ok", "\x00\x85a\xa0b\x1c c\x1f", "İstanbul ΣΑΣ é ﬁ Å", "word... and, more!? (yes);no", "᠎​﻿ x",
       "tab\tsep  \t x", "á" * 50, "ab" * 4000, "word " * 5000, " " * 3000 + "end", "Ⅷ Ⅸ ²x x²", "end  "]


@pytest.fixture(scope="module")
def vocabulary():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return f.read()


@pytest.fixture(scope="module")
def library(vocabulary):
    return Tokenizer.from_str(vocabulary)


@pytest.fixture(scope="module")
def own(vocabulary):
    return token_files.ChunkEncoder(vocabulary)


def wanted(library, text):
    return library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ODD)
def test_odd_texts_as_the_library_encodes_them(library, own, text):
    assert array("I", own.encode([text])[0]).tolist() == wanted(library, text)


@settings(max_examples=500, deadline=None)
@given(st.one_of(st.text(st.characters(max_codepoint=0x3FFF, exclude_categories=["Cs", "Cn"]), max_size=60),
                 st.text(st.sampled_from("aé'sbT .,!?\n\t \x1c\x85_1<|>"), max_size=40)))
def test_any_text_as_the_library_encodes_it(library, own, text):
    assert array("I", own.encode([text])[0]).tolist() == wanted(library, text)


def test_small_memory_changes_nothing(library, vocabulary, monkeypatch):
    monkeypatch.setattr(token_files, "KEEP_CHUNKS", 2)
    own = token_files.ChunkEncoder(vocabulary)
    for text in ("one, two three two one, four", "five two one two, one one."):
        assert array("I", own.encode([text])[0]).tolist() == wanted(library, text)


def test_many_texts_at_once(library, own):
    assert [array("I", x).tolist() for x in own.encode(ODD * 2)] == [wanted(library, t) for t in ODD * 2]


def test_a_batch_looks_each_chunk_up_once(library, vocabulary, monkeypatch):
    """Regular texts share their look-ups, however often and wherever a chunk stands."""
    own, asked = token_files.ChunkEncoder(vocabulary), []
    look_up = token_files._Memory.all
    monkeypatch.setattr(token_files._Memory, "all", lambda self, chunks: asked.extend(chunks) or look_up(self, chunks))
    texts = ["été one two\none one\nété.", "two one\nété. two", "", "  one  two ", "one"]
    assert [array("I", x).tolist() for x in own.encode(texts)] == [wanted(library, t) for t in texts]
    regular = asked[-7:] if len(asked) > 7 else asked
    assert len(regular) == len(set(regular)) and "one" in regular and "\nété." in regular


def test_column_of_ids(spark, library, vocabulary, monkeypatch):
    monkeypatch.setattr(token_files, "_BATCH_CHARS", 50)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)] + [(None, None)], "doc_id long, text string")
    for r in token_files.encoded(docs.coalesce(1), vocabulary).collect():
        assert r["ids"] == wanted(library, "" if r["doc_id"] is None else ODD[r["doc_id"]]) + [2]


def rows_of(n, seed):
    draw = random.Random(seed)
    words = ["the", "of", "Étude", "x1", "naïve", "rest", "çoi", "end."]
    return [(i, " ".join(draw.choices(words, k=draw.choice([0, 3, 40, 900]))), "x", i) for i in draw.sample(range(3 * n), n)]


SCHEMA = "doc_id long, text string, ids string, part long"


def expected(library, rows):
    encoded = [(d is not None, d or 0, wanted(library, t or "") + [2]) for d, t, *_ in rows]
    out, at = [], 0
    for known, d, ids in sorted(encoded, key=lambda r: r[:2]):
        out.append((d if known else None, at, len(ids), zlib.crc32(array("I", ids).tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize("parts", [1, 6])
def test_round_trip(spark, fresh, library, vocabulary, parts):
    rows = rows_of(300, parts) + [(100_000 + i, t, None, i) for i, t in enumerate(ODD)] + [(99_999, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    token_files.write_tokens(docs, fresh("t"), vocabulary)
    out = token_files.token_digests(spark, fresh("t"))
    assert [f.dataType.simpleString() for f in out.schema] == ["bigint"] * 4
    assert sorted(map(tuple, out.collect())) == expected(library, rows)
    ids = {r["doc_id"]: r["ids"] for r in token_files.read_tokens(spark, fresh("t")).collect()}
    assert all(ids[d] == wanted(library, t or "") + [2] for d, t, *_ in rows)


def test_repeated_and_missing_ids_are_gapless(spark, fresh, library, vocabulary):
    rows = [(5, "same text", None, 0)] * 200 + [(5, "other", None, 0), (None, "no id", None, 0), (None, None, None, 0), (1, "a", None, 0)]
    token_files.write_tokens(spark.createDataFrame(rows, SCHEMA).repartition(7), fresh("t"), vocabulary)
    out = sorted(map(tuple, token_files.token_digests(spark, fresh("t")).collect()), key=lambda r: r[1])
    assert [r[1] for r in out] == [sum(x[2] for x in out[:i]) for i in range(len(out))]
    assert [r[0] for r in out] == [None, None, 1] + [5] * 201
    assert sorted(r[2:] for r in out) == sorted(r[2:] for r in expected(library, rows))


def test_no_rows(spark, fresh, vocabulary):
    token_files.write_tokens(spark.createDataFrame([], SCHEMA), fresh("t"), vocabulary)
    assert token_files.token_digests(spark, fresh("t")).collect() == []
    assert token_files.read_span(spark, fresh("t"), 0, 10).collect() == []


def rows_scanned(df):
    """Rows that left the scan of the token files."""
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if plan.nodeName().startswith("Adaptive") else plan
    leaves = plan.collectLeaves()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        while leaf.nodeName().endswith("QueryStage"):
            leaf = leaf.plan().collectLeaves().apply(0)
        if "orc" in leaf.nodeName().lower():
            return leaf.metrics().apply("numOutputRows").value()
    raise AssertionError("no scan")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory, vocabulary):
    """Even ids only, in row groups of 100 documents."""
    path = str(tmp_path_factory.mktemp("orc") / "t")
    docs = spark.range(4000).select((F.col("id") * 2).alias("doc_id"), F.concat_ws(" ", F.lit("document"), "id").alias("text"))
    token_files.write_tokens(docs, path, vocabulary, stride=1000, stripe_bytes=1 << 14)
    return path


def test_documents_are_found_by_metadata(spark, stored):
    assert [r["doc_id"] for r in token_files.read_documents(spark, stored, [3002]).collect()] == [3002]
    rows = spark.read.orc(f"{stored}/tokens")
    assert rows_scanned(rows.where("doc_id = 3002")) <= 1000
    assert rows_scanned(rows.where("doc_id = 3001")) == 0             # within the range of ids, told by the Bloom filter


def test_spans_read_their_row_groups(spark, stored):
    whole = sorted(token_files.read_tokens(spark, stored).select("start", "n_tokens", "doc_id").collect())
    total = whole[-1][0] + whole[-1][1]
    for start, stop in ((0, 1), (0, total), (total // 3, total // 3 + 50), (total - 1, total), (total, total + 5), (7, 7)):
        span = token_files.read_span(spark, stored, start, stop)
        got = sorted(span.select("start", "n_tokens", "doc_id").collect())
        assert got == [r for r in whole if r[0] < stop and r[0] + r[1] > start and start < stop]
    assert rows_scanned(token_files.read_span(spark, stored, 0, 10)) < 4000


def test_files_hold_stripes(spark, stored, fresh):
    import glob
    files = [pyarrow.orc.ORCFile(f) for f in glob.glob(f"{stored}/tokens/*.orc")]
    assert sum(f.nrows for f in files) == 4000 and sum(f.nstripes for f in files) > len(files)
