from __future__ import annotations

import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trendloom.llm import bpe
from trendloom.llm.queries import vocabulary

ODD = ["", "  ", "a<|endoftext|>b", "İstanbul ΣΑΣ é \x1c x\x1dy", "it's I'LL 12３½ ²", "日本語 text　x",
       "😀👍🏽 ok", "<|startoftext|> <|endoftext|", "\x00\x85a\xa0b", "ﬁ Å Å", "'s't' x's ...'s",
       "​﻿a", "ab" * 3000, "word " * 5000, "á" * 50]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def own():
    with open(vocabulary(), encoding="utf-8") as f:
        return bpe.WordBpe.from_json(f.read())


def same(library, own, text):
    wanted = library.encode(text, add_special_tokens=False).ids
    ids = own.encode(text).tolist()
    assert ids == wanted
    assert own.decode(ids) == library.decode(wanted, skip_special_tokens=False)


@pytest.mark.parametrize("text", ODD)
def test_odd_texts_as_the_library_encodes_them(library, own, text):
    same(library, own, text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(max_codepoint=0x2FFF, exclude_categories=["Cs", "Cn"]), max_size=60))
def test_any_text_as_the_library_encodes_it(library, own, text):
    same(library, own, text)


def test_small_cache_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "KEEP_CHUNKS", 2)
    with open(vocabulary(), encoding="utf-8") as f:
        own = bpe.WordBpe.from_json(f.read())
    for text in ("one, two three two one, four", "five two one two, one one"):
        same(library, own, text)


def test_columns(spark, library):
    rows = [(1, t, "x") for t in ODD if "<|" not in t] + [(None, None, None), (1, "", "y"), (1, "", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    out = bpe.bpe_digests(docs, vocabulary()).collect()
    assert len(out) == len(rows) and set(out[0].asDict()) == {
        "doc_id", "text", "n_tokens", "ids_sha256", "decoded_sha256"}
    for row in out:
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        data = b"".join(i.to_bytes(4, "little") for i in ids)
        assert row.ids_sha256 == hashlib.sha256(data).hexdigest()
    assert bpe.bpe_digests(docs.limit(0), vocabulary()).count() == 0


def test_encode_then_decode(spark):
    docs = spark.createDataFrame([("Hello, World 42",), (None,)], "text string")
    ids = docs.select(bpe.bpe_encode(F.col("text"), vocabulary()).alias("ids"))
    back = [r[0] for r in ids.select(bpe.bpe_decode(F.col("ids"), vocabulary())).collect()]
    assert back == ["hello</w> ,</w> world</w> 4</w> 2</w>", ""]
