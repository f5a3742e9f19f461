from __future__ import annotations

import textwrap

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from contract.views import inverted_index
from trendloom.functions import arrays, numbers, text

SLOW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
WORDS = st.sampled_from(["well-known", "a", "x--y", "hello", "co-op", "Ünï", "\n", "  ", " ",
                         "\x1f", "state-of-the-art", "long" * 30, "it's", "\xa0", "　"])


def one(spark, schema, row, expr):
    return spark.createDataFrame([row], schema).select(expr.alias("v")).collect()[0]["v"]


def restored(spark, index):
    return one(spark, "m map<string,array<int>>", (index,), text.restore_text(F.col("m")))


@SLOW
@given(st.lists(st.text("abcdeü'-", min_size=1, max_size=4), min_size=1, max_size=60), st.randoms())
def test_any_word_order_comes_back(spark, words, random):
    places = {}
    for i, w in enumerate(words):
        places.setdefault(w, []).append(i)
    keys = list(places)
    random.shuffle(keys)
    index = {k: random.sample(places[k], len(places[k])) for k in keys}
    assert restored(spark, index) == " ".join(words)


@pytest.mark.parametrize("index", [None, {}, {"a": []}])
def test_no_positions_give_null(spark, index):
    assert restored(spark, index) is None


@SLOW
@given(st.lists(st.integers(0, 10_000), min_size=1, max_size=30, unique=True))
def test_holes_between_positions_close_up(spark, positions):
    index = {f"w{p}": [p] for p in positions}
    assert restored(spark, index) == " ".join(f"w{p}" for p in sorted(positions))


def test_later_word_wins_a_clashing_position(spark):
    raw = spark.createDataFrame([('{"a":[0,1],"b":[1]}', '{"b":[1],"a":[0,1]}')], "x string, y string")
    index = [F.from_json(c, "map<string,array<int>>") for c in ("x", "y")]
    row = raw.select(*[text.restore_text(i) for i in index]).collect()[0]
    assert tuple(row) == ("a b", "a a")


def test_text_to_index_to_text_round_trip(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    same = docs.select(
        text.restore_text(inverted_index(F.col("text"))) == text.collapse(F.col("text")))
    assert {r[0] for r in same.collect()} == {True}


def test_whitespace_set_is_complete():
    assert set(text.WHITESPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


@SLOW
@given(st.lists(st.lists(WORDS, max_size=40).map(" ".join), min_size=20, max_size=60))
def test_strip_collapse_and_shorten_behave_like_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    t = F.col("t")
    rows = df.select(t, text.strip(t), text.collapse(t), text.shorten(t, 20),
                     text.shorten(t, 88)).collect()
    for raw, strip, collapse, short, longer in rows:
        assert strip == raw.strip()
        assert collapse == " ".join(raw.split())
        assert short == textwrap.shorten(raw, 20)
        assert longer == textwrap.shorten(raw, 88)


@SLOW
@given(st.lists(st.one_of(
    st.floats(0, 1e6), st.integers(0, 4000).map(lambda k: k / 20),
    st.integers(0, 4000).map(lambda k: k / 2000)), min_size=50, max_size=200))
def test_rounding_and_sums_behave_like_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    rows = df.select("x", *[numbers.round_exact(F.col("x"), d) for d in (0, 1, 2, 3)]).collect()
    for x, *rounded in rows:
        assert rounded == [float(round(x, d)) for d in (0, 1, 2, 3)]
    total = one(spark, "a array<double>", (values,), arrays.exact_sum(F.col("a")))
    assert total == sum(values)


@pytest.mark.parametrize("x, digits, expected", [(2.675, 2, 2.67), (2.5, 0, 2), (0.25, 1, 0.2),
                                                 (1.15, 1, 1.1), (-2.5, 0, -2.0)])
def test_rounding_at_ties(spark, x, digits, expected):
    assert one(spark, "x double", (x,), numbers.round_exact(F.col("x"), digits)) == expected


@pytest.mark.parametrize("url, expected", [
    ("https://x.org/W1", "W1"), ("W1", "W1"), ("", None), (None, None), ("a/", "")])
def test_short_id(spark, url, expected):
    assert one(spark, "u string", (url,), text.short_id(F.col("u"))) == expected


HOSTS = st.sampled_from(["https://arxiv.org/abs/", "http://ARXIV.org/pdf/", "arXiv: ", "arxiv.org/abs/"])
NEW_STYLE = st.builds("{:04d}.{:05d}".format, st.integers(701, 9912), st.integers(1, 99999))
OTHER = st.sampled_from([None, "", "https://doi.org/10.1/x", "https://example.org/abs/1"])


def link_ids(spark, rows, **options):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                               "n int, i map<string,string>, l string, p string").orderBy("n")
    return [r[0] for r in df.select(text.link_id(*[F.col(c) for c in "ilp"], **options)).collect()]


@SLOW
@given(st.lists(st.tuples(HOSTS, NEW_STYLE, st.integers(0, 2), OTHER), min_size=5, max_size=20))
def test_the_id_is_found_wherever_the_link_stands(spark, cases):
    rows = []
    for host, number, place, other in cases:
        link = host + number
        rows.append(({"a": other, "b": link} if place == 0 else None, link if place == 1 else other,
                     link + ".pdf" if place == 2 else other))
    wanted = [number for _, number, _, _ in cases]
    assert link_ids(spark, rows) == wanted
    assert link_ids(spark, rows, old_style_ids=True) == wanted


@SLOW
@given(st.lists(st.tuples(OTHER, OTHER), min_size=5, max_size=20))
def test_other_links_give_no_id(spark, cases):
    rows = [({"a": a}, a, b) for a, b in cases]
    assert set(link_ids(spark, rows)) == {None} == set(link_ids(spark, rows, old_style_ids=True))


@SLOW
@given(st.lists(st.tuples(st.sampled_from(["hep-th", "cs"]), st.integers(1_000_000, 9_999_999),
                          NEW_STYLE, st.integers(1, 9)), min_size=3, max_size=10))
def test_old_style_and_versioned_ids_are_an_option(spark, cases):
    old = [(None, f"https://arxiv.org/abs/{group}/{n}", None) for group, n, _, _ in cases]
    versioned = [(None, f"https://arxiv.org/abs/{number}v{v}", None) for _, _, number, v in cases]
    doi = [(None, f"https://doi.org/10.48550/arxiv.{number}", None) for _, _, number, _ in cases]
    assert link_ids(spark, old, old_style_ids=True) == [f"{group}/{n}" for group, n, _, _ in cases]
    assert link_ids(spark, old) == [group for group, _, _, _ in cases]
    assert link_ids(spark, versioned, old_style_ids=True) == [number for _, _, number, _ in cases]
    assert link_ids(spark, versioned) == [f"{number}v{v}" for _, _, number, v in cases]
    assert link_ids(spark, doi, old_style_ids=True) == [number for _, _, number, _ in cases]
    assert set(link_ids(spark, doi)) == {None}
