"""License scans, secrets, benchmark decontamination."""
from __future__ import annotations

from collections import Counter
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trendloom.llm import decontaminate, licenses, secrets

CLASHING = "doc_id long, text string, source string, digest string, label string, spans string, words int, n_base int"


def docs(spark, rows):
    """Rows of (id, text, source) beside columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, s, "d", "l", "x", 1, 2) for i, t, s in rows], CLASHING)


# Licenses

def scan(spark, *texts, **options):
    rows = licenses.license_scan(docs(spark, [(i, t, "s") for i, t in enumerate(texts)]), **options).collect()
    return [r for r in sorted(rows, key=lambda r: r.doc_id)]


def test_base_phrases_in_any_case_and_spacing(spark):
    a, b, c, d = scan(spark, "Used UNDER the\nMIT-License, under the mit license.", "Apache License, version 2.0",
                      "cc by-nc; xcc by nc", "under the mit licenses")
    assert (a.n_words, a.n_base, a.first_word, a.last_word, a.base_labels) == (9, 2, 1, 5, "mit")
    assert (b.n_base, b.first_word, b.base_labels, b.score) == (1, 0, "apache-2", 1.0)
    assert (c.n_base, c.base_labels) == (1, "cc-by-nc")
    assert (d.n_base, d.first_word, d.base_labels) == (0, None, "")


def test_null_empty_and_foreign_texts(spark):
    for row in scan(spark, None, "", "--- !!", "漢字 é"):
        assert (row.n_base, row.labels, row.score, row.last_word) == (0, "", 0.0, None)
    assert [r.n_words for r in scan(spark, None, "", "--- !!", "漢字 é")] == [0, 0, 0, 2]
    assert licenses.license_scan(docs(spark, []).limit(0)).count() == 0


def test_a_notice_is_found_anywhere_in_a_long_text(spark):
    filler = " ".join(f"w{i}" for i in range(3000))
    for at in (0, 977, 12_000):
        text = filler[:at] + " All rights, reserved " + filler[at:]
        row, = scan(spark, text)
        assert (row.labels, row.n_base) == ("all-rights-reserved", 0)


def test_the_threshold_is_met_exactly(spark):
    words = [f"t{i}" for i in range(10)]
    found = scan(spark, " ".join(words[:9]), " ".join(words[:8]), " ".join(words),
                 templates=(("ten", " ".join(words)),), threshold=(9, 10))
    assert [(r.labels, r.score) for r in found] == [("ten", 0.9), ("", 0.0), ("ten", 1.0)]


def test_license_join_equals_brute_force(spark):
    rng = random.Random(5)
    vocabulary = sorted({w for _, t in licenses.TEMPLATES for w in t.split()}) + ["x", "y"]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 120))) for _ in range(150)]
    found = scan(spark, *texts, threshold=(6, 10))
    for text, row in zip(texts, found):
        words, labels, best = text.split(), set(), 0.0
        for start in range(0, len(words), licenses.STRIDE):
            block = set(words[start:start + 2 * licenses.STRIDE])
            for label, notice in licenses.TEMPLATES:
                wanted = set(notice.split())
                share = len(wanted & block) / len(wanted)
                if 10 * len(wanted & block) >= 6 * len(wanted):
                    labels.add(label)
                    best = max(best, share)
        base = {lb for p, lb in licenses.BASE_PHRASES if f" {p} " in f" {text} "}
        assert set(filter(None, row.labels.split(","))) == labels | base
        assert row.score == (1.0 if base else best)


def test_repeated_rows_and_lost_ids_keep_their_own_row(spark):
    text = "Released under the MIT License."
    rows = licenses.license_scan(docs(spark, [(1, text, "a"), (1, text, "a"), (None, text, None), (1, None, "a")])).collect()
    assert sorted((r.doc_id or 0, r.n_base) for r in rows) == [(0, 1), (1, 0), (1, 1), (1, 1)]


def test_word_characters_are_looked_up_one_by_one(spark):
    """Every character counts as the contract says, and no class holds a range, which costs a call per character."""
    chars = [chr(c) for c in [*range(0x500), 0x2028, 0x3000, 0xD7FF, 0xE000, 0xFFFF, 0x10000, 0x1F600, 0x10FFFF]]
    text = "".join(f"{c}x {c} y{c}\n" for c in chars)
    frame = docs(spark, [(1, text, "s")]).select(licenses.words_of(F.col("text")), licenses.word_count(F.col("text")))
    words, count = frame.collect()[0]
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    assert words == re.findall(licenses.WORD, lowered) and count == len(words)
    assert "-" not in licenses._LETTER + licenses._BETWEEN


# Secrets

def python_spans(text):
    found = []
    assign = re.compile(r"((?:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
    for kind, n, hits in (("assign", 12, [(m, m[2]) for m in assign.finditer(text)]),
                          ("access", 18, [(m, m[0]) for m in re.finditer("AKIA[A-Z0-9]+", text)]),
                          ("hex", 16, [(m, m[0]) for m in re.finditer("[0-9a-f]+", text)])):
        found += [(m.start(), secrets.KINDS.index(kind), f"{kind}:{m.start()}:{m.end()}") for m, v in hits if len(v) >= n]
    return ",".join(s for _, _, s in sorted(found))


PIECES = ["password", "Token", "API_KEY", "apikey", "=", ": ", "'", '"', " ", "\n", "abcdef0123456789", "AKIA", "ABCDEFGH12345678",
          "é", "😀", "secret=abc", "x" * 11, "deadbeef" * 3, ".", "ſecret=", "zQ9" * 9]


def base_of(row):
    return ",".join(s for s in row.spans.split(",") if s and not s.startswith("blob"))


def test_spans_equal_a_plain_search(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choices(PIECES, k=rng.randint(0, 30))) for _ in range(300)]
    texts += ["token=a " * 700 + "token=abcdefghijkl", "", "deadbeef" * 2000]
    rows = secrets.secret_digest(secrets.secret_scan(docs(spark, [(i, t, "s") for i, t in enumerate(texts)]))).collect()
    for row in rows:
        wanted = python_spans(texts[row.doc_id])
        assert base_of(row) == wanted
        assert row.n_assign == wanted.count("assign")


def test_ownership_tells_copies_from_live_values(spark):
    shared, own = "token=sharedvalue1234", "token=ownvalue98765432"
    rows = [(i, f"{shared} {i}", f"s{i}") for i in range(5)] + [(9, own, "s0"), (10, own, "s0"), (11, "token=example12345678", "q")]
    found = {r.doc_id: r for r in secrets.secret_digest(secrets.secret_scan(docs(spark, rows))).collect()}
    assert [(found[i].n_live, found[i].n_copied) for i in (0, 4, 9, 10, 11)] == [(0, 1), (0, 1), (1, 0), (1, 0), (0, 1)]


def test_blobs_are_reported_only_while_they_look_live(spark):
    blob = "Ab3" * 10
    alone = secrets.secret_digest(secrets.secret_scan(docs(spark, [(1, blob, "a")]))).collect()[0]
    many = secrets.secret_digest(secrets.secret_scan(docs(spark, [(i, blob, f"s{i}") for i in range(4)]))).collect()
    assert alone.spans == "blob:0:30" and {r.spans for r in many} == {""}


def test_masking(spark):
    rows = [(1, "é token=abcdefghijkl, end", "a"), (2, None, "a"), (3, "clean", "a"), (4, 'token="0a7b3c9d1e5f2a4b6c8d" x', "b")]
    out = secrets.without_live_secrets(docs(spark, rows))
    assert out.columns == docs(spark, rows).columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: "é [SECRET], end", 2: None, 3: "clean", 4: '[SECRET]" x'}


def test_repositories_of_one_owner_decide_too(spark):
    """Two values of one owner: in as many repositories as an owner may have, and in one more; copies of a row,
    lost ids and a second owner count as they should."""
    most = secrets.REPOSITORIES_PER_OWNER
    kept, spread, shared = ("token=" + f"{word}Q9zX7vK3mB8" for word in ("kept", "spread", "shared"))
    rows = [(i, kept, "a") for i in range(most)] * 2 + [(1000 + i, spread, "a") for i in range(most)] + [(None, spread, "a")]
    rows += [(2000 + i, shared, "a") for i in range(most + 1)] + [(3000, shared, None)]
    found = secrets.secret_digest(secrets.secret_scan(docs(spark, rows))).collect()
    assert {(r.doc_id or 1000) // 1000: (r.n_live, r.n_copied) for r in found} == {0: (1, 0), 1: (0, 1), 2: (1, 0), 3: (1, 0)}
    masked = secrets.without_live_secrets(docs(spark, rows)).groupBy("text").count().collect()
    assert {r.text: r["count"] for r in masked} == {"[SECRET]": 3 * most + 2, spread: most + 1}


def test_secrets_of_odd_rows(spark):
    rows = [(None, "token=abcdefghijkl", None), (1, "token=abcdefghijkl", None), (1, "token=abcdefghijkl", None), (2, None, None)]
    out = secrets.secret_digest(secrets.secret_scan(docs(spark, rows))).collect()
    assert sorted((r.doc_id or 0, r.n_assign) for r in out) == [(0, 1), (1, 1), (1, 1), (2, 0)]
    assert secrets.secret_scan(docs(spark, []).limit(0)).count() == 0


# Decontamination

def edit_distance_anywhere(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


@settings(max_examples=150, deadline=None)
@given(st.text("abc", min_size=1, max_size=70), st.text("abc", max_size=90), st.integers(0, 12))
def test_bit_parallel_distance_equals_the_table(item, text, budget):
    wanted = edit_distance_anywhere(item, text)
    found = decontaminate.myers(decontaminate.letter_masks(item), len(item), text, budget)
    if wanted >= len(item) or wanted > budget:
        assert found is None or found[0] == wanted
    else:
        assert found[0] == wanted
        assert edit_distance_anywhere(item, text[:found[1]]) == wanted


@settings(max_examples=60, deadline=None)
@given(st.text("abcdefgh ", min_size=20, max_size=80), st.integers(0, 2**32), st.integers(0, 12))
def test_every_place_within_the_budget_is_found(item, seed, edits):
    rng = random.Random(seed)
    item = decontaminate.normal(item)
    if not item:
        return
    changed = list(item)
    for _ in range(edits):
        at = rng.randrange(len(changed) + 1)
        rng.choice([lambda: changed.insert(at, "z"), lambda: changed.__setitem__(slice(at, at + 1), "y"),
                    lambda: changed.__delitem__(slice(at, at + 1))])()
    text = decontaminate.normal("".join(rng.choices("ijkl ", k=200)) + "".join(changed) + "".join(rng.choices("ijkl ", k=200)))
    distance, budget = edit_distance_anywhere(item, text), int(0.1 * len(item))
    found = decontaminate.Matcher([(7, item)], 0.1).find(text)
    assert bool(found) == (distance <= budget)
    if found:
        assert found[0][:2] == (7, distance)
        assert edit_distance_anywhere(item, text[found[0][2]:found[0][3]]) == distance


def test_leaks_and_filter(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choices("aeioutnrs", k=6))
    passages = [" ".join(word() for _ in range(30)) for _ in range(4)]
    changed = passages[1].replace(passages[1][20:24], "QQ")
    rows = [(1, "x " + passages[0].upper().replace(" ", ",\n") + " y", "s"), (2, changed, "s"), (3, None, "s"), (4, "", "s"),
            (5, " ".join(word() for _ in range(4000)), "s"), (None, passages[2], "s"), (1, passages[0], "s"), (6, passages[3][:80], "s")]
    items = spark.createDataFrame([*enumerate(passages), (9, None), (10, " .. "), (0, passages[0])], "item_id long, text string")
    for block_chars in (1_000_000, 150):
        found = decontaminate.benchmark_leaks(docs(spark, rows), items, block_chars=block_chars).collect()
        assert sorted((r.id if "id" in r else r.doc_id or 0, r.item_id) for r in found) == [(0, 2), (1, 0), (1, 0), (2, 1)]
        kept = decontaminate.without_leaks(docs(spark, rows), items, block_chars=block_chars)
        assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6] and kept.columns == docs(spark, rows).columns
    assert decontaminate.benchmark_leaks(docs(spark, rows), items.limit(0)).count() == 0
    assert decontaminate.benchmark_leaks(docs(spark, []).limit(0), items).count() == 0
    assert decontaminate.without_leaks(docs(spark, rows), items.limit(0)).count() == len(rows)


@pytest.mark.parametrize("text", ["", None, "  "])
def test_no_items_or_no_text_find_nothing(text):
    assert decontaminate.Matcher([]).find("abc") == []
    assert decontaminate.Matcher([(1, "some item here")]).find(decontaminate.normal(text)) == []


def test_items_are_told_apart_by_id_and_text_in_any_block(spark):
    first, second = "the quick brown fox jumps over a lazy dog today", "seven more wizards quietly vex the big judge now"
    items = spark.createDataFrame([(None, first), (None, second), (4, first), (4, second), (4, first), (None, first.upper()), (9, None)],
                                  "item_id long, text string")
    texts = spark.createDataFrame([(1, f"{first} and {second}"), (2, second), (3, "nothing"), (None, first)], "doc_id long, text string")
    results = [Counter(tuple(r) for r in decontaminate.benchmark_leaks(texts, items, block_chars=n).collect())
               for n in (1_000_000, 100, 10, 1)]
    assert results[0] == results[1] == results[2] == results[3]
    assert sum(results[0].values()) == 5 + 2 + 3
    kept = [sorted(r.doc_id for r in decontaminate.without_leaks(texts, items, block_chars=n).collect()) for n in (1_000_000, 10)]
    assert kept == [[3], [3]]
