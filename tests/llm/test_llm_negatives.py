from __future__ import annotations

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trendloom.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, id string, score string"


def quantised(vector):
    return [math.floor(256 * float(x)) for x in vector]


def takes_part(row):
    return row[2] is not None and row[1] is not None and all(x is not None and math.isfinite(x) for x in row[1]) \
        and sum(x * x for x in quantised(row[1])) < 2 ** 62


def plain(rows, every=100, positives=5, k=5):
    """All scores in Python integers, sorted and cut."""
    used = []
    for row in filter(takes_part, rows):
        label = (row[2] + 1) % 10 if row[0] is not None and row[0] % 7 == 0 else row[2]
        used.append((row[0], label, quantised(row[1])))
    anchors = {(i, l, tuple(v)) for i, l, v in used if i is not None and i % every == 0}
    out = []
    for aid, alabel, av in anchors:
        scored = [(-sum(x * y for x, y in zip(av, v)), i is None, i or 0, l) for i, l, v in used
                  if len(v) == len(av) and i != aid]
        scored.sort()
        for ps, pnull, pid, _ in [x for x in scored if x[3] == alabel][:positives]:
            found = [x for x in scored if x[3] != alabel and 80 * -ps <= 100 * -x[0] <= 100 * -ps][:k]
            out += [(aid, None if pnull else pid, n + 1, None if x[1] else x[2], -ps, -x[0]) for n, x in enumerate(found)]
    return sorted(out, key=repr)


def mined(spark, rows, every=100, **more):
    df = spark.createDataFrame([(*r, "x", None) for r in rows], SCHEMA)
    out = negatives.hard_negatives(df, F.col("id") % every == 0, label=negatives.mined_label(), **more)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, out.collect()), key=repr)


def vectors(n, d, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(10, d))
    return [[float(np.float32(x)) for x in centres[i % 10] * 0.3 + rng.normal(size=d) * 0.1 * spread] for i in range(n)]


def test_as_brute_force_in_many_small_waves(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ROWS", 64)
    rows = [(i, v, random.Random(i).randrange(10)) for i, v in enumerate(vectors(700, 20, 3))]
    wanted = plain(rows, every=20)
    assert len(wanted) > 300
    assert mined(spark, rows, every=20, wave=200) == wanted
    assert mined(spark, rows, every=20) == wanted


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    base = vectors(60, 4, 5)
    rows = [(i, v, i % 2) for i, v in enumerate(base)]
    rows += [(100, base[0], 0), (100, base[0], 0), (100, base[1], 1), (200, base[2], 0)]       # repeated anchors
    rows += [(7, base[0], 0), (7, base[0], 0), (None, base[0], 1), (None, base[0], 0)]         # repeats, no id
    rows += [(300, None, 1), (301, [1.0, None, 0.0, 0.0], 1), (302, [nan] * 4, 0), (303, [inf] * 4, 1),
             (304, base[3], None), (400, [], 0), (401, [], 1), (402, [], 0), (500, [0.5], 1), (501, [0.5], 1), (502, [0.5], 0)]
    rows += [(600, [4e6, 1e6, -3e6, 2e6], 0), (601, [4e6, 1e6, -3e6, 2e6], 0), (602, [4e6, 1e6, -3e6, 1e6], 1),
             (603, [3e38] * 4, 1), (-100, base[4], 1)]
    wanted = plain(rows)
    assert {r[0] for r in wanted} >= {0, 100, 400, 500, 600, -100}
    assert mined(spark, rows) == wanted


def test_ties_go_to_the_smaller_id(spark):
    rows = [(i, [1.0, 0.0], 1 if i % 3 else 2) for i in range(1, 40)] + [(100, [1.0, 0.0], 2)]
    assert mined(spark, rows) == plain(rows) != []


def test_no_rows(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(5, [1.0], 1)]) == []
    assert mined(spark, [(100, [1.0], 1)]) == []


def test_one_label_holds_nearly_all(spark):
    rows = [(i, v, 3 if i % 50 else 4) for i, v in enumerate(vectors(600, 8, 9))]
    assert mined(spark, rows) == plain(rows) != []


def test_partitioning_changes_nothing(spark):
    rows = [(i, v, i % 10) for i, v in enumerate(vectors(400, 8, 2))]
    df = spark.createDataFrame([(*r, "x", None) for r in rows], SCHEMA)
    results = [sorted(map(tuple, negatives.hard_negatives(df.repartition(n), F.col("id") % 100 == 0).collect()))
               for n in (1, 7)]
    assert results[0] == results[1] != []


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 150), st.integers(1, 5), st.integers(1, 5), st.integers(0, 24), st.integers(0, 1 << 30))
def test_scores_are_exact(d, n, m, bits, seed):
    rng = np.random.default_rng(seed)
    top = min(1 << bits, math.isqrt((1 << 62) // max(1, d)) - 1)

    def block(k):
        return negatives.Block(*[np.zeros(k, np.int64)] * 4, rng.integers(-top, top + 1, (k, d)).astype(np.float64))
    a, b = block(n), block(m)
    exact = [[sum(int(x) * int(y) for x, y in zip(u, v)) for v in b.vectors] for u in a.vectors]
    assert negatives.scores(a, b).tolist() == exact


@pytest.mark.parametrize("bits", [10, 31, 45, 61])
def test_enough_primes_at_the_bound(bits):
    chosen = negatives.moduli(1 << bits)
    assert math.prod(chosen) > 2 << bits and math.prod(chosen[:-1]) <= 2 << bits
    assert all(negatives.WIDTH * (p // 2) ** 2 <= 1 << 24 for p in chosen)


@settings(max_examples=200, deadline=None)
@given(st.integers(-(1 << 62), 1 << 62), st.integers(0, 100))
def test_window_floor(score, low):
    n = int(negatives.window_floor(np.array([score]), low)[0])
    assert low * score <= 100 * n and low * score > 100 * (n - 1)
