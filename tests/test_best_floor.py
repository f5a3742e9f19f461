"""The floor of the best works: what is sorted is a handful, and the lists stay the same."""
from __future__ import annotations

import random

from helpers import topic, works

from trendloom.plans import trends


def test_best_works_sort_a_handful_and_match_brute_force(spark):
    rnd = random.Random(3)
    rows = [{"id": f"W{i % 2990}" if i % 97 else None, "title": f"t{i}", "publication_year": 2001,
             "cited_by_count": rnd.choice([None, *range(40 if i % 3 else 100_000)]), "primary_topic": topic(f"T{i % 3}")}
            for i in range(3000)] + [{"id": f"S{i}", "publication_year": 2001, "cited_by_count": i, "primary_topic": topic("few")} for i in range(3)]
    df = works(spark, rows)
    floors = {r.topic_id: r.floor for r in trends.best_floor(df).collect()}
    assert set(floors) == {"T0", "T1", "T2"}
    best = trends.topic_best_works(df).collect()
    for tid in ("T0", "T1", "T2", "few"):
        cited = sorted((r["cited_by_count"] or 0 for r in rows if r["primary_topic"][0] == tid), reverse=True)
        got = sorted((r["rank"], r["cited_by"]) for r in best if r["topic_id"] == tid)
        assert [c for _, c in got] == cited[:6]
        if tid in floors:
            assert floors[tid] <= cited[5] and sum(c >= floors[tid] for c in cited) < len(cited) / 10
