from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from helpers import topic, works
from pyspark.sql import functions as F

from trendloom.operators.filters import SliceSpec
from trendloom.plans import reports, trends


def metric(spark, values, column):
    df = spark.createDataFrame([([float(v) for v in values],)], "v array<double>")
    return df.select(column(F.col("v"))).collect()[0][0]


@pytest.mark.parametrize("values, growth, acceleration", [
    ([1, 1, 2, 4], 3.0, (6 / 1) / (1 / 1)),
    ([1, 1, 1, 3, 5], 4.5, ((1 + 3 + 5) / 1) / (1 / 1)),
    ([2], 200.0, (0 / 0.01) / (0.01 / 2)),
    ([1, 3], 3.0, (0 / 3) / (3 / 1)),
    ([0, 0, 5, 5], 1000.0, (10 / 0.01) / (0.01 / 0.01)),
    ([4, 4, 0, 0, 8, 8], 2.0, (16 / 0.01) / (0.01 / 8)),
    ([1, 2, 3, 4, 5, 6], 2.5, (11 / 7) / (7 / 3)),
])
def test_growth_and_acceleration_by_hand(spark, values, growth, acceleration):
    assert metric(spark, values, trends.growth_of) == pytest.approx(growth, rel=1e-12)
    assert metric(spark, values, trends.acceleration_of) == pytest.approx(acceleration, rel=1e-12)


def test_raw_growth_replaces_an_empty_start_by_one(spark):
    assert metric(spark, [0, 0, 3, 4], lambda v: trends.growth_of(v, 1.0)) == 7.0


def corpus(seed=1, n=4000):
    rnd, rows = random.Random(seed), []
    for i in range(n):
        tid = f"https://o/T{min(rnd.randrange(12), rnd.randrange(12))}"
        rows.append(dict(
            id=f"W{i:05d}", title=None if i % 97 == 0 else f"title {i}", doi=rnd.choice([None, "", f"d{i}"]),
            publication_year=rnd.choice([2015, 2016, 2017, 2018, 2019, 2019, 2020, 2021, 2021]),
            primary_topic=None if i % 50 == 0 else topic(tid, f"name {tid[-2:]}"),
            institution_names=[rnd.choice(["A", "B", "C", "", None, "D"]) for _ in range(rnd.randrange(4))],
            institution_countries=[rnd.choice(["RU", "US", None]) for _ in range(rnd.randrange(3))],
            cited_by_count=rnd.randrange(50), venue="v"))
    return rows


def half_split(values, cuts):
    return [sum(values[a:b]) for a, b in zip(cuts, cuts[1:])]


def brute_cards(rows, min_works, top):
    """The card metrics counted with dictionaries."""
    base, per, names = Counter(), defaultdict(Counter), {}
    orgs, lands, best = defaultdict(Counter), defaultdict(Counter), defaultdict(list)
    for r in rows:
        if not r["primary_topic"]:
            continue
        tid, year = r["primary_topic"][0], r["publication_year"]
        base[year] += 1
        per[tid][year] += 1
        names[tid] = r["primary_topic"][1]
        orgs[tid].update(x for x in r["institution_names"] if x)
        lands[tid].update(x for x in r["institution_countries"] if x)
        best[tid].append((-r["cited_by_count"], r["id"], r["title"]))
    years, cards = sorted(base), []
    for tid, counts in per.items():
        if sum(counts.values()) < min_works:
            continue
        p = [round(counts[y] / base[y] * 10_000, 1) for y in years]
        n, third = len(p), max(1, len(p) // 3)
        early, late = half_split(p, [0, n // 2, n])
        p1, p2, p3 = half_split(p, [0, third, 2 * third, n])
        growth = late / (early or 0.01)
        ordered = sorted(best[tid])
        cards.append((round(growth, 2), tid, dict(
            id=tid.split("/")[-1], title=names[tid], works=sum(counts.values()),
            first=min(counts), acceleration=round((p3 / (p2 or 0.01)) / ((p2 or 0.01) / (p1 or 0.01)), 2),
            score=round(min(growth / 3, 1.0), 3), orgs=len(orgs[tid]), lands=len(lands[tid]),
            top=[x for x, _ in sorted(orgs[tid].items(), key=lambda kv: (-kv[1], kv[0]))][:5],
            case=ordered[0][2], sources=[t for _, _, t in ordered[1:6]], shares=p)))
    cards.sort(key=lambda c: (-c[0], c[1]))
    return [(i + 1, g, c) for i, (g, _, c) in enumerate(cards[:top])]


@pytest.mark.parametrize("partitions", [1, 7])
def test_cards_match_a_count_with_dictionaries(spark, partitions):
    rows = corpus()
    df = works(spark, rows).repartition(partitions)
    got = trends.trend_cards(df, top=8, min_works=100).orderBy("rank").collect()
    want = brute_cards(rows, 100, 8)
    assert len(got) == len(want) == 8
    for row, (rank, growth, card) in zip(got, want):
        assert (row["rank"], row.features.normalized_growth) == (rank, growth)
        assert (row.id, row.title, row.works_total, row.first_year) == (
            card["id"], card["title"], card["works"], card["first"])
        assert row.features.acceleration == card["acceleration"]
        assert (row.score, row.features.organizations, row.features.countries) == (
            card["score"], card["orgs"], card["lands"])
        assert row.top_organizations == card["top"]
        assert row.case_example.title == card["case"]
        assert [s.title for s in row.sources] == card["sources"]
        assert [p.per_10k for p in row.series] == card["shares"]


def test_series_is_dense_and_skips_works_without_topic_or_year(spark):
    df = works(spark, [
        dict(id="1", primary_topic=topic("T1", None), publication_year=2010),
        dict(id="2", primary_topic=topic("T1", "One"), publication_year=2012),
        dict(id="3", primary_topic=topic("T2", "Two"), publication_year=2011),
        dict(id="4", primary_topic=topic("", "x"), publication_year=2013),
        dict(id="5", primary_topic=topic("T1", "One"), publication_year=None),
        dict(id="6", publication_year=2014)])
    rows = {r.topic_id: r for r in trends.topic_series(df).collect()}
    assert set(rows) == {"T1", "T2"} and rows["T1"].name == "One"
    assert [(p.year, p.works, p.per_10k) for p in rows["T1"].series] == [
        (2010, 1, 10000.0), (2011, 0, 0.0), (2012, 1, 10000.0)]
    points = trends.topic_points(trends.topic_series(df)).where("topic_id = 'T2'").collect()
    assert [p.works for p in points] == [0, 1, 0]


def test_catalogue_growth_spans_all_corpus_years(spark):
    df = works(spark, [dict(id=str(i), primary_topic=topic("T1"), publication_year=2012)
                       for i in range(3)] + [dict(id="z", publication_year=2010),
                                             dict(id="y", publication_year=None)])
    row = trends.topic_growth(df, min_works=2).collect()[0]
    assert (row.works, row.growth, row.series) == (3, 3.0, [0, 3])
    assert trends.topic_growth(df, min_works=4).count() == 0


def test_hot_topic_is_cut_before_the_shuffle(spark):
    plan = trends.topic_best_works(works(spark, []))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_index_document(spark):
    cards = trends.trend_cards(works(spark, corpus()), top=3, min_works=100)
    doc = reports.index_doc(cards, SliceSpec(), "v", "now").collect()[0]
    assert [t["rank"] for t in doc.trends] == [1, 2, 3]
    assert doc.direction.years == [2015, 2021] and doc.validation.cutoff_year == 2021
    assert [c.name for c in doc.validation.negative_controls] == list(reports.NEGATIVE_CONTROLS)
    assert doc.validation.metric is None


def test_sketches_of_years_merge_and_stay_within_their_error(spark):
    """One topic with 20,000 orgs and one with few; the years of the first overlap in half of the names."""
    many = spark.range(30_000).select(
        F.col("id").cast("string").alias("id"), F.struct(F.lit("T1").alias("id"), F.lit("n").alias("name"), F.lit(0.9).cast("float").alias("score")).alias("primary_topic"),
        (F.lit(2010) + F.floor(F.col("id") / 10_000)).cast("smallint").alias("publication_year"),
        F.array(F.concat(F.lit("I"), (F.col("id") % 10_000 + F.floor(F.col("id") / 10_000) * 5_000).cast("string"))).alias("institution_names"),
        F.array(F.lit("C1"), F.lit(""), F.lit(None).cast("string")).alias("institution_countries"))
    few = works(spark, [dict(id=f"F{i}", primary_topic=topic("T2"), publication_year=2010 + i % 2, institution_names=[f"I{i % 7}"],
                             institution_countries=None) for i in range(40)])
    both = many.unionByName(few.select(*many.columns))
    whole = trends.name_sketches(both)
    parts = [trends.name_sketches(both.where(F.col("publication_year") == y)) for y in (2010, 2011, 2012)]
    merged = trends.merged_sketches(*parts, parts[1])
    for sketches in (whole, merged):
        got = {r.topic_id: (r.organizations, r.countries) for r in trends.sketched_diffusion(sketches).collect()}
        assert got["T1"][0] == pytest.approx(20_000, rel=3 * 1.04 / 2 ** (trends.SKETCH_LG_K / 2)) and got["T1"][1] == 1
        assert got["T2"] == (7, 0)
    exact = {r.topic_id: (r.organizations, r.countries) for r in trends.topic_diffusion(both).collect()}
    assert exact == {"T1": (20_000, 1), "T2": (7, 0)}
    assert trends.sketched_diffusion(trends.name_sketches(both.limit(0))).collect() == []
