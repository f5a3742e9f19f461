"""Near duplicates, fingerprints, sharding, WARC archives."""
from __future__ import annotations

import gzip
import hashlib
import io
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from trendloom.llm import fingerprints, near_dup, sharding, warc
from trendloom.llm.graph import components

CLASHING = "doc_id long, text string, id long, class string, sketch string, size int, shard int, slot int, component string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, 5, "c", "s", 1, 2, 3, "k") for i, t in rows], CLASHING)


def family(rng, n, words=120, edits=4):
    """A text and copies with a few words changed."""
    base = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(words)]
    out = []
    for _ in range(n):
        copy = list(base)
        for at in rng.sample(range(words), rng.randint(0, edits)):
            copy[at] = "".join(rng.choices("xyz", k=6))
        out.append(" ".join(copy))
    return out


def brute_groups(texts, width, numerator, denominator):
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    least = {i: i for i in texts}

    def root(i):
        while least[i] != i:
            i = least[i]
        return i
    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and denominator * both >= numerator * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                least[y] = x
    return {i: root(i) for i in texts}, {i: len(s) for i, s in sets.items()}


@pytest.mark.parametrize("region", [2, 24])
def test_groups_equal_brute_force(spark, region):
    rng = random.Random(11)
    texts = [t for n in (1, 1, 2, 3, 5, 9, 40) for t in family(rng, n, edits=5)] + ["a b", "A  b", "a", "", None, " \n"]
    rng.shuffle(texts)
    rows = dict(enumerate(texts))
    wanted, sizes = brute_groups(rows, 3, 85, 100)
    found = near_dup.near_duplicates(docs(spark, list(rows.items())), 3, (85, 100), region=region).collect()
    assert {r.doc_id: r.component_id for r in found} == wanted
    assert {r.doc_id: r.n_shingles for r in found} == sizes
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_only_small_parts_of_a_large_region_are_paired(spark):
    rng = random.Random(2)
    rows = list(enumerate(family(rng, 300, words=200, edits=6)))
    found = near_dup.near_duplicates(docs(spark, rows), 5, (1, 2), region=8).collect()
    assert {r.component_id for r in found} == {0}


def shared_template(rng, pairs, own, common, words=600):
    """Texts of one template in pairs: both of a pair have ``common`` words changed alike, each has ``own`` more."""
    base = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(words)]
    out = []
    for _ in range(pairs):
        places = rng.sample(range(1, words // 4 - 1), common + 2 * own)
        alike = {4 * at: "".join(rng.choices("xyz", k=9)) for at in places[:common]}
        for mine in (places[common:common + own], places[common + own:]):
            changed = alike | {4 * at: "".join(rng.choices("uvw", k=9)) for at in mine}
            out.append(" ".join(changed.get(at, w) for at, w in enumerate(base)))
    return out


def test_sparse_pairs_of_a_template_equal_brute_force(spark):
    rng = random.Random(3)
    texts = shared_template(rng, 150, 8, 4)
    rng.shuffle(texts)
    rows = dict(enumerate(texts))
    wanted, _ = brute_groups(rows, 3, 85, 100)
    assert len(set(wanted.values())) == 150
    found = near_dup.near_duplicates(docs(spark, list(rows.items())), 3, (85, 100)).collect()
    assert {r.doc_id: r.component_id for r in found} == wanted


def test_regions_inside_large_ones_give_all_pairs_up_to_the_same_bound(spark):
    rows = [(bytes([n]), [1], [n // 20], [n // 20]) for n in range(40)]
    classes = spark.createDataFrame(rows, "class binary, keys0 array<long>, keys1 array<long>, keys2 array<long>")
    pairs, inner, crowded = near_dup.candidates(classes)
    wanted = {(bytes([a]), bytes([b])) for a in range(40) for b in range(a + 1, 40) if a // 20 == b // 20}
    assert {(bytes(r.a), bytes(r.b)) for r in inner.collect()} == wanted
    assert crowded.count() == 40 and pairs.count() == 77


def test_links_are_not_counted(spark):
    found = near_dup.near_duplicates(docs(spark, [(1, "a b c d"), (2, "a b c  d"), (3, None)]))
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert {r.doc_id: r.component_id for r in found.collect()} == {1: 1, 2: 1, 3: 3}


def test_prefixes_of_sets_that_meet_the_threshold_share_a_shingle():
    rng = np.random.default_rng(5)
    counts = rng.integers(0, 3, near_dup._BUCKETS)
    for n in (1, 2, 7, 20, 100):
        for up, down in ((85, 100), (4, 5), (1, 2), (1, 1)):
            a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            m = max(1, -(-n * up // down))
            x, y = (near_dup.rarest(np.sort(s), counts, (up, down)) for s in (a, a[:m]))
            assert set(x.tolist()) & set(y.tolist())


def test_one_per_group_with_lost_and_repeated_ids(spark):
    text = family(random.Random(4), 1)[0]
    rows = [(1, text), (1, text), (2, text + " end"), (None, text), (None, None), (3, None), (4, "other words stand here today")]
    kept = near_dup.one_per_group(docs(spark, rows))
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, None, None, 3, 4])
    assert kept.columns == docs(spark, rows).columns
    assert near_dup.one_per_group(docs(spark, []).limit(0)).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(201, 200), (7, 7)]
    df = spark.createDataFrame(links, "a long, b long")
    label = {r.id: r.component for r in components(df).collect()}
    assert {label[i] for i in range(61)} == {0} and {label[100 + i] for i in range(50)} == {100} and label[201] == 200


# Fingerprints

def shingles(text, width=fingerprints.WIDTH):
    w = (text or "").lower().split()
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def test_edited_texts_and_the_order_of_documents(spark):
    texts = {5: "héllo wörld 😀 again", 9: "", 2: "one two three four five six", 30: None, 31: "x", 7: "tail of it all"}
    rows = {r.doc_id: r for r in fingerprints.fingerprint_report(docs(spark, list(texts.items()))).collect()}
    order = sorted(texts)
    for i, a in enumerate(order):
        t, following = texts[a] or "", texts[order[(i + 1) % len(order)]] or ""
        half = len(t) // 2
        assert rows[a].edited_sha256 == hashlib.sha256((t[:len(t) - half] + following[:half]).encode()).hexdigest()
        assert rows[a].n_chars == len(t)
    assert rows[9].fingerprint == rows[30].fingerprint == ""


@pytest.mark.parametrize("n, partitions", [(1, 1), (2, 3), (500, 4)])
def test_next_follows_in_every_range(spark, n, partitions):
    df = spark.range(n).select((F.col("id") * 3).alias("k"), F.col("id").cast("string").alias("t")).repartition(partitions)
    rows = {r.k: r.next_t for r in fingerprints.with_next(df, "k", ["t"]).collect()}
    assert rows == {3 * i: str((i + 1) % n) for i in range(n)}


def test_repeated_and_lost_keys_keep_all_rows(spark):
    rows = [(1, "a")] * 3 + [(None, "b"), (None, "c"), (2, "d")]
    out = fingerprints.with_next(spark.createDataFrame(rows, "k long, t string"), "k", ["t"]).collect()
    assert sorted(r.t + r.next_t for r in out) == ["aa", "aa", "ad", "bc", "ca", "db"]
    assert fingerprints.fingerprint_report(docs(spark, []).limit(0)).count() == 0


def test_estimates_are_close_and_sketches_merge(spark):
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefghij", k=4)) for _ in range(3000)]
    pairs = [(" ".join(words[:1500]), " ".join(words[s:1500 + s])) for s in (0, 100, 500, 1400)] + [("", ""), ("a", ""), ("a b", "a b")]
    df = spark.createDataFrame(pairs, "a string, b string")
    a, b = (fingerprints.sketch_text(F.col(c)) for c in "ab")
    got = df.select("a", "b", a.alias("x"), b.alias("y"), fingerprints.sketch_text(F.concat_ws(" | | | | | ", "a", "b")).alias("u")).select(
        "*", fingerprints.resemblance(F.col("x"), F.col("y")).alias("j"), fingerprints.containment(F.col("x"), F.col("y")).alias("c"),
        fingerprints.distinct_shingles(F.col("x")).alias("n"), fingerprints.merge(F.col("x"), F.col("y")).alias("m")).collect()
    for r in got:
        p, q = shingles(r.a), shingles(r.b)
        assert r.j == pytest.approx(len(p & q) / len(p | q) if p | q else 1, abs=0.15)
        assert r.c == pytest.approx(len(p & q) / len(p) if p else 1, abs=0.2)
        assert r.n == pytest.approx(len(p), rel=0.3)
        assert r.x == sorted(set(r.x)) and len(r.x) == min(len(p), fingerprints.K)
        assert r.m == sorted(set(r.x) | set(r.y))[:fingerprints.K]


def test_a_sketch_is_exact_even_where_the_bound_leaves_too_few(spark):
    text = " ".join(["same words here again"] * 2000) + " " + " ".join(str(i) for i in range(400))
    df = spark.createDataFrame([(text,)], "t string")
    row = df.select(fingerprints.sketch_text(F.col("t")).alias("s"), fingerprints.shingle_hashes(F.col("t")).alias("h")).first()
    assert row.s == sorted(set(row.h))[:fingerprints.K]


# Sharding

@pytest.mark.parametrize("shards", [1, 5, 16])
def test_shards_are_near_equal_and_keep_equal_texts_together(spark, shards):
    rng = random.Random(6)
    texts = ["".join(rng.choices("ab é\n", k=rng.randint(0, 400))) for _ in range(600)] + ["hot text"] * 60 + [None, "", ""]
    rows = sharding.kd_shards(docs(spark, list(enumerate(texts))), shards=shards).collect()
    assert len(rows) == len(texts)
    size = Counter()
    for r in rows:
        text = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(text) + 1, zlib.crc32(text))
        size[r.shard] += r.size
    total = sum(size.values())
    assert set(size) == set(range(shards)) and max(size.values()) - min(size.values()) <= 0.1 * total / shards + 60 * 9
    assert max(len({r.shard for r in rows if texts[r.doc_id] == t}) for t in ("hot text", "")) == 1
    for s in size:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))


def test_cuts_are_the_weighted_medians_of_a_sorted_list(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choices("ab 12é\n", k=rng.choice([0, 3, 40, 400]))) for _ in range(300)] + ["same 1"] * 40
    meta = sharding.with_metadata(docs(spark, list(enumerate(texts)))).withColumn("node", F.col("id") % 3).cache()
    rows = meta.collect()
    for dim, name in enumerate(sharding.DIMENSIONS):
        asked = {}
        for node in range(3):
            mine = [r for r in rows if r.node == node]
            asked[node] = (dim, min(r[name] for r in mine), max(r[name] for r in mine),
                           sum(r.size for r in mine) * (node + 1) // 4)
        for node, cut in sharding.weighted_cuts(meta, asked).items():
            places = sorted((r[name] << 32 | r.text_crc32, r.size) for r in rows if r.node == node)
            ways = {p: sum(size for q, size in places if q < p) for p in {q for q, _ in places} | {places[-1][0] + 1}}
            assert cut.missed == min(abs(b - asked[node][3]) for b in ways.values())
            assert abs(sum(size for q, size in places if q < cut.place) - asked[node][3]) == cut.missed


def test_dimensions_are_metadata_of_the_text(spark):
    got = sharding.with_metadata(docs(spark, [(1, "ab 12é\n3"), (2, None), (3, "")])).orderBy("id").collect()
    assert [(r.size, r.beyond_ascii, r.lines, r.digits, r.word_length) for r in got] == [
        (10, 1, 1, 375000, 4000), (1, 0, 0, 0, 0), (1, 0, 0, 0, 0)]


def test_plans_do_not_grow_with_the_shards(spark):
    rows = [(i, f"{i} " * (i % 7 + 3)) for i in range(400)]
    few, many = (sharding.kd_leaves(sharding.with_metadata(docs(spark, rows)), n) for n in (2, 32))
    assert len({r.node for r in many.select("node").distinct().collect()}) == 32
    assert len(many._jdf.queryExecution().analyzed().toString()) < 1.2 * len(few._jdf.queryExecution().analyzed().toString())


def test_shards_by_target_bytes_and_of_odd_tables(spark):
    rows = [(i, "x" * 99) for i in range(40)] + [(i, f"{i} " * 40) for i in range(40, 80)]
    found = sharding.kd_shards(docs(spark, rows), target_bytes=2500).collect()
    assert len({r.shard for r in found}) > 1
    assert sharding.kd_shards(docs(spark, []).limit(0), shards=4).count() == 0
    same = sharding.kd_shards(docs(spark, [(None, "a"), (1, "a"), (1, "a")]), shards=4).collect()
    assert len({r.shard for r in same}) == 1 and sorted(r.slot for r in same) == [0, 1, 2]


# WARC

def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "d", "t") for i, u, h in rows],
                                 "page_id long, url string, html string, digest string, type string")


def test_archives_round_trip(spark, tmp_path):
    long, very_long = "é" * 60, "".join(random.Random(1).choices("abcdef<>", k=3_000_000))
    rows = [(4, "http://a/ b", long), (2, "u\r\nX: y", long), (9, None, long), (5, "v", None), (6, "v", ""), (7, "v", "short"),
            (8, "v", "short"), (1, "w", very_long), (3, "w", very_long), (None, "w", long), (10, "z", "\r\n\r\nWARC/1.1\r\n\r\n" * 9)]
    found = warc.archive_pages(pages(spark, rows).repartition(2), f"file://{tmp_path}/arc", archive_bytes=1000).collect()
    assert len(found) == len(rows) and all(r.intact for r in found)
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found}
    for i, _, html in rows:
        data = (html or "").encode()
        assert got[i][:2] == (len(data), hashlib.sha256(data).hexdigest())
    assert {i: g[2:] for i, g in got.items() if g[2] == "revisit"} == {
        4: ("revisit", 2), 9: ("revisit", 2), None: ("revisit", 2), 3: ("revisit", 1)}


def test_each_member_stands_alone_and_the_file_is_still_a_gzip(spark, tmp_path):
    records = [warc.record_bytes(i, "http://x", b"p" * i * 50, None) for i in range(1, 30)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.warc.gz").write_bytes(gzip.compress(b"".join(records[:20])) + gzip.compress(b"".join(records[20:])))
    assert warc.normalise_file(f"file://{tmp_path}/in", f"file://{tmp_path}/out", "a.warc.gz") == 29
    data = (tmp_path / "out" / "a.warc.gz").read_bytes()
    assert gzip.decompress(data) == b"".join(records)
    index = spark.read.schema(warc.INDEX).json(f"{tmp_path}/out/*.index.json").orderBy("offset").collect()
    assert [gzip.decompress(data[r.offset:r.offset + r.length]) for r in index] == records


def test_cut_off_archives_are_errors():
    record = warc.record_bytes(1, "u", b"x" * 5000, None)
    whole = gzip.compress(record)
    with pytest.raises(ValueError):
        list(warc.inflate(io.BytesIO(whole[:-20])))
    with pytest.raises(ValueError):
        for _, raw in warc.split_records(iter([record[:-100]])):
            list(raw)


def test_damaged_payloads_are_errors(spark, tmp_path):
    record = warc.record_bytes(1, "u", b"sound payload", None).replace(b"sound", b"wound")
    read = warc.read_record(gzip.compress(record))
    assert not read["intact"] and read["payload_digest"] == hashlib.sha256(b"wound payload").hexdigest()
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.warc.gz").write_bytes(gzip.compress(record))
    assert warc.normalise_file(f"file://{tmp_path}/in", f"file://{tmp_path}/out", "a.warc.gz") == 1
    with pytest.raises(Exception, match="damaged"):
        warc.read_archives(spark, f"file://{tmp_path}/out").collect()


def test_no_pages(spark):
    assert warc.archive_pages(pages(spark, []).limit(0)).count() == 0


def test_a_text_that_shares_the_id_of_a_copy_is_not_lost(spark):
    a, b = family(random.Random(5), 1)[0], family(random.Random(6), 1)[0]
    got = near_dup.one_per_group(docs(spark, [(3, b), (5, a), (5, b), (5, a), (7, a + " end"), (7, b)])).collect()
    assert sorted((r.doc_id, r.text) for r in got) == sorted([(3, b), (5, a)])


def test_one_of_several_texts_of_the_smallest_id_stays(spark):
    a = family(random.Random(7), 1)[0]
    got = near_dup.one_per_group(docs(spark, [(3, a), (3, a + " end"), (4, a + " end")])).collect()
    assert [r.doc_id for r in got] == [3]
