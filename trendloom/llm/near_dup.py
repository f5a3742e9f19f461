"""Near-duplicate groups with an LSH forest over MinHash signatures.

A text is its set of distinct word shingles. Texts with equal sets are one class from the start, so a
group of exact copies, however large, enters the search as one row.

The forest keeps one order of the signature per tree; a tree's rows that agree on its first minhashes
form a region. Regions of at most ``region`` classes give all their pairs as candidates (at most
``region - 1`` per class and tree, so the number of candidates is linear in the rows). A larger
region is gone through by longer common prefixes instead: every class is compared with the region's
first and last class, and the region is cut again by the next minhashes of the same tree, to the depth
at which it is small or the signature ends. Depth thus follows the data region by region. No class is
dropped: the classes of a large region are very similar, and mostly meet through its two centres, through
the smaller regions inside it, and again in every other tree, which has other regions.

Large regions that are not all one group after that are open, and their classes are completed exactly:
a join over the rarest shingles of each class finds every pair of them that can meet the threshold
(prefix and length filter, no cap), and pairs already in one group, which change nothing, are left
out. The order of shingles by rarity comes from counts in a table of fixed size; it decides the cost only, as
any one order gives all pairs. A family of texts just below the threshold can give many pairs there.

The number of trees comes from the threshold, so that a pair just at it misses every region of the
first depth with a probability below ``miss``. Candidates whose signatures already differ by far more
than chance allows (estimate 7 standard errors below the threshold) are left out; all others are
confirmed on the full shingle sets, as 64-bit hashes.

Groups are the connected components of the confirmed links, found by hooking and pointer jumping on
tables; no component and no link list reaches the driver. Every step writes to the shared folder.

Null texts and texts without words have an empty set, stay alone and link with nothing; a text with
fewer words than a shingle has its whole sequence as its one shingle. Classes are named by their set,
not by an id, so rows without an id or with the id of another row keep their own class; a group's
id is the smallest one in it, null if it has none. Other columns are ignored.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.llm.common import own_cache, sent_if_small
from trendloom.llm.graph import components
from trendloom.session import materialize

DEPTHS = (3, 6, 9)           # minhashes of a tree that a region's classes share, level by level
REGION = 24                  # classes up to which a region gives all its pairs
MISS = 2e-5
_KEEP_WORDS = 100_000        # words whose hash a worker keeps
_BUCKETS = 1 << 20           # counters for the rarity of shingles
_SLICES = 64                 # parts in which the counters are summed
_CHUNK = 1 << 11             # shingles hashed at a time, which bounds the memory of long texts

_words: dict[bytes, int] = {}


def trees_for(threshold: float, miss: float = MISS) -> int:
    """Trees needed for a pair at the threshold to meet in a region of the first depth."""
    return max(1, math.ceil(math.log(miss) / math.log1p(-threshold ** DEPTHS[0])))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; words are split at ASCII white space and
    A-Z is lower-cased."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(_words) > _KEEP_WORDS:
        _words.clear()
    get, hashes = _words.get, np.empty(len(words), np.uint64)
    for i, w in enumerate(words):
        h = get(w)
        if h is None:
            h = _words[w] = xxhash.xxh3_64_intdigest(w)
        hashes[i] = h
    n = max(1, len(words) - width + 1)
    total = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(min(width, len(words))):
            total = _mix(total * np.uint64(0x9E3779B97F4A7C15) + hashes[k:k + n] + np.uint64(k + 1))
    return np.unique(total)


def signature(shingles: np.ndarray, size: int) -> np.ndarray:
    """``size`` minhashes of 32 bits; the functions are the same everywhere."""
    rng = np.random.default_rng(7)
    a = rng.integers(1, 1 << 63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 1 << 63, size, dtype=np.uint64)
    best = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(shingles), _CHUNK):
            best = np.minimum(best, (shingles[at:at + _CHUNK, None] * a + b).min(axis=0))
    return (best >> np.uint64(32)).astype(np.uint32)


def _region_keys(sig: np.ndarray, trees: int) -> list[list[int]]:
    """Per depth the hash of each tree's prefix."""
    by_tree = sig.reshape(trees, DEPTHS[-1])
    return [[xxhash.xxh3_64_intdigest(by_tree[t, :d].tobytes(), t) - (1 << 63) for t in range(trees)]
            for d in DEPTHS]


def sketch(docs: DataFrame, width: int, trees: int, id_col: str, text: str) -> DataFrame:
    """``id, n_shingles, set_hash, text_hash, sig, keys0..`` of every row; all columns are narrow."""
    size = trees * DEPTHS[-1]
    names = [f"keys{i}" for i in range(len(DEPTHS))]
    schema = ("n_shingles long, set_hash binary, sig binary, "
              + ", ".join(f"{n} array<long>" for n in names))

    @F.pandas_udf(schema)
    def sketched(texts: pd.Series) -> pd.DataFrame:
        own_cache("near_dup", _words.clear)
        rows = []
        for t in texts:
            shingles = shingle_set(t, width)
            if not len(shingles):
                rows.append((0, None, None, *([] for _ in names)))
                continue
            sig = signature(shingles, size)
            rows.append((len(shingles), xxhash.xxh3_128_digest(shingles.tobytes()), sig.tobytes(),
                         *_region_keys(sig, trees)))
        return pd.DataFrame(rows, columns=["n_shingles", "set_hash", "sig", *names])
    made = docs.select(F.col(id_col).cast("long").alias("id"), F.md5(text).alias("text_hash"),
                       sketched(F.col(text)).alias("s"))
    return made.select("id", "text_hash", "s.*")


def _pair(left: Column, right: Column) -> Column:
    return F.when(left != right, F.struct(
        F.least(left, right).alias("a"), F.greatest(left, right).alias("b")))


def candidates(classes: DataFrame, region: int = REGION) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Distinct pairs ``a < b`` of classes that share a region of the forest; the pairs of small regions
    inside large ones, which only matter where the centres left them apart; and the members
    ``class, tree, key`` of the large regions of the first depth, which hold those of all others."""
    found, rest, crowded, inner = None, classes, None, None
    for level in range(len(DEPTHS)):
        keyed = rest.select("class", F.posexplode(f"keys{level}").alias("tree", "key")) if level == 0 else \
            rest.select("class", "tree", F.get(f"keys{level}", F.col("tree")).alias("key"))
        sizes = keyed.groupBy("tree", "key").agg(
            F.count(F.lit(1)).alias("n"), F.min("class").alias("first"), F.max("class").alias("last")) \
            .where(F.col("n") > 1)
        sizes = materialize(sizes, f"forest-regions-{level}")
        members = materialize(keyed.join(sizes, ["tree", "key"]), f"forest-members-{level}")
        small = members.where(F.col("n") <= region).groupBy("tree", "key") \
            .agg(F.sort_array(F.collect_list("class")).alias("classes"))
        within = small.select(F.explode(F.flatten(F.transform("classes", lambda x, i: F.transform(
            F.slice("classes", i + 2, F.lit(region)), lambda y: F.struct(x.alias("a"), y.alias("b")))))).alias("p"))
        large = members.where(F.col("n") > region)
        stars = large.select(F.explode(F.array_compact(F.array(
            _pair(F.col("class"), F.col("first")), _pair(F.col("class"), F.col("last"))))).alias("p"))
        if level == 0:
            crowded = large.select("class", "tree", "key")
            found = within.unionByName(stars).select("p.a", "p.b")
        else:
            found = found.unionByName(stars.select("p.a", "p.b"))
            inner = within.select("p.a", "p.b") if inner is None else inner.unionByName(within.select("p.a", "p.b"))
        if level + 1 < len(DEPTHS):
            rest = large.select("class", "tree").join(
                classes.select("class", f"keys{level + 1}"), "class")
    return found.distinct(), inner, crowded


def labelled(groups: DataFrame) -> DataFrame:
    return groups.select(F.col("id").alias("class"), "component")


def inner_pairs(inner: DataFrame, groups: DataFrame, tried: DataFrame) -> DataFrame:
    """Pairs of the small regions inside large ones that are not in one group yet and were not tried."""
    label = labelled(groups)
    return inner.distinct() \
        .join(label.withColumnsRenamed({"class": "a", "component": "ca"}), "a", "left") \
        .join(label.withColumnsRenamed({"class": "b", "component": "cb"}), "b", "left") \
        .where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b").join(tried, ["a", "b"], "left_anti")


def open_classes(crowded: DataFrame, groups: DataFrame) -> DataFrame:
    """``class, component`` of the classes in large regions that are not all one group."""
    members = materialize(crowded.join(labelled(groups), "class", "left").withColumn(
        "component", F.coalesce("component", "class")), "forest-crowded")
    apart = materialize(members.groupBy("tree", "key").agg(F.min("component").alias("first"), F.max("component").alias("last"))
                        .where("first <> last").select("tree", "key"), "forest-open-regions")
    return members.join(apart, ["tree", "key"]).select("class", "component").distinct()


def shingle_counts(held: DataFrame) -> np.ndarray:
    """How often shingles of each bucket stand in ``held``; only these ``_BUCKETS`` sums reach the driver."""
    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            hashes = np.frombuffer(b"".join(batch["shingles"]), np.uint64)
            found = np.bincount((hashes % np.uint64(_BUCKETS)).astype(np.int64), minlength=_BUCKETS)
            total = found if total is None else total + found
        if total is not None:
            yield pd.DataFrame({"slice": range(_SLICES), "counts": [c.tobytes() for c in total.reshape(_SLICES, -1)]})

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, counts in zip(batch["slice"], batch["counts"]):
                total[at] = total.get(at, 0) + np.frombuffer(counts, np.int64)
        if total:
            yield pd.DataFrame({"slice": list(total), "counts": [c.tobytes() for c in total.values()]})
    slices = held.select("shingles").mapInPandas(counted, "slice int, counts binary").repartition("slice") \
        .mapInPandas(summed, "slice int, counts binary")
    out = np.zeros((_SLICES, _BUCKETS // _SLICES), np.int64)
    for row in slices.toLocalIterator():
        out[row["slice"]] = np.frombuffer(row["counts"], np.int64)
    return out.ravel()


def rarest(shingles: np.ndarray, counts: np.ndarray, threshold: tuple[int, int]) -> np.ndarray:
    """The rarest shingles of a set, rarest first: so many that two sets which meet the threshold share one."""
    n = len(shingles)
    order = np.lexsort((shingles, counts[(shingles % np.uint64(_BUCKETS)).astype(np.int64)]))
    return shingles[order[:n - -(-threshold[0] * n // threshold[1]) + 1]]


def exact_pairs(opened: DataFrame, held: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """All pairs of ``opened`` from different components whose sets (``held``) can meet the threshold.

    Two sets of ``na`` and ``nb`` shingles that meet it share at least ``up / (up + down) * (na + nb)``. In one
    order of all shingles, the first one that they share thus has so many places of either set from it on."""
    up, down = threshold
    counts = held.sparkSession.sparkContext.broadcast(shingle_counts(held))

    @F.pandas_udf("struct<n: long, tokens: array<long>>")
    def prefixes(sets: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([(len(x) // 8, rarest(np.frombuffer(x, np.uint64), counts.value, threshold).view(np.int64))
                             for x in sets], columns=["n", "tokens"])
    made = materialize(held.select("class", prefixes("shingles").alias("p")), "forest-prefixes")
    postings = materialize(made.join(opened, "class").select(
        "class", "component", F.col("p.n").alias("n"), F.posexplode("p.tokens").alias("at", "token")), "forest-postings")
    shared = materialize(postings.groupBy("token").agg(F.min("component").alias("first"), F.max("component").alias("last"))
                         .where("first <> last").select("token"), "forest-shared")
    met = materialize(postings.join(shared, "token").withColumn("left", F.col("n") - F.col("at")).drop("at"), "forest-met")
    least = up * (F.col("x.n") + F.col("y.n"))
    return met.alias("x").join(met.alias("y"), (F.col("x.token") == F.col("y.token"))
                               & (F.col("x.class") < F.col("y.class")) & (F.col("x.component") != F.col("y.component"))
                               & ((up + down) * F.col("x.left") >= least) & ((up + down) * F.col("y.left") >= least)
                               & (down * F.least("x.n", "y.n") >= up * F.greatest("x.n", "y.n"))) \
        .select(F.col("x.class").alias("a"), F.col("y.class").alias("b")).distinct()


def _estimate_floor(threshold: float, size: int) -> float:
    return threshold - 7 * math.sqrt(threshold * (1 - threshold) / size)


def close_pairs(pairs: DataFrame, classes: DataFrame, threshold: tuple[int, int], size: int) -> DataFrame:
    """The pairs whose set sizes and signatures allow the threshold."""
    floor = _estimate_floor(threshold[0] / threshold[1], size)
    narrow = classes.select("class", "n_shingles", "sig")

    @F.pandas_udf("double")
    def agreement(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([float((np.frombuffer(x, np.uint32) == np.frombuffer(y, np.uint32)).mean())
                          for x, y in zip(a, b)], dtype="float64")
    sided = pairs.join(narrow.select(F.col("class").alias("a"), F.col("n_shingles").alias("na"),
                                     F.col("sig").alias("sa")), "a") \
        .join(narrow.select(F.col("class").alias("b"), F.col("n_shingles").alias("nb"),
                            F.col("sig").alias("sb")), "b")
    sized = sided.where(F.lit(threshold[1]) * F.least("na", "nb") >= F.lit(threshold[0]) * F.greatest("na", "nb"))
    return sized.where(agreement("sa", "sb") >= floor).select("a", "b")


def sets_of(wanted: DataFrame, docs: DataFrame, width: int, text: str) -> DataFrame:
    """``class, shingles`` of the classes ``class, text_hash``; one text per class gives its set."""
    @F.pandas_udf("binary")
    def sets(texts: pd.Series) -> pd.Series:
        return pd.Series([shingle_set(t, width).tobytes() for t in texts], dtype=object)
    picked = sent_if_small(wanted, 48)           # 16 bytes of class and 32 of digest
    held = docs.select(F.md5(text).alias("text_hash"), F.col(text).alias("text")) \
        .join(picked, "text_hash").dropDuplicates(["class"])
    return materialize(held.select("class", sets("text").alias("shingles")), "forest-sets")


def linked_pairs(pairs: DataFrame, held: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """The pairs whose full shingle sets meet the threshold. A set goes once to its own side of the pairs
    and once per pair to the other."""
    @F.pandas_udf("boolean")
    def linked(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(a, b):
            u, v = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(u, v, assume_unique=True))
            out.append(threshold[1] * both >= threshold[0] * (len(u) + len(v) - both))
        return pd.Series(out, dtype=bool)
    sided = pairs.join(held.select(F.col("class").alias("b"), F.col("shingles").alias("sb")), "b") \
        .join(held.select(F.col("class").alias("a"), F.col("shingles").alias("sa")), "a")
    return sided.where(linked("sa", "sb")).select("a", "b")


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, width: int,
              threshold: tuple[int, int], text: str) -> DataFrame:
    """The pairs whose full shingle sets meet the threshold."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    wanted = materialize(classes.join(ends, "class", "left_semi").select("class", "text_hash"), "forest-wanted")
    return linked_pairs(pairs, sets_of(wanted, docs, width, text), threshold)


def grouped(docs: DataFrame, width: int, threshold: tuple[int, int], id_col: str, text: str,
            region: int) -> tuple[DataFrame, DataFrame]:
    """The sketches of all rows, and ``set_hash, component`` of the classes that are linked with another."""
    trees = trees_for(threshold[0] / threshold[1])
    rows = materialize(sketch(docs, width, trees, id_col, text), "forest-sketch")
    keys = [f"keys{i}" for i in range(len(DEPTHS))]
    classes = materialize(
        rows.where(F.col("n_shingles") > 0).dropDuplicates(["set_hash"])
        .select(F.col("set_hash").alias("class"), "text_hash", "n_shingles", "sig", *keys), "forest-classes")
    pairs, inner, crowded = candidates(classes, region)
    size = trees * DEPTHS[-1]
    close = materialize(close_pairs(pairs, classes, threshold, size), "forest-close")
    links = materialize(confirmed(close, classes, docs, width, threshold, text), "forest-links")
    groups = components(links)
    further = materialize(close_pairs(inner_pairs(inner, groups, close), classes, threshold, size), "forest-further")
    if not further.isEmpty():
        more = materialize(confirmed(further, classes, docs, width, threshold, text), "forest-links")
        links, close = links.unionByName(more), close.unionByName(further)
        groups = components(links)
    opened = materialize(open_classes(crowded, groups), "forest-open")
    if not opened.isEmpty():
        wanted = materialize(classes.join(opened, "class").select("class", "text_hash"), "forest-wanted")
        held = sets_of(wanted, docs, width, text)
        last = materialize(exact_pairs(opened, held, threshold).join(close, ["a", "b"], "left_anti"), "forest-exact")
        more = materialize(linked_pairs(last, held, threshold), "forest-links")
        links = links.unionByName(more)
        groups = components(links)
    return rows, groups.withColumnRenamed("id", "set_hash")


def near_duplicates(docs: DataFrame, width: int = 5, threshold: tuple[int, int] = (4, 5),
                    id_col: str = "doc_id", text: str = "text", region: int = REGION) -> DataFrame:
    """One row per input row: id, ``n_shingles``, ``component_id`` (smallest id reachable over links
    of at least ``threshold``) and ``kept``. Links are not counted, as pairs within a group are not all looked at."""
    rows, linked = grouped(docs, width, threshold, id_col, text, region)
    sets = rows.where(F.col("set_hash").isNotNull()).groupBy("set_hash").agg(F.min("id").alias("first"))
    named = materialize(sets.join(linked, "set_hash", "left")
                        .withColumn("component", F.coalesce("component", "set_hash")), "forest-components")
    smallest = materialize(named.groupBy("component").agg(F.min("first").alias("component_id")), "forest-firsts")
    named = materialize(named.join(smallest, "component").select("set_hash", "component_id"), "forest-named")
    out = rows.select("id", "n_shingles", "set_hash").join(named, "set_hash", "left")
    component = F.when(F.col("set_hash").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))


def one_per_group(docs: DataFrame, width: int = 5, threshold: tuple[int, int] = (4, 5), id_col: str = "doc_id",
                  text: str = "text", region: int = REGION) -> DataFrame:
    """The documents without those that another row of their group stands for: of a group's rows, told apart by id and
    text, the one with the smallest id stays (of several texts of that id the one of the smallest MD5). Rows without
    an id or without words stay, and of rows that repeat both id and text one stays."""
    rows, linked = grouped(docs, width, threshold, id_col, text, region)
    named = rows.where("id is not null and set_hash is not null")
    row = F.struct("id", "text_hash")
    firsts = materialize(named.groupBy("set_hash").agg(F.min(row).alias("first")).join(linked, "set_hash", "left"), "forest-firsts")
    stay = materialize(firsts.groupBy(F.coalesce("component", "set_hash")).agg(F.min("first").alias("first")).select("first.*"),
                       "forest-stay")
    seen = materialize(rows.where("id is not null").groupBy("id", "text_hash").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.col("set_hash").isNotNull()).alias("named")), "forest-seen")
    gone = materialize(seen.where("named").select("id", "text_hash").join(stay, ["id", "text_hash"], "left_anti"), "forest-dropped")
    twice = materialize(seen.where("n > 1").select("id", "text_hash").join(gone, ["id", "text_hash"], "left_anti"), "forest-repeated")
    keyed = docs.withColumns({"__id": F.col(id_col).cast("long"), "__hash": F.md5(text)})

    def meets(other: DataFrame) -> Column:
        return (keyed["__id"] == other["id"]) & keyed["__hash"].eqNullSafe(other["text_hash"])
    rest = keyed.join(sent_if_small(gone, 40), meets(gone), "left_anti")
    if not twice.isEmpty():
        again = rest.join(sent_if_small(twice, 40), meets(twice), "left_semi").dropDuplicates(["__id", "__hash"])
        rest = rest.join(sent_if_small(twice, 40), meets(twice), "left_anti").unionByName(again)
    return rest.select(*docs.columns)
