"""K-d tree sharding: documents are split at distributed weighted medians of their metadata.

A node with more than one shard to fill is cut in two along its widest dimension (its range against
the range of the whole corpus) at the value where the bytes of one half are reached; the halves are
cut again until every leaf is one shard, i.e. holds the target bytes. All nodes of a level are cut together.
Where a large group of equal texts stands at the cut and makes it miss, the next widest dimension,
on which the group stands elsewhere, is tried, and the best cut taken.

The dimensions are metadata of the text alone: bytes, characters outside ASCII, lines, share of digits, mean word
length. So equal texts always meet in one shard. A checksum only orders the texts of one value and is no
dimension. A weighted median is found exactly by narrowing: a histogram of bytes over at most
``BINS`` bins per open node tells the bin in which the cut lies, which is then binned again, until it is a
single place (value and checksum). A row's node is a column, written once per level, and the cuts
of a level are a table that rows look theirs up in, so plans do not grow with the shards. The driver
holds one row per node of a level, at most one per shard; histograms stay on Spark.

Sizes near equal is the law (``bytes``): the only unevenness is one group of equal texts, which no law
keeps together and splits at once. Null texts have no bytes, size 1 and the checksum of an empty text.
Slots number a shard's rows by checksum, then id; rows that repeat an id get a slot each.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trendloom.operators.ranking import with_row_index
from trendloom.session import materialize

BINS = 2048
TOLERANCE = 0.005            # share of a node's bytes by which a cut may miss before another dimension is tried
DIMENSIONS = ("size", "beyond_ascii", "lines", "digits", "word_length")
LARGEST = (1 << 31) - 1      # of a dimension, so that value and checksum make one long
SENT_ROWS = 100_000          # rows of a table of cuts (40 bytes each) up to which it is sent to all tasks


@dataclass
class Cut:
    """Rows of the node before ``place`` on dimension ``dim`` go to its lower half; ``missed`` bytes it is off."""
    dim: int
    place: int
    missed: int


def with_metadata(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, the dimensions and the checksum of every row."""
    content = F.coalesce(F.col(text), F.lit(""))

    def without(characters: str) -> Column:
        return F.length(F.translate(F.col("__text"), characters, ""))
    chars = F.length("__text")
    metadata = {
        "size": F.octet_length("__text").cast("long") + 1,
        "beyond_ascii": F.octet_length("__text") - chars,
        "lines": chars - F.length(F.replace("__text", F.lit("\n"), F.lit(""))),
        "digits": F.coalesce(F.try_divide((chars - without("0123456789")).cast("long") * 1_000_000, chars), F.lit(0)),
        "word_length": chars.cast("long") * 1000
        / (chars - F.length(F.replace("__text", F.lit(" "), F.lit(""))) + 1),
    }
    return docs.select(F.col(id_col).alias("id"), content.alias("__text")).select(
        "id", *[F.least(c.cast("long"), F.lit(LARGEST)).alias(n) for n, c in metadata.items()],
        F.crc32(F.encode("__text", "UTF-8")).alias("text_crc32"))


def _place(dim: Column) -> Column:
    """A row's place along a dimension: its value, then its checksum."""
    value = F.coalesce(*[F.when(dim == i, F.col(d)) for i, d in enumerate(DIMENSIONS)])
    return F.shiftleft(value, 32) + F.col("text_crc32")


def _per_node(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table of one row per node, sent to all tasks while it is small."""
    table = spark.createDataFrame(rows, schema)
    return F.broadcast(table) if len(rows) <= SENT_ROWS else table


def weighted_cuts(rows: DataFrame, asked: dict[int, tuple[int, int, int, int]]) -> dict[int, Cut]:
    """Per node the cut nearest to the wanted bytes along one dimension. ``asked`` maps a node to (dimension, lowest and
    highest value, wanted bytes); ``rows`` holds ``node``, the dimensions and the checksum."""
    spark, cuts = rows.sparkSession, {}
    open_ = {n: (dim, lo << 32, (hi << 32) + (1 << 32) - 1, 0, wanted) for n, (dim, lo, hi, wanted) in asked.items()}
    while open_:
        table = _per_node(spark, [(n, dim, lo, hi, -(-(hi - lo + 1) // BINS), under, wanted)
                                  for n, (dim, lo, hi, under, wanted) in open_.items()],
                          "node long, dim int, lo long, hi long, width long, under long, wanted long")
        place = _place(F.col("dim"))
        bins = rows.join(table, "node").select("node", "width", "lo", "under", "wanted", "size", place.alias("p"), "hi") \
            .where(F.col("p").between(F.col("lo"), F.col("hi"))) \
            .groupBy("node", "lo", "width", "under", "wanted", F.expr("(p - lo) div width").alias("bin")) \
            .agg(F.sum("size").alias("bytes"))
        so_far = F.sum("bytes").over(Window.partitionBy("node").orderBy("bin")) + F.col("under")     # at most BINS rows
        found = bins.withColumn("upto", so_far).where(
            (F.col("upto") >= F.col("wanted")) & (F.col("upto") - F.col("bytes") < F.col("wanted")))
        narrowed = {}
        for r in found.collect():
            dim, _, hi, _, wanted = open_[r["node"]]
            lo, under = r["lo"] + r["bin"] * r["width"], r["upto"] - r["bytes"]
            if r["width"] > 1:
                narrowed[r["node"]] = (dim, lo, min(hi, lo + r["width"] - 1), under, wanted)
            else:            # the group at the cut goes to the side that it leaves nearer to its share
                with_it = abs(r["upto"] - wanted) < abs(under - wanted)
                cuts[r["node"]] = Cut(dim, lo + with_it, abs((r["upto"] if with_it else under) - wanted))
        open_ = narrowed
    return cuts


def _by_width(row, whole: list[tuple[int, int]]) -> list[int]:
    """The dimensions, widest first."""
    def width(i: int) -> float:
        span = whole[i][1] - whole[i][0]
        return (row[f"max_{DIMENSIONS[i]}"] - row[f"min_{DIMENSIONS[i]}"]) / span if span else 0.0
    return sorted(range(len(DIMENSIONS)), key=width, reverse=True)


def kd_leaves(meta: DataFrame, shards: int) -> DataFrame:
    """``meta`` with ``node``, the shard of every row. A node is known by the first of its shards."""
    spark = meta.sparkSession
    rows, nodes, whole = meta.withColumn("node", F.lit(0).cast("long")), {0: shards}, None
    while any(n > 1 for n in nodes.values()):
        stats = {r["node"]: r for r in rows.groupBy("node").agg(
            F.sum("size").alias("bytes"), *[f(d).alias(f"{name}_{d}") for d in DIMENSIONS
                                            for name, f in (("min", F.min), ("max", F.max))]).collect()
                 if nodes[r["node"]] > 1}
        if whole is None and stats:
            whole = [(stats[0][f"min_{d}"], stats[0][f"max_{d}"]) for d in DIMENSIONS]
        best: dict[int, Cut] = {}
        for attempt in range(len(DIMENSIONS)):
            asked = {}
            for n, r in stats.items():
                if n not in best or best[n].missed > TOLERANCE * r["bytes"]:
                    i = _by_width(r, whole)[attempt]
                    asked[n] = (i, r[f"min_{DIMENSIONS[i]}"], r[f"max_{DIMENSIONS[i]}"],
                                max(1, r["bytes"] * (nodes[n] // 2) // nodes[n]))
            for n, cut in weighted_cuts(rows, asked).items():
                best[n] = min(best.get(n, cut), cut, key=lambda c: c.missed)
        table = _per_node(spark, [(n, c.dim, c.place, n + nodes[n] // 2) for n, c in best.items()],
                          "node long, dim int, place long, upper long")
        cut_rows = rows.join(table, "node", "left").withColumn("node", F.when(
            _place(F.col("dim")) >= F.col("place"), F.col("upper")).otherwise(F.col("node")))
        rows = materialize(cut_rows.select(*rows.columns), "shard-level")
        # a node without rows has no cut, and its shards stay empty
        nodes = {k: v for n, s in nodes.items() if s == 1 or n in best
                 for k, v in ([(n, 1)] if s == 1 else [(n, s // 2), (n + s // 2, s - s // 2)])}
    return rows


def kd_shards(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None,
              id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: id, ``size, text_crc32, shard, slot``. Give the number of shards, or the
    bytes a shard should reach."""
    meta = materialize(with_metadata(docs, id_col, text), "shard-metadata")
    if shards is None:
        total = meta.agg(F.sum("size")).first()[0] or 0
        shards = max(1, -(-total // target_bytes))
    placed = kd_leaves(meta, shards).select("id", "size", "text_crc32", F.col("node").cast("int").alias("shard"))
    indexed = materialize(with_row_index(placed, "shard", "text_crc32", "id"), "shard-rows")
    starts = [(r["shard"], r["at"]) for r in indexed.groupBy("shard").agg(F.min("row_index").alias("at")).collect()]
    return indexed.join(_per_node(docs.sparkSession, starts, "shard int, at long"), "shard").select(
        F.col("id").alias(id_col), "size", "text_crc32", "shard",
        (F.col("row_index") - F.col("at")).cast("long").alias("slot"))
