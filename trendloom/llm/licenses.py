"""License scan: an exact set-similarity join of text blocks with license templates.

A text is cut into blocks of ``2 * stride`` words that start every ``stride`` words, so any notice of
at most ``stride`` words lies whole in some block. A block meets a template when it holds at least
``threshold`` of the template's distinct words. The join finds all such pairs without comparing all:

* the template words are ordered by the number of documents that hold them, rarest first, counted
  over the whole corpus;
* prefix filter: a pair that meets the threshold shares one of the ``size - need + 1`` rarest words
  of the template, so only texts and blocks with such a word are looked at, and they meet the
  templates through that word;
* length filter: the block must hold at least ``need`` template words at all;
* positional filter: what is left behind the shared word, in either order, must still reach ``need``;
* the survivors are checked on the full sets.

The templates are a small fixed library (their words are in the plan, no corpus data is broadcast).
Nothing is shuffled but one narrow row per hit text, keyed by the digest of the text, so repeated
rows, null ids and groups of copies meet pre-aggregated hits; the join back is left to Spark, which
splits a skewed side.

Null texts count as empty: no words, no labels, score 0. A text shorter than a block is one block.
Other columns of the input, whatever their names, are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.functions.arrays import bind

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"                      # in lower-cased text
# The same for scans, in any case and character by character: the engine decides a listed character by one look-up in a
# table, but ranges one after the other, through calls that cost most of a scan. Lower-cased text holds no A-Z.
_GAPS = "".join(f"\\x{c:02X}" for c in range(128) if not chr(c).isalnum())
_LETTER, _BETWEEN = f"[^{_GAPS}]", f"[{_GAPS}]+"

# Phrases and the label each one gives wherever its words stand consecutively.
BASE_PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
# Notices as they are usually written.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("gpl-3", "licensed under the gnu general public license version 3"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0"),
    ("all-rights-reserved", "all rights reserved"),
)
STRIDE = 20
THRESHOLD = (9, 10)          # a ratio of integers, so that the bound is exact


def lower_ascii(text: Column) -> Column:
    """The text with A-Z in lower case; null becomes empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(text), F.lit(_LETTER + "+"), F.lit(0))


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(_LETTER + "+")).cast("long")


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def _holds_any(text: Column, phrases: list[str]) -> Column:
    """Whether the words of any phrase stand consecutively, in either case."""
    if not phrases:
        return F.lit(False)
    any_of = "|".join(_BETWEEN.join(p.split()) for p in phrases)
    return F.coalesce(text, F.lit("")).rlike(f"(?i)(?<!{_LETTER})(?:{any_of})(?!{_LETTER})")


def _need(size: int, threshold: tuple[int, int]) -> int:
    return max(1, -(-threshold[0] * size // threshold[1]))


def global_order(docs: DataFrame, words: list[str], text: str = "text") -> list[str]:
    """The given words, rarest first: by the number of documents that hold them, then by the word.
    Counts cover all documents; only one row per given word reaches the driver."""
    held = docs.select(F.explode(F.array_intersect(_strings(words), words_of(F.col(text)))).alias("word"))
    counts = {r["word"]: r["n"] for r in held.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    return sorted(words, key=lambda w: (counts.get(w, 0), w))


def template_index(spark, templates, order: list[str], threshold: tuple[int, int]) -> tuple[DataFrame, list[str]]:
    """One row per prefix word of each template, and the distinct prefix words."""
    rank = {w: i for i, w in enumerate(order)}
    rows = []
    for n, (label, notice) in enumerate(templates):
        words = sorted(set(notice.split()), key=rank.__getitem__)
        need = _need(len(words), threshold)
        rows += [(w, at, n, label, words, need) for at, w in enumerate(words[:len(words) - need + 1])]
    index = spark.createDataFrame(
        rows, "probe string, t_at int, template int, label string, t_words array<string>, need int")
    return index, sorted({r[0] for r in rows})


def license_blocks(docs: DataFrame, order: list[str], probes: list[str], base=BASE_PHRASES,
                   stride: int = STRIDE, text: str = "text") -> DataFrame:
    """``digest, start, words, sorted_words`` of every block of the texts that hold a base phrase or
    a probe word."""
    wanted = _holds_any(F.col(text), [p for p, _ in base]) | _holds_any(F.col(text), probes)
    cut = bind(words_of(F.col(text)), lambda ws: F.when(F.size(ws) > 0, F.transform(
        F.sequence(F.lit(0), F.size(ws) - 1, F.lit(stride)),
        lambda s: F.struct(s.cast("long").alias("start"),
                           F.slice(ws, s + 1, F.lit(2 * stride)).alias("words")))))
    return (
        docs.where(wanted)
        .select(F.md5(F.coalesce(F.col(text), F.lit(""))).alias("digest"), F.explode(cut).alias("b"))
        .select("digest", "b.start", "b.words")
        .withColumn("sorted_words", F.array_intersect(_strings(order), "words"))
    )


def base_hits(blocks: DataFrame, base=BASE_PHRASES, stride: int = STRIDE) -> DataFrame:
    """``digest, label, place``: every start of a base phrase, found in the block whose first half holds it."""
    def places(phrase: str, label: str) -> Column:
        words = phrase.split()
        at = F.filter(F.sequence(F.lit(0), F.lit(stride - 1)),
                      lambda i: F.slice("words", i + 1, F.lit(len(words))) == _strings(words))
        return F.transform(at, lambda i: F.struct(
            F.lit(label).alias("label"), (F.col("start") + i).alias("place")))
    return blocks.select("digest", F.explode(F.concat(*[places(p, l) for p, l in base])).alias("h")) \
        .select("digest", "h.label", "h.place")


def template_hits(blocks: DataFrame, index: DataFrame) -> DataFrame:
    """``digest, label, score``: the block and template pairs that meet the threshold."""
    probed = blocks.select("digest", "sorted_words", F.posexplode("sorted_words").alias("b_at", "probe"))
    left = F.least(F.size("t_words") - F.col("t_at"), F.size("sorted_words") - F.col("b_at"))
    return (
        probed.join(F.broadcast(index), "probe")
        .where((F.size("sorted_words") >= F.col("need")) & (left >= F.col("need")))
        .withColumn("shared", F.size(F.array_intersect("t_words", "sorted_words")))
        .where(F.col("shared") >= F.col("need"))
        .select("digest", "label", (F.col("shared") / F.size("t_words")).alias("score"))
    )


def license_scan(docs: DataFrame, templates=TEMPLATES, base=BASE_PHRASES, stride: int = STRIDE,
                 threshold: tuple[int, int] = THRESHOLD, id_col: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """One row per input row: id, ``n_words, n_base, first_word, last_word, base_labels, labels,
    score``. ``score`` is the best share of a template held by a block; 1 where a base phrase stands."""
    longest = max((len(n.split()) for n in [t for _, t in templates] + [p for p, _ in base]), default=0)
    if longest > stride:
        raise ValueError("stride must not be below the longest notice")
    docs = docs.select(F.col(id_col), F.col(text).alias("text"))
    vocabulary = sorted({w for _, notice in templates for w in notice.split()})
    order = global_order(docs, vocabulary)
    index, probes = template_index(docs.sparkSession, templates, order, threshold)
    blocks = license_blocks(docs.select("text"), order, probes, base, stride)
    hits = base_hits(blocks, base, stride).select("digest", "label", "place", F.lit(1.0).alias("score")) \
        .unionByName(template_hits(blocks, index).withColumn("place", F.lit(None).cast("long"))) \
        .distinct()
    found = hits.groupBy("digest").agg(
        F.count("place").alias("n_base"), F.min("place").alias("first_word"),
        F.max("place").alias("last_word"), F.max("score").alias("score"),
        _joined(F.collect_set(F.when(F.col("place").isNotNull(), F.col("label")))).alias("base_labels"),
        _joined(F.collect_set("label")).alias("labels"))
    rows = docs.select(id_col, word_count(F.col("text")).alias("n_words"),
                       F.md5(F.coalesce("text", F.lit(""))).alias("digest"))
    return rows.join(found, "digest", "left").select(
        id_col, "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
        "first_word", "last_word", F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))


def _joined(labels: Column) -> Column:
    return F.array_join(F.sort_array(labels), ",")
