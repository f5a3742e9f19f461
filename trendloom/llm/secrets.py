"""Secret scan with corpus-wide ownership frequency.

Patterns find candidate spans in every whole text. A candidate's value is hashed, and over the whole
corpus each hash is counted by the distinct owners and repositories that hold it. A value that many
owners hold, or that stands in many repositories for each of its owners, is a copied example; one that
few owners hold in few repositories, and that does not look like a placeholder, looks live. Unlabelled high-entropy strings (kind ``blob``) are reported only when they
look live; the spans of the base patterns are always reported, with their class.

Everything is DataFrame functions. Spark gives matches but no places, so a span's place is the
running length of the pieces between the matches; the running sum goes block by block, which keeps
texts with very many matches far from quadratic work. Candidates are written once, narrow; counts
are three grouped steps (hash, owner, repository), so a value in a third of all rows meets
pre-aggregated. Results are kept per digest of the text, so copies are classified once, and repeated
rows or null ids keep their own row.

Null texts count as empty and have no spans; null owners and repositories count as one owner and one
repository. Other columns are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.functions.arrays import bind
from trendloom.llm.common import sent_if_small
from trendloom.session import materialize

# The patterns, and the shortest value each kind accepts.
KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")
VALUE = r"[A-Za-z0-9+/_.=-]+"
ASSIGN = r"(?i:(" + "|".join(KEYWORDS) + r"))[\"']?\x20*[:=]\x20*[\"']?(" + VALUE + ")"
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
BLOB = r"[A-Za-z0-9+/_-]+"
LEAST = {"assign": 12, "access": 18, "hex": 16, "blob": 24}
KINDS = ("assign", "access", "hex", "blob")
PLACEHOLDER = r"(?i:example|sample|dummy|changeme|placeholder|x{4}|0{6}|123456)"
FEW_OWNERS = 2
REPOSITORIES_PER_OWNER = 100     # above it, on average over its owners, a value is a copied example
_STEP = 256

# A text without any of these has no candidate.
_ANY = (r"(?i:password|passwd|secret|token|api_?key)|AKIA|(?<![0-9a-f])[0-9a-f]{16}"
        r"|(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{24}")


def running_sums(steps: Column) -> Column:
    """Sums of the first 1, 2, ... elements of an array of integers."""
    def total(xs: Column) -> Column:
        return F.aggregate(xs, F.lit(0), lambda a, x: a + x)

    def with_offsets(xs: Column, offsets: Column) -> Column:
        return F.transform(xs, lambda _, i: F.get(offsets, (i / _STEP).cast("int")) + total(
            F.slice(xs, (i / _STEP).cast("int") * _STEP + 1, i % _STEP + 1)))

    def blocks(xs: Column) -> Column:
        sums = F.transform(F.sequence(F.lit(0), F.size(xs) - 1, F.lit(_STEP)),
                           lambda s: total(F.slice(xs, s + 1, F.lit(_STEP))))
        return bind(sums, lambda bs: bind(
            F.transform(bs, lambda _, b: total(F.slice(bs, F.lit(1), b))),
            lambda offsets: with_offsets(xs, offsets)))
    return bind(steps, lambda xs: F.when(F.size(xs) > 0, blocks(xs)).otherwise(F.array().cast("array<int>")))


def spans_of(text: Column, kind: str, pattern: str, group: int) -> Column:
    """``array<struct<start, order, kind, end, value>>`` of the leftmost non-overlapping matches whose
    value (a group of the match) is long enough; places are code points, ends exclusive."""
    found = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("whole"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"),
        F.split(text, pattern, -1).alias("between"))

    def placed(f: Column) -> Column:
        steps = F.transform(f["whole"], lambda w, i: F.length(F.get(f["between"], i)) + F.length(w))
        return bind(running_sums(steps), lambda ends: F.filter(F.transform(
            f["whole"], lambda w, i: F.struct(
                (F.get(ends, i) - F.length(w)).alias("start"), F.lit(KINDS.index(kind)).alias("order"),
                F.lit(kind).alias("kind"), F.get(ends, i).alias("end"), F.get(f["value"], i).alias("value"))),
            lambda s: F.length(s["value"]) >= LEAST[kind]))
    return bind(found, placed)


def candidate_spans(text: Column) -> Column:
    """All candidates of a text by place, then kind. Runs of a class are whole, so a lower bound in
    the pattern gives the same spans as dropping short runs afterwards; for assignments it would not,
    as a short one hides what it covers."""
    def at_least(pattern: str, n: int) -> str:
        return pattern[:-1] + f"{{{n},}}"
    blobs = F.filter(spans_of(text, "blob", at_least(BLOB, LEAST["blob"]), 0), lambda s:
                     s["value"].rlike("[0-9]") & s["value"].rlike("[a-z]") & s["value"].rlike("[A-Z]"))
    return F.array_sort(F.concat(
        spans_of(text, "assign", ASSIGN, 2), spans_of(text, "access", at_least(ACCESS, LEAST["access"] - 4), 0),
        spans_of(text, "hex", at_least(HEX, LEAST["hex"]), 0), blobs))


def ownership(found: DataFrame) -> DataFrame:
    """``hash, n_owners, n_repositories`` over all candidates of the corpus."""
    each = found.select("owner", "repository", F.explode("spans").alias("s")) \
        .select(F.col("s.hash").alias("hash"), "owner", "repository")
    by_owner = each.distinct().groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repositories"))
    return by_owner.groupBy("hash").agg(
        F.count(F.lit(1)).alias("n_owners"), F.sum("repositories").alias("n_repositories"))


def spans_per_text(docs: DataFrame, owner: str = "source", repository: str = "doc_id", text: str = "text",
                   few_owners: int = FEW_OWNERS, per_owner: int = REPOSITORIES_PER_OWNER) -> DataFrame:
    """``digest, spans`` of every distinct text that has spans to report, each with its class and counts."""
    rows = docs.select(F.col(owner).alias("owner"), F.col(repository).alias("repository"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    hashed = F.transform(candidate_spans(F.col("text")), lambda s: F.struct(
        s["start"].alias("start"), s["order"].alias("order"), s["kind"].alias("kind"), s["end"].alias("end"),
        F.sha2(s["value"], 256).alias("hash"), s["value"].rlike(PLACEHOLDER).alias("placeholder")))
    found = materialize(
        rows.where(F.col("text").rlike(_ANY))
        .select("owner", "repository", F.md5("text").alias("digest"), hashed.alias("spans"))
        .where(F.size("spans") > 0), "secret-candidates")

    each = found.groupBy("digest").agg(F.first("spans").alias("spans")) \
        .select("digest", F.explode("spans").alias("s"))
    specific = (F.col("n_owners") <= few_owners) & (F.col("n_repositories") <= per_owner * F.col("n_owners"))
    live = specific & ~F.col("s.placeholder")
    judged = each.join(ownership(found), F.col("s.hash") == F.col("hash")).select(
        "digest", F.struct("s.start", "s.order", "s.kind", "s.end", "hash", live.alias("live"),
                           "n_owners", "n_repositories").alias("s"))
    return materialize(judged.where((F.col("s.kind") != "blob") | F.col("s.live")).groupBy("digest")
                       .agg(F.array_sort(F.collect_list("s")).alias("spans")), "secret-spans")


def secret_scan(docs: DataFrame, owner: str = "source", repository: str = "doc_id", id_col: str = "doc_id",
                text: str = "text", few_owners: int = FEW_OWNERS, per_owner: int = REPOSITORIES_PER_OWNER) -> DataFrame:
    """One row per input row: id and its spans (array of structs with class and counts). ``repository``
    names a document's repository."""
    per_text = spans_per_text(docs, owner, repository, text, few_owners, per_owner)
    out = docs.select(F.col(id_col).alias("id"), F.md5(F.coalesce(F.col(text), F.lit(""))).alias("digest")) \
        .join(per_text, "digest", "left")
    spans = F.coalesce(F.col("spans"), F.array().cast(per_text.schema["spans"].dataType))
    return out.select(F.col("id").alias(id_col), spans.alias("spans"))


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_digest(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The fixed digest columns of ``secret_scan``."""
    def of(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"] != "blob")
    return scanned.select(
        id_col, of("assign"), of("access"), of("hex"), F.sha2(span_list(base), 256).alias("base_sha256"),
        span_list(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"),
        F.size(F.filter("spans", lambda s: ~s["live"])).cast("long").alias("n_copied"))


def _masked(text: Column, spans: Column, mask: str) -> Column:
    """The text with every span (in order of place) replaced once; overlapping spans count as one."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        return F.struct(
            F.when(fresh, F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mask)))
            .otherwise(acc["out"]).alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))
    return F.aggregate(spans, start, step, lambda acc: F.concat(
        acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))


def without_live_secrets(docs: DataFrame, owner: str = "source", repository: str = "doc_id", text: str = "text",
                         mask: str = "[SECRET]", few_owners: int = FEW_OWNERS,
                         per_owner: int = REPOSITORIES_PER_OWNER) -> DataFrame:
    """``docs`` with every live-looking span masked; texts without one, copied examples and all other
    columns stay as they are."""
    live = spans_per_text(docs, owner, repository, text, few_owners, per_owner) \
        .select("digest", F.filter("spans", lambda s: s["live"]).alias("__live")).where(F.size("__live") > 0)
    live = materialize(live, "secret-live")
    live = sent_if_small(live, F.size("__live") * 128 + 48).withColumnRenamed("digest", "__digest")
    joined = docs.withColumn("__digest", F.md5(F.col(text))).join(live, "__digest", "left")
    return joined.withColumn(text, F.when(F.col("__live").isNull(), F.col(text)).otherwise(
        _masked(F.col(text), F.col("__live"), mask))).select(*docs.columns)
