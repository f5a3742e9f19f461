"""Toxicity by weak supervision.

Many voters look at every text: lexicon voters (words and word stems that labelled rows tie to the
toxic class, dealt over ``LEXICON_VOTERS`` voters), and fixed pattern voters. Each says toxic, clean or
nothing. A generative label model explains the votes by a hidden class: expectation-maximisation gives
each voter's behaviour per class from the vote patterns of the whole corpus, held to what the labelled rows
show; pairs of voters that still agree more than the class explains are correlated, and each voter's say
shrinks by its correlations. The posterior of the label model, not the raw labels, then trains a linear
classifier over the lexicon entries and the votes, which scores every whole text.

Bounds, all parameters: ``LABELLED`` labelled texts per class (drawn by a hash of the text, expected number) and
``FITTED`` texts for the classifier reach the driver as vote strings and entry numbers, as do at most
``LEXICON`` entries and the counted vote patterns. Everything else (votes, pattern counts) covers
all rows. The model is a few thousand numbers.

Null and empty texts hold no entry and get the score of a text without any. Without labelled rows the
fixed voters alone, with assumed behaviour, give the labels. Labels of one text that differ count as toxic. Labels, language,
source and id are never part of a score.
"""
from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.llm.common import held_out, own_cache, sent_if_small
from trendloom.session import materialize

LABELLED = 6000
FITTED = 20_000
LEXICON = 600
LEXICON_VOTERS = 8
EVIDENCE = 30.0              # likelihood-ratio statistic an entry must reach
STEMS = (4, 5, 6)            # lengths of the word stems that are counted beside whole words
DENSITIES = (0.004, 0.01, 0.02)   # shares of a text's words at which an entry counts once more
COUNTED = 100_000            # entries a task counts before it hands them on
LIFT = 30                    # times an entry must be likelier in toxic texts
PRIOR = 0.1
_WORD = re.compile(r"[^\W\d_]+")

# Insults of everyday English, and patterns of abuse.
INSULTS = frozenset(("idiot idiots moron morons stupid dumb loser losers scum trash pathetic worthless disgusting "
                     "clown clowns fool fools imbecile jerk bastard garbage vermin filth freak creep").split())
_PATTERNS = (
    re.compile(r"\byou(?:'re| are)? (?:such )?(?:an? )?(?:" + "|".join(sorted(INSULTS)) + r")\b"),
    re.compile(r"\b(?:shut up|hate you|go to hell|kill yourself|get lost)\b"),
    re.compile(r"!!"),
)
_SHOUT = re.compile(r"\b[A-Z]{3,} [A-Z]{3,} [A-Z]{3,}\b")
NOTHING, TOXIC, CLEAN = "0", "1", "2"


def counted_entries(words: Counter, known: frozenset[str] | None = None) -> Counter:
    """Occurrences of words and of stems; of the ``known`` ones only, if given."""
    found = Counter({w: c for w, c in words.items() if known is None or w in known})
    for n in STEMS:
        for w, c in words.items():
            if len(w) > n:
                stem = w[:n] + "*"
                if known is None or stem in known:
                    found[stem] += c
    return found


def with_density(found: Counter, n_words: int) -> set[str]:
    """The entries, and each again for every share of the text's words that it reaches."""
    held = set(found)
    for level, share in enumerate(DENSITIES, 1):
        held.update([f"{e}~{level}" for e, c in found.items() if c >= share * n_words])
    return held


def entries_of(text: str) -> set[str]:
    """All entries a text could give the lexicon, in lower case."""
    words = Counter(_WORD.findall(text.lower()))
    return with_density(counted_entries(words), words.total())


@dataclass
class Model:
    """``lexicon`` numbers the entries; weights are those of the classifier."""
    lexicon: dict[str, int] = field(default_factory=dict)
    bias: float = float(np.log(PRIOR / (1 - PRIOR)))
    entry_weights: list[float] = field(default_factory=list)
    vote_weights: list[float] = field(default_factory=list)
    accuracy: list[float] = field(default_factory=list)
    correlation: np.ndarray | None = None

    def score(self, text: str | None, known: frozenset[str]) -> float:
        votes, entries = evidence(text or "", self.lexicon, known)
        z = self.bias + sum(self.entry_weights[e] for e in entries) + sum(
            w * _signed(v) for w, v in zip(self.vote_weights, votes))
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def _signed(vote: str) -> int:
    return {NOTHING: 0, TOXIC: 1, CLEAN: -1}[vote]


def plain_entries(lexicon: dict[str, int]) -> frozenset[str]:
    return frozenset(e.partition("~")[0] for e in lexicon)


def evidence(text: str, lexicon: dict[str, int], known: frozenset[str]) -> tuple[str, list[int]]:
    """The votes, one character per voter, and the numbers of the lexicon entries held; ``known`` are
    the ``plain_entries`` of the lexicon."""
    lower = text.lower()
    words = Counter(_WORD.findall(lower))
    held = lexicon.keys() & with_density(counted_entries(words, known), words.total())
    entries = sorted(lexicon[e] for e in held)
    said = {e % LEXICON_VOTERS for e in entries}
    votes = [TOXIC if v in said else NOTHING for v in range(LEXICON_VOTERS)]
    insulted = bool(INSULTS & words.keys())
    votes.append(TOXIC if insulted else NOTHING)
    votes += [TOXIC if p.search(lower) else NOTHING for p in _PATTERNS]
    votes.append(TOXIC if _SHOUT.search(text) else NOTHING)
    votes.append(CLEAN if not entries and not insulted else NOTHING)
    votes.append(CLEAN if len(entries) < 2 and "!" not in lower else NOTHING)
    return "".join(votes), entries


VOTERS = LEXICON_VOTERS + 1 + len(_PATTERNS) + 3


def label_model(all_votes: dict[str, float], toxic_votes: dict[str, float], clean_votes: dict[str, float],
                prior: float = PRIOR, rounds: int = 40):
    """Posterior of the toxic class per vote pattern, voter accuracies and residual correlations.

    ``all_votes`` counts patterns over the corpus; the other two count them over labelled texts and act as
    prior counts of each voter's behaviour."""
    patterns = sorted({*all_votes, *toxic_votes, *clean_votes})
    codes = np.array([[int(v) for v in p] for p in patterns], int).reshape(len(patterns), -1)
    counts = np.array([all_votes.get(p, 0.0) for p in patterns])
    known = np.array([[c.get(p, 0.0) for p in patterns] for c in (clean_votes, toxic_votes)])
    one_hot = np.eye(3)[codes]                                          # pattern x voter x vote
    if known.sum() == 0:                                                # assumed: a voter is right 4 times of 5
        per_vote = np.array([[0.90, 0.02, 0.08], [0.55, 0.40, 0.05]])
        seen = np.repeat(per_vote[:, None, :] * 100, codes.shape[1], axis=1)
    else:
        seen = np.einsum("cp,pjv->cjv", known, one_hot)
    strength = min(1.0, seen[:, 0].sum() / max(1.0, counts.sum()))       # the corpus weighs as much as the labels
    say = np.ones(codes.shape[1])

    def posterior(theta: np.ndarray) -> np.ndarray:
        logs = np.einsum("pjv,cjv,j->pc", one_hot, np.log(theta), say) + np.log([1 - prior, prior])
        odds = np.clip(logs[:, 1] - logs[:, 0], -40, 40)
        return 1 / (1 + np.exp(-odds))
    theta = (seen + 1) / (seen + 1).sum(axis=2, keepdims=True)
    for _ in range(rounds):
        p = posterior(theta)
        soft = np.stack([1 - p, p]) * counts * strength
        theta = seen + 1 + np.einsum("cp,pjv->cjv", soft, one_hot)
        theta /= theta.sum(axis=2, keepdims=True)
    p = posterior(theta)
    value = np.array([0.0, 1.0, -1.0])
    x, mean = value[codes], theta @ value                                # pattern x voter, class x voter
    share = np.stack([1 - p, p]) * (counts + known.sum(axis=0))
    centred = x[None] - mean[:, None]
    cov = np.einsum("cp,cpj,cpk->jk", share, centred, centred) / max(1.0, share.sum())
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    correlation = cov / np.outer(sd, sd)
    others = np.maximum(correlation - np.eye(len(sd)), 0).sum(axis=1)
    say = 1 / (1 + others)
    p = posterior(theta)
    spoke_right = theta[1, :, 1] * prior + theta[0, :, 2] * (1 - prior)
    spoke = spoke_right + theta[0, :, 1] * (1 - prior) + theta[1, :, 2] * prior
    return dict(zip(patterns, p.tolist())), (spoke_right / spoke).tolist(), correlation


def fit_linear(rows: list[tuple[str, list[int]]], targets: np.ndarray, entries: int, rounds: int = 400,
               ridge: float = 1e-4) -> np.ndarray:
    """Logistic regression on soft targets by accelerated gradient steps; bias, entries, votes."""
    x = np.zeros((len(rows), 1 + entries + VOTERS), np.float32)
    x[:, 0] = 1
    for i, (votes, held) in enumerate(rows):
        x[i, [1 + e for e in held]] = 1
        x[i, 1 + entries:] = [_signed(v) for v in votes]
    step = 4.0 / max(1.0, float((x * x).sum(axis=1).max()))
    w = v = np.zeros(x.shape[1], np.float32)
    for k in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ v, -40, 40)))
        moved = v - step * (x.T @ (p - targets) / len(rows) + ridge * v)
        v, w = moved + k / (k + 3) * (moved - w), moved
    return w


def _sampled(hashed: Column, share: float) -> Column:
    return F.pmod(F.xxhash64(hashed, F.lit("sample")), F.lit(1_000_000)) < int(share * 1_000_000) \
        if share < 1 else F.lit(True)


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text: str, label: str,
                    per_class: int) -> tuple[DataFrame, float]:
    """``hash, toxic`` of distinct labelled texts not held out, about ``per_class`` of each class, and the
    share of toxic ones among all of them. Only ids and hashes are joined."""
    held = docs.where(~held_out(F.col(id_col))).select(F.col(id_col).alias("id"), F.xxhash64(
        F.coalesce(F.col(text), F.lit(""))).alias("hash"))
    known = held.join(labels.select(F.col(id_col).alias("id"), F.col(label).alias("toxic"))
                      .where("toxic in (0, 1)"), "id") \
        .groupBy("hash").agg(F.max("toxic").cast("int").alias("toxic"))
    known = materialize(known, "labelled-texts")
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = {c: min(1.0, per_class / sizes[c]) for c in sizes}
    keep = F.lit(False)
    for c, s in share.items():
        keep = keep | ((F.col("toxic") == c) & _sampled(F.col("hash"), s))
    total = sum(sizes.values())
    return materialize(known.where(keep), "labelled-sample"), sizes.get(1, 0) / total if total else PRIOR


def learn_lexicon(texts: DataFrame, limit: int = LEXICON, counted: int = COUNTED) -> dict[str, int]:
    """The entries that tell the classes apart best among the sampled ``text, toxic`` rows. A task hands its counts
    on whenever it holds ``counted`` entries."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        toxic, clean = Counter(), Counter()

        def given() -> pd.DataFrame:
            both = list(toxic.keys() | clean.keys())
            counts = pd.DataFrame({"entry": pd.Series(both, dtype=object), "a": [toxic[e] for e in both], "b": [clean[e] for e in both]})
            toxic.clear()
            clean.clear()
            return counts
        for batch in batches:
            for text, label in zip(batch["text"], batch["toxic"]):
                (toxic if label else clean).update(entries_of(text))
                if len(toxic) + len(clean) > counted:
                    yield given()
        yield given()
    sizes = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return {}
    n1, n0 = float(sizes[1]), float(sizes[0])

    def part(seen: Column, size: float) -> Column:
        total = F.col("a") + F.col("b")
        return F.when(seen > 0, seen * F.log(seen / (total * (size / (n1 + n0))))).otherwise(0.0)
    told = texts.select("text", "toxic").mapInPandas(count, "entry string, a long, b long") \
        .groupBy("entry").agg(F.sum("a").alias("a"), F.sum("b").alias("b")) \
        .where(F.col("a") / n1 > LIFT * F.col("b") / n0) \
        .withColumn("told", 2 * (part(F.col("a"), n1) + part(F.col("b"), n0))).where(F.col("told") >= EVIDENCE)
    best = told.orderBy(F.desc("told"), "entry").limit(limit).collect()
    return {r["entry"]: i for i, r in enumerate(best)}


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic",
        labelled: int = LABELLED, fitted: int = FITTED, lexicon_size: int = LEXICON) -> Model:
    """Lexicon, label model and classifier from the documents and the labels of those not held out."""
    sample, prior = labelled_sample(docs, labels, id_col, text, label, labelled)
    rows = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text")) \
        .withColumn("hash", F.xxhash64("text"))
    texts = rows.join(sent_if_small(sample, 16), "hash").dropDuplicates(["hash"])    # about two times ``labelled`` rows
    lexicon = learn_lexicon(texts, lexicon_size)

    known = plain_entries(lexicon)

    @F.pandas_udf("votes string, entries array<int>")
    def voted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own_cache("toxicity", lambda: None)
        for batch in batches:
            yield pd.DataFrame([evidence(t, lexicon, known) for t in batch], columns=["votes", "entries"])
    votes = materialize(rows.select("hash", voted("text").alias("v")).select("hash", "v.*"), "toxic-votes")
    counted = votes.groupBy("votes").count().collect()        # at most the number of patterns
    if not counted:
        return Model(lexicon)
    labelled_votes = votes.dropDuplicates(["hash"]).join(sample, "hash").groupBy("votes", "toxic").count().collect()
    posterior, accuracy, correlation = label_model(
        {r["votes"]: r["count"] for r in counted},
        {r["votes"]: r["count"] for r in labelled_votes if r["toxic"] == 1},
        {r["votes"]: r["count"] for r in labelled_votes if r["toxic"] == 0}, min(max(prior, 0.001), 0.999))
    share = min(1.0, fitted / max(1, sum(r["count"] for r in counted)))
    known_too = votes.join(sent_if_small(sample.select("hash"), 16), "hash", "left_semi")
    drawn = votes.where(_sampled(F.struct("hash", "votes"), share)).unionByName(known_too) \
        .dropDuplicates(["hash"]).select("votes", "entries").collect()
    rows_ = [(r["votes"], r["entries"]) for r in drawn]
    targets = np.array([posterior[v] for v, _ in rows_], np.float32)
    w = fit_linear(rows_, targets, len(lexicon)).tolist()
    return Model(lexicon, w[0], w[1:1 + len(lexicon)], w[1 + len(lexicon):], accuracy, correlation)


def score(text: Column, model: Model) -> Column:
    """Probability that a text is toxic."""
    known = plain_entries(model.lexicon)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t, known) for t in texts], dtype="float64")
    return scored(text)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic",
             **bounds: int) -> DataFrame:
    """One row per input row: id, ``held_out, score, predicted``."""
    model = fit(docs, labels, id_col, text, label, **bounds)
    return docs.select(F.col(id_col), held_out(F.col(id_col)).alias("held_out"), score(F.col(text), model).alias("score")) \
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic",
                  **bounds: int) -> DataFrame:
    """The documents that the classifier does not reject, with all their columns."""
    model = fit(docs, labels, id_col, text, label, **bounds)
    return docs.where(score(F.col(text), model) < 0.5)
