"""Language identification by cross-parsing entropy.

Per language a suffix automaton holds every substring of a bounded training text. A text is parsed
greedily: each phrase is the longest match that the automaton has from there on. A text in the same language falls
into few, long phrases. The cost of a language is its number of phrases times the bits that point into
its training text, per character; the language with the least cost wins, the first by name among equals.

Training: of each language, the ``DOCS_PER_LANGUAGE`` distinct texts with the smallest hash, and from them
sentences in hash order up to ``TRAIN_CHARS`` characters. Only these reach the driver (languages times
``TRAIN_CHARS``), and only they are sent to the workers, which build the automata once each. Prediction is a
map over whole texts. A language is given up on as soon as it has 1.5 times the cost of the best one, where
its exact count no longer matters for the choice or the score.

Null texts and texts without a letter are ``und`` with score 0, as is everything when no row can be
learned from. Other columns are ignored, and neither language, source nor id is looked at when predicting.
"""
from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendloom.llm.common import held_out
from trendloom.session import materialize

DOCS_PER_LANGUAGE = 96
TRAIN_CHARS = 60_000
_NOT_LETTERS = re.compile(r"[\W\d_]+")
GIVE_UP = 1.5                # cost against the best one's from which the score is 1
_STEP = 2048                 # characters between two looks at whether a language is out


def letters(text: str | None) -> str:
    """Lower case, everything but letters as one blank."""
    return _NOT_LETTERS.sub(" ", (text or "").lower()).strip()


def suffix_automaton(text: str) -> dict:
    """The root of the automaton; a state is a dictionary from character to state, and every substring
    of the text is a path from the root."""
    nexts: list[dict[str, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        current = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nexts[p]:
            nexts[p][c] = current
            p = link[p]
        if p >= 0:
            q = nexts[p][c]
            if length[p] + 1 == length[q]:
                link[current] = q
            else:
                clone = len(nexts)
                nexts.append(dict(nexts[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nexts[p].get(c) == q:
                    nexts[p][c] = clone
                    p = link[p]
                link[q] = link[current] = clone
        last = current
    states: list[dict] = [{} for _ in nexts]
    for state, steps in zip(states, nexts):
        for c, to in steps.items():
            state[c] = states[to]
    return states[0]


def count_phrases(root: dict, text: str, limit: float = math.inf) -> float:
    """Phrases of the greedy parse; infinite once the count passes ``limit``."""
    n, state = 0, root
    for at in range(0, len(text), _STEP):
        for c in text[at:at + _STEP]:
            state = state.get(c)
            if state is None:
                n += 1
                state = root.get(c)
                if state is None:
                    n += 1
                    state = root
        if n > limit:
            return math.inf
    return n + (state is not root)


class CrossParser:
    def __init__(self, training: dict[str, str]) -> None:
        self.names = sorted(training)
        self.roots = {name: suffix_automaton(training[name]) for name in self.names}
        self.bits = {name: math.log2(len(training[name]) + 2) for name in self.names}

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score (0 to 1): how much more the next language costs, 1 from ``GIVE_UP`` times on."""
        plain = letters(text)
        if not self.names or not any(map(str.isalpha, plain)):
            return "und", 0.0
        probe = plain[len(plain) // 2:][:256]
        order = sorted(self.names, key=lambda name: count_phrases(self.roots[name], probe) * self.bits[name])
        costs: dict[str, float] = {}
        best = math.inf
        for name in order:
            phrases = count_phrases(self.roots[name], plain, GIVE_UP * best / self.bits[name])
            costs[name] = phrases * self.bits[name]
            best = min(best, costs[name])
        winner = min(self.names, key=lambda name: (costs[name], name))
        others = [c for name, c in costs.items() if name != winner]
        return winner, min(1.0, (min(others, default=math.inf) / best - 1) / (GIVE_UP - 1))


_parser: dict[str, CrossParser] = {}


def _worker_parser(key: str, training: dict[str, str]) -> CrossParser:
    if key not in _parser:
        _parser.clear()
        _parser[key] = CrossParser(training)
    return _parser[key]


def training_texts(docs: DataFrame, lang: str = "lang", text: str = "text",
                   docs_per_language: int = DOCS_PER_LANGUAGE, train_chars: int = TRAIN_CHARS) -> dict[str, str]:
    """Training text per language, from all rows given."""
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()) \
        .select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(text).alias("hash"))
    # a constant rank bound: every map task cuts its rows to that many per language
    first = Window.partitionBy("lang").orderBy("hash")
    chosen = materialize(rows.select("lang", "hash").distinct().withColumn("n", F.row_number().over(first))
                         .where(F.col("n") <= docs_per_language).select("lang", "hash"), "language-sample")
    texts = rows.join(F.broadcast(chosen), ["lang", "hash"]).dropDuplicates(["lang", "hash"])
    sentences = texts.select("lang", F.explode(F.split("text", r"[.!?\n]+")).alias("s")) \
        .select("lang", F.left("s", F.lit(train_chars)).alias("s")).where(F.length("s") > 1).distinct()
    # at most docs_per_language texts per language stand behind this window
    order = Window.partitionBy("lang").orderBy(F.xxhash64("s"), "s").rowsBetween(Window.unboundedPreceding, -1)
    kept = sentences.withColumn("before", F.coalesce(F.sum(F.length("s")).over(order), F.lit(0))) \
        .where(F.col("before") < train_chars).orderBy("lang", "before").collect()
    training: dict[str, list[str]] = {}
    for r in kept:
        training.setdefault(r["lang"], []).append(letters(r["s"]))
    return {name: " ".join(parts) for name, parts in training.items() if any(parts)}


def predict(text: Column, training: dict[str, str]) -> Column:
    """Struct ``lang_pred, score`` of a text column."""
    key = hashlib.sha256(repr(sorted(training.items())).encode()).hexdigest()

    @F.pandas_udf("lang_pred string, score double")
    def parsed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        parser = _worker_parser(key, training)
        for texts in batches:
            yield pd.DataFrame([parser.predict(t) for t in texts], columns=["lang_pred", "score"])
    return parsed(text)


def identify(docs: DataFrame, id_col: str = "doc_id", lang: str = "lang", text: str = "text", **bounds: int) -> DataFrame:
    """One row per input row: id, ``held_out, lang_pred, score``; learns from the rows not held out."""
    training = training_texts(docs.where(~held_out(F.col(id_col))), lang, text, **bounds)
    found = docs.select(F.col(id_col), held_out(F.col(id_col)).alias("held_out"),
                        predict(F.col(text), training).alias("p"))
    return found.select(id_col, "held_out", "p.lang_pred", "p.score")
