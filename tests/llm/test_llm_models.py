"""Language identification, toxicity, and the pipeline."""
from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from trendloom.llm import decontaminate, language, queries, toxicity
from trendloom.llm.common import held_out

SF = "/root/testdata/sf0.01"
SYLLABLES = {"aa": ["ka", "to", "ri", "mu"], "bb": ["sch", "ein", "ver", "ung"], "cc": ["ée", "oui", "ch", "aux"]}


def prose(rng, lang, words=60):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(words)).capitalize() + "."


def corpus(spark, n=240):
    rng = random.Random(9)
    rows = [(i, prose(rng, lang), lang, "s") for i in range(n) for lang in [("aa", "bb", "cc")[i % 3]]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")


# Language

@settings(max_examples=100, deadline=None)
@given(st.text("abc ", max_size=60), st.text("abcd ", max_size=60))
def test_phrases_are_the_longest_matches(training, text):
    n, at = 0, 0
    while at < len(text):
        end = at
        while end < len(text) and text[at:end + 1] in training:
            end += 1
        n += 1
        at = max(end, at + 1)
    counted = language.count_phrases(language.suffix_automaton(training), text)
    unknown = sum(c not in training for c in text)
    assert n <= counted <= n + unknown + 1


def test_every_substring_and_nothing_else_is_a_path():
    text = "abracadabra abra"
    root = language.suffix_automaton(text)
    for i in range(len(text)):
        for j in range(i + 1, len(text) + 1):
            state = root
            for c in text[i:j]:
                state = state[c]
    assert language.count_phrases(root, "dabra a") == 1 and language.count_phrases(root, "brabra") == 2


def test_held_out_texts_get_their_language(spark):
    docs = corpus(spark)
    rows = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert {r.held_out for r in rows} == {True, False}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert np.mean([r.lang == r.lang_pred for r in rows if r.held_out]) >= 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_rows(spark):
    rows = [(1, None, "aa"), (2, "", "aa"), (3, "123 !?", "aa"), (None, "kato rimu kato", None), (4, "kato rimu kato " * 40, "aa"),
            (4, "kato rimu kato " * 40, "aa"), (6, "schein verung " * 40, "bb"), (7, "schein verung " * 40, "bb")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = language.identify(docs).collect()
    assert len(found) == len(rows)
    assert {(r.doc_id, r.lang_pred) for r in found if r.doc_id in (1, 2, 3)} == {(1, "und"), (2, "und"), (3, "und")}
    assert {r.lang_pred for r in found if r.doc_id in (None, 4)} == {"aa"}
    nothing = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in language.identify(nothing).collect()} == {("und", 0.0)}
    assert language.identify(docs.limit(0)).count() == 0


def test_learning_does_not_depend_on_held_out_labels(spark):
    docs = corpus(spark, 120)
    wrong = docs.withColumn("lang", F.when(held_out(F.col("doc_id")), "zz").otherwise(F.col("lang")))
    a, b = ({r.doc_id: (r.lang_pred, r.score) for r in language.identify(d).collect()} for d in (docs, wrong))
    assert a == b


def test_giving_up_changes_neither_choice_nor_score():
    rng = random.Random(2)
    training = {lang: language.letters(prose(rng, lang, 800)) for lang in SYLLABLES}
    parser = language.CrossParser(training)
    for lang in SYLLABLES:
        text = prose(rng, lang, 900)
        plain = language.letters(text)
        costs = sorted((language.count_phrases(parser.roots[x], plain) * parser.bits[x], x) for x in SYLLABLES)
        assert parser.predict(text) == (costs[0][1], min(1.0, 2 * (costs[1][0] / costs[0][0] - 1)))


# Toxicity

def judged(spark, n=600):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(n):
        words, toxic = prose(rng, "aa", 80).split(), i % 4 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "scum", "grobmu", "grobka", "grobri"]))
        rows.append((i, " ".join(words), "s"))
        if i % 3:
            labels.append((i, int(toxic), "q"))
    return (spark.createDataFrame(rows, "doc_id long, text string, votes string"),
            spark.createDataFrame(labels, "doc_id long, toxic int, text string"))


def test_toxic_texts_are_told_apart_on_held_out_rows(spark):
    docs, labels = judged(spark)
    rows = [r for r in toxicity.classify(docs, labels).collect() if r.held_out]
    assert np.mean([r.predicted == (r.doc_id % 4 == 0) for r in rows]) >= 0.97
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)


def test_held_out_labels_are_not_learned_from(spark):
    docs, labels = judged(spark, 200)
    flipped = labels.withColumn("toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = ({r.doc_id: r.score for r in toxicity.classify(docs, x).collect()} for x in (labels, flipped))
    assert a == pytest.approx(b)


def test_toxicity_of_odd_rows(spark):
    docs, labels = judged(spark, 120)
    odd = spark.createDataFrame([(None, "you idiot", "v"), (1, None, "v"), (1, "", "v"), (2, "x" * 200_000, "v")], docs.schema)
    lost = spark.createDataFrame([(None, 1, ""), (1, None, ""), (5, 7, "")], labels.schema)
    out = toxicity.classify(docs.unionByName(odd), labels.unionByName(lost)).collect()
    assert len(out) == 124 and all(r.score is not None for r in out)
    assert toxicity.classify(docs.limit(0), labels).count() == 0
    unlabelled = {r.doc_id: r.score for r in toxicity.classify(docs, labels.limit(0)).collect()}
    insulted = {r.doc_id for r in docs.where("text like '%idiot%' or text like '%scum%'").collect()}
    assert min(unlabelled[i] for i in insulted) > max(s for i, s in unlabelled.items() if i not in insulted)


def test_the_label_model_finds_accuracies_and_correlations():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.3
    rates = [(0.8, 0.05), (0.6, 0.10), (0.5, 0.02), (0.5, 0.02)]
    votes = [np.where(truth, rng.random(truth.size) < a, rng.random(truth.size) < b) for a, b in rates]
    votes[3] = votes[2]                                        # a copy adds nothing
    patterns = ["".join("1" if v[i] else "0" for v in votes) for i in range(truth.size)]
    count = lambda keep: {p: float(n) for p, n in zip(*np.unique([x for x, k in zip(patterns, keep) if k], return_counts=True))}
    known = np.arange(truth.size) < 2000
    posterior, accuracy, correlation = toxicity.label_model(
        count(~known), count(known & truth), count(known & ~truth), 0.3)
    assert correlation[2, 3] > 0.9 and abs(correlation[0, 1]) < 0.2
    assert accuracy[0] > accuracy[1] and accuracy[2] > 0.85
    assert np.mean([(posterior[p] >= 0.5) == t for p, t in zip(patterns, truth)]) > 0.88


# Pipeline

def test_every_stage_against_plain_python(spark):
    docs = queries.table(spark, SF, "documents")
    kept = {}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "near_dedup", "decontamination", "secrets", "bpe"]
    small = docs.where("length(text) < 1500")
    now = small
    for name, stage in corpus_pipeline.STAGES[:4]:
        before = {r.doc_id: r for r in now.collect()}
        now = spark.createDataFrame(stage(spark, now, SF).collect(), docs.schema)
        after = {r.doc_id: r for r in now.collect()}
        assert now.columns == docs.columns and set(after) <= set(before)
        kept[name] = (before, after)
    before, after = kept["near_dedup"]
    assert set(after) == {i for i, c in groups(before).items() if i == c}
    before, after = kept["decontamination"]
    matcher = decontaminate.Matcher([(r.item_id, r.text) for r in queries.table(spark, SF, "benchmark").collect()])
    assert set(before) - set(after) == {i for i, r in before.items() if matcher.find(decontaminate.normal(r.text))}
    exact = [decontaminate.normal(t) for _, t in matcher.items]
    assert not [i for i, r in after.items() if any(t in decontaminate.normal(r.text) for t in exact)]
    before, after = kept["secrets"]
    assert set(before) == set(after)
    for i, r in after.items():
        assert r.n_chars == len(r.text) and (r.text == before[i].text or "[SECRET]" in r.text)
        assert not re.search("AKIA[A-Z0-9]{14,}", r.text) or "AKIA" in before[i].text
    import public_tokenizers
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in stages["bpe"](spark, now, SF).collect():
        assert r.n_tokens == len(library.encode(after[r.doc_id].text, add_special_tokens=False).ids)


def groups(rows):
    sets = {}
    for i, r in rows.items():
        w = (r.text or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    held = {}
    for i, s in sets.items():
        for g in s:
            held.setdefault(g, []).append(i)
    least = {i: i for i in rows}

    def root(i):
        while least[i] != i:
            i = least[i]
        return i
    for a, s in sets.items():
        for b in {x for g in s for x in held[g] if x > a}:
            both = len(s & sets[b])
            if 5 * both >= 4 * (len(s) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                least[y] = x
    return {i: root(i) for i in rows}


def test_clean_documents_stay(spark):
    docs = queries.table(spark, SF, "documents")
    left = {r.doc_id for r in corpus_pipeline.toxicity(spark, docs, SF).select("doc_id").collect()}
    labels = queries.table(spark, SF, "labels").collect()
    clean = {r.doc_id for r in labels if r.toxic == 0}
    assert len(clean & left) / len(clean) >= 0.98


def test_pipeline_of_an_empty_table(spark):
    now = queries.table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, SF)
    assert now.count() == 0


def test_counts_handed_on_in_pieces_give_the_same_lexicon(spark):
    rng = random.Random(8)
    rows = [(" ".join(rng.choices(["badword", "worse"] if i % 2 else ["fine", "good"], k=4) + rng.choices("abcdefgh", k=9)), i % 2)
            for i in range(200)]
    texts = spark.createDataFrame(rows, "text string, toxic int")
    assert toxicity.learn_lexicon(texts, counted=7) == toxicity.learn_lexicon(texts) != {}
