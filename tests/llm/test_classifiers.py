import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vellum.llm import quality, toxicity
from vellum.llm.common import held_out

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, score string, _s int, _id int, _y int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "x", 1, 2, 3) for i, t in rows], DOCS).repartition(3)


def corpus():
    """Clean, repetitive and insulting texts, with labels for most."""
    rows, labels = [], []
    for i in range(300):
        words = [f"{a}{b}" for a in ("la", "mo", "ti", "re") for b in (f"n{(i * 7) % 13}", "tra", f"s{i % 5}", "pel")]
        bad, toxic = i % 4 == 0, i % 5 == 0
        if bad:
            words = [words[0]] * 20
        if toxic:
            words.insert(i % 9, "awful" if i % 2 else "nasty")
        rows.append((i, " ".join(words) + "."))
        if i % 10:
            labels.append((i, int(not bad), int(toxic)))
    for i in range(0, 300, 5):
        labels.append((i, int(i % 4 != 0), 1))
    return rows, labels


ODD = [(1000, None), (1001, ""), (1002, " \n\t "), (None, "la mo"), (1003, "x"), (1004, "same text"), (1004, "same text"), (1005, "é" * 200_000), (1006, "word " * 100_000)]


def label_frame(spark, labels):
    return spark.createDataFrame(labels + [(None, 1, 0), (7, None, None), (8, 5, 5)], "doc_id long, quality int, toxic int")


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 3 == 1


def test_held_out_rows(spark):
    df = spark.createDataFrame([(i,) for i in [None, *range(100)]], "doc_id long").select("doc_id", held_out().alias("h"))
    assert all(r.h == held(r.doc_id) for r in df.collect())


@pytest.fixture(scope="module")
def fitted(spark):
    rows, labels = corpus()
    docs, marks = frame(spark, rows), label_frame(spark, labels)
    return rows, labels, quality.fit(docs, marks, trees=4), toxicity.fit(docs, marks)


def statistics_of(text):
    t = text or ""
    words = [w for w in __import__("re").split(r"[ \t\n\r\f\x0B]+", t) if w]
    lines = [x for x in t.split("\n") if x]
    ratio = lambda a, b: a / b if b else 0.0
    return {
        "n_words": len(words), "n_chars": len(t), "word_length": ratio(len(t), len(words)), "distinct_words": ratio(len(set(words)), len(words)),
        "adjacent_repeats": ratio(sum(a == b for a, b in zip(words, words[1:])), len(words)), "upper": ratio(sum(c.isupper() for c in t), len(t)),
        "digits": ratio(sum(c in "0123456789" for c in t), len(t)), "symbols": ratio(sum(c in "#$%&*|!@^~=<>{}\\_+" for c in t), len(t)),
        "line_length": ratio(len(t), len(lines)), "repeated_lines": ratio(len(lines) - len(set(lines)), len(lines)),
    }


def rule_score(model, text):
    s = statistics_of(text)
    total = model.intercept
    for rule, weight in model.rules:
        if all((s[n] <= v) if upper else (s[n] > v) for n, upper, v in rule.tests):
            total += weight
    return 1 / (1 + math.exp(-total))


def test_quality_scores_against_a_plain_evaluation_of_the_rules(spark, fitted):
    rows, _, model, _ = fitted
    assert model.rules and len(model.rules) < 200
    rows = rows + ODD + [(2000, "A B\nA B\n\nC!! $$ 12_3"), (2001, "ÀÉ À Éa ß 𝔘")]
    got = quality.scored(frame(spark, rows), model, keep=["doc_id", "text"])
    assert got.columns == ["doc_id", "text", "score"]
    for r in got.collect():
        assert r.score == pytest.approx(rule_score(model, r.text), abs=1e-9)
    assert quality.scored(frame(spark, rows).limit(0), model, keep=["doc_id"]).count() == 0
    assert quality.scored(frame(spark, rows), model).columns == ["doc_id", "text", "lang", "_s", "_id", "_y", "score"]
    passed = quality.accepted(frame(spark, rows), model)
    assert passed.columns == frame(spark, rows).columns
    assert passed.count() == sum(rule_score(model, t) >= 0.5 for _, t in rows)


def test_quality_learns_the_planted_difference(spark, fitted):
    rows, _, model, _ = fitted
    scores = {r.doc_id: r.score for r in quality.scored(frame(spark, rows), model, keep=["doc_id"]).collect()}
    wrong = [i for i, _ in rows if held(i) and (scores[i] >= 0.5) != (i % 4 != 0)]
    assert len(wrong) <= 2


def brute_toxicity(model, text):
    present = set()
    codes = np.array([ord(c.lower()) if c.isascii() else ord(c) for c in text or ""], np.uint32)
    for order in model.orders:
        h, _ = toxicity.ngram_hashes(codes, np.zeros(len(codes), np.int32), order, model.bits)
        present |= set(h.tolist())
    total = model.intercept + sum(w for f, w in zip(model.hashes.tolist(), model.weights.tolist()) if f in present)
    return 1 / (1 + math.exp(-total))


def test_toxicity_scores_against_a_plain_evaluation(spark, fitted):
    rows, _, _, model = fitted
    assert len(model.hashes)
    rows = rows[:60] + ODD + [(2000, "NASTY " + "x" * 2_000_000 + " awful"), (2001, "na" + "sty")]
    got = toxicity.scored(frame(spark, rows), model, keep=["doc_id", "text"]).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.score == pytest.approx(brute_toxicity(model, r.text), abs=1e-9)


def test_toxicity_learns_the_planted_words(spark, fitted):
    rows, _, _, model = fitted
    scores = {r.doc_id: r.score for r in toxicity.scored(frame(spark, rows), model, keep=["doc_id"]).collect()}
    wrong = [i for i, _ in rows if held(i) and (scores[i] >= 0.7) != (i % 5 == 0)]
    assert len(wrong) <= 2


def test_features_do_not_depend_on_slices():
    texts = ["abc def", "", None, "Ünï " * 700, "x", "abc" * 5000, "tail"]
    column = pa.array(texts, pa.string())

    def found():
        out = set()
        for rows, h in toxicity.distinct_features(column, None, bits=16):
            out |= set(zip(rows.tolist(), h.tolist()))
        return out

    whole = found()
    original = toxicity.slices
    try:
        toxicity.slices = lambda c: original(c, limit=64)
        assert found() == whole
    finally:
        toxicity.slices = original
    for i, t in enumerate(texts):
        codes = np.array([ord(c.lower()) if c.isascii() else ord(c) for c in t or ""], np.uint32)
        expected = set()
        for order in toxicity.ORDERS:
            expected |= set(toxicity.ngram_hashes(codes, np.zeros(len(codes), np.int32), order, 16)[0].tolist())
        assert {h for r, h in whole if r == i} == expected


@pytest.mark.parametrize("module", [quality, toxicity])
def test_without_usable_labels_the_score_is_the_rate(spark, module):
    docs = frame(spark, [(i, f"text {i}") for i in range(30)])
    none = label_frame(spark, []).limit(0)
    assert {r.score for r in module.scored(docs, module.fit(docs, none), keep=["doc_id"]).collect()} == {0.5}
    ones = spark.createDataFrame([(i, 1, 1) for i in range(30)], "doc_id long, quality int, toxic int")
    n = sum(not held(i) for i in range(30))
    scores = {round(r.score, 9) for r in module.scored(docs, module.fit(docs, ones), keep=["doc_id"]).collect()}
    assert scores == {round((n + 1) / (n + 2), 9)}
    assert module.scored(docs.limit(0), module.fit(docs.limit(0), ones), keep=["doc_id"]).count() == 0


@pytest.mark.parametrize("module", [quality, toxicity])
def test_labels_of_held_out_rows_and_other_columns_are_never_read(spark, module):
    rows, labels = corpus()
    flipped = [(i, 1 - q, 1 - t) if held(i) else (i, q, t) for i, q, t in labels]
    other = frame(spark, rows).withColumn("lang", F.lit("zz"))
    a = module.fit(frame(spark, rows), label_frame(spark, labels))
    b = module.fit(other, label_frame(spark, flipped))
    pick = lambda m: {r.doc_id: round(r.score, 9) for r in module.scored(frame(spark, rows), m, keep=["doc_id"]).collect()}
    assert pick(a) == pick(b)


def test_tree_paths_become_rules():
    text = """RandomForest
  Tree 0 (weight 1.0):
    If (feature 0 <= 3.5)
     If (feature 3 > 0.25)
      Predict: 0.0
     Else (feature 3 <= 0.25)
      Predict: 1.0
    Else (feature 0 > 3.5)
     Predict: 1.0
"""
    got = {r.tests for r in quality.path_rules(text)}
    assert got == {
        (("n_words", True, 3.5),), (("distinct_words", False, 0.25), ("n_words", True, 3.5)),
        (("distinct_words", True, 0.25), ("n_words", True, 3.5)), (("n_words", False, 3.5),),
    }


def test_held_out_accuracy_on_the_given_documents(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = quality.scored(docs, quality.fit(docs, labels), keep=["doc_id"]).where(held_out()).join(labels, "doc_id").collect()
    assert sum((r.score >= 0.5) == (r.quality == 1) for r in rows) / len(rows) > 0.95
