"""The quality classifier: held-out accuracy, its parts by brute force, and awkward input."""

import zlib

import numpy as np
import pytest
from cases import awkward, empty, prose

from tickloom.llm import catalogue, classifier
from tickloom.llm.classifier import classify

FOLDER = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int, text string, score double"


def area(scores, labels):
    """Share of pairs of either class that are in the right order."""
    order = np.argsort(scores, kind="stable")
    ranks = np.empty(len(scores))
    for value in np.unique(scores):
        same = np.flatnonzero(np.array(scores)[order] == value)
        ranks[order[same]] = same.mean()
    labels = np.array(labels)
    ones = labels.sum()
    return (ranks[labels == 1].sum() - ones * (ones - 1) / 2) / (ones * (len(labels) - ones))


def test_held_out_documents_are_told_apart(spark):
    rows = catalogue.queries()["op11_quality_classifier"](spark, FOLDER).collect()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    assert sorted(r.doc_id for r in rows) == sorted(d.doc_id for d in docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    known = [(r.score, quality[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in quality]
    assert len(known) > 100
    assert area([s for s, *_ in known], [q for _, q, _ in known]) > 0.97
    assert np.mean([q == p for _, q, p in known]) > 0.95


def test_held_out_labels_are_not_learned(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    turned = labels.selectExpr(
        "doc_id", "if(crc32(string(doc_id)) % 3 = 1, 1 - quality, quality) AS quality", "toxic"
    )
    scores = lambda l: {r.doc_id: r.score for r in classify(docs, l).collect()}
    assert scores(labels) == pytest.approx(scores(turned), abs=1e-9)


def test_indicators_are_all_ngrams_of_the_text():
    codes = classifier._Codes()
    text = "The cat,\nthe CAT ### the cat"
    tokens = ["the", "cat", ",", "\n", "the", "cat", "###", "the", "cat"]
    of = lambda t: zlib.crc32(t.encode())
    single = {of(t) for t in tokens}
    pairs = {(of(a) * 0x100000001B3 + of(b) + 1) % 2**64 for a, b in zip(tokens, tokens[1:])}
    expected = {(c * 0x9E3779B97F4A7C15 % 2**64 >> 40) % classifier.BUCKETS for c in single | pairs}
    assert set(classifier.indicators(text, codes).tolist()) == expected
    assert len(classifier.indicators(None, codes)) == len(classifier.indicators(" ", codes)) == 0


def test_descent_finds_the_least_loss():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 4))
    signs = np.sign(x @ [1.0, -2, 0.5, 0] + 0.3 + rng.normal(size=60))
    rows = [(np.arange(4), row) for row in x]
    weights, intercept = classifier.fit_hinge(rows, signs, np.full(60, 1.0), 4)

    def loss(w, b):
        return (w @ w + b * b) / 2 + np.maximum(0, 1 - signs * (x @ w + b)).sum()

    least = loss(weights, intercept)
    for _ in range(2000):
        step = rng.normal(size=5) * rng.choice([0.3, 0.03, 0.003])
        assert loss(weights + step[:4], intercept + step[4]) > least - 0.05


def test_log_ratios_count_every_labelled_row(spark):
    rows = [(i, i % 3 == 0, [1, 2] if i % 3 else [2, 5]) for i in range(90)]
    features = spark.createDataFrame([(i, int(l), p) for i, l, p in rows], "pick long, label int, places array<int>")
    ratios = classifier._log_ratios(features.repartition(5))
    low = {1: 60, 2: 60, 5: 0}
    high = {1: 0, 2: 30, 5: 30}
    for place in (0, 1, 2, 5):
        share = [(c.get(place, 0) + 1) / (sum(c.values()) + classifier.BUCKETS) for c in (low, high)]
        assert ratios[place] == pytest.approx(np.log(share[1] / share[0]))


def test_sample_keeps_within_both_bounds(spark):
    rows = [(7 if i < 50 else i, 1, list(range(10))) for i in range(100)]
    features = spark.createDataFrame(rows, "pick long, label int, places array<int>")
    assert len(classifier._sample(features, 30, 10**6)) == 30
    assert len(classifier._sample(features, 100, 255)) == 25
    assert classifier._sample(features, 100, 5) == []


def labels_of(spark, rows):
    return spark.createDataFrame(rows, LABELS)


def test_awkward_documents(spark):
    rows = [(1, 1, 0, "t", 0.5), (2, 0, 0, "t", 0.5), (3, None, 0, None, None), (None, 1, 0, "t", 1.0)]
    rows += [(5, 1, 0, "t", 0.5), (5, 0, 0, "t", 0.5), (6, 1, 0, "t", 0.5), (7, 0, 0, "t", 0.5), (8, 7, 0, "t", 0.5)]
    docs = awkward(spark)
    got = classify(docs, labels_of(spark, rows)).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r.doc_id) for r in docs.collect())
    of = lambda i: {r.score for r in got if r.doc_id == i}
    assert of(3) == of(4) and len(of(3)) == len(of(5)) == 1
    assert len(of(2)) == 1 and all(0 <= r.score <= 1 for r in got)
    assert classify(empty(spark), labels_of(spark, rows)).collect() == []


def test_without_both_classes_all_scores_are_equal(spark):
    docs = spark.createDataFrame([(i, prose(i, 20)) for i in range(30)], "doc_id long, text string")
    learned = [i for i in range(30) if zlib.crc32(str(i).encode()) % 3 != 1]
    ones = classify(docs, labels_of(spark, [(i, 1, 0, "t", 0.0) for i in range(30)])).collect()
    assert {round(r.score, 9) for r in ones} == {round((len(learned) + 1) / (len(learned) + 2), 9)}
    none = classify(docs, labels_of(spark, [])).collect()
    assert {r.score for r in none} == {0.5} and {r.predicted for r in none} == {1}
