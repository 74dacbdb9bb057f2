"""The classifier's features, loss and probabilities against plain numpy."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.feature import StopWordsRemover
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from arborlit.operators import classify

TOPICS = {"chem": "acid base salt reaction bond acid molecule", "gene": "gene allele genome exon gene transcript", "cell": "cell membrane nucleus cell tissue organ"}


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    out = []
    for k in range(180):
        label = list(TOPICS)[(k % 10 > 4) + (k % 10 > 7)]  # of unequal sizes
        other = " ".join(TOPICS.values()).split()
        own = TOPICS[label].split()
        text = " ".join(rng.choice(own if rng.random() < 0.6 else other) for _ in range(8)) + " and the of"
        out.append((str(k), text.title(), "", f"{'S' if rng.random() < 0.7 else 'T'}{label} | Any | ", label if k % 9 else ""))
    return out


@pytest.fixture(scope="module")
def trained(spark, rows):
    docs = spark.createDataFrame(rows, "pmid string, title_e string, abstract string, subjects string, hard_category string")
    return docs, classify.train(docs, "hard_category")


def plain_features(rows, fit, words, subjects):
    """TF-IDF of one and two words, rows of length one, then an indicator a subject."""
    stop = set(StopWordsRemover.loadDefaultStopWords("english"))
    terms = {}
    for pmid, text, *_ in rows:
        w = [x for x in re.findall(r"\b\w\w+\b", text.lower()) if x not in stop]
        terms[pmid] = Counter(w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)])
    df = Counter(t for p in fit for t in terms[p])
    assert set(words) == {t for t, n in df.items() if n >= 2}
    idf = {t: math.log((len(fit) + 1) / (df[t] + 1)) for t in words}
    out = {}
    for pmid, _, _, named, _ in rows:
        v = np.array([terms[pmid][t] * idf[t] for t in words])
        out[pmid] = np.concatenate((v / (np.linalg.norm(v) or 1.0), [float(s in named.split(" | ")) for s in subjects]))
    return out


def test_model_against_numpy(spark, rows, trained):
    docs, model = trained
    stages = model.model.stages
    counts = [s for s in stages if s.hasParam("minDF")]
    logistic = next(s for s in stages if s.hasParam("regParam"))
    prepared = classify.prepared(docs).withColumn("__label", F.lit("chem")).withColumn("__weight", F.lit(1.0))
    done = model.model.transform(prepared).withColumn("__test", F.pmod(F.xxhash64("pmid", F.lit(42)), F.lit(5)) == 0)
    got = {r.pmid: r for r in done.select("pmid", "__test", vector_to_array("__features").alias("x"), vector_to_array("probability").alias("p"), "__predicted", "hard_category").collect()}
    fit = [p for p, *_, label in rows if label and not got[p]["__test"]]
    mine = plain_features(rows, fit, counts[0].vocabulary, counts[1].vocabulary)
    for pmid, r in got.items():
        np.testing.assert_allclose(r.x, mine[pmid], atol=1e-9)
    coef, bias = logistic.coefficientMatrix.toArray(), logistic.interceptVector.toArray()
    for pmid, r in got.items():  # softmax of the linear scores
        z = coef @ mine[pmid] + bias
        p = np.exp(z - z.max())
        np.testing.assert_allclose(r.p, p / p.sum(), atol=1e-9)
    # the fitted point is the minimum of the weighted cross-entropy with its penalty: no plain step goes lower
    label = {p: model.labels.index(x) for p, *_, x in rows if x}
    x, y = np.array([mine[p] for p in fit]), np.array([label[p] for p in fit])
    size = Counter(y.tolist())
    w = np.array([len(y) / (len(size) * size[k]) for k in y.tolist()])  # classes count alike, however many they are
    mean = (w[:, None] * x).sum(0) / w.sum()
    std = np.sqrt((w[:, None] * (x - mean) ** 2).sum(0) / (w.sum() - (w**2).sum() / w.sum()))

    def loss(c, b):
        z = x @ c.T + b
        z -= z.max(1, keepdims=True)
        p = np.exp(z) / np.exp(z).sum(1, keepdims=True)
        g = p.copy()
        g[np.arange(len(y)), y] -= 1
        g *= w[:, None] / w.sum()
        return -(w * np.log(p[np.arange(len(y)), y])).sum() / w.sum() + 0.5e-4 * ((c * std) ** 2).sum(), g.T @ x + 1e-4 * c * std**2, g.sum(0)

    here, dc, db = loss(coef, bias)
    assert abs(dc).max() < 1e-3 and abs(db).max() < 1e-3
    c, b, best = coef.copy(), bias.copy(), here
    for _ in range(3000):
        _, dc, db = loss(c, b)
        c, b = c - 0.5 * dc, b - 0.5 * db
        best = min(best, loss(c, b)[0])
    assert here - best < 1e-3
    assert here < math.log(3) / 3


def test_predictions_and_report_are_those_values(rows, trained):
    docs, model = trained
    told = {r.pmid: r for r in classify.predict(model, docs, "hard_category").collect()}
    assert set(told) == {p for p, *_, label in rows if not label}
    prepared = classify.prepared(docs).withColumn("__label", F.lit("chem")).withColumn("__weight", F.lit(1.0))
    p = {r.pmid: r.p for r in model.model.transform(prepared).select("pmid", vector_to_array("probability").alias("p")).collect()}
    for pmid, r in told.items():
        assert r.hard_category_predicted == model.labels[int(np.argmax(p[pmid]))]
        assert r.hard_category_predicted_confidence == pytest.approx(max(p[pmid]), abs=5.1e-4)
    held = [(label, model.labels[int(np.argmax(p[x]))]) for x, *_, label in rows if label and docs.where(F.col("pmid") == x).select(F.pmod(F.xxhash64("pmid", F.lit(42)), F.lit(5)) == 0).first()[0]]
    for r in model.report.collect():
        right = sum(a == b == r.label for a, b in held)
        chosen, support = sum(b == r.label for _, b in held), sum(a == r.label for a, _ in held)
        assert r.support == support and r.precision == pytest.approx(right / chosen if chosen else 0) and r.recall == pytest.approx(right / support if support else 0)
    assert sum(a == b for a, b in held) / len(held) > 0.8


@pytest.mark.parametrize("size", [5, 40, 8000])
def test_vocabulary_is_that_of_a_plain_count_and_pairs_out_of_reach_are_not_shuffled(spark, monkeypatch, size):
    """The most frequent words and pairs in two texts at least; only pairs of words more frequent than the last of ``size`` words are counted."""
    rng = np.random.default_rng(5)
    words = ["Éclair", "l", "42", "gène", "_x", "THE", *(f"w{k}" for k in range(40))]
    texts = [" ".join(rng.choice(words, p=(p := 1 / np.arange(1, len(words) + 1)) / p.sum()) for _ in range(rng.integers(0, 60))) for _ in range(600)] + ["", "once only-once"]
    stop, often, within = set(StopWordsRemover.loadDefaultStopWords("english")), Counter(), Counter()
    terms = {}
    for text in texts:
        w = [x for x in re.findall(r"\b\w\w+\b", text.lower()) if x not in stop]
        terms[text] = Counter(w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)])
        often.update(terms[text])
        within.update(set(terms[text]))
    want = sorted((t for t in often if within[t] >= 2), key=lambda t: (-often[t], " " in t, t))[:size]
    frequent = []
    monkeypatch.setattr(classify, "_pairs", lambda known, most, f=classify._pairs: frequent.append(most) or f(known, most))
    rows = spark.createDataFrame([(x,) for x in texts], "__text string").repartition(5)
    counts = classify.word_counts(rows, size)
    assert counts.vocabulary == want
    assert frequent[0] < size
    for r in counts.transform(rows).collect():
        got = {want[k]: n for k, n in zip(r["__counts"].indices.tolist(), r["__counts"].values.tolist(), strict=True)}
        assert got == {t: n for t, n in terms[r["__text"]].items() if t in set(want)}


def test_two_classes_have_the_minimum_of_the_softmax_and_no_class_of_unknown_labels(spark, rows):
    docs = spark.createDataFrame([r for r in rows if r[4] != "cell"], "pmid string, title_e string, abstract string, subjects string, hard_category string")
    model = classify.train(docs, "hard_category").model
    logistic = next(s for s in model.stages if s.hasParam("regParam"))
    assert logistic.numClasses == 2
    done = model.transform(classify.prepared(docs).withColumn("__label", F.col("hard_category")).withColumn("__weight", F.lit(1.0)))
    done = done.withColumn("__test", F.pmod(F.xxhash64("pmid", F.lit(42)), F.lit(5)) == 0)
    got = {r.pmid: r for r in done.select("pmid", "__test", "__label", vector_to_array("__features").alias("x"), vector_to_array("probability").alias("p")).collect()}
    fit = [r for r in got.values() if r["__label"] and not r["__test"]]
    x, y = np.array([r.x for r in fit]), np.array([r["__label"] == "gene" for r in fit]).astype(int)
    w = len(y) / (2 * np.bincount(y)[y])
    mean = (w[:, None] * x).sum(0) / w.sum()
    std = np.sqrt((w[:, None] * (x - mean) ** 2).sum(0) / (w.sum() - (w**2).sum() / w.sum()))
    c, b = logistic.coefficients.toArray() / 2 * np.array([[-1], [1]]), logistic.intercept / 2 * np.array([-1, 1])
    p = np.exp(x @ c.T + b)
    p /= p.sum(1, keepdims=True)
    np.testing.assert_allclose([r.p for r in fit], p, atol=1e-9)
    p[np.arange(len(y)), y] -= 1
    g = p * w[:, None] / w.sum()
    assert abs(g.T @ x + 1e-4 * c * std**2).max() < 1e-3 and abs(g.sum(0)).max() < 1e-3  # of the softmax with a vector for each class
