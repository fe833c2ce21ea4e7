"""The quality network: its gradient against differences, its scores against a plain version, held-out accuracy, edge cases."""

from __future__ import annotations

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tariffa.llm import quality
from tariffa.llm.common import fold, table

SCHEMA = "doc_id long, text string"


def small(seed=1, width=6):
    weights = quality.start(width, 5, 4, seed)
    return quality.Network(weights | {"mean": np.full(width, 0.1), "scale": np.full(width, 0.7)})


def test_gradient_is_that_of_the_loss():
    net, rng = small(), np.random.default_rng(2)
    x, starts = rng.normal(size=(11, 6)), np.array([0, 1, 5])
    label, weight = np.array([1.0, 0.0, 1.0]), np.array([0.2, 0.5, 0.3])
    _, slope = quality.gradient(net, x, starts, label, weight)
    for name, g in slope.items():
        flat = np.atleast_1d(net.weights[name]).reshape(-1)
        for k in range(flat.size):
            losses = []
            for shift in (1e-6, -1e-6):
                moved = flat.copy()
                moved[k] += shift
                other = quality.Network(net.weights | {name: moved.reshape(np.shape(net.weights[name]))})
                losses.append(quality.gradient(other, x, starts, label, weight)[0])
            assert math.isclose((losses[0] - losses[1]) / 2e-6, np.atleast_1d(g).reshape(-1)[k], abs_tol=1e-6)


def plain_features(passage, raw, previous):
    """One passage (bytes), with the byte before it, by counting."""
    fine, coarse = [0] * quality.FINE, [0] * quality.COARSE**2
    for k, b in enumerate(raw):
        fine[quality._FINE[b]] += 1
        if k or previous is not None:
            before = raw[k - 1] if k else previous
            coarse[quality._COARSE[before] * quality.COARSE + quality._COARSE[b]] += 1
    words = passage
    told = [sum(a == b for a, b in zip(words, words[1:], strict=False)) / len(words), len(set(words)) / len(words), len(words) / quality.WORDS]
    return [math.sqrt(c / len(raw)) for c in fine + coarse] + told + [math.log1p(len(raw) / len(words))]


def plain_passages(text):
    raw = (text or "").encode()
    words = [(m.start(), m.group()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw)]
    if not words:
        return np.zeros((1, quality.FEATURES))
    cuts = [0] + [words[i][0] for i in range(quality.WORDS, len(words), quality.WORDS)] + [len(raw)]
    out = []
    for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        own = [w for _, w in words[k * quality.WORDS : (k + 1) * quality.WORDS]]
        out.append(plain_features(own, raw[a:b], raw[a - 1] if k % quality.CHUNK else None))
    return np.array(out)


def plain_score(net, text):
    p, scores, encoded = net.weights, [], []
    for x in plain_passages(text):
        h = [math.tanh(sum(w * v for w, v in zip(row, (x - p["mean"]) / p["scale"], strict=True)) + b) for row, b in zip(p["W"], p["b"], strict=True)]
        gates = [math.tanh(np.dot(v, h)) / (1 + math.exp(-np.dot(u, h))) for v, u in zip(p["V"], p["U"], strict=True)]
        scores.append(math.exp(np.dot(p["w"], gates)))
        encoded.append(h)
    z = [sum(a * h[i] for a, h in zip(scores, encoded, strict=True)) / sum(scores) for i in range(len(encoded[0]))]
    return 1 / (1 + math.exp(-(np.dot(p["c"], z) + p["d"])))


TEXTS = [None, "", " \n\t", "one", "  Deux mots\n", "A, b; c! " * 40, "ünï " * 200 + "!!", "word\n" * 700, "x" * 5000]


@pytest.mark.parametrize("chunk", [3, 4096])
def test_scores_against_a_plain_network(monkeypatch, chunk):
    monkeypatch.setattr(quality, "CHUNK", chunk)
    net = small(width=quality.FEATURES)
    for text, got in zip(TEXTS, net.scores(TEXTS), strict=True):
        assert math.isclose(got, plain_score(net, text), abs_tol=2e-6)
        weights = net.passage_weights(text)
        assert len(weights) == len(plain_passages(text)) and math.isclose(weights.sum(), 1)


def test_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = quality.learn(docs, labels, fold("doc_id", 3) != 1)
    held = docs.join(labels, "doc_id").filter(fold("doc_id", 3) == 1).select("quality", quality.score(model).alias("score")).toPandas()
    assert ((held["score"] >= 0.5) == (held["quality"] == 1)).mean() >= 0.95
    again = quality.learn(docs.repartition(5), labels, fold("doc_id", 3) != 1)
    assert np.allclose(again.weights["c"], model.weights["c"], atol=1e-9)


def test_attention_finds_the_passage_that_matters(spark):
    """Bad documents hold one bad passage among good ones."""
    good = "The quiet river ran on and nobody saw it turn. " * 7
    bad = "BUY!! NOW!! " * 32
    rows = [(i, good * (i % 4 + 1) + (bad if i % 2 else "") + good * 2) for i in range(200)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(200)], "doc_id long, quality int")
    model = quality.learn(docs, labels, F.lit(True))
    out = {r["doc_id"]: r for r in docs.select("doc_id", quality.score(model).alias("s"), quality.attention(model).alias("a")).collect()}
    assert all((out[i]["s"] >= 0.5) == (i % 2 == 0) for i in range(200))
    for i in range(1, 200, 2):
        marks = out[i]["a"]
        words = rows[i][1].split()
        share = [sum("!" in w for w in words[k * 64 : k * 64 + 64]) for k in range(len(marks))]
        assert share[int(np.argmax(marks))] > 0


def test_edge_cases(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "text here"), (4, "text here"), (4, "text here"), (5, "w " * 300_000)], SCHEMA)
    labels = spark.createDataFrame([(1, 0), (4, 1), (4, None), (None, 1), (5, 0), (9, 1)], "doc_id long, quality int")
    wide = docs.withColumns({c: F.lit("x") for c in ("content", "label", "quality", "_id", "score")})
    model = quality.learn(wide, labels, F.lit(True))
    got = sorted(map(tuple, wide.select("text", quality.score(model).alias("out")).collect()), key=str)
    assert len(got) == 6 and all(0 <= s <= 1 for _, s in got)
    assert len({s for t, s in got if t == "text here"}) == len({s for t, s in got if not t}) == 1
    one = quality.learn(docs, labels.filter("quality = 1"), F.lit(True))
    none = quality.learn(docs, labels.limit(0), F.lit(True))
    assert (one, none) == (1.0, 0.0) and docs.filter(quality.score(none) == 0).count() == 6
    assert docs.limit(0).select(quality.score(model)).count() == 0 and quality.learn(docs.limit(0), labels, F.lit(True)) == 0.0
