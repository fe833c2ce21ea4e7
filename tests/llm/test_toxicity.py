"""Held-out accuracy, and the effect of the counterfactual penalty."""

from __future__ import annotations

import logging
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tariffa.llm import toxicity
from tariffa.llm.common import fold, table

FOLDER = "/root/testdata/sf0.1"
GROUPS = (("redfolk", "bluefolk", "greenfolk"),)


def biased(spark):
    """Abuse is nearly always about one group; clean texts name the others."""
    rng = random.Random(6)
    plain = [f"p{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    rows, labels = [], []
    for i in range(600):
        words, toxic = rng.choices(plain, k=20), int(i % 3 == 0)
        if toxic:
            words += ["redfolk"] if rng.random() < 0.9 else []
            words += [rng.choice(["vile", "awful", "rotten"])] if rng.random() < 0.8 else []
        elif rng.random() < 0.3:
            words.append(rng.choice(["bluefolk", "greenfolk"]))
        rng.shuffle(words)
        rows.append((i, " ".join(words), "x"))
        labels.append((i, toxic))
    return spark.createDataFrame(rows, "doc_id long, text string, label string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_swaps_reduce_false_alarms_on_neutral_mentions(spark):
    docs, labels = biased(spark)
    neutral = spark.createDataFrame([(i, f"pa{chr(97 + i % 7)} redfolk pba pca") for i in range(20)], "doc_id long, text string")
    abuse = spark.createDataFrame([(1, "pba vile paa"), (2, "rotten bluefolk redfolk")], "doc_id long, text string")
    rates = {}
    for penalty in (0.0, 3.0):
        model = toxicity.learn(docs, labels, F.lit(True), groups=GROUPS, swap_penalty=penalty)
        flagged = neutral.select(toxicity.score(model).alias("s"))
        rates[penalty] = flagged.filter("s >= 0.5").count()
    assert abuse.select(toxicity.score(model).alias("s")).filter("s >= 0.5").count() == 2
    assert rates[0.0] == 20 and rates[3.0] <= 10


def test_counterfactuals():
    found = toxicity.counterfactuals({"redfolk", "walk"}, GROUPS)
    assert sorted(map(sorted, found)) == [["bluefolk", "walk"], ["greenfolk", "walk"], ["walk"]]
    assert toxicity.counterfactuals({"walk"}, GROUPS) == []


def test_held_out_accuracy(spark):
    docs, labels = table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")
    model = toxicity.learn(docs, labels, fold("doc_id", 5) != 0)
    found = docs.join(labels, "doc_id").filter(fold("doc_id", 5) == 0).withColumn("score", toxicity.score(model))
    found = found.withColumn("hit", toxicity.verdict("score"))
    false_alarms, caught, toxic, clean = found.agg(
        *[F.count_if(F.expr(e)) for e in ("hit = 1 and toxic = 0", "hit = 1 and toxic = 1", "toxic = 1", "toxic = 0")]
    ).first()
    assert toxic > 50 and clean > 500
    assert false_alarms <= 0.01 * clean and caught >= 0.85 * toxic


def test_odd_tables(spark):
    docs = spark.createDataFrame(
        [(1, None, "a"), (2, "", "a"), (3, "vile text", "a"), (3, "vile text", "b"), (4, "kind text", "a"), (None, "kind", "a")],
        "doc_id long, text string, score string",
    )
    labels = spark.createDataFrame([(3, 1), (3, 0), (4, 0), (4, None), (2, 0), (None, 1), (99, 1)], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels, F.lit(True))
    scores = docs.select("doc_id", "text", toxicity.score(model).alias("s")).collect()
    assert all(0 <= r["s"] <= 1 for r in scores)
    assert len({r["s"] for r in scores if not r["text"]}) == 1
    assert len({r["s"] for r in scores if r["doc_id"] == 3}) == 1
    assert toxicity.learn(docs, labels.limit(0), F.lit(True)) is None
    assert [r[0] for r in docs.select(toxicity.score(None)).collect()] == [0.0] * 6
    assert docs.limit(0).select(toxicity.score(model)).count() == 0
    one_sided = toxicity.learn(docs, labels.filter("toxic = 0 and doc_id = 4"), F.lit(True))
    assert docs.filter("doc_id = 4").select(toxicity.score(one_sided)).first()[0] < 0.5


def test_fit_recovers_a_separating_word():
    rows = [(1, [0, 1]), (1, [0, 2]), (0, [1, 2]), (0, [2]), (0, [1]), (1, [0])] * 5
    weights, bias = toxicity.fit(rows, [], 3, l1=1e-3)
    assert weights[0] > 2 and bias < 0 and abs(weights[1]) < weights[0] / 2
    # a swap of the only word that tells the rows apart: both words get one weight, or none if it is dropped
    swapped = toxicity.fit([(1, [0]), (0, [])], [([0], [1])], 2, swap_penalty=50.0)[0]
    assert swapped[0] == pytest.approx(swapped[1], abs=0.1)
    assert toxicity.fit([(1, [0]), (0, [])], [([0], [])], 2, swap_penalty=50.0)[0][0] == pytest.approx(0, abs=0.1)


@pytest.mark.parametrize("penalty", [0.0, 2.0])
def test_fit_is_at_the_optimum(penalty):
    """The conditions of a minimum, from dense matrices: gradients of live weights balance the L1 term, the others stay below it."""
    rng = random.Random(3)
    size, l1 = 12, 3e-2
    rows = [(int(rng.random() < 0.3), sorted(rng.sample(range(size), 4))) for _ in range(80)]
    swaps = [([rng.randrange(6)], [6 + rng.randrange(6)]) for _ in range(15)] + [([1], [])]
    weights, bias = toxicity.fit(rows, swaps, size, l1=l1, swap_penalty=penalty, steps=20_000)
    x = np.array([[float(i in f) for i in range(size)] for _, f in rows])
    y = np.array([float(t) for t, _ in rows])
    d = np.array([[float(i in come) - float(i in gone) for i in range(size)] for gone, come in swaps])
    share = np.where(y > 0, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    residual = (1 / (1 + np.exp(-(x @ weights + bias))) - y) * share
    gradient = x.T @ residual + 2 * penalty / len(swaps) * d.T @ (d @ weights)
    live = weights != 0
    assert residual.sum() == pytest.approx(0, abs=1e-6) and live.any() and not live.all()
    assert gradient[live] == pytest.approx(-l1 * np.sign(weights[live]), abs=1e-6)
    assert (abs(gradient[~live]) <= l1 + 1e-6).all()


def test_scores_by_a_plain_scorer(spark):
    docs, labels = biased(spark)
    model = toxicity.learn(docs, labels, F.lit(True), groups=GROUPS)
    for r in docs.select("text", toxicity.score(model).alias("s")).collect():
        found = set(re.findall(r"[^\W\d_]+", r["text"].lower()))
        found |= {w[:4] + "*" for w in found if len(w) >= 4}
        assert r["s"] == pytest.approx(1 / (1 + math.exp(-model.bias - sum(model.weights.get(w, 0.0) for w in found))))


def test_swaps_are_counted_and_their_absence_is_told(spark, caplog):
    docs, labels = biased(spark)
    texts = {r["doc_id"]: set(r["text"].split()) for r in docs.collect()}
    wanted = sum(3 * len(words & set(GROUPS[0])) for words in texts.values())
    assert toxicity.learn(docs, labels, F.lit(True), groups=GROUPS).swaps == wanted > 0
    with caplog.at_level(logging.WARNING, logger=toxicity.LOG.name):
        assert toxicity.learn(docs, labels, F.lit(True), groups=()).swaps == 0
    assert "identity term" in caplog.text
