"""Targets, draws and permutations; and a mix against its own rules."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tariffa.llm import mixing

SCHEMA = "doc_id long, text string, source string, start long, block string"


def table(spark, parts=3):
    rng = random.Random(9)
    rows = []
    for i in range(500):
        name = rng.choice(["a", "a", "a", "a", "b", "c", "é", "tiny" if i % 50 == 0 else "b", None])
        rows.append((i, " ".join(f"w{j}" for j in range(rng.randrange(1, 80))), name, 0, ""))
    rows += [(900, None, "a", 0, ""), (901, "", "b", 0, ""), (902, " \n ", "only blank", 0, ""), (None, "x y z", "b", 0, "")]
    rows += [(903, "same text", "c", 0, "")] * 3 + [(904, "x " * 30_000, "a", 0, "")]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def test_targets_share_the_excess_by_weight():
    assert mixing.targets([100, 100, 100], [1, 2, 3], 3) == [50, 100, 150]
    # the third stops at 30; the rest goes 1 : 2
    assert mixing.targets([100, 100, 10], [1, 2, 3], 3) == [60, 120, 30]
    # and again, when sharing pushes another over
    assert mixing.targets([1000, 20, 10], [1, 20, 3], 3) == pytest.approx([940, 60, 30])
    assert mixing.targets([0, 5], [1, 2], 3) == [0, 5]
    assert mixing.targets([], [], 3) == []


def test_draws_meet_the_quotas():
    quotas, limits = np.array([1000.0, 2000.0, 12.0, 0.0]), np.array([3000, 2400, 12, 0])
    counts = mixing.draws(quotas, limits, 16, 1)
    assert counts.sum() == 3012 and (counts.sum(axis=0) <= limits).all()
    assert np.abs(counts.sum(axis=0) - quotas).max() <= 1
    assert len({tuple(c) for c in counts[:-1]}) > 5  # shards vary
    assert (mixing.draws(quotas, limits, 16, 1) == counts).all()


@pytest.mark.parametrize("size", [1, 2, 3, 5, 64, 65, 1000, 4097])
def test_permutations(size):
    index = np.arange(size)
    made = [mixing.permuted(index, np.full(size, size), np.full(size, k, np.uint64)) for k in (1, 2)]
    for order in made:
        assert sorted(order) == list(range(size))
    assert size < 64 or (made[0] != made[1]).any()


def test_a_mix_keeps_its_promises(spark):
    docs = table(spark)
    settings = {"block": 8, "shards": 8, "bucket_rows": 40}
    rows = mixing.mix(docs, **settings).taken().collect()
    want = {}
    sizes = sorted((r["doc_id"], len((r["text"] or "").encode().split()), r["source"]) if r["doc_id"] is not None else (-1, 3, "b") for r in docs.collect())
    assert sorted((r["id"] if r["id"] is not None else -1, r["size"]) for r in rows) == [(i, n) for i, n, _ in sizes]
    for _, n, source in sizes:
        want[source] = want.get(source, 0) + n
    names = sorted((s for s in want if s is not None), key=lambda s: s.encode()) + [None]
    goal = mixing.targets([want[s] for s in names], [float(i % 3 + 1) for i in range(len(names))], 3)
    assert {(r["number"], r["source_size"]) for r in rows} == {(i, want[s]) for i, s in enumerate(names)}
    for i, s in enumerate(names):
        own = [r for r in rows if r["number"] == i]
        assert own[0]["target"] == pytest.approx(goal[i])
        assert abs(sum(r["taken"] for r in own) - goal[i]) <= 2 * 8, s
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in rows)


def test_reruns_agree_whatever_the_partitions(spark):
    found = [
        sorted(map(tuple, mixing.mix(table(spark, n), block=8, shards=8).taken().select("id", "size", "number", "taken").collect()), key=str)
        for n in (1, 5)
    ]
    assert found[0] == found[1]


def test_mixed_documents_hold_the_words_taken(spark):
    docs = table(spark)
    plan = mixing.mix(docs, block=8, shards=4)
    out = mixing.mixed_documents(plan)
    assert out.columns == docs.columns
    words = {(r["id"], r["taken"]) for r in plan.taken().filter("taken > 0 and id < 900").collect()}
    length = F.sum(F.size(mixing.word_list("text")))
    assert {(r[0], r[1]) for r in out.filter("doc_id < 900").groupBy("doc_id").agg(length).collect()} == words
    texts = {r["doc_id"]: r["text"].split() for r in docs.filter("doc_id < 900").collect()}
    for r in out.filter("doc_id < 900").collect():
        kept = iter(texts[r["doc_id"]])
        assert all(w in kept for w in r["text"].split())  # in order


def test_empty_table(spark):
    plan = mixing.mix(spark.createDataFrame([], SCHEMA))
    assert plan.taken().count() == mixing.mixed_documents(plan).count() == 0
