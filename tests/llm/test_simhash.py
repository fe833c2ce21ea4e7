"""Fingerprints, links and components against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from tariffa.llm import simhash
from tariffa.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_fingerprint(text, width=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values):
    """Smallest position that each value reaches over at most three differing bits."""
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def clustered(count, seed=5):
    """Values in chains: many are a few bits from another one."""
    rng, out = random.Random(seed), [0, 2**64 - 1]
    while len(out) < count:
        base = rng.choice(out) if rng.random() < 0.7 else rng.getrandbits(64)
        for bit in rng.sample(range(64), rng.choice([1, 2, 3, 4, 5])):
            base ^= 1 << bit
        out.append(base)
    return list(dict.fromkeys(out))


def test_gray_neighbours_differ_in_one_bit():
    values = np.arange(256, dtype=np.uint64)
    order = values[np.argsort(simhash.gray_rank(values))]
    assert all((int(a) ^ int(b)).bit_count() == 1 for a, b in zip(order, order[1:], strict=False))


@pytest.mark.parametrize("count", [2, 16, 17, 300, 900])
def test_the_index_finds_all_links(count):
    values = np.array(clustered(count), np.uint64)[:count]
    values = values[np.argsort(simhash.gray_rank(values))]
    left, right = simhash.links(values, queries=100)
    got = set(zip(left.tolist(), right.tolist(), strict=True))
    ints = [int(v) for v in values]
    assert got == {(i, j) for j in range(len(ints)) for i in range(j) if (ints[i] ^ ints[j]).bit_count() <= 3}


@pytest.mark.parametrize("crowded", [4096, 8])
def test_components_of_clustered_fingerprints(spark, crowded):
    """A small limit cuts most groups again, up to the last level."""
    values = clustered(600)
    signed = [(v - 2**64 if v >> 63 else v,) for v in values]
    found = components(simhash.linked(spark.createDataFrame(signed, "fingerprint long"), crowded, 100), "a", "b")
    root = {r["node"]: r["root"] for r in found.collect()}
    want = plain_components(values)
    groups, got = {}, {}
    for i, (s,) in enumerate(signed):
        groups.setdefault(want[i], set()).add(s)
        got.setdefault(root.get(s, s), set()).add(s)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, got.values()))


def test_documents_with_nulls_repeats_and_clashing_names(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    texts = [None, "", "one", "One two", "one two THREE", "É à", " ".join(words * 60)]
    for _ in range(12):
        text = rng.choices(words, k=120)
        texts.append(" ".join(text))
        text[5] = "changed"
        texts.append("  ".join(text).upper())
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "one", "x"), (3, "One two", "x")]
    found = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, fingerprint string"))
    got = sorted(((r["id"], r["fingerprint"] % 2**64, r["component"]) for r in found.collect()), key=str)
    values = [plain_fingerprint(t) for _, t, _ in rows]
    roots = plain_components(values)
    least = {}
    for (i, *_), root in zip(rows, roots, strict=True):
        if i is not None:
            least[root] = min(i, least.get(root, i))
    want = [(i, v, least.get(r)) for (i, *_), v, r in zip(rows, values, roots, strict=True)]
    assert got == sorted(want, key=str)
    assert found.filter("keeper").count() == len(set(roots))


def test_one_of_each_group_stays(spark):
    docs = spark.createDataFrame([(5, "a b c d", 1), (2, "A b c d", 2), (9, "quite another text here", 3)], "doc_id long, text string, root long")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 9]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).count() == simhash.keep_one(empty).count() == 0


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 500), (900, 901)], "a long, b long")
    found = {r["node"]: r["root"] for r in components(edges, "a", "b").collect()}
    assert found == {i: 0 for i in range(201)} | {900: 900, 901: 900}
