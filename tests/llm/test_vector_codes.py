"""Codes, errors and codebooks against plain integers, and the masks against every entry."""

from __future__ import annotations

import math
import random
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from tariffa.llm import vector_codes

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain_codes(rows, parts=16, rounds=2):
    kept = [(i, [math.floor(256 * x) for x in v], y) for i, v, y in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    width = len(kept[0][1]) // parts
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:64]
    book = [[v[p * width : (p + 1) * width] for _, v, _ in first] for p in range(parts)]

    def nearest(v, p):
        part = v[p * width : (p + 1) * width]
        return min((sum((a - b) ** 2 for a, b in zip(part, entry, strict=True)), e) for e, entry in enumerate(book[p]))

    for _ in range(rounds):
        members = {}
        for _, v, _ in kept:
            for p in range(parts):
                members.setdefault((p, nearest(v, p)[1]), []).append(v[p * width : (p + 1) * width])
        for (p, e), own in members.items():
            book[p][e] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    digest = sha256(",".join(str(x) for part in book for entry in part for x in entry).encode()).hexdigest()
    out = [(i, [nearest(v, p) for p in range(parts)], y) for i, v, y in kept]
    totals = {}
    for _, found, y in out:
        totals[y] = totals.get(y, 0) + sum(d for d, _ in found)
    return sorted(str((i, "".join(f"{e:02x}" for _, e in f), sum(d for d, _ in f), totals[y], digest)) for i, f, y in out)


def found(df, **settings):
    out = vector_codes.encode(df, **settings)
    assert out.columns == ["id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted(str(tuple(r)) for r in out.collect())


def vectors(seed, count, size, spread):
    rng = random.Random(seed)
    return [(rng.randrange(-50, 10**6) * 2 + 1, [rng.gauss(0, spread) for _ in range(size)], rng.choice([1, 2, None])) for _ in range(count)]


@pytest.mark.parametrize("spread", [0.004, 0.1, 1e3, 2e5])
def test_against_plain_integers(spark, spread):
    """Small norms give ties and equal entries, large ones integers beyond the fast path."""
    rows = vectors(3, 300, 32, spread)
    rows += [(10**7, None, 1), (10**7 + 1, [None] * 32, 1), (10**7 + 2, [float("nan")] * 32, 1), (10**7 + 3, [float("-inf")] * 32, None)]
    rows += rows[:5] + [(None, [0.0] * 32, 1), (-1000, [0.0] * 32, None)]
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(5)) == plain_codes(rows)


def test_few_vectors_none_and_clashing_names(spark):
    rows = vectors(4, 3, 16, 1.0)
    assert found(spark.createDataFrame(rows, SCHEMA)) == plain_codes(rows)
    assert found(spark.createDataFrame([], SCHEMA)) == found(spark.createDataFrame([(1, None, 1)], SCHEMA)) == []
    extra = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("id", "vector", "own", "code", "error", "label_error")})
    assert found(extra) == plain_codes(rows)


def test_lengths_that_do_not_fit_are_errors(spark):
    with pytest.raises(ValueError):
        vector_codes.encode(spark.createDataFrame([(1, [0.0] * 17, 1)], SCHEMA))
    with pytest.raises(ValueError):
        vector_codes.encode(spark.createDataFrame([(1, [0.0] * 16, 1)], SCHEMA), entries=65)


@pytest.mark.parametrize("width", [1, 2, 4, 9])
def test_masks_hold_exactly_the_entries_of_the_box(width):
    rng = np.random.default_rng(width)
    entries = rng.integers(-20, 20, (64, width))
    slices, parts = vector_codes.Slices(entries), rng.integers(-25, 25, (500, width))
    radius = slices.radius(parts)
    inside = (np.abs(parts[:, None] - entries[None]) <= radius[:, None, None]).all(axis=2)
    want = [sum(1 << int(e) for e in np.flatnonzero(row)) for row in inside]
    assert slices.candidates(parts, radius).tolist() == want
    squared = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
    number, least = slices.nearest(parts)
    assert (number == squared.argmin(axis=1)).all() and (least == squared.min(axis=1)).all()


def test_fewer_entries_are_measured_than_there_are():
    rng = np.random.default_rng(1)
    slices, parts = vector_codes.Slices(rng.integers(-90, 90, (64, 4))), rng.integers(-90, 90, (2000, 4))
    masks = slices.candidates(parts, slices.radius(parts))
    assert np.bitwise_count(masks).mean() < 32
