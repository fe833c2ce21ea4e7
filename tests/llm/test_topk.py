"""Best inner products against all pairs."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tariffa.llm import topk

SCHEMA = "vec_id long, embedding array<float>, vector string, score int"


def plain(rows, k):
    usable = [
        (i, [math.floor(256 * float(np.float32(x))) for x in v])
        for i, v, *_ in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = set()
    for q, a in usable:
        if q % 50:
            continue
        scored = [(-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in usable if i != q]
        out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:k], 1)}
    return out


def answer(spark, rows, k=5, **settings):
    vectors = spark.createDataFrame(rows, SCHEMA)
    found = topk.search(vectors, vectors.filter("vec_id % 50 = 0"), k, **settings)
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found.collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("settings", [{}, {"pivots": 3, "rings": 4, "chunk": 50, "block": 4, "sample": 20}])
def test_search_is_exact(spark, settings):
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 1, (6, 8))
    rows = [(i, [float(x) for x in centres[i % 6] * (1 + i % 3) + rng.normal(0, 0.1, 8)], "", 0) for i in range(600)]
    rows += [(1000 + i, [0.25] * 8, "", 0) for i in range(300)]  # one vector many times: ties
    rows += [(5000, None, "", 0), (5050, [], "", 0), (5100, [1.0] + [None] * 7, "", 0), (5150, [float("nan")] * 8, "", 0)]
    rows += [(5200, [float("inf")] * 8, "", 0), (None, [1.0] * 8, "", 0), (5250, [0.0] * 8, "", 0), (5300, [1.0, -1.0], "", 0)]
    assert answer(spark, rows, **settings) == plain(rows, 5)


@pytest.mark.parametrize("norm", [1.0, 1e3, 1e6, 1e9])
def test_scores_are_exact_integers_at_any_size(spark, norm):
    """Products beyond 2^53, near ties and repeated rows; one wide component at the largest size."""
    rng = np.random.default_rng(int(math.log10(norm)))
    width = 8 if norm < 1e9 else 1
    base = rng.normal(0, norm / 3 if norm < 1e9 else norm / 300, (40, width))
    # neighbours a few units apart, whose scores differ below the rounding of doubles
    rows = [(i, [float(np.float32(x)) for x in base[i % 40] * (1 + (i // 40) * 1e-7)], "", 0) for i in range(400)]
    rows += [(1000 + i, rows[0][1], "", 0) for i in range(30)]
    assert answer(spark, rows) == plain(rows, 5)
    assert answer(spark, rows, pivots=4, rings=6, chunk=20, block=3, sample=50) == plain(rows, 5)


def test_rounding_leaves_nothing_out():
    """Float scores that lie wrong way round are put right by integers, ties to the first row."""
    x = np.array([[2.0**31 + 1, 1.0]])
    y = np.array([[2.0**31, 3.0], [2.0**31, 5.0], [2.0**31, 4.0], [2.0**31, 5.0]])
    assert topk._top_exact(x, y, x @ y.T, 2) == ([0, 0], [1, 3], [(2**31 + 1) * 2**31 + 5] * 2)


def test_too_large_components_are_an_error(spark):
    vectors = spark.createDataFrame([(0, [1e30], "", 0), (1, [1.0], "", 0)], SCHEMA)
    with pytest.raises(ValueError, match="2\\^62"):
        topk.search(vectors, vectors, 1)
    large = spark.createDataFrame([(0, [1e15] * 4, "", 0), (1, [1e15] * 4, "", 0)], SCHEMA)
    with pytest.raises(Exception, match="does not fit a long"):
        topk.search(large, large, 1).collect()


def test_a_block_copies_only_the_pieces_it_visits(spark):
    """Two far clouds, queries in one of them: the rows of the other are never dealt to the queries' blocks."""
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in (100.0 if i % 2 else -100.0) + rng.normal(0, 1, 2)], "", 0) for i in range(400)]
    vectors = spark.createDataFrame(rows, SCHEMA)
    index = topk.build(vectors, "vec_id", "embedding", pivots=2, rings=8)
    asked = vectors.filter("vec_id = 50").select(F.col("vec_id").alias("query_id"), topk.quantised("embedding").alias("vector"), F.lit(0).alias("part"))
    visited = topk._visits(asked, index, 5, True).select("pivot").distinct().collect()
    assert len(visited) == 1
    assert answer(spark, rows) == plain(rows, 5)


def test_fewer_candidates_than_asked_for(spark):
    rows = [(0, [1.0, 0.0], "", 0), (1, [0.5, 0.5], "", 0), (50, [-1.0, 0.0], "", 0)]
    assert answer(spark, rows) == plain(rows, 5)


def test_nothing_to_search(spark):
    assert answer(spark, [(0, None, "", 0)]) == set()
    assert answer(spark, [(0, [1.0], "", 0)]) == set()


def test_bounds_leave_annuli_out():
    """Far annuli aren't visited: the point of the index."""
    rng = np.random.default_rng(2)
    points = np.r_[rng.normal(0, 1, (200, 4)), rng.normal(500, 1, (200, 4))]
    centres = topk.spread_pivots(points, 2)
    assert np.linalg.norm(centres[0] - centres[1]) > 900
