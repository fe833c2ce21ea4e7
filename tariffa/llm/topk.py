"""Exact top-k by inner product over a pivot-distance index.

Every vector x gets one more coordinate, sqrt(M^2 - |x|^2) with M the largest norm, and every query q a zero:
then |q - x|^2 = |q|^2 + M^2 - 2 q.x, and the best inner product is the nearest point.  A vector is keyed by its nearest
pivot and its distance to it; the keys are cut into annuli.  A query meets the annuli in the order of their lower
bounds |d(q, pivot) - d(x, pivot)|: first the nearest ones that hold enough vectors for a full answer, then all those the triangle
inequality cannot exclude against the k-th score found so far.  The search stops where the bound does, so the answer is exact.

Pivots come from a bounded sample (``sample`` vectors, by hash); every vector is indexed.  The table of annuli is bounded by
``pivots`` x ``rings`` and is the only thing sent to all tasks.  A crowded annulus (one vector repeated many times, say)
is dealt into chunks of about ``chunk`` rows, and queries are dealt into blocks as well.

Scores are exact integers.  By Cauchy and Schwarz no partial sum of products exceeds the product of both norms; up to 2^53 doubles hold
all of them.  Beyond, doubles only choose the candidates, all those whose score may reach the k-th within the rounding of a sum of products,
and Python integers score them.  A component from 2^62 on, or a best score beyond a long, is an error.  The bounds allow for rounding too:
the annuli's distances are taken wider by what a rounded square can move a square root.

A block of queries and the pieces of annuli that one of them visits meet in one task; pieces that no query of the block visits are not
copied for it.

Vectors that are null or hold a null or non-finite component, and rows without identifier, take no part.  Shorter vectors count as
padded with zeros.  Candidates sharing a query's identifier are left out, repeated queries are asked once, ties go to the smaller
identifier, and an empty table gives an empty result.  Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tariffa.llm.common import collectable
from tariffa.sources.sinks import stored

SCALE = 256
UNIT = 2.0**-53  # of rounding
EXACT = 2.0**53  # integers up to here are exact in doubles
LARGEST = 2.0**62
QUERIES_PER_TASK = 64


def quantised(vector: str, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component as long; null if the vector takes no part."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~F.coalesce(bad, F.lit(True)), F.transform(wide, lambda x: F.floor(x * scale)))


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    if len(vectors) and min(map(len, vectors)) == width:
        return np.stack(list(vectors)).astype(np.float64)
    out = np.zeros((len(vectors), width))
    for row, vector in zip(out, vectors, strict=True):
        row[: len(vector)] = vector
    return out


def _loose(width: int, norms: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """What rounding moves a bound of distance by at most, and a bound of score, for queries of these norms.

    A square of a distance is off by a few units for each of ``width`` terms, relative to the squares of the norms; its root, and the
    added coordinate, which is a root as well, by no more than the root of that.
    """
    size = norms + np.sqrt(reach)
    relative = 8 * (width + 4) * UNIT
    return 4 * np.sqrt(relative) * size, relative * size * size


def _augmented(x: np.ndarray, reach: float) -> np.ndarray:
    return np.c_[x, np.sqrt(np.maximum(reach - (x * x).sum(axis=1), 0.0))]


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1)[None, :] - 2 * x @ pivots.T
    return np.sqrt(np.maximum(square, 0.0))


def spread_pivots(points: np.ndarray, count: int) -> np.ndarray:
    """Points far from each other: each new one is the farthest from those chosen."""
    chosen = [0]
    nearest = _distances(points, points[:1])[:, 0]
    while len(chosen) < min(count, len(points)) and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, _distances(points, points[chosen[-1:]])[:, 0])
    return points[chosen]


def _check_size(largest: float | None) -> None:
    if (largest or 0.0) >= LARGEST:
        raise ValueError("components are too large: floor(256 * x) must stay below 2^62")


class Index:
    """The indexed vectors (id, vector, pivot, ring, piece) and the bounded table of annuli."""

    def __init__(self, rows: DataFrame, pivots: np.ndarray, annuli: pd.DataFrame, width: int, reach: float):
        self.rows, self.pivots, self.annuli, self.width, self.reach = rows, pivots, annuli, width, reach


def build(
    vectors: DataFrame, id: str, vector: str, pivots: int = 32, rings: int = 32, sample: int = 2048, chunk: int = 4096
) -> Index | None:
    """Key every vector by its nearest pivot and distance; None if no vector takes part."""
    clean = stored(
        vectors.select(F.col(id).cast("long").alias("id"), quantised(vector).alias("vector")).filter(
            "id is not null and vector is not null"
        ),
        "vectors",
    )
    norm = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    largest = F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double"))))
    reach, width, most = clean.agg(F.max(norm), F.max(F.size("vector")), F.max(largest)).first()
    if reach is None:
        return None
    _check_size(most)
    # no norm is above it, however it was rounded
    reach *= 1 + 4 * (width + 2) * UNIT
    some = clean.orderBy(F.xxhash64("id"), "id").limit(sample).toPandas()
    centres = spread_pivots(_augmented(_matrix(some["vector"], width), reach), pivots)
    # no point is farther from a pivot than twice the largest norm
    step = max(2 * np.sqrt(reach) / rings, 1e-9)

    def key(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            away = _distances(_augmented(_matrix(frame["vector"], width), reach), centres)
            pivot = away.argmin(axis=1)
            distance = away[np.arange(len(away)), pivot]
            yield frame.assign(pivot=pivot.astype(np.int32), distance=distance, ring=(distance / step).astype(np.int32))

    keyed = stored(
        clean.mapInPandas(key, "id long, vector array<long>, pivot int, distance double, ring int"), "keyed"
    )
    found = keyed.groupBy("pivot", "ring").agg(
        F.min("distance").alias("low"), F.max("distance").alias("high"), F.count(F.lit(1)).alias("rows")
    )
    annuli = pd.DataFrame(
        [r.asDict() for r in collectable(found, pivots * (rings + 2), "annuli")], columns=["pivot", "ring", "low", "high", "rows"]
    ).sort_values(["pivot", "ring"], ignore_index=True)
    annuli["pieces"] = np.ceil(annuli["rows"] / chunk).astype(int)
    sizes = vectors.sparkSession.createDataFrame(annuli[["pivot", "ring", "pieces"]])
    dealt = keyed.join(F.broadcast(sizes), ["pivot", "ring"]).withColumn(
        "piece", F.pmod(F.xxhash64("id", "vector"), F.col("pieces")).cast("int")
    )
    return Index(dealt.drop("pieces", "distance"), centres, annuli, width, reach)


def _visits(queries: DataFrame, index: Index, k: int, first: bool) -> DataFrame:
    """The annuli each query has to meet: the first ones, or those left that may still hold a better vector."""
    pivots, width, reach, annuli = index.pivots, index.width, index.reach, index.annuli
    owner = annuli["pivot"].to_numpy()
    low, high, rows, pieces = (annuli[c].to_numpy() for c in ("low", "high", "rows", "pieces"))
    enough = 2 * k + 1

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            x = _matrix(frame["vector"], width)
            square = (x * x).sum(axis=1)[:, None]
            far, off = _loose(width, np.sqrt(square), reach)
            away = _distances(np.c_[x, np.zeros(len(x))], pivots)[:, owner]
            bound = np.maximum(0.0, np.maximum(low - away, away - high) - far)
            order = np.argsort(bound, axis=1, kind="stable")
            before = np.cumsum(rows[order], axis=1) - rows[order]
            opening = np.zeros_like(order, bool)
            np.put_along_axis(opening, order, before < enough, axis=1)
            if first:
                wanted = opening
            else:
                best = (square + reach - bound * bound) / 2 + off
                floor = frame["floor"].to_numpy(dtype=float)
                wanted = ~opening & (np.isnan(floor)[:, None] | (best >= floor[:, None]))
            query, annulus = np.nonzero(wanted)
            query, annulus = (np.repeat(v, pieces[annulus]) for v in (query, annulus))
            starts = np.flatnonzero(np.r_[True, (query[1:] != query[:-1]) | (annulus[1:] != annulus[:-1])]) if len(query) else query
            piece = np.arange(len(query)) - np.repeat(starts, np.diff(np.r_[starts, len(query)]))
            out = frame.iloc[query][["query_id", "vector", "part"]].reset_index(drop=True)
            yield out.assign(
                pivot=owner[annulus].astype(np.int32), ring=annuli["ring"].to_numpy()[annulus].astype(np.int32), piece=piece.astype(np.int32)
            )

    return queries.mapInPandas(run, "query_id long, vector array<long>, part int, pivot int, ring int, piece int")


def _top(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row of scores the k largest finite ones: row, place and score; of equal ones the first."""
    top = np.argsort(-scores, axis=1, kind="stable")[:, :k]
    value = np.take_along_axis(scores, top, axis=1)
    row, rank = np.nonzero(np.isfinite(value))
    return row, top[row, rank], value[row, rank]


def _top_exact(x: np.ndarray, y: np.ndarray, scores: np.ndarray, k: int) -> tuple[list[int], list[int], list[int]]:
    """The same by exact integers, of the rows that rounding leaves in question."""
    off = 4 * (x.shape[1] + 2) * UNIT * np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1).max()
    found: tuple[list[int], list[int], list[int]] = ([], [], [])
    for row, own in enumerate(scores):
        finite = np.flatnonzero(np.isfinite(own))
        if len(finite) > k:
            least = np.partition(own[finite], -k)[-k]
            finite = finite[own[finite] >= least - 2 * off[row]]
        asked = [int(v) for v in x[row]]
        exact = [(-sum(a * int(b) for a, b in zip(asked, y[place], strict=True)), int(place)) for place in finite]
        for value, place in sorted(exact)[:k]:
            if not -(2**63) <= -value < 2**63:
                raise OverflowError("a score does not fit a long")
            for column, entry in zip(found, (row, place, -value), strict=True):
                column.append(entry)
    return found


def _meet(queries: DataFrame, index: Index, k: int, first: bool) -> DataFrame:
    """The best k of every annulus piece for every query that visits it."""
    width = index.width
    place = ["pivot", "ring", "piece"]
    keys = [*place, "part"]

    def best(asked: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(rows):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype=np.int64)
        rows = rows.sort_values("id", kind="stable")
        ids, asking = rows["id"].to_numpy(), asked["query_id"].to_numpy()
        x, y = _matrix(asked["vector"], width), _matrix(rows["vector"], width)
        scores = x @ y.T
        scores[asking[:, None] == ids[None, :]] = -np.inf
        exact = max((v * v).sum(axis=1).max() for v in (x, y)) * (1 + 4 * (width + 2) * UNIT) <= EXACT
        query, found, value = _top(scores, k) if exact else _top_exact(x, y, scores, k)
        return pd.DataFrame({"query_id": asking[query], "vec_id": ids[found], "score": np.array(value, dtype=np.int64)})

    visits = stored(_visits(queries, index, k, first), "visits")
    # a piece is copied once for every block of queries with a visit to it
    visited = visits.select(*[F.col(c).alias(c) for c in keys]).distinct()
    blocks = index.rows.join(visited, place)
    return visits.groupBy(*keys).cogroup(blocks.groupBy(*keys)).applyInPandas(best, "query_id long, vec_id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(
    vectors: DataFrame, queries: DataFrame, k: int, id: str = "vec_id", vector: str = "embedding", block: int = 2048, **settings
) -> DataFrame:
    """The k best rows of ``vectors`` for each row of ``queries``: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    index = build(vectors, id, vector, **settings)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    asked = (
        queries.select(F.col(id).cast("long").alias("query_id"), quantised(vector).alias("vector"))
        .filter("query_id is not null and vector is not null")
        .distinct()
    )
    size = F.max(F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double")))))
    count, most = asked.agg(F.count(F.lit(1)), size).first()
    _check_size(most)
    parts = max(1, -(-count // block))
    asked = stored(asked.withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(parts)).cast("int")), "queries")
    # a query has many visits: however few files the queries lie in, these are found in tasks of few queries each
    tasks = -(-count // QUERIES_PER_TASK) or 1
    opening = stored(_ranked(_meet(asked.repartition(tasks, "query_id"), index, k, True), k), "opening")
    floors = opening.filter(F.col("rank") == k).select("query_id", F.col("score").alias("floor"))
    rest = _meet(asked.join(floors, "query_id", "left").repartition(tasks, "query_id"), index, k, False)
    columns = ["query_id", "vec_id", "score"]
    return _ranked(opening.select(*columns).unionByName(rest), k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )
