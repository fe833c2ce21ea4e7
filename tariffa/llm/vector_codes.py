"""Vector code compression: every vector becomes one entry number for each of its parts.

Components are integers, floor(256 * x).  A vector is cut into equal consecutive parts; each part position has a codebook of at most 64
entries, which starts as that part of the vectors with the smallest identifiers and is improved by rounds of assignment and
averaging (floor of the mean; an entry without parts stays).

Nearest entries are found by slicing and intersecting.  For every dimension of a part the entries' coordinates are sorted, and
the mask of the first j of them is kept for each j, one bit an entry.  The entry that is nearest in one dimension gives a first radius: whatever
is nearer lies within it in every dimension.  Two binary searches for each dimension give the entries in that slice as a difference
of two prefix masks, and the AND over the dimensions leaves a superset of all entries that are at least as near.  Only those are measured, exactly and in
integers; ties go to the smaller number.

Each round is one scan: tasks sum the parts of each entry, and one row for each part and entry, a bounded number, reaches the driver.

Vectors that are null or hold a null or non-finite component take no part.  With fewer than 64 vectors there are fewer entries.
Vectors of different lengths, or of a length that the parts do not divide, are an error, and so are components of 2**62 and more.  Repeated
identifiers and a null identifier, which comes last, are ordered by their vectors for the start.  Null labels are one label.
An empty table gives an empty result and further columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffa.sources.sinks import stored

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
# below this, differences, squares and their sum over a part fit in 64 bits for parts of up to 256 components
SMALL = 1 << 26
LARGEST = 1 << 62


def usable(vector: str | Column) -> Column:
    """Not null, and all components finite numbers."""
    v = F.col(vector) if isinstance(vector, str) else vector
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~bad


def integers(vectors: np.ndarray) -> np.ndarray:
    """floor(256 * x) as 64-bit integers."""
    scaled = np.floor(vectors.astype(np.float64) * SCALE)
    if scaled.size and np.abs(scaled).max() >= LARGEST:
        raise ValueError("a component is too large: floor(256 * x) must be below 2**62")
    return scaled.astype(np.int64)


class Slices:
    """The entries of one part position, sorted by each dimension with the masks of their prefixes."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(entries, order, axis=0)
        bits = np.uint64(1) << order.astype(np.uint64)
        self.prefix = np.zeros((len(entries) + 1, entries.shape[1]), np.uint64)
        np.bitwise_or.accumulate(bits, axis=0, out=self.prefix[1:])
        self.order = order

    def radius(self, parts: np.ndarray) -> np.ndarray:
        """A distance within which each part has an entry: to the one that is nearest in the first dimension, rounded up."""
        if not parts.shape[1]:
            return np.zeros(len(parts), parts.dtype)
        first = self.sorted[:, 0]
        right = np.clip(np.searchsorted(first, parts[:, 0]), 0, len(first) - 1)
        left = np.maximum(right - 1, 0)
        best = None
        for guess in (left, right):
            squared = ((parts - self.entries[self.order[guess, 0]]) ** 2).sum(axis=1)
            best = squared if best is None else np.minimum(best, squared)
        return root_up(best)

    def candidates(self, parts: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """One mask a part: the entries that lie within the radius in every dimension."""
        masks = np.full(len(parts), self.prefix[-1, 0] if parts.shape[1] else np.uint64((1 << len(self.entries)) - 1), np.uint64)
        for d in range(parts.shape[1]):
            low = np.searchsorted(self.sorted[:, d], parts[:, d] - radius, "left")
            high = np.searchsorted(self.sorted[:, d], parts[:, d] + radius, "right")
            masks &= self.prefix[high, d] & ~self.prefix[low, d]
        return masks

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest entry of each part, ties to the smaller number."""
        masks = self.candidates(parts, self.radius(parts))
        flags = np.unpackbits(masks.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        row, entry = np.nonzero(flags)
        squared = ((parts[row] - self.entries[entry]) ** 2).sum(axis=1)
        starts = np.searchsorted(row, np.arange(len(parts)))
        least = np.minimum.reduceat(squared, starts) if len(parts) else squared
        hit = squared == least[row]
        row, entry = row[hit], entry[hit]
        return entry[np.searchsorted(row, np.arange(len(parts)))], least


def root_up(squared: np.ndarray) -> np.ndarray:
    """Integers whose squares are not below the given ones."""
    if squared.dtype == object:
        from math import isqrt

        return np.array([isqrt(x) + 1 for x in squared], object)
    return np.ceil(np.sqrt(squared.astype(np.float64))).astype(np.int64) + 1


def exact(vectors: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as 64-bit integers where those suffice for every sum, else as Python integers."""
    most = max((int(np.abs(x).max()) for x in (vectors, book) if x.size), default=0)
    if most < SMALL and vectors.dtype == np.int64 and book.dtype == np.int64:
        return vectors, book
    return vectors.astype(object), book.astype(object)


def assigned(vectors: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry numbers and squared distances, one row a vector and one column a part; ``book`` is parts x entries x width."""
    vectors, book = exact(vectors, book)
    width = book.shape[2]
    cut = [vectors[:, p * width : (p + 1) * width] for p in range(len(book))]
    found = [Slices(entries).nearest(part) for entries, part in zip(book, cut, strict=True)]
    return np.stack([e for e, _ in found], axis=1), np.stack([d for _, d in found], axis=1)


# --- rounds on Spark --------------------------------------------------------------------------------


def matrix(batch: pa.RecordBatch, length: int) -> np.ndarray:
    """The vectors of a batch as integers, one row each."""
    column = batch.column("vector")
    if (np.diff(column.offsets.to_numpy()) != length).any():
        raise ValueError(f"all vectors must have {length} components")
    return integers(column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length))


def mean_book(kept: DataFrame, book: np.ndarray) -> np.ndarray:
    """The codebook after one round: each entry the floor of the mean of the parts assigned to it."""
    parts, entries, width = book.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts * entries, width), object)
        counts = np.zeros(parts * entries, np.int64)
        for batch in batches:
            vectors = matrix(batch, parts * width)
            numbers, _ = assigned(vectors, book)
            small, _ = exact(vectors, book)
            for p in range(parts):
                place = p * entries + numbers[:, p]
                counts += np.bincount(place, minlength=parts * entries)
                own = np.zeros((parts * entries, width), small.dtype)
                np.add.at(own, place, small[:, p * width : (p + 1) * width])
                sums = sums + own
        used = np.flatnonzero(counts)
        if len(used):
            totals = [[str(x) for x in sums[k]] for k in used]
            yield pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int64()), pa.array(counts[used]), pa.array(totals, pa.list_(pa.string()))], ["place", "count", "sums"]
            )

    found = kept.select("vector").mapInArrow(run, "place long, count long, sums array<string>")
    whole = [F.sum(F.col("sums")[k].cast("decimal(38,0)")).alias(f"sum{k}") for k in range(width)]
    # one row for each part and entry
    rows = found.groupBy("place").agg(F.sum("count").alias("count"), *whole).collect()
    flat = book.reshape(parts * entries, width).astype(object)
    for r in rows:
        flat[r["place"]] = [int(r[f"sum{k}"]) // r["count"] for k in range(width)]
    return flat.reshape(book.shape).astype(np.int64)


def codebooks(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Parts x entries x width, from rows (id, vector) of usable vectors; no entry if there is no vector."""
    first = kept.select("id", "vector").orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).collect()
    if not first:
        return np.zeros((parts, 0, 0), np.int64)
    lengths = {len(r["vector"]) for r in first}
    if len(lengths) > 1 or max(lengths) % parts:
        raise ValueError(f"all vectors must have one length, a multiple of {parts}")
    start = integers(np.array([r["vector"] for r in first], np.float64).reshape(len(first), max(lengths)))
    book = start.reshape(len(first), parts, -1).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        book = mean_book(kept, book)
    return book


def fingerprint(book: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position."""
    return sha256(",".join(map(str, book.reshape(-1).tolist())).encode()).hexdigest()


def encode(
    vectors: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """One row per usable vector: id, code, error, label_error, codebooks_sha256.

    ``error`` is the squared distance to the entries of the code, ``label_error`` its sum over equal labels.
    """
    if entries > 64:
        raise ValueError("a mask holds 64 entries")
    named = vectors.select(*[F.col(f"`{c}`").alias(n) for c, n in ((id, "id"), (vector, "vector"), (label, "label"))])
    kept = named.filter(usable("vector"))
    book = codebooks(kept, parts, entries, rounds)
    length = book.shape[0] * book.shape[2]
    # identifiers and labels pass by as text: any type, nulls included
    plain = kept.select(F.col("id").cast("string").alias("id"), F.col("label").cast("string").alias("label"), "vector")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, squared = assigned(matrix(batch, length), book)
            codes = ["".join(f"{e:02x}" for e in row) for row in numbers.tolist()]
            errors = [sum(row) for row in squared.tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array(codes, pa.string()), pa.array(errors, pa.int64())],
                ["id", "label", "code", "error"],
            )

    coded = stored(plain.mapInArrow(run, "id string, label string, code string, error long"), "codes")
    totals = stored(coded.groupBy(F.col("label").alias("own")).agg(F.sum("error").alias("label_error")), "label-errors")
    return coded.join(totals, F.col("label").eqNullSafe(F.col("own"))).select(
        F.col("id").cast(named.schema["id"].dataType).alias("id"),
        "code",
        "error",
        "label_error",
        F.lit(fingerprint(book)).alias("codebooks_sha256"),
    )
