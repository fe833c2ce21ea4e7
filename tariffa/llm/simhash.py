"""SimHash near-duplicates by a hierarchical index in Gray order.

Fingerprints are 64 majority bits over the XXH64 values (seed 42) of a text's word shingles, repeats included;
texts shorter than a shingle are hashed whole, and a text without words has fingerprint zero.
Two fingerprints link when at most three bits differ.

The index.  Only distinct fingerprints are searched.  Four differences cannot hide in three, so two linked
fingerprints agree on one of four blocks of bits; rows that agree on a block form a group.  A crowded group is
cut again over the four parts of its remaining bits, so no task holds more than a bounded number of
rows and no link is lost.  Within a task the fingerprints are sorted by Gray rank, runs of neighbours form nodes that
keep the bits all of them share (a mask and a pattern), and so on upwards.  A search carries the differences counted so far
from node to child, counts only the bits the child adds, and drops the whole node once they exceed three.
A task returns a spanning tree of its links, not the pairs.

Null texts count as empty, a null identifier never names a component unless all of it are null, repeated
rows share a component, an empty table gives an empty result and further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tariffa.llm.common import on_files, pieces, with_locator, without_rows, words_of
from tariffa.llm.components import components
from tariffa.sources.sinks import stored

SEED = 42
MAX_BITS = 3
LEVELS = 4  # after the last, at most 20 bits are open, so a group has at most 2**20 rows
FAN_OUT = 16


def fingerprint(words: list[bytes], width: int) -> int:
    """Majority bits as an unsigned value."""
    if not words:
        return 0
    shingles = max(1, len(words) - width + 1)
    joined = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False)) if len(words) >= width else [b" ".join(words)]
    hashes = np.fromiter(map(xxh64_intdigest, joined, repeat(SEED)), np.uint64, shingles)
    ones = np.zeros(64, np.int64)
    for start in range(0, shingles, 65_536):
        part = hashes[start : start + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > shingles, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id: str, text: str, width: int) -> DataFrame:
    """Columns id, fingerprint (signed long), _file and _row, one row per document, written once."""
    rows = with_locator(docs, id, text).select(F.col(id).alias("id"), F.col(text).alias("text"), "_file", "_row")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for piece in pieces(frames, "text"):
            values = np.fromiter((fingerprint(words_of(t), width) for t in piece["text"]), np.uint64, len(piece))
            yield piece.drop(columns="text").assign(fingerprint=values.view(np.int64))

    kind = rows.schema["id"].dataType.simpleString()
    return stored(rows.mapInPandas(run, f"id {kind}, _file string, _row long, fingerprint long"), "fingerprints")


# --- the search ------------------------------------------------------------------------------


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def finer(mask: int) -> list[int]:
    """The mask with one of four parts of its open bits added, for each part."""
    open_bits = [bit for bit in range(64) if not mask >> bit & 1]
    return [mask | sum(1 << int(bit) for bit in part) for part in np.array_split(open_bits, MAX_BITS + 1)]


def gray_rank(values: np.ndarray) -> np.ndarray:
    """Position of each value in the Gray code's order."""
    rank = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def gray_index(values: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Masks and patterns of each level, leaves last, over values sorted by Gray rank."""
    levels = [(np.full(len(values), ~np.uint64(0)), values)]
    while len(levels[0][0]) > 1:
        masks, patterns = levels[0]
        starts = np.arange(0, len(masks), FAN_OUT)
        every = np.bitwise_and.reduceat(patterns, starts)
        some = np.bitwise_or.reduceat(patterns, starts)
        shared = np.bitwise_and.reduceat(masks, starts) & (every | ~some)
        levels.insert(0, (shared, every & shared))
    return levels


def links(values: np.ndarray, queries: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i, j), i < j, of sorted values that differ in at most three bits."""
    levels = gray_index(values)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for start in range(0, len(values), queries):
        asked = np.arange(start, min(start + queries, len(values)))
        node = np.zeros(len(asked), np.int64)
        differences = np.zeros(len(asked), np.int64)
        known = np.zeros(len(asked), np.uint64)
        for depth, (masks, patterns) in enumerate(levels):
            if depth:
                children = node[:, None] * FAN_OUT + np.arange(FAN_OUT)
                # a pair is met from its larger end, so nodes wholly beyond the asking value are left out
                span = FAN_OUT ** (len(levels) - 1 - depth)
                real = (children < len(masks)) & (children * span < asked[:, None])
                asked, known, differences = (np.repeat(x, real.sum(axis=1)) for x in (asked, known, differences))
                node = children[real]
            added = masks[node] & ~known
            differences = differences + np.bitwise_count((values[asked] ^ patterns[node]) & added)
            near = differences <= MAX_BITS
            asked, node, differences, known = asked[near], node[near], differences[near], masks[node[near]]
        ahead = node < asked
        found.append((node[ahead], asked[ahead]))
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


def spanning(size: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest index each of ``size`` nodes reaches over the links."""
    root = np.arange(size)
    while True:
        low = np.minimum(root[left], root[right])
        after = root.copy()
        for end in (left, right):
            np.minimum.at(after, root[end], low)
            np.minimum.at(after, end, low)
        after = after[after]
        if (after == root).all():
            return root
        root = after


def _search(frame: pd.DataFrame) -> pd.DataFrame:
    """Links of all groups that were dealt into one bucket."""
    bits = frame["fingerprint"].to_numpy().view(np.uint64)
    masks, rank = frame["mask"].to_numpy(), gray_rank(bits)
    group = bits & masks.view(np.uint64)
    order = np.lexsort((rank, group, masks))
    bits, masks, group = bits[order], masks[order], group[order]
    new = np.r_[True, (masks[1:] != masks[:-1]) | (group[1:] != group[:-1])]
    starts = np.flatnonzero(new)
    ends = np.r_[starts[1:], len(bits)]
    out: list[np.ndarray] = []
    for first, last in zip(starts[ends - starts > 1], ends[ends - starts > 1], strict=True):
        values = bits[first:last]
        left, right = links(values)
        if len(left):
            root = spanning(len(values), left, right)
            own = np.flatnonzero(root != np.arange(len(values)))
            out.append(np.stack([values[own], values[root[own]]]))
    pairs = np.concatenate(out, axis=1).view(np.int64) if out else np.zeros((2, 0), np.int64)
    return pd.DataFrame({"a": pairs[0], "b": pairs[1]})


def linked(distinct: DataFrame, crowded: int = 4096, bucket_rows: int = 20_000) -> DataFrame:
    """Links (a, b) that connect whatever is within three bits, from distinct fingerprints."""
    spark = distinct.sparkSession
    masks = finer(0)
    rows = distinct.select("fingerprint", F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask"))
    parts = []
    for level in range(LEVELS):
        rows = rows.withColumn("value", F.col("fingerprint").bitwiseAND(F.col("mask")))
        if level == LEVELS - 1:
            parts.append(rows)
            break
        counts = rows.groupBy("mask", "value").count()
        full = stored(counts.filter(F.col("count") > crowded).select("mask", "value"), "crowded")
        if full.isEmpty():
            parts.append(rows)
            break
        parts.append(rows.join(full, ["mask", "value"], "left_anti"))
        below = F.create_map(
            *[x for m in masks for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(f)) for f in finer(m)]))]
        )
        rows = stored(
            rows.join(full, ["mask", "value"], "left_semi").select("fingerprint", F.explode(below[F.col("mask")]).alias("mask")),
            "finer",
        )
        masks = [f for m in masks for f in finer(m)]
    found = None
    total = sum(part.count() for part in parts)
    buckets = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), total // bucket_rows)
    for part in parts:
        dealt = part.withColumn("bucket", F.pmod(F.xxhash64("mask", "value"), F.lit(buckets)))
        links_ = dealt.groupBy("bucket").applyInPandas(_search, "a long, b long")
        found = links_ if found is None else found.unionByName(links_)
    return found


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 3, crowded: int = 4096
) -> DataFrame:
    """One row per document: id, fingerprint, component, keeper, _file, _row.

    ``component`` is the smallest identifier of the documents that can be reached, ``keeper`` marks one row of each.
    """
    prints = fingerprints(docs, id, text, width)
    # nulls sort last, then where the row lies
    place = F.struct(F.isnull("id").alias("unknown"), "id", "_file", "_row")
    distinct = stored(prints.groupBy("fingerprint").agg(F.min(place).alias("first")), "distinct")
    found = components(linked(distinct.select("fingerprint"), crowded), "a", "b")
    member = distinct.join(found, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root")
    )
    least = member.groupBy("root").agg(F.min("first").alias("least"))
    named = member.join(least, "root").select("fingerprint", "least")
    return prints.join(named, "fingerprint").select(
        "id",
        "fingerprint",
        F.col("least.id").alias("component"),
        (place == F.col("least")).alias("keeper"),
        "_file",
        "_row",
    )


def as_hex(column: str) -> Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """All columns of one document of each group: the one with the smallest identifier."""
    docs = on_files(docs)
    return without_rows(docs, near_duplicates(docs, id, text, width).filter("not keeper"))
