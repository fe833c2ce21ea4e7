"""Mixing sources to target weights.

The words of each source, documents in a keyed order, are packed into blocks of a fixed number of words (the last block of a
source may be shorter).  Every output shard draws its source counts from a multinomial distribution over the quotas that are still open, so
the shards vary and the totals meet the targets to within a block; the last shard takes what is left.  The j-th slot of a source takes block
``permutation(j)``: a pseudorandom permutation of the source's block numbers, a new one for every pass over the source.  Slots and documents
meet in a join on (source, block); nothing depends on the number of partitions, and reruns agree.

Word positions come from running totals inside buckets of documents and running totals of the buckets, so no task orders a whole source.
The driver holds one row per source (name, size, rows) and the draws (shards x sources): sources are a list of names that
somebody gives weights to, not data that grows.

Null texts count as empty and documents without words are never taken.  A null source is a source of its own, the last one.  A null identifier
is an identifier like others, repeated rows are separate documents, an empty table gives an empty mix and further columns are ignored
(the mixed documents keep them).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tariffa.llm.common import SPACE, collectable, numbered_columns, on_files, renamed_back, with_locator
from tariffa.sources.sinks import stored

MOST_SOURCES = 100_000


def word_list(text: str) -> Column:
    return F.filter(F.split(F.coalesce(F.col(text), F.lit("")), f"{SPACE}+"), lambda w: w != "")


def targets(sizes: Sequence[int], weights: Sequence[float], most: float) -> list[float]:
    """Shares of the total by weight; what a source cannot hold (``most`` times its size) is shared anew by weight."""
    out = [0.0] * len(sizes)
    rest, open_ = float(sum(sizes)), [i for i, s in enumerate(sizes) if s]
    while open_:
        scale = rest / sum(weights[i] for i in open_)
        over = [i for i in open_ if scale * weights[i] > most * sizes[i]]
        for i in over or open_:
            out[i] = most * sizes[i] if over else scale * weights[i]
        if not over:
            break
        rest -= sum(out[i] for i in over)
        open_ = [i for i in open_ if i not in over]
    return out


def draws(quotas: np.ndarray, limits: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Blocks of each source in each shard: multinomial over the open quotas, never beyond a source's limit."""
    random = np.random.RandomState(seed)
    total = int(round(quotas.sum()))
    edges = [total * k // shards for k in range(shards + 1)]
    taken = np.zeros(len(quotas), np.int64)
    out = np.zeros((shards, len(quotas)), np.int64)
    for shard in range(shards):
        need = edges[shard + 1] - edges[shard]
        if shard == shards - 1:
            # what is left, by largest remainder
            left = np.clip(quotas - taken, 0, limits - taken)
            count = np.floor(left * min(1.0, need / max(left.sum(), 1e-9)) + 1e-9).astype(np.int64)
            room = limits - taken - count
            for i in np.argsort(-(left - count), kind="stable"):
                count[i] += min(max(need - count.sum(), 0), min(1, room[i]))
        else:
            count = np.zeros(len(quotas), np.int64)
            while (missing := need - count.sum()) > 0:
                left = np.clip(quotas - taken - count, 0, None) * (limits - taken - count > 0)
                if left.sum() <= 0:
                    break
                count += random.multinomial(missing, left / left.sum())
                count = np.minimum(count, limits - taken)
        out[shard] = count
        taken += count
    return out


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A keyed permutation of range(size): four Feistel rounds, walked until the value is in range."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(size, 2))).astype(np.uint64) + np.uint64(1)) // np.uint64(2))
    half = half.astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        h, m, k = half[todo], mask[todo], key[todo]
        left, right = out[todo] >> h, out[todo] & m
        for turn in range(4):
            x = right + k + np.uint64(0x9E3779B97F4A7C15 * (turn + 1) % 2**64)
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((x ^ (x >> np.uint64(31))) & m)
        out[todo] = left << h | right
        todo = todo[out[todo] >= size[todo].astype(np.uint64)]
    return out.astype(np.int64)


@dataclass
class Mix:
    """``documents``: what was mixed; ``docs``: one row of each (source number, id, size, start, place); ``sources``: one per source;
    ``slots``: the blocks of the mix (shard, slot, source number, pass, block)."""

    documents: DataFrame
    docs: DataFrame
    sources: pd.DataFrame
    slots: DataFrame
    block: int

    def pieces(self) -> DataFrame:
        """Where each document overlaps each block: offset in the document and number of words."""
        end = F.col("start") + F.col("size")
        spread = self.docs.filter("size > 0").withColumn(
            "block",
            F.explode(F.sequence(F.floor(F.col("start") / self.block), F.floor((end - 1) / self.block))),
        )
        first = F.greatest(F.col("start"), F.col("block") * self.block)
        return spread.withColumn("offset", first - F.col("start")).withColumn(
            "words", F.least(end, (F.col("block") + 1) * self.block) - first
        )

    def taken(self) -> DataFrame:
        """Every document with its source's size and target and the words the mix takes from it, repeats counted."""
        times = self.slots.groupBy("number", "block").agg(F.count(F.lit(1)).alias("times"))
        used = (
            self.pieces()
            .join(times, ["number", "block"])
            .groupBy("number", "start")
            .agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
        )
        table = self.docs.sparkSession.createDataFrame(
            self.sources[["number", "source_size", "target"]], "number int, source_size long, target double"
        )
        # a document with words is the only one that starts where it does
        found = self.docs.join(
            used.withColumn("used", F.lit(True)),
            (self.docs["number"] == used["number"]) & (self.docs["start"] == used["start"]) & (self.docs["size"] > 0),
            "left",
        ).select(self.docs["*"], F.coalesce("taken", F.lit(0)).alias("taken"))
        return found.join(F.broadcast(table), "number")


def mix(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = (1, 2, 3),
    most: float = 3.0,
    block: int = 128,
    shards: int = 64,
    seed: int = 42,
    bucket_rows: int = 16_384,
) -> Mix:
    """Plan a mix whose sources, by code point and null last, get ``weights`` in turn; a document is used ``most`` times at most."""
    spark, docs = docs.sparkSession, on_files(docs)
    counted = stored(
        with_locator(docs, id, text, source).select(
            F.col(id).alias("id"), F.col(source).alias("source"), F.size(word_list(text)).cast("long").alias("size"),
            # the order depends on identifier and text alone, not on where the files lie
            F.xxhash64(id, text).alias("order"), "_file", "_row"
        ),
        "sizes",
    )
    found = counted.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    rows = sorted(
        collectable(found, MOST_SOURCES, "sources"), key=lambda r: (r["source"] is None, (r["source"] or "").encode())
    )
    sizes = [r["source_size"] for r in rows]
    sources = pd.DataFrame(
        {
            "number": np.arange(len(rows), dtype=np.int32),
            "source": [r["source"] for r in rows],
            "source_size": np.array(sizes, np.int64),
            "target": targets(sizes, [float(weights[i % len(weights)]) for i in range(len(rows))], most),
            "buckets": np.array([-(-r["rows"] // bucket_rows) for r in rows], np.int64),
            "blocks": np.array([-(-s // block) for s in sizes], np.int64),
        }
    )

    # positions: totals of buckets, then running totals inside each
    named = spark.createDataFrame(
        [(int(n), s, int(b)) for n, s, b in zip(sources["number"], sources["source"], sources["buckets"], strict=True)],
        "number int, source string, buckets long",
    )
    placed = counted.withColumnRenamed("source", "own").join(F.broadcast(named), F.col("own").eqNullSafe(F.col("source")))
    placed = placed.withColumn("bucket", F.pmod("order", F.col("buckets"))).drop("own", "source", "buckets")
    totals = placed.groupBy("number", "bucket").agg(F.sum("size").alias("total"))
    running = Window.partitionBy("number").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("number", "bucket", F.coalesce(F.sum("total").over(running), F.lit(0)).alias("before"))
    inside = Window.partitionBy("number", "bucket").orderBy("order", "id", "size", "_file", "_row")
    ahead = F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    positioned = placed.withColumn("ahead", ahead).join(before, ["number", "bucket"])
    numbered = stored(
        positioned.select("number", "id", "size", (F.col("before") + F.col("ahead")).alias("start"), "_file", "_row"), "positions"
    )

    # draws: quotas in blocks, as many as hold the target's words
    blocks = sources["blocks"].to_numpy()
    quotas = sources["target"].to_numpy() / np.maximum(sources["source_size"].to_numpy(), 1) * blocks
    counts = draws(quotas, np.floor(most * blocks).astype(np.int64), shards, seed)
    firsts = np.cumsum(counts, axis=0) - counts
    drawn = [
        (shard, number, int(firsts[shard, number]), int(counts[shard, number]), int(blocks[number]))
        for shard in range(shards)
        for number in range(len(rows))
        if counts[shard, number]
    ]

    def slots(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                for start in range(0, row.count_, 500_000):
                    j = np.arange(row.first_ + start, row.first_ + min(start + 500_000, row.count_))
                    turn, index = j // row.blocks, j % row.blocks
                    key = (turn * 1_000_003 + row.number).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03) + np.uint64(seed)
                    yield pd.DataFrame(
                        {
                            "shard": np.int32(row.shard),
                            "number": np.int32(row.number),
                            "slot": j,
                            "turn": turn.astype(np.int32),
                            "block": permuted(index, np.full(len(j), row.blocks), key),
                        }
                    )

    shape = "shard int, number int, first_ long, count_ long, blocks long"
    spread = spark.createDataFrame(drawn, shape)
    expanded = spread.mapInPandas(slots, "shard int, number int, slot long, turn int, block long")
    return Mix(docs, numbered, sources, expanded, block)


def mixed_documents(plan: Mix, text: str = "text") -> DataFrame:
    """The mix as documents: all columns of a document, once for each pass over its source that takes words of it.

    The text holds the words taken in that pass, in order; it is the document's own if all of them are.
    """
    docs = plan.documents
    taken = (
        plan.pieces()
        .join(plan.slots, ["number", "block"])
        .groupBy("_file", "_row", "turn", "size")
        .agg(F.array_sort(F.collect_list(F.struct("offset", "words"))).alias("_spans"), F.sum("words").alias("_count"))
        .withColumnRenamed("turn", "_turn")
        .withColumnRenamed("size", "_size")
    )
    own = f"c{docs.columns.index(text)}"
    parts = F.flatten(
        F.transform("_spans", lambda s: F.slice(F.col("_words"), (s["offset"] + 1).cast("int"), s["words"].cast("int")))
    )
    joined = with_locator(docs, *numbered_columns(docs)).join(taken, ["_file", "_row"]).withColumn("_words", word_list(own))
    mixed = joined.withColumn(own, F.when(F.col("_count") == F.col("_size"), F.col(own)).otherwise(F.array_join(parts, " ")))
    return renamed_back(mixed, docs.columns)
