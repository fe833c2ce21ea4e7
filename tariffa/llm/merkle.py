"""A Merkle manifest of a dataset as a persistent tree: a change of one leaf makes a version that copies only its ancestors.

A leaf is the SHA-256 of a row's fields, each ``-`` if null, else byte count, colon, value.  Leaves ascend by identifier inside each
group (a source); every ``FAN`` consecutive nodes become the digest of their hexadecimal texts until one is left, the group's subroot.
The subroots, in the order of the groups, become the root in the same way.

How it is spread.  Leaves are numbered by a range partitioning and running counts, so no task sorts a whole group.  Aligned blocks of
``FAN ** LEVELS`` nodes are built in one task each, and only their tops go on to the next round, which has that many times fewer
rows: the upper tree is as distributed as the lower one.  Going down again, every block learns the siblings above it.  A
tampered leaf then becomes a version: inside its block it copies its ancestors and shares every other node with the tree it comes
from, and the version's top goes on through the siblings above the block in the same way.  No version rebuilds a node that it does not own.

Null fields are marked ``-``; a null group is a group of its own and comes first; a null identifier comes first in its group;
repeated identifiers are ordered by their leaves, and rows that are alike in all fields are leaves of their own.  Empty and very long
texts are hashed whole, an empty table gives an empty result and further columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tariffa.llm.common import with_locator
from tariffa.sources.sinks import stored

FAN = 3
LEVELS = 5
STEP = "array<struct<before:string,after:string>>"


def field(value: Column) -> Column:
    """A value as the leaf holds it."""
    as_text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(as_text).cast("string"), F.lit(":"), as_text), F.lit("-"))


def leaf_digest(fields: Sequence[Column]) -> Column:
    return F.sha2(F.encode(F.concat(*map(field, fields)), "UTF-8"), 256)


# --- the tree inside one block -------------------------------------------------------------------


def digest(parts: Sequence[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def build(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes of each level, the given ones first."""
    tree = [nodes]
    for _ in range(levels):
        last = tree[-1]
        tree.append([digest(last[i : i + FAN]) for i in range(0, len(last), FAN)])
    return tree


def height(total: int, most: int) -> int:
    """Levels above ``total`` nodes of a group, ``most`` at most."""
    levels = 0
    while total > 1 and levels < most:
        total, levels = -(-total // FAN), levels + 1
    return levels


def path(tree: list[list[str]], at: int) -> list[tuple[str, str]]:
    """The siblings before and after a node and each of its ancestors, joined."""
    steps = []
    for nodes in tree[:-1]:
        first = at - at % FAN
        steps.append(("".join(nodes[first:at]), "".join(nodes[at + 1 : first + FAN])))
        at //= FAN
    return steps


def version(changed: str, steps: list[tuple[str, str]]) -> str:
    """The top of the version in which a node is ``changed``: its ancestors are copied, all siblings are shared."""
    for before, after in steps:
        changed = sha256((before + changed + after).encode()).hexdigest()
    return changed


def blocks(frame: pd.DataFrame) -> Iterator[tuple[int, int, pd.DataFrame, list[list[str]]]]:
    """Group, block, rows in order and tree of every block in a task's rows."""
    for (group, block), rows in frame.groupby(["group", "block"], sort=False):
        rows = rows.sort_values("at", kind="stable")
        yield group, block, rows, build(rows["digest"].tolist(), height(int(rows["total"].iloc[0]), LEVELS))


# --- rounds ---------------------------------------------------------------------------------------


def numbered(rows: DataFrame, group: str, order: Sequence[str], name: str) -> tuple[DataFrame, DataFrame]:
    """The rows, written in order with a ``place``, and their runs: group, part, first, before, total.

    A run is what one part of the range partitioning holds of a group, so a group has at most as many runs as there are parts.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stored(rows, name).repartitionByRange(parts, group, *order).sortWithinPartitions(group, *order)
    placed = stored(ranged.withColumn("place", F.monotonically_increasing_id()), name)
    runs = placed.groupBy(group, F.shiftright("place", 33).alias("part")).agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("rows"))
    whole = Window.partitionBy(group)
    ahead = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        group, "part", "first", F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("before"), F.sum("rows").over(whole).alias("total")
    )
    return placed, stored(runs, "runs")


def _buckets(nodes: DataFrame) -> int:
    return max(2 * int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), nodes.count() // 20_000)


def _dealt(nodes: DataFrame, buckets: int) -> DataFrame:
    """Nodes (group, at, total, digest) with their block and a bucket; a bucket holds whole blocks, so its rows are bounded."""
    with_block = nodes.withColumn("block", F.floor(F.col("at") / F.lit(FAN**LEVELS)).cast("long"))
    return with_block.withColumn("bucket", F.pmod(F.xxhash64("group", "block"), F.lit(buckets)))


def tops(nodes: DataFrame) -> DataFrame:
    """One node for each block: group, at, total, digest of the round above."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        out = [(g, b, -(-int(rows["total"].iloc[0]) // FAN**LEVELS), tree[-1][0]) for g, b, rows, tree in blocks(frame)]
        return pd.DataFrame(out, columns=["group", "at", "total", "digest"])

    dealt = _dealt(nodes.select("group", "at", "total", "digest"), _buckets(nodes))
    return dealt.groupBy("bucket").applyInPandas(run, "group long, at long, total long, digest string")


def climb(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Tops (group, digest) of all groups, and the nodes of every round, lowest first."""
    rounds = [nodes]
    while not rounds[-1].filter(F.col("total") > FAN**LEVELS).isEmpty():
        rounds.append(stored(tops(rounds[-1]), "nodes"))
    return stored(tops(rounds[-1]).select("group", "digest"), "tops"), rounds


def _below(nodes: DataFrame, above: DataFrame, run, schema: str) -> DataFrame:
    """``run`` over the blocks of nodes, each task with what ``above`` (group, at, steps, subroot, root) says of its blocks."""
    buckets = _buckets(nodes)
    upper = above.withColumn("bucket", F.pmod(F.xxhash64("group", "at"), F.lit(buckets)))
    return _dealt(nodes, buckets).groupBy("bucket").cogroup(upper.groupBy("bucket")).applyInPandas(run, schema)


def _known(upper: pd.DataFrame) -> dict[tuple[int, int], tuple[list[tuple[str, str]], str | None, str]]:
    steps = ([(s["before"], s["after"]) for s in row] for row in upper["steps"])
    keys = zip(upper["group"], upper["at"], strict=True)
    return dict(zip(keys, zip(steps, upper["subroot"], upper["root"], strict=True), strict=True))


def descend(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """Group, at, digest, steps, subroot and root of the nodes of the lowest of ``rounds``."""

    def run(rows: pd.DataFrame, upper: pd.DataFrame) -> pd.DataFrame:
        known, out = _known(upper), []
        for group, block, members, tree in blocks(rows):
            steps, subroot, root = known[group, block]
            for k, at in enumerate(members["at"]):
                own = [{"before": b, "after": a} for b, a in path(tree, k) + steps]
                out.append((group, at, tree[0][k], own, subroot, root))
        return pd.DataFrame(out, columns=["group", "at", "digest", "steps", "subroot", "root"])

    schema = f"group long, at long, digest string, steps {STEP}, subroot string, root string"
    for nodes in reversed(rounds):
        above = stored(_below(nodes, above, run, schema), "paths")
    return above


def manifest(
    docs: DataFrame,
    tampered: Column,
    change: Column,
    id: str = "doc_id",
    group: str = "source",
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    content: str = "text",
) -> DataFrame:
    """One row per document: id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Where ``tampered`` holds, the content is replaced by ``change``; ``folded_root`` is the root of the version this makes.
    ``proof_sha256`` is the digest of all siblings on the way to the root.
    """
    before = [F.col(f"`{f}`") for f in fields]
    after = [change if f == content else c for f, c in zip(fields, before, strict=True)]
    leaves = with_locator(
        docs,
        F.col(f"`{id}`").alias("id"),
        F.col(f"`{group}`").cast("string").alias("source"),
        leaf_digest(before).alias("digest"),
        F.when(tampered, leaf_digest(after)).alias("changed"),
    ).select("id", "source", "digest", "changed", F.xxhash64("_file").alias("file"), F.col("_row").alias("row"))
    placed, runs = numbered(leaves, "source", ["id", "digest", "file", "row"], "leaves")

    sources = runs.groupBy("source").agg(F.max("total").alias("total")).withColumn("all", F.lit(0))
    ordered, order_runs = numbered(sources, "all", ["source"], "sources")
    at = F.col("place") - F.col("first") + F.col("before")
    part = F.shiftright("place", 33).alias("part")
    numbers = ordered.select("source", "place", part).join(order_runs, "part").select(
        "source", at.alias("group"), F.col("total").alias("sources")
    )
    numbers = stored(numbers, "numbers")
    runs = stored(runs.withColumnRenamed("source", "own").join(numbers, F.col("own").eqNullSafe(F.col("source"))).drop("source"), "runs")
    here = (F.shiftright("place", 33) == F.col("part")) & F.col("source").eqNullSafe(F.col("own"))
    rows = placed.join(runs, here)
    nodes = stored(rows.select(F.col("id").cast("string").alias("id"), "group", at.alias("at"), "total", "digest", "changed"), "nodes")

    subroots, rounds = climb(nodes)
    uppers = numbers.join(subroots, "group").select(
        F.lit(0).cast("long").alias("group"), F.col("group").alias("at"), F.col("sources").alias("total"), "digest"
    )
    root, upper_rounds = climb(stored(uppers, "subroots"))
    start = F.lit(0).cast("long").alias("at"), F.array().cast(STEP).alias("steps"), F.lit(None).cast("string").alias("subroot")
    over = descend(upper_rounds, root.select("group", *start, F.col("digest").alias("root")))
    over = over.select(F.col("at").alias("group"), start[0], "steps", F.col("digest").alias("subroot"), "root")
    over = descend(rounds[1:], over)

    def run(rows: pd.DataFrame, upper: pd.DataFrame) -> pd.DataFrame:
        known, out = _known(upper), []
        for group_, block, members, tree in blocks(rows):
            above, subroot, root_ = known[group_, block]
            for k, (own, changed) in enumerate(zip(members["id"], members["changed"], strict=True)):
                steps = path(tree, k) + above
                folded = version(changed if isinstance(changed, str) else tree[0][k], steps)
                out.append((own, tree[0][k], subroot, root_, digest([b + a for b, a in steps]), folded, folded == root_))
        return pd.DataFrame(out, columns=COLUMNS)

    schema = "id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    kind = placed.schema["id"].dataType
    return _below(nodes, over, run, schema).withColumn("id", F.col("id").cast(kind))


COLUMNS = ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
