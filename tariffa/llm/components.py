"""Connected components by alternating large-star and small-star steps.

Nodes are long values; the answer gives every node that has an edge and the smallest node it reaches.
Each step is a grouping and a join on one end of the edges; every round is written to the shared folder,
so plans stay short and a lost executor costs a re-read.  Edges of a node with very many
neighbours meet only their node's minimum (one row), so such a join splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffa.sources.sinks import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node it knows."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    joined = both.filter("b > a").join(least, "a")
    return joined.select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and the node, to the smallest of them.  Here a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return joined.unionByName(least.withColumnRenamed("m", "b")).distinct()


def components(edges: DataFrame, a: str, b: str, most_rounds: int = 60) -> DataFrame:
    """Columns ``node`` and ``root``.  Self-links and null ends are ignored."""
    first, second = F.col(a).cast("long"), F.col(b).cast("long")
    current = stored(
        edges.select(F.greatest(first, second).alias("a"), F.least(first, second).alias("b")).filter("a > b").distinct(),
        "edges",
    )
    seen = None
    for _ in range(most_rounds):
        # stars ending at the same root are the fixed point; a checksum of the edges tells
        state = current.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == seen:
            break
        seen = state
        current = stored(_small_star(_large_star(current)), "edges")
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
