"""What drives a boosted score: split importance and additive per-row contributions."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tariffa.config import EXPOSURE_KEY
from tariffa.functions.columns import first_match
from tariffa.operators.boosting import encoded_names
from tariffa.operators.features import CATEGORICAL_FEATURES
from tariffa.operators.leaf_tables import node_table
from tariffa.operators.quantiles import quantiles
from tariffa.sources.sinks import stored


def base_feature(encoded: Column) -> Column:
    """Source column of an encoded feature name."""
    return first_match(
        [((encoded == c) | encoded.startswith(f"{c}_"), c) for c in CATEGORICAL_FEATURES], encoded
    )


def _feature_names(encoder, spark) -> DataFrame:
    names = encoded_names(encoder)
    return spark.createDataFrame(list(enumerate(names)), "feature_index int, encoded_feature string")


def split_importance(model, encoder, name: str, spark) -> DataFrame:
    """Split count, mean and total gain and cover per encoded feature; unused features get 0."""
    measures = (
        node_table(model, spark)
        .filter(F.col("left_id") >= 0)
        .groupBy("feature_index")
        .agg(
            F.count(F.lit(1)).cast("double").alias("weight"),
            F.avg("gain").alias("gain"),
            F.avg("cover").alias("cover"),
            F.sum("gain").alias("total_gain"),
            F.sum("cover").alias("total_cover"),
        )
    )
    columns = ["weight", "gain", "cover", "total_gain", "total_cover"]
    full = (
        _feature_names(encoder, spark)
        .join(measures, "feature_index", "left")
        .select("encoded_feature", *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in columns])
    )
    gain = full.agg(F.sum("gain")).scalar()
    return full.select(
        F.lit(name).alias("model"),
        "encoded_feature",
        *columns,
        base_feature(F.col("encoded_feature")).alias("base_feature"),
        F.when(gain > 0, F.col("gain") / gain).otherwise(0.0).alias("gain_share"),
    ).orderBy(F.desc("gain"), F.desc("total_gain"), "encoded_feature")


def leaf_intervals(nodes: DataFrame) -> DataFrame:
    """Every leaf as one row: tree_id, node_id, value, and ``bounds`` on the features of its path.

    A bound is (feature_index, low, high, share): a row reaches the leaf if ``low < x <= high`` for each of them, and
    ``share`` is the part of the cover that does.  A feature has one bound however often the path cuts it.  The paths
    are followed level by level, so there are as many joins as the trees have levels.
    """
    binary = F.col("category_count") == 2
    # of two categories, 0 and 1, the cut lies between them; the left side may hold either
    plain = nodes.select(
        "tree_id",
        "node_id",
        "left_id",
        "right_id",
        "cover",
        (F.col("prediction") * F.col("tree_weight")).alias("value"),
        F.col("feature_index").alias("feature"),
        F.when(binary, F.lit(0.5)).otherwise(F.get("left_values", F.lit(0))).alias("cut"),
        (binary & (F.get("left_values", F.lit(0)) == 1.0)).alias("swapped"),
        (~binary & (F.col("category_count") != -1)).alias("many"),
    )
    if not plain.filter("left_id >= 0 AND many").isEmpty():
        raise ValueError("a feature with more than two categories cannot be an interval")
    child = plain.select(F.col("tree_id"), F.col("node_id").alias("child_id"), F.col("cover").alias("child_cover"))
    step = "array<struct<feature:int,low:double,high:double,share:double>>"
    walk = plain.filter("node_id = 0").withColumn("bounds", F.array().cast(step))
    below, above = F.lit(float("-inf")), F.lit(float("inf"))
    leaves = walk.filter("left_id < 0")
    while not (inner := walk.filter("left_id >= 0")).isEmpty():
        sides = F.array(
            F.struct(F.col("left_id").alias("child_id"), (~F.col("swapped")).alias("low_side")),
            F.struct(F.col("right_id").alias("child_id"), F.col("swapped").alias("low_side")),
        )
        down = inner.select("tree_id", "cover", "feature", "cut", "bounds", F.inline(sides)).join(child, ["tree_id", "child_id"])
        taken = F.struct(
            "feature",
            F.when(F.col("low_side"), below).otherwise(F.col("cut")).alias("low"),
            F.when(F.col("low_side"), F.col("cut")).otherwise(above).alias("high"),
            F.when(F.col("cover") > 0, F.col("child_cover") / F.col("cover")).otherwise(0.5).alias("share"),
        )
        steps = down.select("tree_id", F.col("child_id").alias("node_id"), F.concat("bounds", F.array(taken)).alias("bounds"))
        # the model's own table is small, and a level of it smaller
        walk = stored(plain.join(steps, ["tree_id", "node_id"]), "level")
        leaves = leaves.unionByName(walk.filter("left_id < 0"))
    each = leaves.select("tree_id", "node_id", "value", F.inline_outer("bounds"))
    bounds = each.groupBy("tree_id", "node_id", "value", "feature").agg(
        F.max("low").alias("low"), F.min("high").alias("high"), F.product("share").alias("share")
    )
    bound = F.struct(F.col("feature").alias("feature_index"), "low", "high", "share")
    return bounds.groupBy("tree_id", "node_id", "value").agg(
        F.array_sort(F.collect_list(F.when(F.col("feature").isNotNull(), bound))).alias("bounds")
    )


def with_interval_margin(df: DataFrame, leaves: DataFrame, values: Column, output: str = "margin") -> DataFrame:
    """Add the ensemble's output from its leaf intervals: the sum of the values of all leaves whose bounds an array of feature
    values meets.  The leaves, as many as the model has, go to the workers; of the array only the features that they ask for do."""
    rows = sorted(leaves.collect(), key=lambda r: (r["tree_id"], r["node_id"]))
    used = sorted({bound["feature_index"] for leaf in rows for bound in leaf["bounds"]})
    column = {f: i for i, f in enumerate(used)}
    keys = [[(column[b["feature_index"]], b["low"], b["high"]) for b in leaf["bounds"]] for leaf in rows]
    tests = sorted({test for key in keys for test in key})
    place = {test: i for i, test in enumerate(tests)}
    parts = []
    for m in sorted({len(key) for key in keys}):
        own = [i for i, key in enumerate(keys) if len(key) == m]
        parts.append((np.array([[place[t] for t in keys[i]] for i in own], int).reshape(len(own), m), np.array([rows[i]["value"] for i in own])))
    columns, low, high = (np.array([t[i] for t in tests], float) for i in range(3))

    @pandas_udf("double")
    def margin(x: pd.Series) -> pd.Series:
        own = np.array(x.tolist(), dtype=float).reshape(len(x), len(used))[:, columns.astype(int)]
        met = (own > low) & (own <= high)
        out = np.zeros(len(x))
        # rows a few at a time: there are thousands of leaves
        for start in range(0, len(x), 512):
            some = met[start : start + 512]
            for places, paid in parts:
                reached = np.ones((len(some), len(places)), bool)
                for j in range(places.shape[1]):
                    reached &= some[:, places[:, j]]
                out[start : start + 512] += reached @ paid
        return pd.Series(out)

    # the array is made once: its elements are taken from a column
    held = df.withColumn("__x", values)
    taken = F.array(*[F.get("__x", F.lit(f)) for f in used]).cast("array<double>")
    return held.withColumn(output, margin(taken)).drop("__x")


@dataclass(frozen=True)
class Games:
    """All leaves as cooperative games, added up.

    A leaf's players are its bounds, and a player's part is a polynomial in which bounds are met.  Leaves with the same bounds
    differ in their coefficients only, so those are added: the work on a row depends on the distinct bounds, not on how many trees
    repeat them.  ``tests`` lists the distinct bounds (column, low, high); for each number of players there is the
    place of the tests (games x players) and, for each set of players that are met, a matrix (games x columns).
    """

    tests: np.ndarray
    parts: list[tuple[np.ndarray, list[np.ndarray]]]
    constant: float
    columns: int


def polynomials(value: float, shares: Sequence[float]) -> np.ndarray:
    """Coefficients (players x sets of players) of each player's Shapley value in a leaf's game.

    The leaf pays ``value`` times the product over players of: 1 or 0 for a player whose bound is known to be met or not, and the share
    of one that is not known.
    """
    m = len(shares)
    out = np.zeros((m, 1 << m))
    for i in range(m):
        others = [j for j in range(m) if j != i]
        for size in range(m):
            weight = math.factorial(size) * math.factorial(m - size - 1) / math.factorial(m)
            for known in itertools.combinations(others, size):
                paid = value * weight * math.prod(shares[j] for j in others if j not in known)
                mask = sum(1 << j for j in known)
                out[i, mask | 1 << i] += paid
                out[i, mask] -= paid * shares[i]
    return out


def games_of(leaves: Sequence, column_of: dict[int, int]) -> Games:
    """``leaves`` as rows of :func:`leaf_intervals`; ``column_of`` says where a feature's values are found."""
    added: dict[tuple, np.ndarray] = {}
    constant = 0.0
    for leaf in leaves:
        players = sorted((column_of[b["feature_index"]], b["low"], b["high"], b["share"]) for b in leaf["bounds"])
        constant += leaf["value"] * math.prod(p[3] for p in players)
        if players:
            key = tuple(p[:3] for p in players)
            added[key] = added.get(key, 0.0) + polynomials(leaf["value"], [p[3] for p in players])
    tests = sorted({test for key in added for test in key})
    place = {test: i for i, test in enumerate(tests)}
    parts = []
    for m in sorted({len(key) for key in added}):
        own = [(key, c) for key, c in added.items() if len(key) == m]
        matrices = [np.zeros((len(own), len(column_of))) for _ in range(1 << m)]
        for g, (key, c) in enumerate(own):
            for i, test in enumerate(key):
                for mask in range(1 << m):
                    matrices[mask][g, test[0]] += c[i, mask]
        parts.append((np.array([[place[t] for t in key] for key, _ in own]), matrices))
    return Games(np.array(tests, float).reshape(len(tests), 3), parts, constant, len(column_of))


def shapley_batch(x: np.ndarray, games: Games, most: int = 512) -> np.ndarray:
    """Exact Shapley values of a tree ensemble for a batch of rows, one column a feature; ``most`` rows at a time."""
    out = np.zeros((len(x), games.columns))
    columns, low, high = games.tests[:, 0].astype(int), games.tests[:, 1], games.tests[:, 2]
    for start in range(0, len(x), most):
        own = x[start : start + most, columns]
        # one bit for each row and distinct bound
        met = ((own > low) & (own <= high)).astype(float)
        for places, matrices in games.parts:
            products = [np.ones((len(own), len(places)))]
            for j in range(places.shape[1]):
                products += [p * met[:, places[:, j]] for p in products]
            for product, matrix in zip(products, matrices, strict=True):
                out[start : start + most] += product @ matrix
    return out


@dataclass(frozen=True)
class Contributions:
    """Per row: key, ``contributions`` (one per listed feature), ``bias`` and ``margin``."""

    rows: DataFrame
    features: list[int]  # slots some tree splits on; every other contribution is 0
    bias: float


def contributions(
    features: DataFrame, encoder, model, *, scale: float = 1.0, key: Sequence[str] = EXPOSURE_KEY
) -> Contributions:
    """Exact additive contributions of every row, as lazy rows.

    ``scale`` turns the ensemble's output into the reported scale (2 for log-odds of a boosted
    classifier).  Only the leaf table, whose size is set by the model, goes to the workers, and
    only the slots that the trees use come in and out.
    """
    leaves = leaf_intervals(node_table(model, features.sparkSession)).collect()
    used = sorted({bound["feature_index"] for leaf in leaves for bound in leaf["bounds"]})
    # summed in one order, so that repeated runs agree to the last bit
    games = games_of(sorted(leaves, key=lambda r: (r["tree_id"], r["node_id"])), {f: i for i, f in enumerate(used)})
    values = vector_to_array("__ml_x")
    encoded = encoder.transform(features).select(
        *key, F.array(*[values[f] for f in used]).cast("array<double>").alias("x")
    )

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.array(batch["x"].tolist(), dtype=float).reshape(len(batch), len(used))
            parts = shapley_batch(x, games)
            out = batch[list(key)].copy()
            out["contributions"] = list(parts * scale)
            out["bias"] = games.constant * scale
            out["margin"] = (parts.sum(axis=1) + games.constant) * scale
            yield out

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.select(*key).schema.fields)
    rows = encoded.mapInPandas(explain, f"{kept}, contributions array<double>, bias double, margin double")
    return Contributions(rows, used, games.constant * scale)


def contribution_summary(parts: Contributions, encoder, name: str, scale_name: str) -> DataFrame:
    """Mean absolute and mean contribution, positive share and quantiles per encoded feature.

    The contributions are worked out once and written without their keys; the per-feature rows exist only inside scans of
    that table: they are aggregated before any shuffle.
    """
    spark = parts.rows.sparkSession
    held = stored(parts.rows.select("contributions"), "contribution_rows")
    long = held.select(F.posexplode("contributions").alias("part", "contribution"))
    measures = long.groupBy("part").agg(
        F.avg(F.abs("contribution")).alias("mean_abs_contribution"),
        F.avg("contribution").alias("mean_contribution"),
        F.avg(F.when(F.col("contribution") > 0, 1.0).otherwise(0.0)).alias("positive_share"),
    )
    # one row per used feature, read by the table and by the total
    measures = stored(measures, "contribution_measures")
    q = quantiles(long, ["part"], ["contribution"], [0.05, 0.5, 0.95], few_groups=True).select(
        "part",
        F.col("q")[0].alias("p05_contribution"),
        F.col("q")[1].alias("p50_contribution"),
        F.col("q")[2].alias("p95_contribution"),
    )
    slots = spark.createDataFrame(list(enumerate(parts.features)), "part int, feature_index int")
    found = slots.join(measures, "part").join(q, "part").drop("part")
    table = _feature_names(encoder, spark).join(found, "feature_index", "left")
    whole = measures.agg(F.sum("mean_abs_contribution")).scalar()
    columns = [
        "mean_abs_contribution",
        "mean_contribution",
        "positive_share",
        "p05_contribution",
        "p50_contribution",
        "p95_contribution",
    ]
    filled = table.select("encoded_feature", *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in columns])
    return filled.select(
        F.lit(name).alias("model"),
        F.lit(scale_name).alias("model_scale"),
        "encoded_feature",
        *columns,
        base_feature(F.col("encoded_feature")).alias("base_feature"),
        F.lit(parts.bias).alias("bias_mean"),
        F.when(whole > 0, F.col("mean_abs_contribution") / whole).otherwise(0.0).alias("mean_abs_contribution_share"),
    ).orderBy(F.desc("mean_abs_contribution"), "encoded_feature")


def base_feature_summary(summary: DataFrame) -> DataFrame:
    """Contribution summary rolled up from encoded features to source columns."""
    return (
        summary.groupBy("model", "base_feature")
        .agg(
            F.count(F.lit(1)).alias("encoded_feature_count"),
            F.sum("mean_abs_contribution").alias("mean_abs_contribution"),
            F.sum("mean_abs_contribution_share").alias("mean_abs_contribution_share"),
            F.sum("mean_contribution").alias("mean_contribution"),
            F.avg("positive_share").alias("positive_share"),
        )
        .orderBy(F.desc("mean_abs_contribution"), "base_feature")
    )


def top_features(summary: DataFrame, columns: Sequence[str], n: int = 10) -> DataFrame:
    """The ``n`` features that move the score most."""
    return summary.orderBy(F.desc("mean_abs_contribution"), "encoded_feature").limit(n).select(*columns)
