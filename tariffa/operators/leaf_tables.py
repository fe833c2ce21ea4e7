"""Scores of a boosted ensemble from tables of its leaves, whose work on a row does not grow with the trees.

A leaf says which labels or which range of a few columns reach it.  Leaves on the same columns are added into one table over the
classes of codes that those leaves tell apart, so a row looks up one value for each set of columns instead of walking every tree.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tariffa.session import new_table_path

# Cells of one table; leaves that would need more are put into several.
MOST_CELLS = 2**20


def node_table(model, spark) -> DataFrame:
    """Nodes of a fitted tree ensemble, from the model as Spark saves it.

    Size: trees x 2^(depth + 1) rows at most, whatever the training data.
    """
    path = new_table_path(spark, "model")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    weights = F.array(*[F.lit(float(w)) for w in model.treeWeights])
    return nodes.select(
        F.col("treeID").alias("tree_id"),
        F.col("nodeData.id").alias("node_id"),
        F.col("nodeData.leftChild").alias("left_id"),
        F.col("nodeData.rightChild").alias("right_id"),
        F.col("nodeData.prediction").alias("prediction"),
        F.col("nodeData.gain").alias("gain"),
        F.col("nodeData.rawCount").cast("double").alias("cover"),
        F.col("nodeData.split.featureIndex").alias("feature_index"),
        F.col("nodeData.split.leftCategoriesOrThreshold").alias("left_values"),
        F.col("nodeData.split.numCategories").alias("category_count"),
        F.element_at(weights, F.col("treeID") + 1).alias("tree_weight"),
    )


@dataclass(frozen=True)
class LeafTables:
    """``cuts`` of each number; for every set of columns, a step for each of their codes (which add up to a cell) and the cells."""

    labels: list[int]
    cuts: list[np.ndarray]
    parts: list[tuple[list[tuple[int, np.ndarray]], np.ndarray]]
    constant: float

    def margin(self, values: Sequence[np.ndarray]) -> np.ndarray:
        """The ensemble's output for label numbers (those without a slot are the number of labels) and numbers."""
        codes = [np.minimum(v, n).astype(np.intp) for v, n in zip(values, self.labels, strict=False)]
        codes += [np.searchsorted(cuts, v) for v, cuts in zip(values[len(codes) :], self.cuts, strict=True)]
        out = np.full(len(values[0]), self.constant)
        for steps, cells in self.parts:
            at = steps[0][1][codes[steps[0][0]]]
            for column, step in steps[1:]:
                at = at + step[codes[column]]
            out += cells[at]
        return out


def leaves_of(nodes: Sequence, labels: Sequence[int], cuts: Sequence[np.ndarray]) -> list[tuple[float, dict[int, np.ndarray]]]:
    """Value of every leaf and, for each column that its path asks for, the codes that reach it; ``nodes`` as rows of :func:`node_table`."""
    slots = [(j, k) for j, n in enumerate(labels) for k in range(n)]
    rows = {(r["tree_id"], r["node_id"]): r for r in nodes}
    leaves, walk = [], [(key, {}) for key in sorted(rows) if key[1] == 0]
    while walk:
        (tree, node), masks = walk.pop()
        row = rows[tree, node]
        if row["left_id"] < 0:
            leaves.append((row["prediction"] * row["tree_weight"], masks))
            continue
        feature, left = row["feature_index"], row["left_values"]
        plain = row["category_count"] == -1
        if feature < len(slots):
            column, label = slots[feature]
            zero, one = ((v <= left[0]) if plain else (v in left) for v in (0.0, 1.0))
            side = np.full(labels[column] + 1, zero)
            side[label] = one
        elif plain:
            column = len(labels) + feature - len(slots)
            own = cuts[column - len(labels)]
            side = np.arange(len(own) + 1) <= np.searchsorted(own, left[0])
        else:
            raise ValueError("a number is not a category")
        for child, mask in (("left_id", side), ("right_id", ~side)):
            walk.append(((tree, row[child]), masks | {column: masks.get(column, True) & mask}))
    return leaves


def leaf_tables(nodes: Sequence, labels: Sequence[int], numbers: int) -> LeafTables:
    """Tables of an ensemble on columns of ``labels`` labels, one-hot, and after them ``numbers`` numbers."""
    first = sum(labels)
    cut = [sorted({r["left_values"][0] for r in nodes if r["left_id"] >= 0 and r["feature_index"] == first + i}) for i in range(numbers)]
    cuts = [np.array(c, float) for c in cut]
    together: dict[tuple, list] = {}
    for value, masks in leaves_of(nodes, labels, cuts):
        # a mask that lets all codes through, or none, is a path of splits that do not tell rows apart
        if all(mask.any() for mask in masks.values()):
            masks = {c: m for c, m in masks.items() if not m.all()}
            together.setdefault(tuple(sorted(masks)), []).append((value, masks))
    constant = math.fsum(value for value, _ in together.pop((), []))
    work, parts = [(columns, together[columns]) for columns in sorted(together, reverse=True)], []
    while work:
        columns, own = work.pop()
        found = [np.unique(np.array([masks[c] for _, masks in own]), axis=1, return_inverse=True) for c in columns]
        shape = [classes.shape[1] for classes, _ in found]
        if math.prod(shape) > MOST_CELLS and len(own) > 1:
            work += [(columns, own[len(own) // 2 :]), (columns, own[: len(own) // 2])]
            continue
        cells = np.zeros(shape)
        for i, (value, _) in enumerate(own):
            cells[np.ix_(*[classes[i] for classes, _ in found])] += value
        strides = [math.prod(shape[k + 1 :]) for k in range(len(shape))]
        steps = [(c, at.reshape(-1) * stride) for c, (_, at), stride in zip(columns, found, strides, strict=True)]
        parts.append((steps, cells.reshape(-1)))
    return LeafTables(list(labels), cuts, parts, constant)


def margin_of(encoder: PipelineModel, model, numbers: Sequence[str], spark) -> Callable[[], Column]:
    """The ensemble's output as a column over the encoder's label numbers and ``numbers``."""
    indexer = encoder.stages[0]
    tables = leaf_tables(node_table(model, spark).collect(), [len(own) for own in indexer.labelsArray], len(numbers))

    @pandas_udf("double")
    def margin(*columns: pd.Series) -> pd.Series:
        values = [c.to_numpy(dtype=float) for c in columns]
        if any(np.isnan(v).any() for v in values):
            raise ValueError("a feature is missing or not a number")
        return pd.Series(tables.margin(values))

    return lambda: margin(*indexer.getOutputCols(), *numbers)
