"""Scores from tables of leaves: those of Spark's own models, without a walk through every tree."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from tariffa.config import BoostingConfig
from tariffa.operators import boosting, leaf_tables
from tariffa.operators.features import CATEGORICAL_FEATURES, LOG_FEATURES
from tests.test_histogram_trees import rows_of


@pytest.fixture(scope="module")
def fitted(spark):
    rows = rows_of(spark, 3000, 15, values=300).persist()
    config = BoostingConfig(frequency_trees=40, frequency_min_rows=2, severity_trees=40)
    parts = [*boosting.fit_frequency(rows, config), *boosting.fit_severity(rows.filter("covered_claim_flag = 1"), config)]
    return boosting.Challenger(*parts, rows, rows), rows


def test_scores_are_those_of_sparks_models(fitted):
    model, rows = fitted
    # labels that no training row has, beside those that one part alone has not seen
    odd = rows.withColumn(CATEGORICAL_FEATURES[1], F.when(F.col("order_id") % 7 == 0, "unseen").otherwise(F.col(CATEGORICAL_FEATURES[1])))
    columns = ["s_frequency", "s_severity", "s_expected_loss_raw"]

    def values(scored):
        return np.array([tuple(r) for r in scored.orderBy("order_id").select(*columns).collect()])

    fast = model.score(odd, "s")
    assert fast.columns == model.spark_score(odd, "s").columns
    np.testing.assert_allclose(values(fast), values(model.spark_score(odd, "s")), rtol=1e-11)
    with pytest.raises(Exception, match="not a number"):
        model.score(odd.withColumn("log_price", F.lit(float("nan"))), "s").select("s_severity").collect()


def test_a_row_looks_up_a_value_for_each_set_of_columns_not_for_each_tree(spark, fitted):
    model, _ = fitted
    nodes = leaf_tables.node_table(model.frequency_model, spark).collect()
    labels = [len(own) for own in model.frequency_encoder.stages[0].labelsArray]
    once = leaf_tables.leaf_tables(nodes, labels, 6)
    again = [r.asDict() | {"tree_id": r["tree_id"] + 100 * k} for k in range(20) for r in nodes]
    often = leaf_tables.leaf_tables(again, labels, 6)
    assert len(often.parts) == len(once.parts) <= 66
    x = [np.arange(5.0) % n for n in labels] + [np.linspace(0, 5, 5)] * 6
    np.testing.assert_allclose(often.margin(x), 20 * once.margin(x), rtol=1e-12)


def test_tables_are_cut_where_they_would_be_large(spark, fitted, monkeypatch):
    model, _ = fitted
    nodes = leaf_tables.node_table(model.severity_model, spark).collect()
    labels = [len(own) for own in model.severity_encoder.stages[0].labelsArray]
    whole = leaf_tables.leaf_tables(nodes, labels, 6)
    monkeypatch.setattr(leaf_tables, "MOST_CELLS", 20)
    small = leaf_tables.leaf_tables(nodes, labels, 6)
    assert max(len(cells) for _, cells in small.parts) <= 20 < max(len(cells) for _, cells in whole.parts)
    rng = np.random.default_rng(5)
    x = [rng.integers(0, n + 1, 500).astype(float) for n in labels] + [rng.random(500) * 6 for _ in range(6)]
    np.testing.assert_allclose(small.margin(x), whole.margin(x), rtol=1e-12)


def test_splits_by_category_are_followed(spark):
    """Spark may cut a one-hot column as two categories, with either on the left."""
    rows = rows_of(spark, 800, 4)
    encoder = Pipeline(stages=boosting.encoder_stages("__ml_x")).fit(rows)
    plain = encoder.transform(rows).withColumn("__label", F.col("net_loss"))
    model = GBTRegressor(labelCol="__label", featuresCol="__ml_x", predictionCol="p", maxIter=8, maxDepth=4, seed=1).fit(plain)
    own = encoder.stages[0].transform(rows).withColumn("m", leaf_tables.margin_of(encoder, model, LOG_FEATURES, spark)())
    found = plain.transform(model.transform).select("order_id", "p").join(own.select("order_id", "m"), "order_id")
    assert found.filter("abs(p - m) > 1e-9").count() == 0 and found.count() == 800
