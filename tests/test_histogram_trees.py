"""Boosting on the labels a row has: Spark's own trees, from passes whose work does not grow with the number of labels."""

from __future__ import annotations

import re
import time
from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tariffa.config import BoostingConfig
from tariffa.operators import boosting, histogram_trees
from tariffa.operators.features import CATEGORICAL_FEATURES, LOG_FEATURES

# nothing is drawn, so Spark's boosting and this one see the same rows and columns
WHOLE = BoostingConfig(
    frequency_trees=11, frequency_depth=3, frequency_step=0.3, frequency_subsample=1.0, frequency_feature_share="all", frequency_min_rows=7,
    severity_trees=11, severity_step=0.3, severity_subsample=1.0, severity_feature_share="all", severity_min_rows=3,
)


def rows_of(spark, n: int, labels: int, values: int = 20):
    def draw(at: int, size: int):
        return F.pmod(F.xxhash64("id", F.lit(at)), F.lit(size))

    rows = spark.range(n).select(
        F.col("id").alias("order_id"),
        *[F.lit(1).alias(c) for c in ("order_item_id", "seller_id", "product_id")],
        *[draw(i, size).cast("string").alias(c) for i, (c, size) in enumerate(zip(CATEGORICAL_FEATURES, (labels, labels, 2, 12, 7), strict=True))],
        *[F.log1p(draw(10 + i, values).cast("double")).alias(c) for i, c in enumerate(LOG_FEATURES)],
        draw(30, 1000).cast("double").alias("u"),
    )
    odds = F.col(CATEGORICAL_FEATURES[0]).cast("int") % 3 + F.col("log_price") - F.col("log_estimated_delivery_days")
    claim = (F.col("u") < 150 + 90 * odds).cast("int")
    return rows.withColumns({"covered_claim_flag": claim, "net_loss": F.when(claim == 1, 5 + 10 * F.abs(odds) + F.col("u") / 100).otherwise(0.0)})


@pytest.mark.parametrize("part", ["frequency", "weighted", "severity"])
def test_the_model_is_the_one_spark_fits_where_nothing_is_drawn(spark, part):
    rows = rows_of(spark, 3000, 15)
    config = replace(WHOLE, positive_weight=10.0) if part == "weighted" else WHOLE
    if part == "severity":
        rows = rows.filter("covered_claim_flag = 1")
        encoder, model = boosting.fit_severity(rows, config)
        estimator, label = boosting._severity_estimator(config), F.log1p("net_loss")
    else:
        encoder, model = boosting.fit_frequency(rows, config)
        estimator, label = boosting._frequency_estimator(config).setWeightCol("__w"), F.col("covered_claim_flag").cast("double")
    weight = F.when(F.col("covered_claim_flag") == 1, config.positive_weight).otherwise(1.0)
    plain = encoder.transform(rows).withColumns({"__label": label, "__w": weight})
    theirs = estimator.fit(plain)
    assert model.treeWeights == theirs.treeWeights and model.numFeatures == theirs.numFeatures

    def scores(fitted):
        out = F.col("__gbt_y") if part == "severity" else vector_to_array("__gbt_r")[1]
        return np.array([r[0] for r in fitted.transform(plain).orderBy("order_id").select(out).collect()])

    np.testing.assert_allclose(scores(model), scores(theirs), rtol=1e-8, atol=1e-10)

    def facts(fitted):
        from tariffa.operators.attribution import node_table

        inner = node_table(fitted, spark).filter("left_id >= 0").groupBy("tree_id", "feature_index")
        found = inner.agg(F.sum("gain"), F.sum("cover")).orderBy("tree_id", "feature_index").collect()
        return [tuple(r) for r in found]

    np.testing.assert_allclose(facts(model), facts(theirs), rtol=1e-8)


def test_a_pass_does_not_pay_for_labels_a_row_does_not_have(spark):
    """Spark's boosting adds a row to every label's column; twenty times the labels were twenty times the work."""
    rng = np.random.default_rng(3)

    def seconds(labels: int) -> float:
        layout = histogram_trees.Layout([labels, labels], [np.arange(10.0)])
        x = np.stack([rng.integers(0, labels, 100_000), labels + rng.integers(0, labels, 100_000), 2 * labels + rng.integers(0, 11, 100_000)])
        block = {"at": 0, "x": x.astype(np.uint16), "y": rng.random(100_000), "scores": np.zeros((1, 100_000))}
        plan = histogram_trees.plan_of(0, False, 1.0, 1.0, (1, 0), [], [], np.array([0]))
        best = []
        for _ in range(3):
            begun = time.perf_counter()
            (found,) = next(histogram_trees.histograms(iter([block]), layout.size, [plan]))
            best.append(time.perf_counter() - begun)
        assert found[0].sum() == 300_000
        return min(best)

    assert seconds(1000) < 5 * seconds(50)


def test_draws_hang_on_the_data_and_the_seed_alone(spark):
    rows = rows_of(spark, 2000, 8, values=500)
    config = BoostingConfig(frequency_trees=10, frequency_min_rows=5)

    def mean(config, rows):
        encoder, model = boosting.fit_frequency(rows, config)
        return model.transform(encoder.transform(rows)).agg(F.avg(vector_to_array("__gbt_p")[1])).first()[0]

    first = mean(config, rows)
    assert abs(first - mean(config, rows.repartition(5))) < 1e-12 < abs(first - mean(replace(config, seed=7), rows))


def test_a_small_table_starts_few_jobs_and_gets_the_trees_of_passes(spark, monkeypatch):
    """A job for every level of every tree was most of the time of a fit, whatever the rows."""
    monkeypatch.setattr(boosting, "ROWS_PER_PARTITION", 400)
    rows = rows_of(spark, 2000, 8, values=500).persist()
    config = BoostingConfig(frequency_trees=40, frequency_min_rows=5)
    tracker, context = spark.sparkContext.statusTracker(), spark.sparkContext

    def fitted(group: str):
        context.setJobGroup(group, group)
        try:
            model = boosting.fit_frequency(rows, config)[1]
        finally:
            context.setLocalProperty("spark.jobGroup.id", None)
        return model.toDebugString.split("\n", 1)[1], len(tracker.getJobIdsForGroup(group))

    together, few = fitted("together")
    monkeypatch.setattr(histogram_trees, "ROWS_OF_ONE_TASK", 0)
    passes, many = fitted("passes")
    number = re.compile(r"-?\d+\.\d+(?:E-?\d+)?")
    assert number.sub("", together) == number.sub("", passes)
    # blocks are summed by task, so the last digits may differ
    np.testing.assert_allclose([float(x) for x in number.findall(together)], [float(x) for x in number.findall(passes)], rtol=1e-9, atol=1e-12)
    assert few < 40 < many


def test_blocks_of_one_task_draw_rows_of_their_own(spark):
    rows = rows_of(spark, 400, 3).select(F.col("u").alias("n"), F.lit(0.0).alias("__label")).repartition(4)
    layout = histogram_trees.Layout([], [np.arange(10.0)])
    blocks = histogram_trees.packed(rows, [], ["n"], layout, 2, True).coalesce(1).collect()
    assert sorted(b["at"] for b in blocks) == [0, 1, 2, 3]


def test_labels_must_be_classes_and_numbers_there(spark):
    rows = rows_of(spark, 100, 3)
    for broken in ({"covered_claim_flag": F.lit(None).cast("int")}, {"covered_claim_flag": F.lit(2)}, {"log_price": F.lit(float("nan"))}):
        with pytest.raises(Exception, match="not one of the classes|not a number"):
            boosting.fit_frequency(rows.withColumns(broken), WHOLE)


def test_shares_of_features_by_sparks_names():
    assert [histogram_trees.drawn_features(s, 709) for s in ("all", "auto", "0.8", "1.0", "5", "sqrt", "onethird")] == [709, 709, 568, 709, 5, 27, 237]
    with pytest.raises(ValueError):
        histogram_trees.drawn_features("0", 9)
