"""How the model stages are laid out: what is dealt to how many tasks, and what waits for what."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tariffa.config import BoostingConfig
from tariffa.operators import boosting
from tariffa.plans import star
from tariffa.sources.sinks import stored


def test_training_rows_of_a_hundred_thousand_are_many_tasks(spark):
    """A pass over this many encoded rows takes a second; one task would leave the other cores idle."""
    assert [boosting.training_partitions(n) for n in (0, 1, 20_000, 20_001, 160_000)] == [1, 1, 1, 2, 8]
    # the number of tasks stops growing until they are large, and never falls
    counts = [boosting.training_partitions(n) for n in range(0, 20_000_000, 10_000)]
    assert counts == sorted(counts) and counts[600] == 64 and counts[-1] == 200


def test_training_rows_are_dealt(spark):
    rows = spark.range(60_000).select(
        F.col("id").alias("order_id"),
        F.lit(1).alias("order_item_id"),
        F.lit(1).alias("seller_id"),
        F.lit(1).alias("product_id"),
        *[F.lit("a").alias(c) for c in boosting.CATEGORICAL_FEATURES],
        *[F.col("id").cast("double").alias(c) for c in boosting.LOG_FEATURES],
        (F.col("id") % 3 == 0).cast("int").alias("covered_claim_flag"),
    )
    encoder = boosting.Pipeline(stages=boosting.encoder_stages("__ml_x")).fit(rows)
    with boosting.training_rows(encoder, rows, boosting.frequency_labels()) as ready:
        sizes = [n for n in ready.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()]
    assert len(sizes) == 3 and sum(sizes) == 60_000 and max(sizes) < 30_000


def test_the_challenger_does_not_wait_for_the_regression(spark, folder, monkeypatch):
    small = BoostingConfig(frequency_trees=2, severity_trees=2)
    monkeypatch.setattr(star, "BOOSTING", small)
    monkeypatch.setattr(star, "SWEEP", (("only", small),))
    s = star.StarStages(spark, folder)
    tested = s.test_features.count()
    assert s.sweep.scores.filter("split = 'test'").count() == tested > 0
    assert not {"glm_model", "glm_pricing", "champion"} & set(s.__dict__)
    # the comparison and the pricing fit both at the same time, and hold the same rows
    assert s.boosted_validation.filter("split = 'test'").count() == tested
    assert s.challenger_pricing.count() == s.claim_rows.count()


def test_a_missing_month_still_stops_the_challenger(spark):
    s = star.StarStages(spark, "unused")
    columns = "order_id long, claim_eligible_flag int, cross_state_flag int, purchase_month int, purchase_weekday int"
    s.__dict__["claim_rows"] = spark.createDataFrame([(1, 1, 0, 3, 2), (2, 0, 0, None, 2)], columns)
    assert [r["purchase_month"] for r in s._split.collect()] == [3]
    broken = star.StarStages(spark, "unused")
    broken.__dict__["claim_rows"] = spark.createDataFrame([(1, 1, 0, None, 2)], columns)
    with pytest.raises(PySparkException, match="purchase_month is missing"):
        broken._split.collect()


def test_a_stage_table_is_read_in_many_tasks(spark):
    """One task wrote it; what scans it next (scores, draws, designs) is not left to one task again."""
    rows = spark.range(0, 1_500_000, 1, 1).select(F.col("id"), *[F.rand(i).alias(f"x{i}") for i in range(4)])
    held = stored(rows)
    sizes = held.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert sum(sizes) == 1_500_000 and max(sizes) < 750_000
