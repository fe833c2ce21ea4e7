"""Simulation, rating, credibility, backtest and stress on small hand-checked tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tariffa.config import CredibilityConfig, SimulationConfig
from tariffa.operators import backtest, credibility, features, rating, simulate, stress
from tariffa.plans import catalog


@pytest.fixture(scope="module")
def stages(spark, folder):
    return catalog.stages(spark, folder)


def test_imputation_falls_back_to_the_overall_median(spark):
    rows = [("a", 10.0, 1.0), ("a", 20.0, 2.0), ("a", None, 3.0), ("a", 0.0, None), ("b", -1.0, 4.0), ("b", None, 5.0)]
    df = spark.createDataFrame(
        rows, "product_category_name_english string, product_weight_g double, product_volume_cm3 double"
    )
    filled = simulate.fill_sizes(df, simulate.size_statistics(simulate.size_counts(df))).collect()
    weights = sorted((r["product_category_name_english"], r["product_weight_g_filled"]) for r in filled)
    assert weights == [("a", 10.0), ("a", 15.0), ("a", 15.0), ("a", 20.0), ("b", 15.0), ("b", 15.0)]
    assert sum(r["product_weight_g_imputed_flag"] for r in filled) == 4
    assert [r["product_volume_cm3_filled"] for r in filled if r["product_volume_cm3"] is None] == [2.0]


def test_exact_caps_replace_missing_ones(stages):
    config = simulate.with_exact_caps(stages.exposures, SimulationConfig(freight_value_cap=None))
    want = stages.exposures.agg(F.percentile("freight_value", 0.99)).first()[0]
    assert abs(config.freight_value_cap - want) < 1e-9
    assert config.freight_to_price_ratio_cap == SimulationConfig().freight_to_price_ratio_cap


def test_event_chain_is_consistent(stages):
    claims = stages.claims
    bad = claims.filter(
        "(return_approved = 1 AND return_requested = 0) OR (refund_without_return = 1 AND return_approved = 0)"
        " OR (partial_refund = 1 AND (return_approved = 0 OR refund_without_return = 1))"
        " OR (covered_claim_flag = 1 AND (claim_eligible_flag = 0 OR freight_value_capped <= 0))"
        " OR (covered_claim_flag = 0 AND net_loss <> 0) OR net_loss < 0"
        " OR (return_requested = 0 AND (request_days_after_delivery <> 0 OR return_reason <> 'none'))"
        " OR (return_requested = 1 AND request_days_after_delivery NOT BETWEEN 1 AND 30)"
        " OR (claim_eligible_flag = 0) <> (claim_status = 'not_eligible')"
    )
    assert bad.count() == 0
    assert claims.count() == 6000
    # the draws do not depend on how the rows are spread
    again = simulate.simulate_claims(
        stages.exposures.repartition(13), catalog.SIMULATION, stages.size_statistics
    ).agg(F.sum("covered_claim_flag"), F.round(F.sum("net_loss"), 4)).first()
    assert again == claims.agg(F.sum("covered_claim_flag"), F.round(F.sum("net_loss"), 4)).first()


def test_baseline_checks(stages):
    row = rating.validate_baseline(stages.baseline, stages.claims).first()
    assert row["ineligible_baseline_pure_premium_nonzero"] == 0
    assert abs(row["expected_loss_ratio"] - 0.6) < 1e-9
    assert row["portfolio_pure_premium_matches"] == 1 and row["rows_match_claims"] == 1


def pricing(spark):
    rows = [
        ("s1", 1, 1, 90.0, 100.0), ("s1", 1, 0, 0.0, 20.0), ("s2", 1, 1, 500.0, 10.0), ("s3", 1, 0, 0.0, 0.0),
        ("s4", 0, 0, 0.0, 0.0),
    ]
    return spark.createDataFrame(
        [(f"o{i}", i, f"p{i}", *r) for i, r in enumerate(rows)],
        "order_id string, order_item_id int, product_id string, seller_id string, claim_eligible_flag int, "
        "covered_claim_flag int, net_loss double, glm_expected_loss double",
    ).withColumns(
        {
            "glm_commercial_premium": F.col("glm_expected_loss") / 0.6,
            "freight_value_capped": F.lit(10.0),
            "baseline_pure_premium": F.col("claim_eligible_flag") * 30.0,
            "baseline_commercial_premium": F.col("claim_eligible_flag") * 50.0,
        }
    )


def test_credibility_defaults_and_total(spark):
    config = CredibilityConfig(k=2.0)
    sellers = credibility.seller_credibility(pricing(spark), config)
    by_id = {r["seller_id"]: r for r in sellers.collect()}
    assert set(by_id) == {"s1", "s2", "s3"}
    assert by_id["s3"]["seller_observed_ae"] == 1.0 and by_id["s3"]["seller_credibility_ae"] == 0.0
    assert by_id["s1"]["seller_credibility_weight"] == 0.5
    assert by_id["s1"]["seller_credibility_relativity_raw"] == 0.875
    assert by_id["s2"]["seller_credibility_relativity_capped"] == 2.0
    priced = credibility.credibility_pricing(pricing(spark), sellers, config)
    check = credibility.validate_credibility(priced).first()
    assert check["portfolio_expected_loss_preserved"] == 1
    assert priced.filter("seller_risk_tier = 'not_eligible' AND credibility_expected_loss = 0").count() == 1


def test_tier_edges(spark):
    values = [(0.8999,), (0.90,), (1.0999,), (1.10,), (1.30,)]
    rows = spark.createDataFrame(values, "r double").select(credibility.risk_tier(F.col("r")).alias("t")).collect()
    assert [r["t"] for r in rows] == ["lower_than_glm", "near_glm", "near_glm", "elevated", "high"]


def test_backtest_and_stress(spark):
    priced = credibility.credibility_pricing(
        pricing(spark), credibility.seller_credibility(pricing(spark), CredibilityConfig(k=2.0))
    )
    whole = backtest.backtest(priced).first()
    assert whole["eligible_exposures"] == 4 and whole["actual_loss"] == 590.0
    assert abs(whole["baseline_loss_ratio"] - 590.0 / 200.0) < 1e-12
    scenarios = {r["scenario"]: r for r in stress.portfolio_stress(priced).collect()}
    assert abs(scenarios["combined_20_20"]["combined_loss_multiplier"] - 1.44) < 1e-12
    assert abs(scenarios["base_observed"]["baseline_stressed_loss_ratio"] - 2.95) < 1e-12
    tiers = stress.segment_stress(priced, "seller_risk_tier", "seller_tier").collect()
    assert abs(sum(r["segment_base_actual_loss"] for r in tiers) - 590.0) < 1e-9
    empty = backtest.backtest(priced.filter("claim_eligible_flag = 9")).first()
    assert empty["eligible_exposures"] == 0 and empty["glm_loss_ratio"] == 0.0


def test_one_to_one_join_report(spark):
    table = pricing(spark)
    row = rating.unmatched_baseline(table, table.filter("seller_id <> 's4'").unionByName(table.limit(1))).first()
    assert row["unmatched_rows"] == 1 and row["repeated_baseline_keys"] == 1


def test_rare_levels_and_leakage(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] * 2 + [(None,)] * 3, "c string")
    levels = features.frequent_levels(df, "c", 3)
    got = {r["g"]: r["count"] for r in features.group_rare_levels(df, "c", levels, "g").groupBy("g").count().collect()}
    assert got == {"a": 3, "Other": 2, "Unknown": 3}
    with pytest.raises(ValueError):
        features.check_leakage(["log_price", "net_loss"])


def test_exact_split_size(stages):
    split = features.order_split_exact(stages.claims, 0.2)
    counts = {r["split"]: r["orders"] for r in features.split_counts(split).collect()}
    assert counts["test"] == round(0.2 * sum(counts.values()))
    assert split.groupBy("order_id").agg(F.count_distinct("split").alias("n")).filter("n > 1").count() == 0
