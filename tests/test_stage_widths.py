"""Stage tables hold what later steps read: the disk of a large run goes into columns that nobody asks for."""

from __future__ import annotations

from pyspark.sql import functions as F

from tariffa.operators import rating
from tariffa.plans import catalog, star


def stages_of_own_rows(spark) -> star.StarStages:
    s = star.StarStages(spark, "unused")
    at = F.col("id")
    s.__dict__["claim_rows"] = spark.range(300).select(
        (at % 120).alias("order_id"),
        (at % 3).cast("int").alias("order_item_id"),
        (at % 7).alias("seller_id"),
        at.alias("product_id"),
        F.when(at % 5 > 0, F.concat(F.lit("c"), at % 5)).alias("product_category_name_english"),
        F.lit("A_to_B").alias("route_state"),
        (at % 12 + 1).cast("int").alias("purchase_month"),
        (at % 10 > 0).cast("int").alias("claim_eligible_flag"),
        (at % 4 == 1).cast("int").alias("covered_claim_flag"),
        *[F.when(at % 4 == 1, at / 10.0).otherwise(0.0).alias(c) for c in ("gross_loss", "paid_loss", "net_loss")],
        F.lit(0.0).alias("recovery_from_carrier"),
        (at / 7.0).alias("freight_value_capped"),
        F.lit(0.25).alias("covered_claim_probability"),
        F.lit("wide").alias("a_column_nobody_reads"),
    )
    return s


def test_the_credibility_table_holds_what_is_read_of_it(spark):
    s = stages_of_own_rows(spark)
    held, whole = s.analytic_credibility, s.analytic_credibility_rows
    assert held.columns == star.CREDIBILITY_COLUMNS and "seller_credibility_weight" in whole.columns
    assert held.exceptAll(whole.select(*held.columns)).isEmpty() and held.count() == 300
    counts = catalog.segment_counts(s).first()
    assert (counts["category_count"], counts["seller_count"], counts["month_count"]) == (5, 7, 12)
    assert catalog.validate_stress(s).first()["base_loss_ratio_matches_backtesting"] == 1


def test_what_is_dealt_by_the_exposure_key_is_narrow(spark):
    s = stages_of_own_rows(spark)
    joined = catalog.glm_with_baseline(s)
    assert s.keyed_claims.columns == star.KEYED_COLUMNS and "claims" not in s.__dict__
    wide = rating.with_baseline(s.claim_rows.select(*star.EXPOSURE_KEY, "covered_claim_flag"), s.baseline_rows)
    assert joined.exceptAll(wide).isEmpty() and joined.count() == wide.count() == 300
    assert catalog.join_completeness(s).first()["unmatched_rows"] == 0


def test_regression_prices_are_written_whole_only_where_they_are_the_result(spark, monkeypatch):
    s = stages_of_own_rows(spark)
    asked = []

    def priced(claims, baseline=None, config=None, columns=(), model=None):
        asked.append(list(columns))
        return s.analytic_pricing.select(*columns)

    monkeypatch.setattr(star.glm, "glm_pricing", priced)
    s.__dict__["glm_model"] = None
    assert s.glm_credibility.columns == star.CREDIBILITY_COLUMNS and len(asked) == 1 and "glm_pricing" not in s.__dict__
    assert set(asked[0]) == {*star.PREMIUM_COLUMNS, "freight_value_capped"}
    assert catalog.glm_credibility_checks(s).first()["portfolio_expected_loss_preserved"] == 1
    assert catalog.glm_backtest_actuals(s).count() == 5 and catalog.glm_stress(s).count() == 7
