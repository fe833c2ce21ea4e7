"""Baseline rating: portfolio premium, segment relativities, per-item premium, checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffa.config import EXPOSURE_KEY, RatingConfig
from tariffa.functions.columns import flag, isclose, positive_divide, safe_divide
from tariffa.operators.segments import segment_totals


def eligible_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col("claim_eligible_flag") == 1)


def total(column: str) -> Column:
    """Sum that is 0 for no rows."""
    return F.coalesce(F.sum(column), F.lit(0))


def portfolio_metrics(claims: DataFrame, config: RatingConfig | None = None) -> DataFrame:
    """One row: exposures, claims, losses, frequency, severity, pure and commercial premium."""
    target = F.lit((config or RatingConfig()).target_loss_ratio)
    eligible = F.col("claim_eligible_flag") == 1

    def loss(column: str) -> Column:
        return F.coalesce(F.sum(F.when(eligible, F.col(column))), F.lit(0.0)).alias(f"total_{column}")

    sums = claims.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(eligible).alias("eligible_exposures"),
        F.count_if(~eligible).alias("ineligible_exposures"),
        F.coalesce(F.sum(F.when(eligible, F.col("covered_claim_flag"))), F.lit(0)).alias("covered_claim_count"),
        loss("gross_loss"),
        loss("recovery_from_carrier"),
        loss("paid_loss"),
        loss("net_loss"),
    )
    pure = safe_divide("total_net_loss", "eligible_exposures")
    return (
        sums.withColumn("target_loss_ratio", target)
        .withColumn("claim_frequency", safe_divide("covered_claim_count", "eligible_exposures"))
        .withColumn("average_severity", safe_divide("total_net_loss", "covered_claim_count"))
        .withColumn("portfolio_pure_premium", pure)
        .withColumn("portfolio_commercial_premium", F.col("portfolio_pure_premium") / target)
        .withColumn("total_commercial_premium", F.col("portfolio_commercial_premium") * F.col("eligible_exposures"))
        .withColumn("expected_loss_ratio", safe_divide("total_net_loss", "total_commercial_premium"))
    )


def portfolio_premiums(claims: DataFrame, config: RatingConfig | None = None) -> Column:
    """Pure and commercial portfolio premium as a scalar subquery (a struct)."""
    metrics = portfolio_metrics(claims, config)
    return metrics.select(F.struct("portfolio_pure_premium", "portfolio_commercial_premium")).scalar()


AVERAGED = ("freight_value", "freight_value_capped")


def rating_summary(
    claims: DataFrame, group: str, *, min_exposure: int, config: RatingConfig | None = None
) -> DataFrame:
    """Experience and indicated premium per segment, relative to the portfolio."""
    target = F.lit((config or RatingConfig()).target_loss_ratio)
    portfolio = portfolio_premiums(claims, config).getField("portfolio_pure_premium")
    sums = {
        "eligible_exposures": F.lit(1),
        "covered_claim_count": F.col("covered_claim_flag"),
        **{f"total_{c}": F.col(c) for c in ("gross_loss", "recovery_from_carrier", "paid_loss", "net_loss")},
        **{f"{part}_{c}": x for c in AVERAGED for part, x in (("sum", F.col(c)), ("known", F.col(c).isNotNull().cast("int")))},
    }
    distinct = {"unique_orders": "order_id", "unique_sellers": "seller_id", "unique_products": "product_id"}
    totals = segment_totals(eligible_rows(claims), [[group]], sums, distinct)
    average = {f"average_{c}": F.try_divide(f"sum_{c}", f"known_{c}") for c in AVERAGED}
    return (
        totals.withColumns(average)
        .drop("segmentation", *[f"{part}_{c}" for c in AVERAGED for part in ("sum", "known")])
        .withColumn("claim_frequency", F.col("covered_claim_count") / F.col("eligible_exposures"))
        .withColumn("average_severity", positive_divide("total_net_loss", "covered_claim_count"))
        .withColumn("pure_premium", F.col("total_net_loss") / F.col("eligible_exposures"))
        .withColumn("relativity", positive_divide("pure_premium", portfolio))
        .withColumn("commercial_premium", F.col("pure_premium") / target)
        .withColumn(
            "credibility_flag",
            F.when(F.col("eligible_exposures") >= min_exposure, "credible_for_baseline").otherwise("insufficient"),
        )
        .orderBy(F.desc("eligible_exposures"), group)
    )


def baseline_pricing(claims: DataFrame, config: RatingConfig | None = None) -> DataFrame:
    """Every item with the portfolio premium: eligible rows get it, the others 0."""
    target = (config or RatingConfig()).target_loss_ratio
    premium = portfolio_premiums(claims, config)
    eligible = F.col("claim_eligible_flag") == 1
    pure, commercial = premium.getField("portfolio_pure_premium"), premium.getField("portfolio_commercial_premium")
    return (
        claims.withColumns(
            {
                "target_loss_ratio": F.lit(target),
                "portfolio_pure_premium": pure,
                "portfolio_commercial_premium": commercial,
            }
        )
        .withColumns(
            {
                "baseline_pure_premium": F.when(eligible, F.col("portfolio_pure_premium")).otherwise(0.0),
                "baseline_commercial_premium": F.when(eligible, F.col("portfolio_commercial_premium")).otherwise(0.0),
            }
        )
        .withColumn("expected_loss", F.col("baseline_pure_premium"))
        .withColumns(
            {
                "expected_loss_ratio_to_freight": positive_divide("expected_loss", "freight_value_capped"),
                "expected_portfolio_loss_ratio": positive_divide("expected_loss", "baseline_commercial_premium"),
            }
        )
    )


def top_by_pure_premium(summary: DataFrame, group: str, n: int = 10) -> DataFrame:
    return (
        summary.filter(F.col("credibility_flag") == "credible_for_baseline")
        .orderBy(F.desc("pure_premium"), group)
        .limit(n)
        .select(
            group,
            "eligible_exposures",
            "covered_claim_count",
            "claim_frequency",
            "average_severity",
            "pure_premium",
            "relativity",
            "commercial_premium",
        )
    )


def credible_group_counts(claims: DataFrame, config: RatingConfig) -> DataFrame:
    """Segments of each kind, and how many reach the exposure threshold."""
    limits = {
        "category": ("product_category_name_english", config.category_min_exposure),
        "route": ("route_state", config.route_min_exposure),
        "seller": ("seller_id", config.seller_min_exposure),
    }
    out = None
    for kind, (column, limit) in limits.items():
        part = (
            eligible_rows(claims)
            .groupBy(column)
            .agg(F.count(F.lit(1)).alias("n"))
            .agg(
                F.lit(kind).alias("segment_kind"),
                F.count(F.lit(1)).alias("segments"),
                F.count_if(F.col("n") >= limit).alias("credible_segments"),
            )
        )
        out = part if out is None else out.unionByName(part)
    return out


def validate_baseline(priced: DataFrame, claims: DataFrame, config: RatingConfig | None = None) -> DataFrame:
    """One row of checks: no premium on ineligible items, loss ratio at target, mean matches."""
    eligible = F.col("claim_eligible_flag") == 1
    premium = portfolio_premiums(claims, config).getField("portfolio_pure_premium")
    claim_rows = claims.agg(F.count(F.lit(1))).scalar()
    return (
        priced.agg(
            F.count(F.lit(1)).alias("pricing_rows"),
            F.count_if(~eligible & (F.col("baseline_pure_premium") != 0)).alias(
                "ineligible_baseline_pure_premium_nonzero"
            ),
            F.count_if(~eligible & (F.col("baseline_commercial_premium") != 0)).alias(
                "ineligible_baseline_commercial_premium_nonzero"
            ),
            F.sum("expected_loss").alias("total_expected_loss"),
            F.sum("baseline_commercial_premium").alias("total_commercial_premium"),
            F.avg(F.when(eligible, F.col("expected_loss"))).alias("mean_expected_loss"),
        )
        .withColumn("expected_loss_ratio", safe_divide("total_expected_loss", "total_commercial_premium"))
        .withColumn("rows_match_claims", flag(F.col("pricing_rows") == claim_rows))
        .withColumn("portfolio_pure_premium_matches", flag(isclose(premium, F.col("mean_expected_loss"))))
        .drop("mean_expected_loss")
    )


def order_premium(priced: DataFrame) -> DataFrame:
    """Item premiums rolled up to the order."""
    return priced.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("exposures"),
        F.sum("claim_eligible_flag").alias("eligible_exposures"),
        F.sum("net_loss").alias("net_loss"),
        F.sum("baseline_pure_premium").alias("baseline_pure_premium"),
        F.sum("baseline_commercial_premium").alias("baseline_commercial_premium"),
    )


def with_baseline(pricing: DataFrame, baseline: DataFrame) -> DataFrame:
    """One-to-one join of a priced table with the baseline premiums on the exposure key.

    An inner test for gaps belongs to :func:`unmatched_baseline`.
    """
    columns = [*EXPOSURE_KEY, "baseline_pure_premium", "baseline_commercial_premium"]
    return pricing.join(baseline.select(*columns), list(EXPOSURE_KEY), "left")


def unmatched_baseline(pricing: DataFrame, baseline: DataFrame) -> DataFrame:
    """One row: rows on both sides, priced rows without a baseline, repeated baseline keys."""
    key = list(EXPOSURE_KEY)
    unmatched = pricing.select(*key).join(baseline.select(*key), key, "left_anti").agg(F.count(F.lit(1))).scalar()
    repeated = (
        baseline.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).agg(F.count_if(F.col("n") > 1)).scalar()
    )
    rows = baseline.agg(F.count(F.lit(1))).scalar()
    return pricing.agg(F.count(F.lit(1)).alias("pricing_rows")).select(
        "pricing_rows",
        rows.alias("baseline_rows"),
        flag(F.col("pricing_rows") == rows).alias("row_counts_match"),
        unmatched.alias("unmatched_rows"),
        repeated.alias("repeated_baseline_keys"),
    )
