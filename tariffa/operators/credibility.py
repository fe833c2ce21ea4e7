"""Seller credibility: shrink each seller's own experience towards the model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffa.config import EXPOSURE_KEY, CredibilityConfig
from tariffa.functions.columns import clip, first_match, flag, isclose, positive_divide, safe_divide
from tariffa.operators.joins import dimension_join
from tariffa.operators.quantiles import quantiles, unpivoted
from tariffa.operators.rating import eligible_rows
from tariffa.operators.segments import segment_totals
from tariffa.sources.sinks import stored

_PUSHED_COLUMNS = [
    "seller_eligible_exposures",
    "seller_claim_count",
    "seller_actual_net_loss",
    "seller_glm_expected_loss",
    "seller_observed_ae",
    "seller_credibility_weight",
    "seller_credibility_relativity_raw",
    "seller_credibility_relativity_capped",
    "seller_credibility_normalization_factor",
    "seller_credibility_relativity",
]
DISTRIBUTION_COLUMNS = [
    "seller_eligible_exposures",
    "seller_credibility_weight",
    "seller_credibility_relativity",
]


def seller_experience(pricing: DataFrame) -> DataFrame:
    """Exposure, claims, losses and model premium per seller, with observed rates."""
    model = ("glm_expected_loss", "glm_commercial_premium")
    sums = {
        "seller_eligible_exposures": F.lit(1),
        "seller_claim_count": F.col("covered_claim_flag"),
        "seller_actual_net_loss": F.col("net_loss"),
        **{f"seller_{c}": F.col(c) for c in model},
        **{f"known_{c}": F.col(c).isNotNull().cast("int") for c in model},
    }
    distinct = {"unique_orders": "order_id", "unique_products": "product_id"}
    totals = segment_totals(eligible_rows(pricing), [["seller_id"]], sums, distinct)
    return (
        totals.withColumns({f"seller_average_{c}": F.try_divide(f"seller_{c}", f"known_{c}") for c in model})
        .drop("segmentation", *[f"known_{c}" for c in model])
        .withColumns(
            {
                "seller_observed_frequency": F.col("seller_claim_count") / F.col("seller_eligible_exposures"),
                "seller_observed_pure_premium": F.col("seller_actual_net_loss") / F.col("seller_eligible_exposures"),
                "seller_glm_pure_premium": F.col("seller_glm_expected_loss") / F.col("seller_eligible_exposures"),
                # no expected loss: neutral experience
                "seller_observed_ae": positive_divide("seller_actual_net_loss", "seller_glm_expected_loss", 1.0),
            }
        )
    )


def risk_tier(relativity: Column) -> Column:
    # The tier limits.
    return first_match(
        [(relativity < 0.90, "lower_than_glm"), (relativity < 1.10, "near_glm"), (relativity < 1.30, "elevated")],
        "high",
    )


def _shrunk(experience: DataFrame, k: Column, config: CredibilityConfig) -> DataFrame:
    n, z = F.col("seller_eligible_exposures"), F.col("seller_credibility_weight")
    return (
        experience.withColumn("seller_credibility_weight", n / (n + k))
        .withColumn("seller_credibility_relativity_raw", z * F.col("seller_observed_ae") + (F.lit(1.0) - z))
        .withColumn(
            "seller_credibility_relativity_capped",
            clip("seller_credibility_relativity_raw", config.relativity_min, config.relativity_max),
        )
    )


def _normalisation(shrunk: DataFrame) -> Column:
    """Factor that keeps the portfolio's expected loss (an aggregate expression)."""
    return safe_divide(
        F.sum("seller_glm_expected_loss"),
        F.sum(F.col("seller_glm_expected_loss") * F.col("seller_credibility_relativity_capped")),
    )


def _priced_sellers(shrunk: DataFrame, factor: Column, config: CredibilityConfig) -> DataFrame:
    return (
        shrunk.withColumn("seller_credibility_normalization_factor", factor)
        .withColumn(
            "seller_credibility_relativity",
            F.col("seller_credibility_relativity_capped") * F.col("seller_credibility_normalization_factor"),
        )
        .withColumn(
            "seller_credibility_expected_loss",
            F.col("seller_glm_expected_loss") * F.col("seller_credibility_relativity"),
        )
        .withColumn(
            "seller_credibility_commercial_premium",
            F.col("seller_credibility_expected_loss") / F.lit(config.target_loss_ratio),
        )
        .withColumn(
            "seller_credibility_ae", positive_divide("seller_actual_net_loss", "seller_credibility_expected_loss", 0.0)
        )
        .withColumn("seller_risk_tier", risk_tier(F.col("seller_credibility_relativity")))
    )


def seller_credibility(pricing: DataFrame, config: CredibilityConfig | None = None) -> DataFrame:
    """One row per seller: credibility weight, relativity (raw, capped, normalised), tier, premium."""
    config = config or CredibilityConfig()
    # one scan of the items: the factor and the rows both read the stored per-seller table
    shrunk = _shrunk(stored(seller_experience(pricing), "experience"), F.lit(float(config.k)), config)
    factor = shrunk.agg(_normalisation(shrunk)).scalar()
    return _priced_sellers(shrunk, factor, config)


def credibility_pricing(
    pricing: DataFrame, sellers: DataFrame, config: CredibilityConfig | None = None
) -> DataFrame:
    """Push the seller relativities back onto every item; ineligible items get 0."""
    target = F.lit((config or CredibilityConfig()).target_loss_ratio)
    joined = dimension_join(
        pricing,
        sellers.select("seller_id", *_PUSHED_COLUMNS, "seller_risk_tier"),
        "seller_id",
        key_source=pricing,
        row_key=EXPOSURE_KEY,
        derived=True,
    )
    filled = joined.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in _PUSHED_COLUMNS}
        | {"seller_risk_tier": F.coalesce("seller_risk_tier", F.lit("not_eligible"))}
    )
    eligible = F.col("claim_eligible_flag") == 1
    return (
        filled.withColumn(
            "credibility_expected_loss",
            F.when(eligible, F.col("glm_expected_loss") * F.col("seller_credibility_relativity")).otherwise(0.0),
        )
        .withColumn("credibility_commercial_premium", F.col("credibility_expected_loss") / target)
        .withColumns(
            {
                "credibility_expected_loss_ratio_to_glm": positive_divide(
                    "credibility_expected_loss", "glm_expected_loss"
                ),
                "credibility_premium_ratio_to_glm": positive_divide(
                    "credibility_commercial_premium", "glm_commercial_premium"
                ),
                "credibility_expected_loss_ratio_to_freight": positive_divide(
                    "credibility_expected_loss", "freight_value_capped"
                ),
            }
        )
    )


def tier_summary(sellers: DataFrame) -> DataFrame:
    return (
        sellers.filter(F.col("seller_risk_tier").isNotNull())
        .groupBy("seller_risk_tier")
        .agg(
            F.count(F.lit(1)).alias("sellers"),
            F.sum("seller_eligible_exposures").alias("eligible_exposures"),
            F.sum("seller_actual_net_loss").alias("actual_net_loss"),
            F.sum("seller_glm_expected_loss").alias("glm_expected_loss"),
            F.sum("seller_credibility_expected_loss").alias("credibility_expected_loss"),
        )
        .withColumn("glm_ae", positive_divide("actual_net_loss", "glm_expected_loss"))
        .withColumn("credibility_ae", positive_divide("actual_net_loss", "credibility_expected_loss"))
    )


def seller_distribution(sellers: DataFrame, columns: Sequence[str] = DISTRIBUTION_COLUMNS) -> DataFrame:
    """Count, mean, deviation, range and upper quantiles of seller measures."""
    # The reported quantiles.
    probabilities = [0.0, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99, 1.0]
    names = ["min", "p25", "p50", "p75", "p90", "p95", "p99", "max"]
    stats = unpivoted(sellers, [], columns).groupBy("field").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std")
    )
    q = quantiles(sellers, [], columns, probabilities)
    return stats.join(q, "field", "left").select(
        "field", "count", "mean", "std", *[F.col("q")[i].alias(name) for i, name in enumerate(names)]
    )


def portfolio_report(priced: DataFrame) -> DataFrame:
    """One row: actual and expected losses on both bases, ratios and premium."""
    sums = eligible_rows(priced).agg(
        F.count(F.lit(1)).alias("eligible_exposures"),
        F.count_distinct("seller_id").alias("sellers_with_eligible_exposure"),
        F.sum("net_loss").alias("actual_total_net_loss"),
        F.sum("glm_expected_loss").alias("glm_expected_total_loss"),
        F.sum("credibility_expected_loss").alias("credibility_expected_total_loss"),
        F.sum("credibility_commercial_premium").alias("credibility_total_commercial_premium"),
    )
    return sums.withColumns(
        {
            "glm_actual_to_expected": safe_divide("actual_total_net_loss", "glm_expected_total_loss"),
            "credibility_actual_to_expected": safe_divide("actual_total_net_loss", "credibility_expected_total_loss"),
            "credibility_expected_loss_ratio": safe_divide(
                "credibility_expected_total_loss", "credibility_total_commercial_premium"
            ),
            "portfolio_expected_loss_change_vs_glm": safe_divide(
                "credibility_expected_total_loss", "glm_expected_total_loss"
            )
            - 1,
        }
    )


def validate_credibility(priced: DataFrame) -> DataFrame:
    """One row of checks: total preserved, nothing on ineligible items, key unique."""
    eligible = F.col("claim_eligible_flag") == 1
    distinct = priced.select(*EXPOSURE_KEY).distinct().agg(F.count(F.lit(1))).scalar()
    sums = priced.agg(
        F.count(F.lit(1)).alias("pricing_rows"),
        F.count_if(~eligible & (F.col("credibility_expected_loss") != 0)).alias(
            "ineligible_credibility_expected_loss_nonzero"
        ),
        F.count_if(~eligible & (F.col("credibility_commercial_premium") != 0)).alias(
            "ineligible_credibility_premium_nonzero"
        ),
        F.sum(F.when(eligible, F.col("credibility_expected_loss"))).alias("__credibility"),
        F.sum(F.when(eligible, F.col("glm_expected_loss"))).alias("__glm"),
    )
    return sums.select(
        "pricing_rows",
        distinct.alias("unique_exposure_keys"),
        "ineligible_credibility_expected_loss_nonzero",
        "ineligible_credibility_premium_nonzero",
        flag(isclose("__credibility", "__glm")).alias("portfolio_expected_loss_preserved"),
    )


def k_sensitivity(
    pricing: DataFrame, ks: Sequence[float] = (250.0, 500.0, 1000.0), config: CredibilityConfig | None = None
) -> DataFrame:
    """Credibility under several values of k: normalisation, relativity range and tier sizes."""
    config = config or CredibilityConfig()
    per_k = stored(seller_experience(pricing), "experience").withColumn(
        "credibility_k", F.explode(F.array(*[F.lit(float(k)) for k in ks]))
    )
    shrunk = _shrunk(per_k, F.col("credibility_k"), config)
    # one row per k: a fixed handful
    factors = shrunk.groupBy("credibility_k").agg(_normalisation(shrunk).alias("__factor"))
    priced = _priced_sellers(
        shrunk.join(F.broadcast(factors), "credibility_k"), F.col("__factor"), config
    )
    tiers = ("lower_than_glm", "near_glm", "elevated", "high")
    return priced.groupBy("credibility_k").agg(
        F.count(F.lit(1)).alias("sellers"),
        F.max("seller_credibility_normalization_factor").alias("normalization_factor"),
        F.min("seller_credibility_relativity").alias("min_relativity"),
        F.max("seller_credibility_relativity").alias("max_relativity"),
        F.avg("seller_credibility_weight").alias("mean_credibility_weight"),
        F.sum("seller_credibility_expected_loss").alias("credibility_expected_loss"),
        *[F.count_if(F.col("seller_risk_tier") == t).alias(f"sellers_{t}") for t in tiers],
    )


def seller_thresholds(pricing: DataFrame, limits: Sequence[int] = (100, 500)) -> DataFrame:
    """Sellers with eligible exposure, the largest one, and how many reach each threshold."""
    per_seller = eligible_rows(pricing).groupBy("seller_id").agg(F.count(F.lit(1)).alias("n"))
    return per_seller.agg(
        F.count(F.lit(1)).alias("sellers"),
        F.sum("n").alias("eligible_exposures"),
        F.max("n").alias("max_exposures"),
        *[F.count_if(F.col("n") >= limit).alias(f"sellers_ge_{limit}") for limit in limits],
    )
