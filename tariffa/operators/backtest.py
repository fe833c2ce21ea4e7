"""Loss-ratio backtest: actual against expected on three premium bases, by segment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffa.config import TARGET_LOSS_RATIO
from tariffa.functions.columns import flag, isclose, safe_divide
from tariffa.operators.rating import eligible_rows
from tariffa.operators.segments import segment_totals

BASES = ("baseline", "glm", "credibility")


# What a backtest adds up, and the identifiers it counts.
_SUMS = {
    "covered_claim_count": "covered_claim_flag",
    "actual_loss": "net_loss",
    "baseline_expected_loss": "baseline_pure_premium",
    "glm_expected_loss": "glm_expected_loss",
    "credibility_expected_loss": "credibility_expected_loss",
    **{f"{b}_commercial_premium": f"{b}_commercial_premium" for b in BASES},
}
_DISTINCT = {"unique_orders": "order_id", "unique_sellers": "seller_id", "unique_products": "product_id"}


def backtest(pricing: DataFrame, groups: Sequence[str] = (), target: float = TARGET_LOSS_RATIO) -> DataFrame:
    """Frequency, severity, A/E and loss ratio on each basis; whole portfolio without ``groups``."""
    return backtests(pricing, [groups], target).drop("segmentation")


def backtests(pricing: DataFrame, segmentations: Sequence[Sequence[str]], target: float = TARGET_LOSS_RATIO) -> DataFrame:
    """The backtests of several segmentations from one scan, told apart by ``segmentation``, their place in the list."""
    sums = {"eligible_exposures": F.lit(1), **{name: F.col(c) for name, c in _SUMS.items()}}
    totals = segment_totals(eligible_rows(pricing), segmentations, sums, _DISTINCT)
    losses = [name for name in _SUMS if name != "covered_claim_count"]
    out = (
        totals.withColumns({name: F.coalesce(F.col(name).cast("double"), F.lit(0.0)) for name in losses})
        .withColumns({c: F.coalesce(c, F.lit(0)) for c in ("eligible_exposures", "covered_claim_count")})
        .withColumns(
            {
                "claim_frequency": safe_divide("covered_claim_count", "eligible_exposures"),
                "average_severity": safe_divide("actual_loss", "covered_claim_count"),
                "actual_pure_premium": safe_divide("actual_loss", "eligible_exposures"),
            }
        )
    )
    for b in BASES:
        out = out.withColumns(
            {
                f"{b}_expected_pure_premium": safe_divide(f"{b}_expected_loss", "eligible_exposures"),
                f"{b}_ae": safe_divide("actual_loss", f"{b}_expected_loss"),
                f"{b}_loss_ratio": safe_divide("actual_loss", f"{b}_commercial_premium"),
            }
        ).withColumn(f"{b}_loss_ratio_vs_target", F.col(f"{b}_loss_ratio") - F.lit(target))

    def miss(basis: str):
        return F.abs(F.col(f"{basis}_ae") - 1)

    return out.withColumns(
        {
            "glm_ae_improvement_vs_baseline": miss("baseline") - miss("glm"),
            "credibility_ae_improvement_vs_glm": miss("glm") - miss("credibility"),
            "credibility_expected_loss_change_vs_glm": safe_divide("credibility_expected_loss", "glm_expected_loss")
            - 1,
        }
    )


def one_of(tested: DataFrame, segmentations: Sequence[Sequence[str]], groups: Sequence[str]) -> DataFrame:
    """The backtest of one segmentation out of the table of all."""
    at = [tuple(g) for g in segmentations].index(tuple(groups))
    others = {c for g in segmentations for c in g} - set(groups)
    return tested.filter(F.col("segmentation") == at).drop("segmentation", *others)


def sorted_backtest(frame: DataFrame, group: str) -> DataFrame:
    """Largest segments first; months in calendar order."""
    if group == "purchase_month":
        return frame.orderBy(group)
    return frame.orderBy(F.desc("eligible_exposures"), group)


def top_segments(
    frame: DataFrame,
    group: str,
    metric: str = "credibility_loss_ratio",
    *,
    min_exposures: int,
    n: int = 10,
    ascending: bool = False,
) -> DataFrame:
    """The ``n`` segments with the highest (or lowest) metric among the large enough ones."""
    columns = [
        group,
        "eligible_exposures",
        "covered_claim_count",
        "actual_loss",
        "credibility_expected_loss",
        "credibility_ae",
        "credibility_loss_ratio",
        metric,
    ]
    order = F.asc(metric) if ascending else F.desc(metric)
    return (
        frame.filter(F.col("eligible_exposures") >= min_exposures)
        .orderBy(order, group)
        .limit(n)
        .select(*dict.fromkeys(columns))
    )


def segment_counts(pricing: DataFrame) -> DataFrame:
    """One row: months, categories, routes, tiers and sellers among the eligible items."""
    labels = {
        "month_count": "purchase_month",
        "category_count": "product_category_name_english",
        "route_count": "route_state",
        "seller_tier_count": "seller_risk_tier",
        "seller_count": "seller_id",
    }
    # a missing label is a segment of its own
    return eligible_rows(pricing).agg(
        *[
            (F.count_distinct(c) + F.max(F.when(F.col(c).isNull(), 1).otherwise(0))).alias(name)
            for name, c in labels.items()
        ]
    )


def validate_backtest(pricing: DataFrame, target: float = TARGET_LOSS_RATIO) -> DataFrame:
    """One row: portfolio totals, credibility total equals the model's, LR = target x A/E."""
    return backtest(pricing, target=target).select(
        F.col("actual_loss").alias("portfolio_actual_loss"),
        F.col("baseline_expected_loss").alias("portfolio_baseline_expected_loss"),
        F.col("glm_expected_loss").alias("portfolio_glm_expected_loss"),
        F.col("credibility_expected_loss").alias("portfolio_credibility_expected_loss"),
        flag(isclose("credibility_expected_loss", "glm_expected_loss")).alias("credibility_expected_loss_matches_glm"),
        flag(isclose(F.col("credibility_loss_ratio"), F.col("credibility_ae") * F.lit(target))).alias(
            "credibility_loss_ratio_equals_target_times_ae"
        ),
    )
