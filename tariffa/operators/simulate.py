"""Rule-based return and claim simulation with draws keyed by the exposure key."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffa.config import EXPOSURE_KEY, RETURN_REASONS, SimulationConfig
from tariffa.functions.columns import cap_above, clip, first_match, flag, keyed_uniform, weighted_choice
from tariffa.operators.joins import checked_broadcast
from tariffa.operators.quantiles import quantiles, unpivoted
from tariffa.sources.sinks import stored

SIZE_COLUMNS = ("product_weight_g", "product_volume_cm3")
_CATEGORY = "product_category_name_english"


@dataclass(frozen=True)
class SizeStatistics:
    """Category and overall medians of the valid sizes, and the 95% points after filling."""

    by_category: DataFrame  # category, product_weight_g, product_volume_cm3 (medians)
    overall: dict[str, float | None]  # the two overall medians
    bulky: dict[str, float | None]  # the two 95% points


def _by_size(rows: DataFrame) -> dict[str, float | None]:
    """Two numbers (one per size column) as plain values."""
    found = {row["size"]: row["value"] for row in rows.select("size", "value").collect()}
    return {c: found.get(c) for c in SIZE_COLUMNS}


def size_statistics(counts: DataFrame) -> SizeStatistics:
    """Exact medians and 95% points from rows counted per (category, weight, volume).

    The category medians and the overall ones come from one pass: each value counts once for
    its category and once for the missing category, which stands for all.
    """
    per_value = stored(
        unpivoted(counts, [_CATEGORY], SIZE_COLUMNS, weight="row_count")
        .groupBy(_CATEGORY, F.col("field").alias("size"), "value")
        .agg(F.sum("row_count").alias("row_count")),
        "sizes",
    )
    scopes = F.array(F.col(_CATEGORY), F.lit(None).cast("string"))
    valid = per_value.filter((F.col("value") > 0) & F.col(_CATEGORY).isNotNull())
    medians = stored(
        quantiles(
            valid.select(F.explode(scopes).alias(_CATEGORY), "size", "value", "row_count"),
            [_CATEGORY, "size"],
            ["value"],
            [0.5],
            weight="row_count",
        ).select(_CATEGORY, "size", F.col("q")[0].alias("value")),
        "size_medians",
    )
    overall = _by_size(medians.filter(F.col(_CATEGORY).isNull()))
    own = medians.filter(F.col(_CATEGORY).isNotNull())
    filled = per_value.join(
        checked_broadcast(own.withColumnRenamed("value", "median")), [_CATEGORY, "size"], "left"
    ).select(
        "size",
        "row_count",
        F.coalesce(
            F.when(F.col("value") > 0, F.col("value")),
            F.col("median"),
            first_match([(F.col("size") == c, F.lit(v).cast("double")) for c, v in overall.items()], F.lit(None)),
        ).alias("value"),
    )
    bulky = _by_size(
        quantiles(filled, ["size"], ["value"], [0.95], weight="row_count", few_groups=True).select(
            "size", F.col("q")[0].alias("value")
        )
    )
    by_category = own.groupBy(_CATEGORY).agg(
        *[F.max(F.when(F.col("size") == c, F.col("value"))).alias(c) for c in SIZE_COLUMNS]
    )
    return SizeStatistics(checked_broadcast(by_category), overall, bulky)


def size_counts(exposure: DataFrame) -> DataFrame:
    """Rows per (category, weight, volume) of any exposure table."""
    return exposure.groupBy(_CATEGORY, *SIZE_COLUMNS).agg(F.count(F.lit(1)).alias("row_count"))


def fill_sizes(exposure: DataFrame, stats: SizeStatistics) -> DataFrame:
    """Replace missing, zero and negative sizes by the category median, else the overall one."""
    medians = stats.by_category.select(
        F.col(_CATEGORY).alias("__category"), *[F.col(c).alias(f"__{c}") for c in SIZE_COLUMNS]
    )
    joined = exposure.join(medians, F.col(_CATEGORY) == F.col("__category"), "left")
    filled = {}
    for c in SIZE_COLUMNS:
        valid = F.col(c) > 0
        filled[f"{c}_filled"] = F.coalesce(
            F.when(valid, F.col(c)), F.col(f"__{c}"), F.lit(stats.overall[c]).cast("double")
        )
        filled[f"{c}_imputed_flag"] = F.when(valid, F.lit(0)).otherwise(F.lit(1))
    return joined.withColumns(filled).drop("__category", *[f"__{c}" for c in SIZE_COLUMNS])


def exact_caps(exposure: DataFrame) -> dict[str, float | None]:
    """The exact 99% points of freight and freight/price."""
    names = ("freight_value", "freight_to_price_ratio")
    found = {row["field"]: row["q"][0] for row in quantiles(exposure, [], names, [0.99]).collect()}
    return {c: found.get(c) for c in names}


def with_exact_caps(exposure: DataFrame, config: SimulationConfig) -> SimulationConfig:
    """The same configuration with missing caps taken from the table."""
    caps = exact_caps(exposure)
    return replace(
        config,
        freight_value_cap=caps["freight_value"] if config.freight_value_cap is None else config.freight_value_cap,
        freight_to_price_ratio_cap=(
            caps["freight_to_price_ratio"] if config.freight_to_price_ratio_cap is None else config.freight_to_price_ratio_cap
        ),
    )


def winsorise(exposure: DataFrame, config: SimulationConfig) -> DataFrame:
    """Cap freight and freight/price from above, at fixed caps or at the table's own 99% points."""
    if config.freight_value_cap is None or config.freight_to_price_ratio_cap is None:
        config = with_exact_caps(exposure, config)
    return exposure.withColumns(
        {
            "freight_value_capped": cap_above("freight_value", config.freight_value_cap),
            "freight_to_price_ratio_capped": cap_above(
                "freight_to_price_ratio", config.freight_to_price_ratio_cap
            ),
        }
    )


def frequency_factors(prepared: DataFrame, bulky: dict[str, float | None], config: SimulationConfig) -> DataFrame:
    """Five multiplicative return factors: category, route, freight ratio, size and month."""
    pairs = [F.lit(x) for item in config.category_factors.items() for x in item]
    by_category = F.create_map(*pairs) if pairs else F.create_map(F.lit("").cast("string"), F.lit(1.0))
    ratio = F.col("freight_to_price_ratio_capped")
    oversize = F.lit(False)
    for c in SIZE_COLUMNS:
        oversize = oversize | (F.col(f"{c}_filled") > F.lit(bulky[c]).cast("double"))
    month = F.col("purchase_month")
    # Factor levels and their limits.
    return prepared.withColumns(
        {
            "return_factor_category": F.coalesce(F.try_element_at(by_category, F.col(_CATEGORY)), F.lit(1.0)),
            "return_factor_route": first_match(
                [(F.col("route_state").isin(*config.high_freight_routes), 1.20), (F.col("cross_state_flag") == 1, 1.10)],
                0.90,
            ),
            "return_factor_freight_ratio": first_match(
                [(ratio < 0.15, 0.90), (ratio < 0.40, 1.00), (ratio < 0.90, 1.10), (ratio >= 0.90, 1.25)], 1.00
            ),
            "return_factor_size": first_match([(oversize, 0.85)], 1.00),
            "return_factor_month": first_match([(month.isin(11, 12), 1.10), (month.isin(1, 2), 1.05)], 1.00),
        }
    )


def return_probability(factored: DataFrame, config: SimulationConfig) -> DataFrame:
    raw = F.lit(config.base_return_rate)
    for name in ("category", "route", "freight_ratio", "size", "month"):
        raw = raw * F.col(f"return_factor_{name}")
    return factored.withColumn(
        "return_probability",
        F.when(
            F.col("claim_eligible_flag") == 1,
            clip(raw, config.min_return_probability, config.max_return_probability),
        ).otherwise(0.0),
    )


def simulate_events(priced: DataFrame, config: SimulationConfig) -> DataFrame:
    """Return requested, approved, refunded without return, partially refunded; day and reason.

    Each draw sits behind the condition that makes it matter, so only the few rows with a
    request pay for the later digests.
    """

    def u(stream: str) -> Column:
        return keyed_uniform(EXPOSURE_KEY, stream, config.seed)

    requested, approved = F.col("return_requested") == 1, F.col("return_approved") == 1
    refunded = F.col("refund_without_return") == 1
    # Approval, refund and partial refund rates.
    approval_rate = first_match([(F.col("freight_to_price_ratio_capped") > 1.0, 0.88)], 0.93)
    refund_rate = first_match([(F.col("price") < config.refund_price_limit, 0.05)], 0.02)
    partial_rate = first_match([(F.col("price") < config.partial_refund_price_limit, 0.08)], 0.04)

    out = priced.withColumn(
        "return_requested",
        F.when((F.col("return_probability") > 0), flag(u("return") < F.col("return_probability"))).otherwise(0),
    )
    out = out.withColumn("return_approved", F.when(requested, flag(u("approval") < approval_rate)).otherwise(0))
    out = out.withColumn("refund_without_return", F.when(approved, flag(u("refund") < refund_rate)).otherwise(0))
    out = out.withColumn(
        "partial_refund", F.when(approved & ~refunded, flag(u("partial") < partial_rate)).otherwise(0)
    )
    out = out.withColumns(
        {
            "request_days_after_delivery": F.when(requested, (F.floor(u("day") * 30) + 1).cast("int")).otherwise(0),
            "return_reason": F.when(requested, weighted_choice(u("reason"), RETURN_REASONS)).otherwise("none"),
        }
    )
    eligible, shipped = F.col("claim_eligible_flag") == 1, F.col("freight_value_capped") > 0
    covered = flag(eligible & requested & approved & ~refunded & shipped)
    return out.withColumns(
        {
            "covered_claim_flag": covered,
            "covered_claim_probability": F.when(
                eligible & shipped, F.col("return_probability") * approval_rate * (F.lit(1.0) - refund_rate)
            ).otherwise(0.0),
        }
    )


def simulate_losses(events: DataFrame, config: SimulationConfig) -> DataFrame:
    """Gross loss, carrier recovery, paid and net loss, claim type and claim status."""

    def u(stream: str) -> Column:
        return keyed_uniform(EXPOSURE_KEY, stream, config.seed)

    covered = F.col("covered_claim_flag") == 1
    # Severity noise 0.8-1.2, half loss on partial refunds, recovery 10%-30%.
    noise = F.lit(0.8) + u("severity") * F.lit(0.4)
    share = F.lit(0.10) + u("recovery_share") * F.lit(0.20)
    partial = first_match([(F.col("partial_refund") == 1, 0.50)], 1.00)
    out = events.withColumns(
        {
            "claim_type": first_match([(covered, "return_shipping")], "none"),
            "gross_loss": F.when(covered, F.col("freight_value_capped") * noise * partial).otherwise(0.0),
        }
    )
    out = out.withColumn(
        "recovery_from_carrier",
        F.when(
            covered, F.when(u("recovery") < config.recovery_probability, F.col("gross_loss") * share).otherwise(0.0)
        ).otherwise(0.0),
    )
    out = out.withColumn("paid_loss", clip(F.col("gross_loss") - F.col("recovery_from_carrier"), low=0.0))
    requested, approved = F.col("return_requested") == 1, F.col("return_approved") == 1
    return out.withColumns(
        {
            "net_loss": F.col("paid_loss"),
            "claim_status": first_match(
                [
                    (F.col("claim_eligible_flag") == 0, "not_eligible"),
                    (covered, "paid"),
                    (requested & ~approved, "declined_not_approved"),
                    (approved & (F.col("refund_without_return") == 1), "closed_refund_without_return"),
                    (requested, "closed_no_covered_loss"),
                ],
                "no_return",
            ),
        }
    )


def prepare_claims(exposure: DataFrame, config: SimulationConfig, stats: SizeStatistics) -> DataFrame:
    """Eligibility, caps, filled sizes, factors and the return probability."""
    out = exposure.withColumn("claim_eligible_flag", flag(F.col("order_status") == config.delivered_status))
    out = fill_sizes(winsorise(out, config), stats)
    return return_probability(frequency_factors(out, stats.bulky, config), config)


def simulate_claims(
    exposure: DataFrame, config: SimulationConfig | None = None, stats: SizeStatistics | None = None
) -> DataFrame:
    """The whole chain from exposures to claims.

    ``stats`` may come from a narrower source than the exposure table itself; by default it is
    taken from ``exposure``.
    """
    config = config or SimulationConfig()
    stats = stats or size_statistics(size_counts(exposure))
    return simulate_losses(simulate_events(prepare_claims(exposure, config, stats), config), config)


def claims_summary(claims: DataFrame) -> DataFrame:
    """One row of counts, rates, totals and pure premiums."""
    eligible = F.col("claim_eligible_flag")
    return claims.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(eligible).alias("eligible_exposures"),
        F.sum(1 - eligible).alias("ineligible_exposures"),
        F.sum("return_requested").alias("return_requested_count"),
        F.avg("return_requested").alias("return_requested_rate_all"),
        F.avg(F.when(eligible == 1, F.col("return_requested"))).alias("return_requested_rate_eligible"),
        F.sum("return_approved").alias("return_approved_count"),
        F.sum("refund_without_return").alias("refund_without_return_count"),
        F.sum("partial_refund").alias("partial_refund_count"),
        F.sum("covered_claim_flag").alias("covered_claim_count"),
        F.avg("covered_claim_flag").alias("covered_claim_frequency_all"),
        F.avg(F.when(eligible == 1, F.col("covered_claim_flag"))).alias("covered_claim_frequency_eligible"),
        F.sum("gross_loss").alias("total_gross_loss"),
        F.sum("recovery_from_carrier").alias("total_recovery_from_carrier"),
        F.sum("paid_loss").alias("total_paid_loss"),
        F.sum("net_loss").alias("total_net_loss"),
        F.avg(F.when(F.col("covered_claim_flag") == 1, F.col("paid_loss"))).alias("average_paid_loss_among_claims"),
        F.avg("net_loss").alias("pure_premium_per_all_exposure"),
        F.avg(F.when(eligible == 1, F.col("net_loss"))).alias("pure_premium_per_eligible_exposure"),
        F.sum("product_weight_g_imputed_flag").alias("product_weight_g_imputed_rows"),
        F.sum("product_volume_cm3_imputed_flag").alias("product_volume_cm3_imputed_rows"),
    )


def claim_label_counts(claims: DataFrame) -> DataFrame:
    """Rows per claim status, claim type and return reason, in one pass."""
    labels = F.array(
        *[
            F.struct(F.lit(c).alias("dimension"), F.col(c).alias("label"))
            for c in ("claim_status", "claim_type", "return_reason")
        ]
    )
    return claims.select(F.inline(labels)).groupBy("dimension", "label").agg(F.count(F.lit(1)).alias("row_count"))
