"""Data profile of the exposure table: counts, gaps, quantiles, caps, anomalies, segments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffa.config import EXPOSURE_KEY
from tariffa.functions.columns import flag
from tariffa.operators.quantiles import quantile_columns, quantiles, unpivoted

NUMERIC_COLUMNS = [
    "price",
    "freight_value",
    "freight_to_price_ratio",
    "product_weight_g",
    "product_volume_cm3",
    "estimated_delivery_days",
]
CAPPED_COLUMNS = ["freight_value", "freight_to_price_ratio", "product_weight_g", "product_volume_cm3"]
QUANTILES = [0.0, 0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99, 0.995, 1.0]
CAP_QUANTILES = [0.95, 0.99, 0.995]
EXTREME_COLUMNS = [
    "order_id",
    "order_item_id",
    "seller_id",
    "product_id",
    "product_category_name_english",
    "route_state",
    "order_status",
    "price",
    "freight_value",
    "freight_to_price_ratio",
    "product_weight_g",
    "product_volume_cm3",
]


def quantile_label(p: float) -> str:
    if p == 0:
        return "min"
    return "max" if p == 1 else f"p{p * 100:g}"


def row_total(df: DataFrame) -> Column:
    """Row count of a table as a scalar subquery."""
    return df.agg(F.count(F.lit(1))).scalar()


def exposure_profile(exposure: DataFrame) -> DataFrame:
    """Rows, columns, distinct keys and ids, multi-item and multi-seller orders.

    Counted upwards (key, then order and seller, then order), so no step gathers an order.
    """
    keys = exposure.groupBy(*EXPOSURE_KEY).agg(F.count(F.lit(1)).alias("n"))
    per_seller = keys.groupBy("order_id", "seller_id").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("keys")
    )
    per_order = per_seller.groupBy("order_id").agg(
        F.sum("n").alias("n"), F.sum("keys").alias("keys"), F.count("seller_id").alias("sellers")
    )
    distinct = exposure.agg(
        F.struct(
            F.count_distinct("seller_id").alias("sellers"), F.count_distinct("product_id").alias("products")
        ).alias("d")
    ).scalar()
    return per_order.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.lit(len(exposure.columns)).alias("column_count"),
        F.coalesce(F.sum("keys"), F.lit(0)).alias("unique_exposure_key"),
        F.count("order_id").alias("unique_order_id"),
        F.count_if(F.col("n") > 1).alias("orders_with_multiple_exposures"),
        F.count_if(F.col("sellers") > 1).alias("orders_with_multiple_sellers"),
        F.max("n").alias("max_exposures_per_order"),
    ).select(
        "*",
        distinct.getField("sellers").alias("unique_seller_id"),
        distinct.getField("products").alias("unique_product_id"),
    )


def missing_report(df: DataFrame) -> DataFrame:
    """Columns with missing values: one scan for all columns, then one row per column."""
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    )
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("missing_count")) for c in df.columns])
    return (
        counts.select("__rows", F.inline(pairs))
        .filter("missing_count > 0")
        .select("field", "missing_count", (F.col("missing_count") / F.col("__rows")).alias("missing_rate"))
        .orderBy(F.desc("missing_rate"), "field")
    )


def numeric_quantiles(df: DataFrame, columns: Sequence[str] = NUMERIC_COLUMNS) -> DataFrame:
    """Count, missing, mean, standard deviation and ten quantiles per numeric column."""
    one_row = df.agg(
        *[
            F.struct(
                F.lit(c).alias("field"),
                F.count(c).alias("count"),
                F.count_if(F.col(c).isNull()).alias("missing"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
            ).alias(f"__{i}")
            for i, c in enumerate(columns)
        ]
    )
    stats = one_row.select(F.inline(F.array(*[f"__{i}" for i in range(len(columns))])))
    q = quantiles(df, [], columns, QUANTILES)
    return stats.join(q, "field", "left").select(
        "field",
        "count",
        "missing",
        "mean",
        "std",
        *[F.col("q")[i].alias(quantile_label(p)) for i, p in enumerate(QUANTILES)],
    )


def cap_diagnostics(df: DataFrame, columns: Sequence[str] = CAPPED_COLUMNS) -> DataFrame:
    """Rows, share of all rows and total value above the 95%, 99% and 99.5% quantiles."""
    caps = quantiles(df, [], columns, CAP_QUANTILES).select(
        "field",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(quantile_label(p)).alias("cap_quantile"), F.col("q")[i].alias("cap_value"))
                    for i, p in enumerate(CAP_QUANTILES)
                ]
            )
        ),
    )
    # at most len(columns) * 3 rows, whatever the size of df
    above = (
        unpivoted(df, [], columns)
        .join(F.broadcast(caps), "field")
        .groupBy("field", "cap_quantile", "cap_value")
        .agg(
            F.count_if(F.col("value") > F.col("cap_value")).alias("rows_above_cap"),
            F.sum(F.when(F.col("value") > F.col("cap_value"), F.col("value") - F.col("cap_value")).otherwise(0.0)).alias(
                "total_value_above_cap"
            ),
        )
    )
    return above.select(
        "field",
        "cap_quantile",
        "cap_value",
        "rows_above_cap",
        (F.col("rows_above_cap") / row_total(df)).alias("share_above_cap"),
        "total_value_above_cap",
    )


def anomaly_checks(df: DataFrame) -> DataFrame:
    """Count and share of rows for each named data check, in one scan."""
    # The checks and their limits.
    checks = {
        "freight_value_eq_0": F.col("freight_value") == 0,
        "freight_to_price_ratio_gt_1": F.col("freight_to_price_ratio") > 1,
        "freight_to_price_ratio_gt_2": F.col("freight_to_price_ratio") > 2,
        "product_weight_g_eq_0": F.col("product_weight_g") == 0,
        "product_weight_g_gt_30000": F.col("product_weight_g") > 30000,
        "product_volume_cm3_gt_200000": F.col("product_volume_cm3") > 200000,
        "estimated_delivery_days_gt_60": F.col("estimated_delivery_days") > 60,
    }
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"), *[F.count_if(test).alias(name) for name, test in checks.items()]
    )
    pairs = F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).alias("rows")) for n in checks])
    return counts.select("__rows", F.inline(pairs)).select(
        "check", "rows", F.when(F.col("__rows") > 0, F.col("rows") / F.col("__rows")).alias("row_share")
    )


def status_summary(df: DataFrame) -> DataFrame:
    return (
        quantile_columns(
            df,
            ["order_status"],
            {
                "freight_median": ("freight_value", 0.5),
                "freight_to_price_ratio_median": ("freight_to_price_ratio", 0.5),
                "estimated_delivery_days_median": ("estimated_delivery_days", 0.5),
            },
            F.count(F.lit(1)).alias("exposures"),
            F.count_distinct("order_id").alias("unique_orders"),
            F.avg("freight_value").alias("freight_mean"),
        )
        .withColumn("exposure_share", F.col("exposures") / row_total(df))
        .orderBy(F.desc("exposures"), "order_status")
    )


def grouped_freight_summary(
    df: DataFrame,
    group: str,
    *,
    min_exposures: int = 50,
    delivered_status: str = "delivered",
) -> DataFrame:
    """Sixteen freight, price and size statistics per segment with at least ``min_exposures`` rows."""
    summary = quantile_columns(
        df,
        [group],
        {
            "price_median": ("price", 0.5),
            "freight_median": ("freight_value", 0.5),
            "freight_p95": ("freight_value", 0.95),
            "freight_to_price_ratio_median": ("freight_to_price_ratio", 0.5),
            "freight_to_price_ratio_p95": ("freight_to_price_ratio", 0.95),
            "product_weight_g_median": ("product_weight_g", 0.5),
            "product_volume_cm3_median": ("product_volume_cm3", 0.5),
        },
        F.count(F.lit(1)).alias("exposures"),
        F.count_distinct("order_id").alias("unique_orders"),
        F.count_distinct("seller_id").alias("unique_sellers"),
        F.count_distinct("product_id").alias("unique_products"),
        F.avg("freight_value").alias("freight_mean"),
        F.max("freight_value").alias("freight_max"),
        F.max("freight_to_price_ratio").alias("freight_to_price_ratio_max"),
        F.avg("cross_state_flag").alias("cross_state_rate"),
        F.avg(flag(F.col("order_status") == delivered_status)).alias("delivered_rate"),
    )
    return (
        summary.withColumn("exposure_share", F.col("exposures") / row_total(df))
        .filter(F.col("exposures") >= min_exposures)
        .orderBy(F.desc("exposures"), group)
    )


def top_values(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """Most frequent labels; equal counts are ordered by label."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("exposures"))
        .orderBy(F.desc("exposures"), column)
        .limit(n)
    )


def describe_metrics(df: DataFrame) -> DataFrame:
    """Median, mean, p95, p99 and max of the headline measures, whole table and by crossing."""
    segments = F.array(
        F.struct(F.lit("all").alias("segment"), F.lit(True).alias("keep")),
        F.struct(F.lit("cross_state").alias("segment"), (F.col("cross_state_flag") == 1).alias("keep")),
        F.struct(F.lit("same_state").alias("segment"), (F.col("cross_state_flag") == 0).alias("keep")),
    )
    measures = ["freight_value", "freight_to_price_ratio", "price", "product_weight_g", "product_volume_cm3"]
    long = (
        unpivoted(df, ["cross_state_flag"], measures)
        .select("field", "value", F.inline(segments))
        .filter(F.col("keep") & ((F.col("segment") == "all") | (F.col("field") == "freight_value")))
    )
    plain = long.groupBy("segment", "field").agg(F.avg("value").alias("mean"), F.max("value").alias("max"))
    exact = quantiles(
        long.withColumnRenamed("field", "measure"), ["segment", "measure"], ["value"], [0.5, 0.95, 0.99],
        few_groups=True,
    ).withColumnRenamed("measure", "measure_name")
    return (
        plain.join(
            exact.select(
                "segment", F.col("measure_name").alias("field"), F.col("q")[0].alias("median"),
                F.col("q")[1].alias("p95"), F.col("q")[2].alias("p99"),
            ),
            ["segment", "field"],
            "left",
        )
        .select("segment", "field", "median", "mean", "p95", "p99", "max")
    )


def exposure_overview(df: DataFrame, delivered_status: str = "delivered") -> DataFrame:
    """One row: rows, orders, delivered rows and share, crossing share, freight and ratio range."""
    delivered = flag(F.col("order_status") == delivered_status)
    return quantile_columns(
        df,
        [],
        {"freight_value_median": ("freight_value", 0.5), "ratio_median": ("freight_to_price_ratio", 0.5)},
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("order_id").alias("unique_orders"),
        F.sum(delivered).alias("delivered_rows"),
        F.avg(delivered).alias("delivered_share"),
        F.sum(1 - delivered).alias("non_delivered_rows"),
        F.avg("cross_state_flag").alias("cross_state_share"),
        F.min("freight_value").alias("freight_value_min"),
        F.avg("freight_value").alias("freight_value_mean"),
        F.max("freight_value").alias("freight_value_max"),
        F.min("freight_to_price_ratio").alias("ratio_min"),
        F.avg("freight_to_price_ratio").alias("ratio_mean"),
        F.max("freight_to_price_ratio").alias("ratio_max"),
    )


def top_extreme_rows(df: DataFrame, column: str, n: int = 25) -> DataFrame:
    """The ``n`` rows with the largest ``column``; missing last, ties by exposure key."""
    return df.orderBy(F.desc_nulls_last(column), *EXPOSURE_KEY).limit(n).select(*EXTREME_COLUMNS)
