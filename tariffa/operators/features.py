"""Model features: entity split, rare-level grouping, log features, leakage guard."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffa.config import EXPOSURE_KEY, SEED
from tariffa.functions.columns import keyed_uniform
from tariffa.operators.joins import checked_broadcast
from tariffa.operators.quantiles import values_at_ranks

# --- Fixed values: feature lists and the fields no model may see ----------------------------
NUMERIC_FEATURES = [
    "price",
    "freight_value_capped",
    "freight_to_price_ratio_capped",
    "product_weight_g_filled",
    "product_volume_cm3_filled",
    "estimated_delivery_days",
]
CATEGORICAL_FEATURES = [
    "category_group",
    "route_group",
    "cross_state_flag_cat",
    "purchase_month_cat",
    "purchase_weekday_cat",
]
LEAKAGE_FIELDS = {
    "return_requested",
    "return_approved",
    "refund_without_return",
    "partial_refund",
    "request_days_after_delivery",
    "return_reason",
    "covered_claim_flag",
    "claim_type",
    "gross_loss",
    "recovery_from_carrier",
    "paid_loss",
    "net_loss",
    "claim_status",
    "return_probability",
    "covered_claim_probability",
    "return_factor_category",
    "return_factor_route",
    "return_factor_freight_ratio",
    "return_factor_size",
    "return_factor_month",
}
# --- End of fixed values --------------------------------------------------------------------

LOG_FEATURES = [f"log_{c}" for c in NUMERIC_FEATURES]
MODEL_FEATURES = [*CATEGORICAL_FEATURES, *LOG_FEATURES]
OTHER, UNKNOWN = "Other", "Unknown"


def check_leakage(features: Iterable[str]) -> None:
    """Refuse features that are outcomes or belong to the simulation (schema only, no job)."""
    leaked = sorted(set(features) & LEAKAGE_FIELDS)
    if leaked:
        raise ValueError(f"features would leak the outcome: {leaked}")


def leakage_report(df: DataFrame, features: Iterable[str] = tuple(MODEL_FEATURES)) -> DataFrame:
    """One row per column of ``df``: is it a model feature, is it barred, is that a conflict."""
    used = set(features)
    rows = [
        F.struct(
            F.lit(c).alias("field"),
            F.lit(int(c in used)).alias("is_feature"),
            F.lit(int(c in LEAKAGE_FIELDS)).alias("is_barred"),
            F.count(F.col(c)).alias("values_present"),
        )
        for c in df.columns
        if c in used or c in LEAKAGE_FIELDS
    ]
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r")).withColumn(
        "conflict", F.col("is_feature") * F.col("is_barred")
    )


def leakage_probe(
    df: DataFrame, build: Callable[[DataFrame], DataFrame], features: Iterable[str] = tuple(MODEL_FEATURES), key: Sequence[str] = EXPOSURE_KEY
) -> DataFrame:
    """One row per feature: does it change when every barred field of the input changes?

    ``build`` makes the features from ``df``.  It is run once on the table and once with all outcomes and simulation fields altered; a
    feature that comes from one of them under whatever name, or through any number of steps, has another checksum then.  Checksums
    are sums over (key, value) hashes, so nothing is joined or shuffled but one row a task.
    """
    altered = {}
    for field in df.schema.fields:
        if field.name in LEAKAGE_FIELDS:
            column, kind = F.col(field.name), field.dataType.typeName()
            if kind == "boolean":
                altered[field.name] = ~F.coalesce(column, F.lit(False))
            elif kind == "string":
                altered[field.name] = F.concat(F.coalesce(column, F.lit("")), F.lit("*"))
            else:
                altered[field.name] = (F.coalesce(column, F.lit(0)) + 7).cast(field.dataType)
    features = list(features)

    def checksums(rows: DataFrame) -> DataFrame:
        sums = [F.sum(F.xxhash64(*key, F.lit(f), F.col(f)).cast("decimal(38,0)")).alias(f) for f in features]
        pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("checksum")) for f in features])
        return build(rows).agg(*sums).select(F.inline(pairs))

    after = checksums(df.withColumns(altered)).withColumnRenamed("checksum", "altered")
    return checksums(df).join(after, "feature").select(
        "feature", (~F.col("checksum").eqNullSafe(F.col("altered"))).cast("int").alias("leaks")
    )


def order_split(df: DataFrame, test_size: float = 0.20, seed: int = SEED) -> DataFrame:
    """Add ``split``: a whole order is test or train, decided by a draw keyed on the order id.

    No shuffle, and an order keeps its side when the table grows.
    """
    return df.withColumn(
        "split", F.when(keyed_uniform(["order_id"], "split", seed) < test_size, "test").otherwise("train")
    )


def order_split_exact(df: DataFrame, test_size: float = 0.20, seed: int = SEED) -> DataFrame:
    """Like :func:`order_split` with exactly ``round(test_size * orders)`` test orders.

    The draw of that rank is looked up and used as the limit.
    """
    drawn = df.select("order_id").distinct().withColumn("u", keyed_uniform(["order_id"], "split", seed))
    limit = values_at_ranks(
        drawn, [], "u", lambda n: [f"bround({n} * {test_size!r}D) - 1"], few_groups=True
    ).agg(F.max("value"))
    u = keyed_uniform(["order_id"], "split", seed)
    return df.withColumn("split", F.when(u <= limit.scalar(), "test").otherwise("train"))


def split_counts(df: DataFrame) -> DataFrame:
    """Orders and rows on each side."""
    per_order = df.groupBy("split", "order_id").agg(F.count(F.lit(1)).alias("n"))
    return per_order.groupBy("split").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("n").alias("exposures")
    )


def frequent_levels(df: DataFrame, column: str, min_exposure: int) -> DataFrame:
    """Labels with at least ``min_exposure`` rows (missing counts as its own label)."""
    return (
        df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit(UNKNOWN)).alias("level"))
        .agg(F.count(F.lit(1)).alias("exposures"))
        .filter(F.col("exposures") >= min_exposure)
    )


def level_counts(df: DataFrame, category_min: int, route_min: int) -> DataFrame:
    """Kept categories and routes, each with the group for all others."""
    parts = [
        frequent_levels(df, column, limit).agg(
            F.lit(name).alias("feature"), (F.count(F.lit(1)) + 1).alias("levels_plus_other")
        )
        for name, column, limit in (
            ("category_group", "product_category_name_english", category_min),
            ("route_group", "route_state", route_min),
        )
    ]
    return parts[0].unionByName(parts[1])


def group_rare_levels(df: DataFrame, column: str, levels: DataFrame, output: str) -> DataFrame:
    """Keep the listed labels; everything else becomes ``Other``."""
    label = F.coalesce(F.col(column).cast("string"), F.lit(UNKNOWN))
    kept = levels.select(F.col("level").alias("__level"))
    return df.join(kept, label == F.col("__level"), "left").withColumn(
        output, F.coalesce("__level", F.lit(OTHER))
    ).drop("__level")


def level_tables(df: DataFrame, category_min: int, route_min: int) -> tuple[DataFrame, DataFrame]:
    """The kept categories and routes of ``df``, counted and broadcast if few."""
    return (
        checked_broadcast(frequent_levels(df, "product_category_name_english", category_min)),
        checked_broadcast(frequent_levels(df, "route_state", route_min)),
    )


def add_log_features(df: DataFrame) -> DataFrame:
    """Fill numerics with 0, floor them at 0 and add ``log1p``."""
    floored = {c: F.greatest(F.coalesce(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)) for c in NUMERIC_FEATURES}
    return df.withColumns(floored).withColumns({f"log_{c}": F.log1p(F.col(c)) for c in NUMERIC_FEATURES})


def prepare_features(
    df: DataFrame, categories: DataFrame, routes: DataFrame, *, missing_parts: str = "zero"
) -> DataFrame:
    """All model features.

    ``missing_parts`` says what a missing flag, month or weekday does: ``zero`` makes it the
    label "0" (boosting), ``fail`` stops the job (regression).
    """
    check_leakage(MODEL_FEATURES)
    out = group_rare_levels(df, "product_category_name_english", categories, "category_group")
    out = group_rare_levels(out, "route_state", routes, "route_group")
    parts = {}
    for column in ("cross_state_flag", "purchase_month", "purchase_weekday"):
        fallback = (
            F.lit(0) if missing_parts == "zero" else F.raise_error(F.lit(f"{column} is missing")).cast("int")
        )
        parts[f"{column}_cat"] = F.coalesce(F.col(column).cast("int"), fallback).cast("string")
    return add_log_features(out.withColumns(parts))


def claims_only(df: DataFrame) -> DataFrame:
    """Rows a severity model learns from."""
    return df.filter((F.col("covered_claim_flag") == 1) & (F.col("net_loss") > 0))
