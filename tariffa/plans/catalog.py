"""The registered queries: one per operator, over a star-schema folder."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffa.config import EXPOSURE_KEY
from tariffa.functions.columns import keyed_uniform
from tariffa.operators import attribution, backtest, boosting, features, glm, metrics, profile, rating, simulate, stress
from tariffa.operators import credibility as cred
from tariffa.operators import exposure as exposures
from tariffa.operators.joins import dimension_join
from tariffa.operators.quantiles import quantiles
from tariffa.plans.star import BACKTESTED, BOOSTING, CREDIBILITY, GLM, RATING, SIMULATION, SWEEP, StarStages, exact_cap_simulation
from tariffa.sources.quarantine import read_csv_diverting
from tariffa.sources.sinks import read_metrics, rewrite_partitions, stored, write_metrics
from tariffa.session import new_table_path

KEY = list(EXPOSURE_KEY)
CATEGORY, ROUTE = "product_category_name_english", "route_state"
Builder = Callable[[StarStages], DataFrame]

_REGISTRY: dict[str, Builder] = {}
_STAGES: dict[tuple, StarStages] = {}


def query(builder: Builder) -> Builder:
    """Register a builder under its function name."""
    _REGISTRY[builder.__name__] = builder
    return builder


def _state(spark: SparkSession, folder: str) -> tuple:
    """Length and time of each file in a folder."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files))


def stages(spark: SparkSession, folder: str) -> StarStages:
    """Stages of one input folder; tables written for one query serve the session's others until a file changes."""
    key = (spark.sparkContext.applicationId, folder, _state(spark, folder))
    if key not in _STAGES:
        _STAGES[key] = StarStages(spark, folder)
    return _STAGES[key]


def forget_stages() -> None:
    """Build every stage afresh from here on (after the input changed, or to time a query alone)."""
    _STAGES.clear()


# Sums of simulated losses differ in the last bits with the order of addition.
_MONEY = re.compile(r"(loss|premium|severity)(?!_ratio)(?!.*(_pct|_change|_to_expected))")


# Quotients of short decimals can end in an exact half, which engines round either way; a nudge
# far below the reported decimals settles it.
NUDGE = 1e-9


def digits(column: str) -> int:
    """Decimals a result column is reported with."""
    return 3 if _MONEY.search(column) else 6


def reported(df: DataFrame) -> DataFrame:
    """Round every double column to its reported decimals."""
    return df.select(
        *[
            F.round(F.col(f"`{f.name}`") + F.lit(NUDGE), digits(f.name)).alias(f.name)
            if f.dataType.typeName() == "double"
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(builder: Builder) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: reported(builder(stages(spark, folder)))

    return {name: bind(builder) for name, builder in _REGISTRY.items()}


def union_all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# --- inputs and exposure ---------------------------------------------------------------------


@query
def scan_exposure_inputs(s: StarStages) -> DataFrame:
    return union_all(
        [
            df.agg(
                F.lit(name).alias("table_name"),
                F.count(F.lit(1)).alias("row_count"),
                F.lit(len(df.columns)).alias("column_count"),
            )
            for name, df in s.tables.by_name().items()
        ]
    )


@query
def exposure_table(s: StarStages) -> DataFrame:
    return exposures.build_exposure(s.tables)


@query
def exposure_table_salted(s: StarStages) -> DataFrame:
    """Items joined to sellers by the shuffled route while one seller holds half of them: its rows are dealt over salts."""
    hot = F.when(F.col("order_id") % 2 == 0, F.lit(1)).otherwise(F.col("seller_id"))
    items = s.tables.items.withColumn("seller_id", hot.cast(s.tables.items.schema["seller_id"].dataType))
    joined = dimension_join(
        items, s.tables.sellers, "seller_id", row_key=["order_id", "order_item_id"], rows_per_salt=10_000, may_broadcast=False
    )
    return joined.groupBy("seller_id", "seller_city", "seller_state").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("freight_value").alias("freight_loss")
    )


def _faulty_csv(s: StarStages) -> dict[str, str]:
    """Items and orders as CSV, some rows with a bad number, a bad date or too few fields."""
    items, orders = s.tables.items, s.tables.orders
    at, line = F.col("order_id"), F.col("order_item_id")
    price = F.when((at % 50 == 3) & (line == 1), F.lit("n/a")).otherwise(F.col("price").cast("string"))
    freight = F.when((at % 64 == 5) & (line == 1), F.lit("12,x")).otherwise(F.col("freight_value").cast("string"))
    whole = [at, line, F.col("product_id"), F.col("seller_id"), F.lit("2020-01-02 03:04:05"), price, freight]
    quoted = [F.concat(F.lit('"'), c.cast("string"), F.lit('"')) for c in whole]
    short = F.concat_ws(",", *quoted[:3])
    item_lines = items.select(F.when((at % 77 == 1) & (line == 2), short).otherwise(F.concat_ws(",", *quoted)).alias("value"))
    bought = F.when(at % 60 == 2, F.lit("2024-13-45 99:00:00")).otherwise(F.col("order_purchase_timestamp").cast("string"))
    due = F.when(at % 90 == 2, F.lit("soon")).otherwise(F.col("order_estimated_delivery_date").cast("string"))
    parts = [at, F.col("customer_id"), F.col("order_status"), bought, F.lit(""), F.lit(""), F.lit(""), due]
    order_lines = orders.select(F.concat_ws(",", *[p.cast("string") for p in parts]).alias("value"))
    paths = {}
    for name, lines in (("items", item_lines), ("orders", order_lines)):
        paths[name] = new_table_path(s.spark, f"faulty-{name}")
        lines.write.text(paths[name])
    return paths


@query
def csv_quarantine(s: StarStages) -> DataFrame:
    """Malformed rows of CSV input, counted per column, beside the rows that are read."""
    parts = []
    for name, path in _faulty_csv(s).items():
        found = read_csv_diverting(s.spark, path, name, header=False)
        kept = found.rows.agg(F.lit(name).alias("table_name"), F.lit("(rows read)").alias("column_name"), F.count(F.lit(1)).alias("row_count"))
        held = found.quarantine.agg(F.lit(name).alias("table_name"), F.lit("(rows diverted)").alias("column_name"), F.count("text").alias("row_count"))
        parts += [kept, held, found.counts()]
    return union_all(parts)


@query
def month_rerun(s: StarStages) -> DataFrame:
    """Claims by month; one month is run again with other losses, and every other month keeps its files."""
    path = new_table_path(s.spark, "by-month")
    rows = s.claim_rows.select(*KEY, "purchase_month", "net_loss")
    rewrite_partitions(rows, path, ["purchase_month"])

    def files(name: str) -> DataFrame:
        held = s.spark.read.schema(rows.select(*KEY, "net_loss", "purchase_month").schema).parquet(path)
        per = held.groupBy("purchase_month", F.col("_metadata.file_path").alias("file")).agg(
            F.count(F.lit(1)).alias("n"), F.sum("net_loss").alias("loss")
        )
        return stored(
            per.groupBy("purchase_month").agg(
                F.sum("n").alias("row_count"), F.sum("loss").alias("total_net_loss"), F.array_sort(F.collect_list("file")).alias(name)
            ),
            name,
        )

    before = files("before").select("purchase_month", "before")
    again = rows.filter("purchase_month = 3").withColumn("net_loss", F.col("net_loss") * 2)
    rewrite_partitions(again, path, ["purchase_month"])
    after = files("after").withColumnRenamed("purchase_month", "month")
    return after.join(before, F.col("month").eqNullSafe(F.col("purchase_month"))).select(
        "purchase_month", "row_count", "total_net_loss", (F.col("before") == F.col("after")).cast("int").alias("files_kept")
    )


@query
def key_audit(s: StarStages) -> DataFrame:
    return exposures.key_audit(s.tables)


@query
def key_uniqueness_report(s: StarStages) -> DataFrame:
    return s.tables.items.groupBy(*KEY).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


@query
def join_match_rates(s: StarStages) -> DataFrame:
    return exposures.join_match_rates(s.tables)


@query
def exposure_profile(s: StarStages) -> DataFrame:
    return profile.exposure_profile(s.exposures)


@query
def missing_report(s: StarStages) -> DataFrame:
    return profile.missing_report(s.exposures)


@query
def numeric_quantiles(s: StarStages) -> DataFrame:
    return profile.numeric_quantiles(s.exposures)


@query
def numeric_quantiles_bucketed(s: StarStages) -> DataFrame:
    """The same table; there is one way at every size."""
    return profile.numeric_quantiles(s.exposures)


@query
def order_time_quantiles(s: StarStages) -> DataFrame:
    """A column far from zero: microseconds since 1970, all different."""
    micros = F.unix_micros("order_purchase_timestamp") + F.col("order_id")
    wanted = {"min": 0.0, "p25": 0.25, "p50": 0.5, "p99": 0.99, "max": 1.0}
    found = quantiles(s.tables.orders.select(micros.alias("micros")), [], ["micros"], list(wanted.values()))
    return found.select(
        F.col("n").alias("orders"), *[F.round(F.col("q")[i]).cast("long").alias(name) for i, name in enumerate(wanted)]
    )


@query
def cap_diagnostics(s: StarStages) -> DataFrame:
    return profile.cap_diagnostics(s.exposures)


@query
def anomaly_checks(s: StarStages) -> DataFrame:
    return profile.anomaly_checks(s.exposures)


@query
def status_summary(s: StarStages) -> DataFrame:
    return profile.status_summary(
        s.exposures
    )


@query
def category_freight_summary(s: StarStages) -> DataFrame:
    return profile.grouped_freight_summary(
        s.exposures,
        CATEGORY,
        min_exposures=RATING.freight_summary_min_exposures,
        delivered_status=SIMULATION.delivered_status,
    )


@query
def route_freight_summary(s: StarStages) -> DataFrame:
    return profile.grouped_freight_summary(
        s.exposures,
        ROUTE,
        min_exposures=RATING.freight_summary_min_exposures,
        delivered_status=SIMULATION.delivered_status,
    )


@query
def route_freight_summary_bucketed(s: StarStages) -> DataFrame:
    """The same table; there is one way at every size."""
    return profile.grouped_freight_summary(
        s.exposures,
        ROUTE,
        min_exposures=RATING.freight_summary_min_exposures,
        delivered_status=SIMULATION.delivered_status,
    )


@query
def top_categories(s: StarStages) -> DataFrame:
    return profile.top_values(s.exposures, CATEGORY)


@query
def top_routes(s: StarStages) -> DataFrame:
    return profile.top_values(s.exposures, ROUTE)


@query
def metric_by_cross_state(s: StarStages) -> DataFrame:
    return profile.describe_metrics(s.exposures)


@query
def exposure_overview(s: StarStages) -> DataFrame:
    return profile.exposure_overview(
        s.exposures, SIMULATION.delivered_status
    )


def _extreme(s: StarStages, column: str) -> DataFrame:
    return profile.top_extreme_rows(s.exposures, column)


@query
def top_freight_rows(s: StarStages) -> DataFrame:
    return _extreme(s, "freight_value")


@query
def top_ratio_rows(s: StarStages) -> DataFrame:
    return _extreme(s, "freight_to_price_ratio")


@query
def top_weight_rows(s: StarStages) -> DataFrame:
    return _extreme(s, "product_weight_g")


@query
def top_volume_rows(s: StarStages) -> DataFrame:
    return _extreme(s, "product_volume_cm3")


@query
def sink_round_trip(s: StarStages) -> DataFrame:
    """Write a table and a one-row metrics file, read both back and compare the counts."""
    spark = s.spark
    table = stored(s.exposures.select(*KEY, "price", "purchase_month"), "round_trip", partition_by=["purchase_month"])
    metrics_row = s.tables.items.agg(F.count(F.lit(1)).alias("row_count"))
    path = write_metrics(metrics_row, new_table_path(spark, "metrics"))
    recorded = read_metrics(spark, path, metrics_row.schema).select("row_count").scalar()
    return table.agg(F.count(F.lit(1)).alias("rows_read"), F.sum("price").alias("price_sum")).select(
        "rows_read", recorded.alias("rows_recorded"), F.round("price_sum", 2).alias("price_sum")
    )


# --- simulation ------------------------------------------------------------------------------


@query
def uniform_by_key(s: StarStages) -> DataFrame:
    return s.tables.items.select(
        *KEY,
        keyed_uniform(KEY, "return", SIMULATION.seed).alias("u_return"),
        keyed_uniform(KEY, "severity", SIMULATION.seed).alias("u_severity"),
    )


@query
def winsorise_p99(s: StarStages) -> DataFrame:
    capped = simulate.winsorise(s.exposures, exact_cap_simulation())
    return capped.select(*KEY, "freight_value_capped", "freight_to_price_ratio_capped")


@query
def impute_by_category_median(s: StarStages) -> DataFrame:
    return simulate.fill_sizes(s.exposures, s.size_statistics).select(
        *KEY,
        CATEGORY,
        "product_weight_g_filled",
        "product_weight_g_imputed_flag",
        "product_volume_cm3_filled",
        "product_volume_cm3_imputed_flag",
    )


@query
def frequency_factors(s: StarStages) -> DataFrame:
    names = [f"return_factor_{n}" for n in ("category", "route", "freight_ratio", "size", "month")]
    return simulate.prepare_claims(s.exposures, SIMULATION, s.size_statistics).select(*KEY, *names)


@query
def return_probability(s: StarStages) -> DataFrame:
    prepared = simulate.prepare_claims(s.exposures, SIMULATION, s.size_statistics)
    return prepared.select(*KEY, "claim_eligible_flag", "return_probability")


@query
def simulated_events(s: StarStages) -> DataFrame:
    prepared = simulate.prepare_claims(s.exposures, SIMULATION, s.size_statistics)
    return simulate.simulate_events(prepared, SIMULATION).select(
        *KEY,
        "return_requested",
        "return_approved",
        "refund_without_return",
        "partial_refund",
        "request_days_after_delivery",
        "return_reason",
        "covered_claim_flag",
        "covered_claim_probability",
    )


@query
def simulated_losses(s: StarStages) -> DataFrame:
    return simulate.simulate_claims(s.exposures, SIMULATION, s.size_statistics).select(
        *KEY, "claim_type", "gross_loss", "recovery_from_carrier", "paid_loss", "net_loss", "claim_status"
    )


@query
def claims_summary(s: StarStages) -> DataFrame:
    return simulate.claims_summary(s.claim_rows)


@query
def claim_label_counts(s: StarStages) -> DataFrame:
    return simulate.claim_label_counts(s.claim_rows)


# --- baseline rating -------------------------------------------------------------------------


@query
def portfolio_metrics(s: StarStages) -> DataFrame:
    return rating.portfolio_metrics(s.claim_rows, RATING)


def _rated(s: StarStages, group: str, limit: int) -> DataFrame:
    return rating.rating_summary(s.claim_rows, group, min_exposure=limit, config=RATING)


@query
def rating_by_category(s: StarStages) -> DataFrame:
    return _rated(s, CATEGORY, RATING.category_min_exposure)


@query
def rating_by_route(s: StarStages) -> DataFrame:
    return _rated(s, ROUTE, RATING.route_min_exposure)


@query
def rating_by_cross_state(s: StarStages) -> DataFrame:
    return _rated(s, "cross_state_flag", 1)


@query
def rating_by_seller(s: StarStages) -> DataFrame:
    return _rated(s, "seller_id", RATING.seller_min_exposure)


@query
def top_segments_by_pure_premium(s: StarStages) -> DataFrame:
    parts = []
    for kind, group, limit in (
        ("category", CATEGORY, RATING.category_min_exposure),
        ("route", ROUTE, RATING.route_min_exposure),
    ):
        top = rating.top_by_pure_premium(_rated(s, group, limit), group)
        parts.append(top.withColumnRenamed(group, "segment").withColumn("segment_kind", F.lit(kind)))
    return union_all(parts)


@query
def credible_group_counts(s: StarStages) -> DataFrame:
    return rating.credible_group_counts(s.claim_rows, RATING)


@query
def baseline_pricing(s: StarStages) -> DataFrame:
    return s.baseline_rows.select(
        *KEY,
        "claim_eligible_flag",
        "target_loss_ratio",
        "portfolio_pure_premium",
        "portfolio_commercial_premium",
        "baseline_pure_premium",
        "baseline_commercial_premium",
        "expected_loss",
        "expected_loss_ratio_to_freight",
        "expected_portfolio_loss_ratio",
    )


@query
def validate_baseline(s: StarStages) -> DataFrame:
    return rating.validate_baseline(s.baseline_rows, s.claim_rows, RATING)


@query
def order_premium(s: StarStages) -> DataFrame:
    return rating.order_premium(s.order_rows)


@query
def glm_with_baseline(s: StarStages) -> DataFrame:
    return rating.with_baseline(s.keyed_claims.select(*KEY, "covered_claim_flag"), s.keyed_baseline)


@query
def join_completeness(s: StarStages) -> DataFrame:
    return rating.unmatched_baseline(s.keyed_claims, s.keyed_baseline)


# --- credibility -----------------------------------------------------------------------------


@query
def seller_experience(s: StarStages) -> DataFrame:
    return cred.seller_experience(s.analytic_pricing)


@query
def seller_credibility(s: StarStages) -> DataFrame:
    return cred.seller_credibility(s.analytic_pricing, CREDIBILITY)


@query
def credibility_pricing(s: StarStages) -> DataFrame:
    return s.analytic_credibility_rows.select(
        *KEY,
        "glm_expected_loss",
        *cred._PUSHED_COLUMNS,
        "seller_risk_tier",
        "credibility_expected_loss",
        "credibility_commercial_premium",
        "credibility_expected_loss_ratio_to_glm",
        "credibility_premium_ratio_to_glm",
        "credibility_expected_loss_ratio_to_freight",
    )


@query
def tier_summary(s: StarStages) -> DataFrame:
    return cred.tier_summary(s.analytic_sellers)


@query
def seller_distribution(s: StarStages) -> DataFrame:
    return cred.seller_distribution(s.analytic_sellers)


@query
def credibility_portfolio(s: StarStages) -> DataFrame:
    return cred.portfolio_report(s.analytic_credibility)


@query
def credibility_k_sensitivity(s: StarStages) -> DataFrame:
    return cred.k_sensitivity(s.analytic_pricing, (100.0, 200.0, 400.0), CREDIBILITY)


@query
def seller_thresholds(s: StarStages) -> DataFrame:
    return cred.seller_thresholds(s.claim_rows, (190, 210))


@query
def validate_credibility(s: StarStages) -> DataFrame:
    return cred.validate_credibility(s.analytic_credibility)


# --- backtest and stress ---------------------------------------------------------------------


def _tested(s: StarStages, *groups: str) -> DataFrame:
    frame = backtest.one_of(s.backtests, BACKTESTED, groups)
    return backtest.sorted_backtest(frame, groups[0]) if groups else frame


@query
def backtest_portfolio(s: StarStages) -> DataFrame:
    return _tested(s)


@query
def backtest_month(s: StarStages) -> DataFrame:
    return _tested(s, "purchase_month")


@query
def backtest_category(s: StarStages) -> DataFrame:
    return _tested(s, CATEGORY)


@query
def backtest_route(s: StarStages) -> DataFrame:
    return _tested(s, ROUTE)


@query
def backtest_tier(s: StarStages) -> DataFrame:
    return _tested(s, "seller_risk_tier")


@query
def backtest_seller(s: StarStages) -> DataFrame:
    return _tested(s, "seller_id")


@query
def segment_counts(s: StarStages) -> DataFrame:
    return backtest.segment_counts(s.analytic_credibility)


@query
def top_loss_ratio_categories(s: StarStages) -> DataFrame:
    return backtest.top_segments(_tested(s, CATEGORY), CATEGORY, min_exposures=RATING.category_min_exposure)


@query
def top_loss_ratio_routes(s: StarStages) -> DataFrame:
    return backtest.top_segments(_tested(s, ROUTE), ROUTE, min_exposures=RATING.route_min_exposure)


@query
def top_loss_ratio_sellers(s: StarStages) -> DataFrame:
    return backtest.top_segments(_tested(s, "seller_id"), "seller_id", min_exposures=RATING.seller_min_exposure)


@query
def validate_backtest(s: StarStages) -> DataFrame:
    return backtest.validate_backtest(s.analytic_credibility, RATING.target_loss_ratio)


@query
def premium_totals(s: StarStages) -> DataFrame:
    return stress.premium_totals(s.analytic_credibility)


@query
def stress_portfolio(s: StarStages) -> DataFrame:
    return stress.portfolio_stress(s.analytic_credibility)


@query
def stress_by_tier(s: StarStages) -> DataFrame:
    return stress.segment_stress(s.analytic_credibility, "seller_risk_tier", "seller_tier")


def _watchlists(s: StarStages) -> list[tuple[str, DataFrame]]:
    n = RATING.watchlist_top_n
    return [
        (
            "category_watchlist",
            stress.watchlist(_tested(s, CATEGORY), CATEGORY, min_exposures=RATING.category_min_exposure, n=n),
        ),
        (
            "route_watchlist",
            stress.watchlist(_tested(s, ROUTE), ROUTE, min_exposures=RATING.route_min_exposure, n=n),
        ),
    ]


@query
def watchlist(s: StarStages) -> DataFrame:
    return union_all([df.withColumn("segment_type", F.lit(kind)) for kind, df in _watchlists(s)])


@query
def stress_watchlist(s: StarStages) -> DataFrame:
    return stress.watchlist_stress(s.analytic_credibility, _watchlists(s))


@query
def worst_scenarios(s: StarStages) -> DataFrame:
    return stress.worst_scenarios(stress_portfolio(s), [stress_by_tier(s), stress_watchlist(s)])


@query
def validate_stress(s: StarStages) -> DataFrame:
    return stress.validate_stress(stress_portfolio(s), backtest_portfolio(s))


# --- model toolkit on a closed-form score ----------------------------------------------------


@query
def order_split(s: StarStages) -> DataFrame:
    return features.split_counts(features.order_split(s.tables.items, GLM.test_size, GLM.seed))


@query
def order_split_exact(s: StarStages) -> DataFrame:
    return features.split_counts(features.order_split_exact(s.tables.items, GLM.test_size, GLM.seed))


def _featured(s: StarStages) -> DataFrame:
    levels = features.level_tables(
        rating.eligible_rows(s.claim_rows), GLM.category_min_exposure, GLM.route_min_exposure
    )
    return features.prepare_features(s.claim_rows, *levels)


@query
def rare_level_grouping(s: StarStages) -> DataFrame:
    return _featured(s).groupBy("category_group", "route_group").agg(F.count(F.lit(1)).alias("exposures"))


@query
def level_counts(s: StarStages) -> DataFrame:
    return features.level_counts(
        rating.eligible_rows(s.claim_rows), GLM.category_min_exposure, GLM.route_min_exposure
    )


@query
def model_features(s: StarStages) -> DataFrame:
    return _featured(s).select(*KEY, *features.MODEL_FEATURES)


@query
def base_feature_names(s: StarStages) -> DataFrame:
    """Encoded feature names of the data's own labels, mapped back to their source columns."""
    pairs = F.array(*[F.concat(F.lit(f"{c}_"), F.col(c)) for c in features.CATEGORICAL_FEATURES])
    names = _featured(s).select(F.explode(pairs).alias("encoded")).groupBy("encoded").agg(
        F.count(F.lit(1)).alias("n")
    )
    return names.groupBy(attribution.base_feature(F.col("encoded")).alias("base_feature")).agg(
        F.count(F.lit(1)).alias("encoded_feature_count"), F.sum("n").alias("row_count")
    )


@query
def leakage_report(s: StarStages) -> DataFrame:
    """Over the columns that the models use as well as those that they must not."""
    return features.leakage_report(_featured(s))


@query
def leakage_probe(s: StarStages) -> DataFrame:
    """Which features move with the outcomes?  None of the models' own; the last one, made from a loss under another name, must."""
    tables = features.level_tables(s.claim_rows, GLM.category_min_exposure, GLM.route_min_exposure)

    def build(rows: DataFrame) -> DataFrame:
        made = features.prepare_features(rows.withColumn("spending", F.log1p("net_loss")), *tables)
        return made.withColumn("control_from_outcome", F.round("spending", 4))

    return features.leakage_probe(s.claim_rows, build, [*features.MODEL_FEATURES, "control_from_outcome"])


def _scored(s: StarStages) -> DataFrame:
    return rating.eligible_rows(s.claim_rows).withColumns(
        {
            "pred_frequency": F.col("covered_claim_probability"),
            "pred_severity": F.col("freight_value_capped"),
            "pred_expected_loss": F.col("covered_claim_probability") * F.col("freight_value_capped"),
        }
    )


@query
def score_deciles(s: StarStages) -> DataFrame:
    return metrics.score_deciles(_scored(s), "pred_frequency", seed=GLM.seed).select(*KEY, "prediction_decile")


@query
def frequency_calibration(s: StarStages) -> DataFrame:
    return metrics.frequency_calibration(metrics.score_deciles(_scored(s), "pred_frequency", seed=GLM.seed))


@query
def severity_calibration(s: StarStages) -> DataFrame:
    claims = features.claims_only(_scored(s))
    return metrics.severity_calibration(metrics.score_deciles(claims, "pred_severity", seed=GLM.seed))


@query
def pure_premium_calibration(s: StarStages) -> DataFrame:
    return metrics.pure_premium_calibration(metrics.score_deciles(_scored(s), "pred_expected_loss", seed=GLM.seed))


@query
def exact_auc(s: StarStages) -> DataFrame:
    split = features.order_split(_scored(s), GLM.test_size, GLM.seed)
    return metrics.exact_auc(split, ["split"], "covered_claim_flag", "pred_frequency")


@query
def prediction_errors(s: StarStages) -> DataFrame:
    split = features.order_split(_scored(s), GLM.test_size, GLM.seed)
    return metrics.prediction_errors(split, ["split"], "covered_claim_flag", "pred_frequency")


# --- regression ------------------------------------------------------------------------------


@query
def glm_balance(s: StarStages) -> DataFrame:
    """Identities of the fitted parts: predicted claims equal the claims, losses over means equal n."""
    model = s.glm_model
    scored = model.score(model.features(rating.eligible_rows(s.claim_rows)))
    is_claim = (F.col("covered_claim_flag") == 1) & (F.col("net_loss") > 0)
    return scored.agg(
        F.count(F.lit(1)).alias("exposures"),
        F.sum("covered_claim_flag").alias("actual_claims"),
        F.round(F.sum("pred_frequency"), 2).alias("predicted_claims"),
        F.count_if(is_claim).alias("claims"),
        F.round(F.sum(F.when(is_claim, F.col("net_loss") / F.col("pred_severity"))), 2).alias(
            "scaled_severity_total"
        ),
    )


@query
def glm_score_equations(s: StarStages) -> DataFrame:
    """Both fits, each on the rows it was fitted on: every column of the design balances."""
    eligible = rating.eligible_rows(s.claim_rows)
    train = features.order_split(eligible, GLM.test_size, GLM.seed).filter("split = 'train'")
    fits = (("pricing", s.glm_model, eligible), ("validation", s.champion, train))
    return union_all([glm.score_equations(m, m.features(rows)).withColumn("fit", F.lit(name)) for name, m, rows in fits])


@query
def glm_coefficients(s: StarStages) -> DataFrame:
    model = s.glm_model
    return glm.coefficient_table(model.frequency, "frequency", s.spark).unionByName(
        glm.coefficient_table(model.severity, "severity", s.spark)
    )


@query
def glm_fit_statistics(s: StarStages) -> DataFrame:
    return glm.fit_statistics(s.glm_model, s.spark)


@query
def glm_metrics(s: StarStages) -> DataFrame:
    return glm.validation_metrics(s.glm_validation)


@query
def glm_validation_counts(s: StarStages) -> DataFrame:
    return glm.validation_metrics(s.glm_validation).select(
        "split",
        "exposures",
        "actual_claims",
        "actual_frequency",
        "actual_total_loss",
        "actual_pure_premium",
        "claims",
        "actual_severity",
    )


@query
def glm_calibration(s: StarStages) -> DataFrame:
    tables = glm.calibration_tables(s.glm_validation.filter("split = 'test'"))
    return union_all(
        [
            df.select(
                F.lit(part).alias("part"),
                "prediction_decile",
                F.col("claims" if part == "severity" else "exposures").alias("row_count"),
                F.col("actual_severity" if part == "severity" else "actual_frequency").alias("actual_mean"),
                F.col("predicted_severity" if part == "severity" else "predicted_frequency").alias("predicted_mean"),
            )
            for part, df in tables.items()
        ]
    )


@query
def glm_pricing(s: StarStages) -> DataFrame:
    return s.glm_pricing


def _ratio_mismatches(ratio: str, above: str, below: str) -> Column:
    """Rows whose ratio times its denominator is not the numerator, or is not 0 where there is nothing to divide by."""
    positive = F.col(below) > 0
    off = F.abs(F.col(ratio) * F.col(below) - F.col(above)) > 1e-9
    return F.count_if(F.col(ratio).isNull() | F.when(positive, off).otherwise(F.col(ratio) != 0))


@query
def glm_pricing_checks(s: StarStages) -> DataFrame:
    priced = s.glm_pricing
    eligible = F.col("claim_eligible_flag") == 1
    product = F.col("glm_frequency") * F.col("glm_severity")
    premium = F.col("glm_expected_loss") / F.lit(RATING.target_loss_ratio)
    return priced.agg(
        F.count(F.lit(1)).alias("pricing_rows"),
        F.count_if(eligible).alias("eligible_exposures"),
        F.count_if(~eligible & (F.col("glm_expected_loss") != 0)).alias("ineligible_priced"),
        F.count_if(eligible & ~(F.col("glm_expected_loss") > 0)).alias("eligible_unpriced"),
        F.count_if(F.abs(F.col("glm_expected_loss") - product) > 1e-9).alias("product_mismatches"),
        F.count_if(F.abs(F.col("glm_commercial_premium") - premium) > 1e-9).alias("premium_mismatches"),
        _ratio_mismatches("glm_expected_loss_ratio_to_freight", "glm_expected_loss", "freight_value_capped").alias(
            "freight_ratio_mismatches"
        ),
        _ratio_mismatches("glm_expected_loss_ratio_to_baseline", "glm_expected_loss", "baseline_pure_premium").alias(
            "baseline_ratio_mismatches"
        ),
        F.sum("baseline_pure_premium").alias("baseline_expected_total_loss"),
    )


@query
def glm_portfolio(s: StarStages) -> DataFrame:
    return glm.portfolio_report(s.glm_pricing)


@query
def glm_credibility_checks(s: StarStages) -> DataFrame:
    return cred.validate_credibility(s.glm_credibility)


@query
def glm_backtest(s: StarStages) -> DataFrame:
    return backtest.backtest(s.glm_credibility, ["seller_risk_tier"], RATING.target_loss_ratio)


@query
def glm_backtest_actuals(s: StarStages) -> DataFrame:
    return backtest.backtest(s.glm_credibility, [CATEGORY], RATING.target_loss_ratio).select(
        CATEGORY, "eligible_exposures", "covered_claim_count", "actual_loss", "baseline_loss_ratio"
    )


@query
def glm_stress(s: StarStages) -> DataFrame:
    return stress.portfolio_stress(s.glm_credibility)


# --- challenger ------------------------------------------------------------------------------


@query
def model_comparison(s: StarStages) -> DataFrame:
    return boosting.model_comparison(s.boosted_validation, GLM.target_loss_ratio)


@query
def model_comparison_actuals(s: StarStages) -> DataFrame:
    return model_comparison(s).select(
        "model_name", "split", "exposures", "actual_claims", "claims_for_severity", "actual_total_loss"
    )


@query
def challenger_calibration_identity(s: StarStages) -> DataFrame:
    """Recomputed from the written scores: calibrated losses match the train actuals, and scaling leaves the ranking alone."""
    scored = s.boosted_validation

    def auc(score: str) -> DataFrame:
        return metrics.exact_auc(scored, ["split"], "covered_claim_flag", score).select("split", F.col("auc").alias(score))

    ranks = auc("challenger_expected_loss_raw").join(auc("challenger_expected_loss"), "split")
    totals = scored.groupBy("split").agg(
        F.count(F.lit(1)).alias("exposures"),
        (F.sum("net_loss") / F.sum("challenger_expected_loss")).alias("ratio"),
        F.countDistinct("challenger_calibration_factor").alias("factors"),
    )
    return totals.join(ranks, "split").select(
        "split",
        "exposures",
        "factors",
        F.when(F.col("split") == "train", F.col("ratio")).otherwise(1.0).alias("train_actual_to_expected"),
        F.abs(F.col("challenger_expected_loss_raw") - F.col("challenger_expected_loss")).alias("auc_gap_raw_vs_calibrated"),
    )


@query
def challenger_margin_identity(s: StarStages) -> DataFrame:
    """Both models once more from their leaf intervals alone, without Spark ML: every test row gets the same score."""
    model = s.challenger_model
    scored = model.spark_score(s.test_features, "check")
    parts = []
    for name, encoder, trees in (
        ("frequency", model.frequency_encoder, model.frequency_model),
        ("severity", model.severity_encoder, model.severity_model),
    ):
        leaves = stored(attribution.leaf_intervals(attribution.node_table(trees, s.spark)), "leaves")
        rows = attribution.with_interval_margin(encoder.transform(scored), leaves, vector_to_array("__ml_x"))
        own = {
            "frequency": F.abs(1.0 / (1.0 + F.exp(-2.0 * F.col("margin"))) - F.col("check_frequency")) > 1e-9,
            "severity": F.abs(F.greatest(F.expm1("margin"), F.lit(0.01)) / F.col("check_severity") - 1.0) > 1e-9,
        }[name]
        tested = rows.agg(F.count(F.lit(1)).alias("rows_checked"), F.count_if(own).alias("margin_mismatches"))
        counted = leaves.agg(F.countDistinct("tree_id").alias("trees")).scalar()
        parts.append(tested.withColumns({"model": F.lit(name), "trees": counted}))
    return union_all(parts)


@query
def challenger_calibration(s: StarStages) -> DataFrame:
    return boosting.comparison_calibration(s.boosted_validation)


@query
def best_model(s: StarStages) -> DataFrame:
    return boosting.best_model(stored(model_comparison(s), "comparison"))


@query
def challenger_pricing(s: StarStages) -> DataFrame:
    return s.challenger_pricing


@query
def challenger_report(s: StarStages) -> DataFrame:
    return boosting.challenger_report(s.challenger_pricing)


@query
def challenger_checks(s: StarStages) -> DataFrame:
    eligible = F.col("claim_eligible_flag") == 1
    return s.challenger_pricing.agg(
        F.count(F.lit(1)).alias("pricing_rows"),
        F.count_if(eligible).alias("eligible_exposures"),
        F.count_if(~eligible & (F.col("challenger_expected_loss") != 0)).alias("ineligible_priced"),
        F.count_if((F.col("challenger_frequency") < 0) | (F.col("challenger_frequency") > 1)).alias(
            "probabilities_outside"
        ),
        F.sum(F.when(eligible, F.col("net_loss"))).alias("actual_total_loss"),
        F.sum(F.when(eligible, F.col("challenger_expected_loss"))).alias("calibrated_expected_total_loss"),
    )


@query
def challenger_decile_sizes(s: StarStages) -> DataFrame:
    return s.challenger_pricing.groupBy("challenger_risk_score_decile").agg(F.count(F.lit(1)).alias("exposures"))


@query
def parameter_sweep(s: StarStages) -> DataFrame:
    return boosting.sweep_report(s.sweep)


@query
def parameter_sweep_checks(s: StarStages) -> DataFrame:
    """Every setting has scored every row of both sides, with a probability and with trees of its own."""
    first, p = F.col("scores")[0], F.col("p")
    long = s.sweep.scores.select("split", "covered_claim_flag", first.alias("p0"), F.posexplode("scores").alias("at", "p"))
    found = long.groupBy("split", "at").agg(
        F.count(F.lit(1)).alias("exposures"),
        F.sum("covered_claim_flag").alias("actual_claims"),
        F.count_if(~((p > 0) & (p < 1))).alias("outside"),
        (F.count_if(p != F.col("p0")) > 0).cast("int").alias("differs_from_first"),
    )
    trees = F.array(*[F.lit(c.frequency_trees) for _, c in SWEEP])
    names = F.array(*[F.lit(name) for name, _ in SWEEP])
    return found.select(F.get(names, "at").alias("setting"), F.get(trees, "at").alias("trees"), "split", "exposures", "actual_claims", "outside", "differs_from_first")


# --- attribution -----------------------------------------------------------------------------


@query
def feature_importance(s: StarStages) -> DataFrame:
    model = s.challenger_model
    return attribution.split_importance(
        model.frequency_model, model.frequency_encoder, "frequency", s.spark
    ).unionByName(attribution.split_importance(model.severity_model, model.severity_encoder, "severity", s.spark))


@query
def contribution_identity(s: StarStages) -> DataFrame:
    """Parts plus bias give the margin, and the margin gives the model's own score, for both models."""
    scored = s.challenger_model.score(s.test_features, "check").select(*KEY, "check_frequency", "check_severity")
    added = F.aggregate("contributions", F.lit(0.0), lambda a, b: a + b) + F.col("bias")
    chance = 1.0 / (1.0 + F.exp(-F.col("margin")))
    wrong = {
        "frequency": F.abs(chance - F.col("check_frequency")) > 1e-9,
        "severity": F.abs(F.greatest(F.expm1("margin"), F.lit(0.01)) / F.col("check_severity") - 1.0) > 1e-9,
    }
    explained = {"frequency": s.frequency_contributions, "severity": s.severity_contributions}
    return union_all(
        [
            explained[name].rows.join(scored, KEY).agg(
                F.lit(name).alias("model"),
                F.count(F.lit(1)).alias("rows_explained"),
                F.count_if(F.abs(added - F.col("margin")) > 1e-9).alias("additive_mismatches"),
                F.count_if(differs).alias("model_mismatches"),
            )
            for name, differs in wrong.items()
        ]
    )


@query
def contribution_summary(s: StarStages) -> DataFrame:
    return s.contribution_table


@query
def base_feature_summary(s: StarStages) -> DataFrame:
    return attribution.base_feature_summary(s.contribution_table)


@query
def top_contribution_features(s: StarStages) -> DataFrame:
    columns = ["model", "encoded_feature", "base_feature", "mean_abs_contribution", "mean_abs_contribution_share"]
    return union_all(
        [
            attribution.top_features(s.contribution_table.filter(F.col("model") == model), columns)
            for model in ("frequency", "severity")
        ]
    )


@query
def attribution_identity(s: StarStages) -> DataFrame:
    """Every encoded feature is listed once, no feature is credited without a split, and as many splits are listed as the leaves ask for."""
    model = s.challenger_model
    leaves = {}
    for name, trees in (("frequency", model.frequency_model), ("severity", model.severity_model)):
        rows = attribution.leaf_intervals(attribution.node_table(trees, s.spark))
        leaves[name] = rows.agg(F.count(F.lit(1)) - F.countDistinct("tree_id")).scalar()
    asked = F.when(F.col("model") == "frequency", leaves["frequency"]).otherwise(leaves["severity"])
    listed = stored(feature_importance(s), "importance")
    importance = listed.groupBy("model").agg(
        F.count(F.lit(1)).alias("importance_features"), F.sum("weight").alias("splits")
    ).withColumn("split_gap", F.col("splits") - asked).drop("splits")
    unused = listed.filter("weight = 0").select("model", "encoded_feature")
    credited = s.contribution_table.join(unused, ["model", "encoded_feature"]).filter("mean_abs_contribution <> 0")
    shares = s.contribution_table.groupBy("model").agg(F.count(F.lit(1)).alias("contribution_features"))
    wrong = credited.groupBy("model").agg(F.count(F.lit(1)).alias("n"))
    return importance.join(shares, "model").join(wrong, "model", "left").select(
        "model", "importance_features", "contribution_features", "split_gap", F.coalesce("n", F.lit(0)).alias("credited_without_split")
    )
