"""Boosted-tree challenger to the regression, compared and calibrated on the same split."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import cached_property

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tariffa.config import EXPOSURE_KEY, BoostingConfig, GlmConfig
from tariffa.functions.columns import clip, positive_divide, safe_divide
from tariffa.operators import metrics
from tariffa.operators.features import (
    CATEGORICAL_FEATURES,
    LOG_FEATURES,
    claims_only,
    level_tables,
    order_split,
    prepare_features,
)
from tariffa.operators.glm import TwoPartGlm, fit_two_part
from tariffa.operators.histogram_trees import boost
from tariffa.operators.leaf_tables import margin_of
from tariffa.operators.rating import eligible_rows
from tariffa.sources.sinks import stored
from tariffa.session import ensure_checkpoint_dir, side_by_side

MODEL_FAMILY = "spark_gbt"
# Encoded training rows a partition holds, a node's pass over which is worth a task, until there are SMALL_PARTITIONS of them;
# a larger table has as many partitions as LARGE_PARTITION_ROWS asks for.
ROWS_PER_PARTITION = 20_000
SMALL_PARTITIONS = 64
LARGE_PARTITION_ROWS = 100_000
# The output columns.
CHALLENGER_OUTPUT_COLUMNS = [
    "order_id",
    "order_item_id",
    "seller_id",
    "product_id",
    "customer_id",
    "order_status",
    "product_category_name_english",
    "route_state",
    "cross_state_flag",
    "purchase_month",
    "purchase_weekday",
    "price",
    "freight_value",
    "freight_value_capped",
    "freight_to_price_ratio_capped",
    "product_weight_g_filled",
    "product_volume_cm3_filled",
    "estimated_delivery_days",
    "claim_eligible_flag",
    "covered_claim_flag",
    "paid_loss",
    "net_loss",
    "target_loss_ratio",
    "baseline_pure_premium",
    "baseline_commercial_premium",
    "glm_frequency",
    "glm_severity",
    "glm_expected_loss",
    "glm_commercial_premium",
    "category_group",
    "route_group",
    "challenger_model_family",
    "challenger_frequency",
    "challenger_severity",
    "challenger_expected_loss_raw",
    "challenger_calibration_factor",
    "challenger_expected_loss",
    "challenger_commercial_premium",
    "challenger_expected_loss_ratio_to_glm",
    "challenger_risk_score_decile",
]


def encoder_stages(output: str) -> list:
    """One slot per training label plus the logs; an unseen label is all zeros."""
    indexed = [f"__ml_i_{c}" for c in CATEGORICAL_FEATURES]
    encoded = [f"__ml_v_{c}" for c in CATEGORICAL_FEATURES]
    return [
        # the extra "unseen" index is the last one, which the encoder drops
        StringIndexer(
            inputCols=CATEGORICAL_FEATURES, outputCols=indexed, stringOrderType="alphabetAsc", handleInvalid="keep"
        ),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
        VectorAssembler(inputCols=[*encoded, *LOG_FEATURES], outputCol=output),
    ]


def encoded_names(encoder: PipelineModel) -> list[str]:
    """Feature name of every vector slot, in order."""
    names = []
    for column, labels in zip(CATEGORICAL_FEATURES, encoder.stages[0].labelsArray, strict=True):
        names += [f"{column}_{label}" for label in labels]
    return [*names, *LOG_FEATURES]


@dataclass(frozen=True)
class Challenger:
    frequency_encoder: PipelineModel
    frequency_model: object
    severity_encoder: PipelineModel
    severity_model: object
    categories: DataFrame
    routes: DataFrame

    def features(self, df: DataFrame) -> DataFrame:
        return prepare_features(df, self.categories, self.routes, missing_parts="zero")

    @cached_property
    def margins(self) -> tuple[Callable[[], Column], Callable[[], Column]]:
        """Outputs of both ensembles from tables of their leaves."""
        spark = self.categories.sparkSession
        parts = ((self.frequency_encoder, self.frequency_model), (self.severity_encoder, self.severity_model))
        return tuple(margin_of(encoder, model, LOG_FEATURES, spark) for encoder, model in parts)

    def score(self, features: DataFrame, prefix: str) -> DataFrame:
        """Add ``{prefix}_frequency``, ``{prefix}_severity`` and their raw product.

        The scores are those of Spark's own models (:meth:`spark_score`) but for rounding; no row becomes a vector of all labels
        or walks all trees.
        """
        frequency, severity = self.margins
        out = self.frequency_encoder.stages[0].transform(features).withColumn("__gbt_f", frequency())
        out = self.severity_encoder.stages[0].transform(out.drop(*self._numbers)).withColumn("__gbt_y", severity())
        return self._scored(out.withColumn("__gbt_f", class_probability("__gbt_f")), prefix)

    def spark_score(self, features: DataFrame, prefix: str) -> DataFrame:
        """The same by Spark's models."""
        out = self.frequency_model.transform(self.frequency_encoder.transform(features)).withColumn("__p", vector_to_array("__gbt_p")[1])
        out = out.drop(*[c for c in out.columns if c.startswith(("__ml_", "__gbt_"))])
        out = self.severity_model.transform(self.severity_encoder.transform(out))
        return self._scored(out.withColumnRenamed("__p", "__gbt_f"), prefix)

    @property
    def _numbers(self) -> list[str]:
        return self.frequency_encoder.stages[0].getOutputCols()

    def _scored(self, out: DataFrame, prefix: str) -> DataFrame:
        out = out.withColumns(
            {
                f"{prefix}_frequency": clip("__gbt_f", 0.0, 1.0),
                # Fixed value: the smallest severity a score may have.
                f"{prefix}_severity": F.greatest(F.expm1("__gbt_y"), F.lit(0.01)),
            }
        )
        out = out.drop(*[c for c in out.columns if c.startswith(("__ml_", "__gbt_"))])
        return out.withColumn(
            f"{prefix}_expected_loss_raw", F.col(f"{prefix}_frequency") * F.col(f"{prefix}_severity")
        )


def class_probability(margin: str) -> Column:
    """Probability of a boosted classifier's class 1, as Spark works it out."""
    return 1.0 - 1.0 / (1.0 + F.exp(2.0 * F.col(margin)))


def _frequency_estimator(config: BoostingConfig) -> GBTClassifier:
    estimator = GBTClassifier(
        labelCol="__label",
        featuresCol="__ml_x",
        predictionCol="__gbt_c",
        maxIter=config.frequency_trees,
        maxDepth=config.frequency_depth,
        stepSize=config.frequency_step,
        subsamplingRate=config.frequency_subsample,
        featureSubsetStrategy=config.frequency_feature_share,
        minInstancesPerNode=config.frequency_min_rows,
        checkpointInterval=config.checkpoint_interval,
        seed=config.seed,
    )
    return estimator.setProbabilityCol("__gbt_p").setRawPredictionCol("__gbt_r")


def _severity_estimator(config: BoostingConfig) -> GBTRegressor:
    return GBTRegressor(
        labelCol="__label",
        featuresCol="__ml_x",
        predictionCol="__gbt_y",
        maxIter=config.severity_trees,
        maxDepth=config.severity_depth,
        stepSize=config.severity_step,
        subsamplingRate=config.severity_subsample,
        featureSubsetStrategy=config.severity_feature_share,
        minInstancesPerNode=config.severity_min_rows,
        checkpointInterval=config.checkpoint_interval,
        seed=config.seed,
    )


def training_partitions(rows: int) -> int:
    """Partitions of a training table, from its number of rows alone."""
    return max(1, min(SMALL_PARTITIONS, -(-rows // ROWS_PER_PARTITION)), -(-rows // LARGE_PARTITION_ROWS))


@contextmanager
def training_rows(encoder: PipelineModel, rows: DataFrame, columns: Sequence[Column]) -> Iterator[DataFrame]:
    """The encoded rows that a fit packs into blocks: label numbers, logs and ``columns``, persisted.

    They are dealt and sorted by the exposure key into as many partitions as their number asks for, so the rows that a tree draws depend on
    the data alone, not on how the input was split or on the cores.
    """
    dealt = rows.repartition(training_partitions(rows.count()), *EXPOSURE_KEY).sortWithinPartitions(*EXPOSURE_KEY)
    indexed = encoder.stages[0].transform(dealt)
    ready = indexed.select(*label_numbers(encoder), *LOG_FEATURES, *columns).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield ready
    finally:
        ready.unpersist()


def frequency_labels() -> list[Column]:
    return [F.col("covered_claim_flag").cast("double").alias("__label")]


def label_numbers(encoder: PipelineModel) -> dict[str, int]:
    """Columns of label numbers, and how many labels each has."""
    indexer = encoder.stages[0]
    return {c: len(labels) for c, labels in zip(indexer.getOutputCols(), indexer.labelsArray, strict=True)}


def fit_frequency(features: DataFrame, config: BoostingConfig):
    """Encoder and boosted classifier; each label is encoded from the rows passed in."""
    ensure_checkpoint_dir(features.sparkSession)
    encoder = Pipeline(stages=encoder_stages("__ml_x")).fit(features)
    with training_rows(encoder, features, frequency_labels()) as ready:
        estimator = _frequency_estimator(config)
        return encoder, boost(ready, label_numbers(encoder), LOG_FEATURES, [(estimator, config.positive_weight)])[0][0]


def fit_severity(claims: DataFrame, config: BoostingConfig):
    """Encoder and boosted regressor of ``log1p(net_loss)``."""
    ensure_checkpoint_dir(claims.sparkSession)
    encoder = Pipeline(stages=encoder_stages("__ml_x")).fit(claims)
    with training_rows(encoder, claims, [F.log1p("net_loss").alias("__label")]) as ready:
        return encoder, boost(ready, label_numbers(encoder), LOG_FEATURES, [(_severity_estimator(config), 1.0)])[0][0]


def fit_challenger(
    population: DataFrame, config: BoostingConfig | None = None, levels: GlmConfig | None = None
) -> Challenger:
    """Fit both parts on eligible rows, side by side; levels are chosen on the same rows."""
    config, levels = config or BoostingConfig(), levels or GlmConfig()
    categories, routes = level_tables(population, levels.category_min_exposure, levels.route_min_exposure)
    features = (
        prepare_features(population, categories, routes, missing_parts="zero")
        .select(*EXPOSURE_KEY, *CATEGORICAL_FEATURES, *LOG_FEATURES, "covered_claim_flag", "net_loss")
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    try:
        claims = claims_only(features)
        if claims.isEmpty():
            raise ValueError("Cannot fit a severity model: there are no covered claims in the training data.")
        fits = [lambda: fit_frequency(features, config), lambda: fit_severity(claims, config)]
        (f_encoder, f_model), (s_encoder, s_model) = side_by_side(population.sparkSession, fits)
    finally:
        features.unpersist()
    return Challenger(f_encoder, f_model, s_encoder, s_model, categories, routes)


def actual_to_expected(scored: DataFrame, expected: str, condition=None):
    """Total actual over total expected loss, as a scalar subquery."""
    rows = scored if condition is None else scored.filter(condition)
    return rows.agg(safe_divide(F.sum("net_loss"), F.sum(expected))).scalar()


# Model name, role and family of the three compared scores.
_COMPARED = {
    "glm": ("current_pricing_model", "spark_binomial_gamma_glm"),
    "challenger_raw": ("challenger_risk_score_uncalibrated", MODEL_FAMILY),
    "challenger_calibrated": ("challenger_pricing_diagnostic", MODEL_FAMILY),
}


def validation_scores(
    pricing: DataFrame,
    config: BoostingConfig | None = None,
    glm: GlmConfig | None = None,
    challenger: Challenger | None = None,
    champion: TwoPartGlm | None = None,
) -> DataFrame:
    """Both models fitted on the train orders (unless given), scoring train and test eligible rows once.

    Columns: the pricing columns, ``split``, the regression's ``pred_*`` and the challenger's
    ``challenger_*`` with the calibrated expected loss.
    """
    config, glm = config or BoostingConfig(), glm or GlmConfig()
    split = order_split(eligible_rows(pricing), glm.test_size, glm.seed)
    train = split.filter("split = 'train'")
    champion = champion or fit_two_part(train, glm)
    challenger = challenger or fit_challenger(train, config, glm)
    scored = champion.score(champion.features(split)).drop(
        "category_group", "route_group", *[c for c in CATEGORICAL_FEATURES], *LOG_FEATURES
    )
    scored = stored(challenger.score(challenger.features(scored), "challenger"), "validation")
    factor = actual_to_expected(scored, "challenger_expected_loss_raw", F.col("split") == "train")
    return scored.withColumn("challenger_calibration_factor", factor).withColumn(
        "challenger_expected_loss", F.col("challenger_expected_loss_raw") * F.col("challenger_calibration_factor")
    )


def compared_scores(scored: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Long form: one row per (row, model) with frequency, severity and expected loss."""
    columns = {
        "glm": ("pred_frequency", "pred_severity", "pred_expected_loss"),
        "challenger_raw": ("challenger_frequency", "challenger_severity", "challenger_expected_loss_raw"),
        "challenger_calibrated": ("challenger_frequency", "challenger_severity", "challenger_expected_loss"),
    }
    models = F.array(
        *[
            F.struct(
                F.lit(name).alias("model_name"),
                F.lit(_COMPARED[name][0]).alias("model_role"),
                F.lit(_COMPARED[name][1]).alias("model_family"),
                F.col(f).alias("frequency"),
                F.col(s).alias("severity"),
                F.col(e).alias("expected_loss"),
            )
            for name, (f, s, e) in columns.items()
        ]
    )
    return scored.select("split", "covered_claim_flag", "net_loss", *extra, F.inline(models))


def model_comparison(scored: DataFrame, target: float) -> DataFrame:
    """Twenty-four measures for each model on each split, from one long table."""
    long = compared_scores(scored)
    group = ["model_name", "model_role", "model_family", "split"]
    is_claim = (F.col("covered_claim_flag") == 1) & (F.col("net_loss") > 0)
    loss, severity = F.when(is_claim, F.col("net_loss")), F.when(is_claim, F.col("severity"))
    table = (
        long.groupBy(*group)
        .agg(
            F.count(F.lit(1)).alias("exposures"),
            F.sum("covered_claim_flag").alias("actual_claims"),
            F.avg("covered_claim_flag").alias("actual_frequency"),
            F.avg("frequency").alias("predicted_frequency"),
            safe_divide(F.sum("covered_claim_flag"), F.sum("frequency")).alias("frequency_actual_to_expected"),
            metrics.mean_squared("covered_claim_flag", "frequency").alias("frequency_brier_score"),
            F.count_if(is_claim).alias("claims_for_severity"),
            F.avg(loss).alias("actual_severity"),
            F.avg(severity).alias("predicted_severity"),
            safe_divide(F.sum(loss), F.sum(severity)).alias("severity_actual_to_expected"),
            F.avg(F.abs(loss - severity)).alias("severity_mae"),
            F.sqrt(F.avg((loss - severity) * (loss - severity))).alias("severity_rmse"),
            F.sum("net_loss").alias("actual_total_loss"),
            F.sum("expected_loss").alias("predicted_total_loss"),
            F.avg("net_loss").alias("actual_pure_premium"),
            F.avg("expected_loss").alias("predicted_pure_premium"),
        )
        .withColumn("pure_premium_actual_to_expected", safe_divide("actual_total_loss", "predicted_total_loss"))
        .withColumn("commercial_premium", F.col("predicted_total_loss") / F.lit(target))
        .withColumn("loss_ratio", safe_divide("actual_total_loss", "commercial_premium"))
    )
    auc = metrics.exact_auc(long, ["model_name", "split"], "covered_claim_flag", "frequency").select(
        "model_name", "split", F.col("auc").alias("frequency_auc")
    )
    return table.join(auc, ["model_name", "split"], "left")


def comparison_calibration(scored: DataFrame) -> DataFrame:
    """Decile tables of the three models on the test split, stacked."""
    long = (
        compared_scores(scored.filter("split = 'test'"), EXPOSURE_KEY)
        .withColumnRenamed("frequency", "pred_frequency")
        .withColumnRenamed("expected_loss", "pred_expected_loss")
    )
    ranked = metrics.score_deciles(long, "pred_expected_loss", by=["model_name"])
    return metrics.pure_premium_calibration(ranked, ["model_name", "model_family", "split"])


def best_model(comparison: DataFrame) -> DataFrame:
    """The best test AUC, and the calibrated challenger's differences to the regression."""
    test = comparison.filter("split = 'test'")
    best = test.orderBy(F.desc_nulls_last("frequency_auc"), "model_name").limit(1)

    def of(model: str, column: str):
        return F.max(F.when(F.col("model_name") == model, F.col(column)))

    gaps = test.agg(
        (of("challenger_calibrated", "frequency_auc") - of("glm", "frequency_auc")).alias("auc_minus_glm"),
        (
            of("challenger_calibrated", "pure_premium_actual_to_expected")
            - of("glm", "pure_premium_actual_to_expected")
        ).alias("ae_minus_glm"),
    ).select(F.struct("auc_minus_glm", "ae_minus_glm"))
    gap = gaps.scalar()
    return best.select(
        F.col("model_name").alias("best_model"),
        F.col("frequency_auc").alias("best_frequency_auc"),
        gap.getField("auc_minus_glm").alias("challenger_frequency_auc_minus_glm"),
        gap.getField("ae_minus_glm").alias("challenger_test_ae_minus_glm"),
    )


def challenger_pricing(
    pricing: DataFrame,
    config: BoostingConfig | None = None,
    glm: GlmConfig | None = None,
    columns: Sequence[str] = CHALLENGER_OUTPUT_COLUMNS,
    model: Challenger | None = None,
) -> DataFrame:
    """Refit on every eligible row, price every item, match the portfolio's actual loss, rank.

    The wide table is written once, with the raw scores; calibration, premium and rank are expressions over it, the rank by nine
    cuts that only the narrow score column is read for.
    """
    config, glm = config or BoostingConfig(), glm or GlmConfig()
    model = model or fit_challenger(eligible_rows(pricing), config, glm)
    eligible = F.col("claim_eligible_flag") == 1
    scored = model.score(model.features(pricing.drop("category_group", "route_group")), "challenger")
    scored = scored.withColumns(
        {
            c: F.when(eligible, F.col(c)).otherwise(0.0)
            for c in ("challenger_frequency", "challenger_severity", "challenger_expected_loss_raw")
        }
    )
    # the totals that calibrate the scores are taken while the table is written
    totals = Observation("challenger totals")
    scored = scored.drop(*CATEGORICAL_FEATURES[2:], *LOG_FEATURES).observe(
        totals,
        F.sum(F.when(eligible, F.col("net_loss"))).alias("actual"),
        F.sum(F.when(eligible, F.col("challenger_expected_loss_raw"))).alias("expected"),
    )
    scored = stored(scored, "challenger")
    actual, expected = totals.get["actual"] or 0.0, totals.get["expected"] or 0.0
    factor = F.lit(float(actual / expected) if expected else 0.0)
    priced = (
        scored.withColumn("challenger_calibration_factor", F.when(eligible, factor).otherwise(0.0))
        .withColumn(
            "challenger_expected_loss",
            F.col("challenger_expected_loss_raw") * F.col("challenger_calibration_factor"),
        )
        .withColumns(
            {
                "target_loss_ratio": F.lit(glm.target_loss_ratio),
                "challenger_model_family": F.lit(MODEL_FAMILY),
                "challenger_commercial_premium": F.col("challenger_expected_loss") / F.lit(glm.target_loss_ratio),
                "challenger_expected_loss_ratio_to_glm": positive_divide(
                    "challenger_expected_loss", "glm_expected_loss"
                ),
                # only eligible rows are ranked; the score is missing elsewhere
                "__rank_score": F.when(eligible, F.col("challenger_expected_loss")),
            }
        )
    )
    ranked = metrics.score_deciles(priced, "__rank_score", "challenger_risk_score_decile", keep_cuts=True)
    return ranked.withColumn(
        "challenger_risk_score_decile", F.coalesce("challenger_risk_score_decile", F.lit(0))
    ).select(*columns)


def challenger_report(priced: DataFrame) -> DataFrame:
    """One row: raw, actual and calibrated totals, factor, A/E and loss ratio."""
    return (
        eligible_rows(priced)
        .agg(
            F.count(F.lit(1)).alias("eligible_exposures"),
            F.sum("challenger_expected_loss_raw").alias("raw_expected_total_loss"),
            F.sum("net_loss").alias("actual_total_loss"),
            F.max("challenger_calibration_factor").alias("final_calibration_factor"),
            F.sum("challenger_expected_loss").alias("calibrated_expected_total_loss"),
            F.sum("challenger_commercial_premium").alias("challenger_total_commercial_premium"),
        )
        .withColumn("challenger_actual_to_expected", safe_divide("actual_total_loss", "calibrated_expected_total_loss"))
        .withColumn("challenger_loss_ratio", safe_divide("actual_total_loss", "challenger_total_commercial_premium"))
    )


@dataclass(frozen=True)
class Sweep:
    """A frequency model under several settings.

    ``scores`` has one row per exposure: key, split, claim flag and ``scores``, one probability for each setting in order.
    """

    scores: DataFrame
    settings: list[tuple[str, BoostingConfig, float]]  # name, setting, seconds its fit took beside the others

    def long(self) -> DataFrame:
        """One row per exposure and setting, made inside the scan."""
        names = F.array(*[F.lit(name) for name, _, _ in self.settings])
        pairs = F.arrays_zip(names.alias("setting"), F.col("scores").alias("p"))
        return self.scores.select("split", "covered_claim_flag", F.inline(pairs))

    def table(self) -> DataFrame:
        """The settings as rows."""
        rows = [(n, c.frequency_trees, c.frequency_depth, c.frequency_step, c.positive_weight, t) for n, c, t in self.settings]
        return self.scores.sparkSession.createDataFrame(
            rows, "setting string, trees int, depth int, step double, claim_weight double, fit_seconds double"
        )


def parameter_sweep(
    pricing: DataFrame, grid: Sequence[tuple[str, BoostingConfig]], glm: GlmConfig | None = None
) -> Sweep:
    """Fit the frequency model of the train orders under every setting, all in the same passes over one encoded table, and
    score train and test rows with all of them in one pass."""
    glm, spark = glm or GlmConfig(), pricing.sparkSession
    split = order_split(eligible_rows(pricing), glm.test_size, glm.seed)
    train = split.filter("split = 'train'")
    categories, routes = level_tables(train, glm.category_min_exposure, glm.route_min_exposure)
    features = (
        prepare_features(split, categories, routes, missing_parts="zero")
        .select(*EXPOSURE_KEY, "split", "covered_claim_flag", *CATEGORICAL_FEATURES, *LOG_FEATURES)
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    ensure_checkpoint_dir(spark)

    try:
        learned = features.filter("split = 'train'")
        encoder = Pipeline(stages=encoder_stages("__ml_x")).fit(learned)
        with training_rows(encoder, learned, frequency_labels()) as ready:
            settings = [(_frequency_estimator(config), config.positive_weight) for _, config in grid]
            fitted = boost(ready, label_numbers(encoder), LOG_FEATURES, settings)
        margins = {f"__s{i}": margin_of(encoder, model, LOG_FEATURES, spark)() for i, (model, _) in enumerate(fitted)}
        scored = encoder.stages[0].transform(features).withColumns(margins)
        probabilities = F.array(*[class_probability(c) for c in margins]).alias("scores")
        held = stored(scored.select(*EXPOSURE_KEY, "split", "covered_claim_flag", probabilities), "sweep")
    finally:
        features.unpersist()
    return Sweep(held, [(name, config, took) for (name, config), (_, took) in zip(grid, fitted, strict=True)])


def sweep_report(sweep: Sweep) -> DataFrame:
    """Train and test AUC, Brier score and mean prediction of every setting, with what it was and how long its fit took."""
    long = sweep.long()
    auc = metrics.exact_auc(long, ["setting", "split"], "covered_claim_flag", "p").select("setting", "split", "auc")
    errors = long.groupBy("setting", "split").agg(
        metrics.mean_squared("covered_claim_flag", "p").alias("brier_score"), F.avg("p").alias("predicted_frequency")
    )
    return auc.join(errors, ["setting", "split"]).join(F.broadcast(sweep.table()), "setting")
