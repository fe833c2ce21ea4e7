"""Two-part regression pricing: claim frequency (binomial) times severity (gamma)."""

from __future__ import annotations

import itertools
import sys
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler, VectorSlicer
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffa.config import GlmConfig
from tariffa.functions.columns import positive_divide, safe_divide
from tariffa.operators import metrics
from tariffa.operators.features import (
    CATEGORICAL_FEATURES,
    LOG_FEATURES,
    claims_only,
    level_tables,
    order_split,
    prepare_features,
)
from tariffa.operators.rating import eligible_rows, with_baseline
from tariffa.session import side_by_side

# The output columns.
GLM_OUTPUT_COLUMNS = [
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
    "category_group",
    "route_group",
    "glm_frequency",
    "glm_severity",
    "glm_expected_loss",
    "glm_commercial_premium",
    "glm_expected_loss_ratio_to_freight",
    "glm_expected_loss_ratio_to_baseline",
]


# The bounds that Spark keeps fitted means in.
LEAST_MEAN, MOST_MEAN = 1e-16, sys.float_info.max


def fitted_mean(eta: Column, link: str) -> Column:
    """Mean of a linear predictor under a logit or a log link, kept inside the family's bounds as Spark keeps it."""
    if link == "logit":
        return F.greatest(F.least(1.0 / (1.0 + F.exp(-eta)), F.lit(1.0 - LEAST_MEAN)), F.lit(LEAST_MEAN))
    if link == "log":
        return F.greatest(F.least(F.exp(eta), F.lit(MOST_MEAN)), F.lit(LEAST_MEAN))
    raise ValueError(f"{link}: only logit and log links are scored")


@dataclass(frozen=True)
class FittedGlm:
    """One fitted regression with the labels each category was trained on."""

    pipeline: PipelineModel
    labels: dict[str, list[str]]  # alphabetical, base level first
    prediction: str
    aliased: tuple[str, ...] = ()  # terms that others determine; they are left out
    max_iter: int = 0

    def score(self, df: DataFrame) -> DataFrame:
        """Add the prediction.  A label not seen in training is scored as the base level.

        The linear predictor is added up from the coefficients of a row's labels and its log features, in the order of the model's own
        dot product, so no row becomes a vector of all levels.
        """
        fitted = self.pipeline.stages[-1]
        values = dict(zip(self.terms(), [*map(float, fitted.coefficients.toArray()), float(fitted.intercept)], strict=True))
        out, eta = df, F.lit(0.0)
        for i, (column, levels) in enumerate(self.labels.items()):
            rows = [(level, values[f"{column}[{level}]"]) for level in levels[1:] if f"{column}[{level}]" in values]
            if rows:
                table = df.sparkSession.createDataFrame(rows, f"__level_{i} string, __value_{i} double")
                # a row a level: a proven size
                out = out.join(F.broadcast(table), F.col(column) == F.col(f"__level_{i}"), "left")
                eta = eta + F.coalesce(f"__value_{i}", F.lit(0.0))
        for c in LOG_FEATURES:
            broken = F.raise_error(F.lit(f"{c} is not a number")).cast("double")
            eta = eta + F.when(F.col(c).isNull() | F.isnan(c), broken).otherwise(F.col(c) * values[c] if c in values else F.lit(0.0))
        mean = fitted_mean(eta + values["Intercept"], fitted.getLink())
        return out.select(*[F.col(f"`{c}`") for c in df.columns], mean.alias(self.prediction))

    @property
    def summary(self):
        return self.pipeline.stages[-1].summary

    @property
    def iterations(self) -> int:
        return int(self.summary.numIterations)

    @property
    def converged(self) -> bool:
        """False as well if a level has no claims at all: its coefficient then falls without end, predictions do not."""
        return self.iterations < self.max_iter

    def terms(self) -> list[str]:
        """Coefficient names in the model's order (intercept last), without the aliased ones."""
        return [t for t in [*encoded_terms(self.labels), "Intercept"] if t not in self.aliased]


def encoded_terms(labels: dict[str, list[str]]) -> list[str]:
    """Columns of the design in the encoder's order: levels from the last to the second, then the log features."""
    levels = [f"{column}[{level}]" for column, own in labels.items() for level in reversed(own[1:])]
    return [*levels, *LOG_FEATURES]


# A regression on this many columns or fewer is solved directly (Spark's own limit).
MOST_TERMS = 4096


def gram_matrix(train: DataFrame, labels: dict[str, list[str]]) -> np.ndarray:
    """Sums of products of all pairs of design columns, the intercept first, from cross tabulations.

    One grouping with a set for each pair of categories; the driver gets a number per pair of levels.
    """
    names = list(labels)
    terms = ["Intercept", *encoded_terms(labels)]
    place = {t: i for i, t in enumerate(terms)}
    sets = [*itertools.combinations(names, 2), *[(n,) for n in names], ()]
    products = [F.sum(F.col(a) * F.col(b)) for a, b in itertools.combinations_with_replacement(LOG_FEATURES, 2)]
    rows = (
        train.groupingSets([list(s) for s in sets], *names)
        .agg(
            *[F.grouping(n).alias(f"__g{i}") for i, n in enumerate(names)],
            F.count(F.lit(1)).cast("double").alias("__n"),
            F.array(*[F.sum(c) for c in LOG_FEATURES]).alias("__sums"),
            F.array(*products).alias("__products"),
        )
        .collect()
        if names
        else train.agg(
            F.count(F.lit(1)).cast("double").alias("__n"),
            F.array(*[F.sum(c) for c in LOG_FEATURES]).alias("__sums"),
            F.array(*products).alias("__products"),
        ).collect()
    )
    out = np.zeros((len(terms), len(terms)))
    for r in rows:
        own = [f"{n}[{r[n]}]" for i, n in enumerate(names) if r[f"__g{i}"] == 0]
        if any(t not in place for t in own):
            continue  # a base level
        at = [place[t] for t in own]
        if len(at) == 2:
            out[at[0], at[1]] = out[at[1], at[0]] = r["__n"]
            continue
        i = at[0] if at else 0
        out[i, i] = r["__n"]
        if at:
            out[0, i] = out[i, 0] = r["__n"]
        for c, total in zip(LOG_FEATURES, r["__sums"], strict=True):
            out[i, place[c]] = out[place[c], i] = total
        if not at:
            pairs = itertools.combinations_with_replacement(LOG_FEATURES, 2)
            for (a, b), total in zip(pairs, r["__products"], strict=True):
                out[place[a], place[b]] = out[place[b], place[a]] = total
    return out


def independent_columns(gram: np.ndarray, tolerance: float = 1e-9) -> list[int]:
    """Columns that the ones before them do not determine, by a Cholesky factorisation in the given order."""
    scale = np.sqrt(np.maximum(np.diag(gram), 1e-300))
    rest = gram / scale[:, None] / scale[None, :]
    kept: list[int] = []
    for j in range(len(rest)):
        if gram[j, j] > 0 and rest[j, j] > tolerance:
            kept.append(j)
            column = rest[j + 1 :, j] / np.sqrt(rest[j, j])
            rest[j + 1 :, j + 1 :] -= np.outer(column, column)
    return kept


def _labels(df: DataFrame) -> dict[str, list[str]]:
    """Levels of each categorical feature; a feature with one level carries no information.

    Rare levels are grouped beforehand, and a regression takes 4,096 columns at most.
    """
    sets = df.agg(*[F.sort_array(F.collect_set(c)).alias(c) for c in CATEGORICAL_FEATURES]).first()
    return {c: list(sets[c]) for c in CATEGORICAL_FEATURES if len(sets[c]) > 1}


def fit_regression(
    train: DataFrame, target: str, family: str, link: str, prediction: str, config: GlmConfig
) -> FittedGlm:
    """Treatment-coded regression; the alphabetically first level of each category is the base."""
    labels = _labels(train)
    stages = []
    encoded = []
    if labels:
        names = list(labels)
        known = [f"__known_{c}" for c in names]
        stages += [
            # descending labels put the base level last, which is the one the encoder drops
            StringIndexer(
                inputCols=known, outputCols=[f"__ml_i_{c}" for c in names], stringOrderType="alphabetDesc"
            ),
            OneHotEncoder(
                inputCols=[f"__ml_i_{c}" for c in names], outputCols=[f"__ml_v_{c}" for c in names], dropLast=True
            ),
        ]
        encoded = [f"__ml_v_{c}" for c in names]
    terms = encoded_terms(labels)
    if len(terms) > MOST_TERMS:
        raise ValueError(f"{len(terms)} terms; the regression takes {MOST_TERMS}: raise the minimum exposure of a level")
    # the intercept comes first and always stays; log features stay before levels that they determine
    order = [0, *range(len(terms) - len(LOG_FEATURES) + 1, len(terms) + 1), *range(1, len(terms) - len(LOG_FEATURES) + 1)]
    gram = gram_matrix(train, labels)[np.ix_(order, order)]
    kept = sorted(order[i] - 1 for i in independent_columns(gram) if order[i])
    aliased = tuple(t for i, t in enumerate(terms) if i not in set(kept))
    stages.append(VectorAssembler(inputCols=[*encoded, *LOG_FEATURES], outputCol="__ml_all"))
    stages.append(VectorSlicer(inputCol="__ml_all", outputCol="__ml_x", indices=kept))
    named = train.withColumns({f"__known_{c}": F.col(c) for c in labels})
    encoder = Pipeline(stages=stages).fit(named)
    regression = GeneralizedLinearRegression(
        family=family,
        link=link,
        labelCol=target,
        featuresCol="__ml_x",
        predictionCol=prediction,
        maxIter=config.max_iter,
        tol=config.tolerance,
    )
    # every iteration reads the encoded rows again
    ready = (
        encoder.transform(named)
        .select(F.col(target).cast("double").alias(target), "__ml_x")
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    try:
        fitted = regression.fit(ready)
    finally:
        ready.unpersist()
    return FittedGlm(PipelineModel(stages=[*encoder.stages, fitted]), labels, prediction, aliased, config.max_iter)


@dataclass(frozen=True)
class TwoPartGlm:
    frequency: FittedGlm
    severity: FittedGlm
    categories: DataFrame
    routes: DataFrame

    def features(self, df: DataFrame) -> DataFrame:
        return prepare_features(df, self.categories, self.routes, missing_parts="fail")

    def score(self, features: DataFrame) -> DataFrame:
        """Add pred_frequency, pred_severity and their product."""
        return self.severity.score(self.frequency.score(features)).withColumn(
            "pred_expected_loss", F.col("pred_frequency") * F.col("pred_severity")
        )


def fit_two_part(population: DataFrame, config: GlmConfig | None = None) -> TwoPartGlm:
    """Fit both parts on eligible rows; levels are chosen on the same rows."""
    config = config or GlmConfig()
    categories, routes = level_tables(population, config.category_min_exposure, config.route_min_exposure)
    needed = [*CATEGORICAL_FEATURES, *LOG_FEATURES, "covered_claim_flag", "net_loss"]
    # each fitting pass reads the same narrow table again
    features = (
        prepare_features(population, categories, routes, missing_parts="fail")
        .select(*needed)
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    try:
        claims = claims_only(features)
        if claims.isEmpty():
            raise ValueError("Cannot fit a severity model: there are no covered claims in the training data.")
        frequency, severity = side_by_side(
            population.sparkSession,
            [
                lambda: fit_regression(features, "covered_claim_flag", "binomial", "logit", "pred_frequency", config),
                lambda: fit_regression(claims, "net_loss", "gamma", "log", "pred_severity", config),
            ],
        )
    finally:
        features.unpersist()
    return TwoPartGlm(frequency, severity, categories, routes)


def coefficient_table(model: FittedGlm, name: str, spark) -> DataFrame:
    """Coefficients with errors, p-values, intervals and relativities; aliased terms are not among them."""
    fitted = model.pipeline.stages[-1]
    values = [*[float(v) for v in fitted.coefficients.toArray()], float(fitted.intercept)]
    errors = [float(v) for v in model.summary.coefficientStandardErrors]
    p_values = [float(v) for v in model.summary.pValues]
    rows = list(zip([name] * len(values), model.terms(), values, errors, p_values, strict=True))
    table = spark.createDataFrame(
        rows, "model string, term string, coefficient double, standard_error double, p_value double"
    )
    # Fixed value: the two-sided 95% point of the normal distribution.
    half = F.lit(1.959963984540054) * F.col("standard_error")
    return table.withColumns(
        {"conf_low": F.col("coefficient") - half, "conf_high": F.col("coefficient") + half}
    ).withColumns(
        {
            "relativity": F.exp("coefficient"),
            "conf_low_relativity": F.exp("conf_low"),
            "conf_high_relativity": F.exp("conf_high"),
        }
    )


def score_equations(model: TwoPartGlm, features: DataFrame) -> DataFrame:
    """What maximum likelihood asks of both parts, one row for every column x of the design, base levels included.

    The claims and the predicted frequencies have one total over x; the losses over their predicted severities have the total of x
    itself.  ``observed`` is the total that holds whatever the model, ``score_gap`` what the model's total differs from it, for each unit of x: 0
    on the rows a model was fitted on, and only there if the coefficients are right.  Columns that the regression leaves out
    are sums of others, so they balance as well.
    """
    columns = [
        F.struct(F.lit("Intercept").alias("feature"), F.lit("").alias("level"), F.lit(1.0).alias("x")),
        *[F.struct(F.lit(c).alias("feature"), F.col(c).alias("level"), F.lit(1.0).alias("x")) for c in CATEGORICAL_FEATURES],
        *[F.struct(F.lit(c).alias("feature"), F.lit("").alias("level"), F.col(c).alias("x")) for c in LOG_FEATURES],
    ]
    is_claim = (F.col("covered_claim_flag") == 1) & (F.col("net_loss") > 0)
    # each row meets each column inside the scan and is added up there; one row a column is shuffled
    long = model.score(features).select(
        "covered_claim_flag", "pred_frequency", F.when(is_claim, F.col("net_loss") / F.col("pred_severity")).alias("scaled"), F.inline(F.array(*columns))
    )
    x, claim_x = F.col("x"), F.when(F.col("scaled").isNotNull(), F.col("x"))
    sums = long.groupBy("feature", "level").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(x).alias("weight"),
        F.sum(x * F.col("covered_claim_flag")).alias("claims"),
        F.sum(x * F.col("pred_frequency")).alias("predicted_claims"),
        F.count("scaled").alias("claim_rows"),
        F.sum(claim_x).alias("claim_weight"),
        F.sum(x * F.col("scaled")).alias("scaled_losses"),
    )
    parts = F.array(
        F.struct(
            F.lit("frequency").alias("model"),
            F.col("rows").alias("row_count"),
            F.col("claims").alias("observed"),
            safe_divide(F.col("predicted_claims") - F.col("claims"), "weight").alias("score_gap"),
        ),
        F.struct(
            F.lit("severity").alias("model"),
            F.col("claim_rows").alias("row_count"),
            F.col("claim_weight").alias("observed"),
            safe_divide(F.col("scaled_losses") - F.col("claim_weight"), "claim_weight").alias("score_gap"),
        ),
    )
    return sums.select(F.inline(parts), "feature", "level").filter("row_count > 0")


def fit_statistics(model: TwoPartGlm, spark) -> DataFrame:
    rows = [
        (name, float(m.summary.aic), int(m.summary.numInstances), int(m.summary.rank), m.iterations, m.converged, " ".join(m.aliased))
        for name, m in (("frequency", model.frequency), ("severity", model.severity))
    ]
    return spark.createDataFrame(rows, "model string, aic double, nobs bigint, model_rank int, iterations int, converged boolean, aliased string")


def validation_scores(claims: DataFrame, config: GlmConfig | None = None, model: TwoPartGlm | None = None) -> DataFrame:
    """Fit on the train orders (unless a model is given), score train and test eligible rows."""
    config = config or GlmConfig()
    split = order_split(eligible_rows(claims), config.test_size, config.seed)
    model = model or fit_two_part(split.filter("split = 'train'"), config)
    return model.score(model.features(split))


def validation_metrics(scored: DataFrame) -> DataFrame:
    """Frequency, severity and pure premium quality on train and test, one row per split."""
    sums = scored.groupBy("split").agg(
        F.count(F.lit(1)).alias("exposures"),
        F.sum("covered_claim_flag").alias("actual_claims"),
        F.avg("covered_claim_flag").alias("actual_frequency"),
        F.avg("pred_frequency").alias("predicted_frequency"),
        metrics.mean_squared("covered_claim_flag", "pred_frequency").alias("brier_score"),
        F.sum("net_loss").alias("actual_total_loss"),
        F.sum("pred_expected_loss").alias("predicted_total_loss"),
        F.avg("net_loss").alias("actual_pure_premium"),
        F.avg("pred_expected_loss").alias("predicted_pure_premium"),
    )
    severity = metrics.prediction_errors(claims_only(scored), ["split"], "net_loss", "pred_severity").select(
        "split",
        F.col("row_count").alias("claims"),
        F.col("actual_mean").alias("actual_severity"),
        F.col("predicted_mean").alias("predicted_severity"),
        F.col("mae").alias("severity_mae"),
        F.col("rmse").alias("severity_rmse"),
    )
    auc = metrics.exact_auc(scored, ["split"], "covered_claim_flag", "pred_frequency").select("split", "auc")
    return (
        sums.join(severity, "split", "left")
        .join(auc, "split", "left")
        .withColumn("actual_to_expected", safe_divide("actual_total_loss", "predicted_total_loss"))
    )


def calibration_tables(scored_test: DataFrame) -> dict[str, DataFrame]:
    """Ten-way calibration of frequency, severity and pure premium."""
    return {
        "frequency": metrics.frequency_calibration(metrics.score_deciles(scored_test, "pred_frequency")),
        "severity": metrics.severity_calibration(metrics.score_deciles(claims_only(scored_test), "pred_severity")),
        "pure_premium": metrics.pure_premium_calibration(metrics.score_deciles(scored_test, "pred_expected_loss")),
    }


def glm_pricing(
    claims: DataFrame,
    baseline: DataFrame | None = None,
    config: GlmConfig | None = None,
    columns: Sequence[str] = GLM_OUTPUT_COLUMNS,
    model: TwoPartGlm | None = None,
) -> DataFrame:
    """Refit on every eligible row and price every item; ineligible items get 0.

    ``baseline`` brings the baseline premiums by exposure key.  Leave it out when ``claims``
    already carries them: they were computed from the same rows, so no join is needed.  A
    ``model`` fitted on the same rows may be passed in.
    """
    config = config or GlmConfig()
    model = model or fit_two_part(eligible_rows(claims), config)
    eligible = F.col("claim_eligible_flag") == 1
    scored = model.score(model.features(claims))
    priced = scored.withColumns(
        {
            "glm_frequency": F.when(eligible, F.col("pred_frequency")).otherwise(0.0),
            "glm_severity": F.when(eligible, F.col("pred_severity")).otherwise(0.0),
            "target_loss_ratio": F.lit(config.target_loss_ratio),
        }
    ).withColumn("glm_expected_loss", F.col("glm_frequency") * F.col("glm_severity"))
    priced = priced.withColumn("glm_commercial_premium", F.col("glm_expected_loss") / F.col("target_loss_ratio"))
    if baseline is not None:
        priced = with_baseline(
            priced.drop("baseline_pure_premium", "baseline_commercial_premium"), baseline
        )
        gap = F.raise_error(F.lit("Missing baseline premium after the join.")).cast("double")
        priced = priced.withColumn("baseline_pure_premium", F.coalesce("baseline_pure_premium", gap))
    return priced.withColumns(
        {
            "glm_expected_loss_ratio_to_freight": positive_divide("glm_expected_loss", "freight_value_capped"),
            "glm_expected_loss_ratio_to_baseline": positive_divide("glm_expected_loss", "baseline_pure_premium"),
        }
    ).select(*columns)


def portfolio_report(priced: DataFrame) -> DataFrame:
    """One row: actual and expected totals, A/E, means and premium against the baseline."""
    return (
        eligible_rows(priced)
        .agg(
            F.sum("net_loss").alias("actual_total_net_loss"),
            F.sum("glm_expected_loss").alias("glm_expected_total_loss"),
            F.sum("baseline_pure_premium").alias("baseline_expected_total_loss"),
            F.avg("glm_expected_loss").alias("glm_mean_expected_loss"),
            F.avg("baseline_pure_premium").alias("baseline_mean_expected_loss"),
            F.sum("glm_commercial_premium").alias("glm_total_commercial_premium"),
        )
        .withColumns(
            {
                "glm_actual_to_expected": safe_divide("actual_total_net_loss", "glm_expected_total_loss"),
                "baseline_actual_to_expected": safe_divide("actual_total_net_loss", "baseline_expected_total_loss"),
                "glm_expected_loss_ratio": safe_divide("glm_expected_total_loss", "glm_total_commercial_premium"),
            }
        )
    )
