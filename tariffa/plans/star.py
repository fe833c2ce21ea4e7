"""Stages over the order/line-item star schema, with parameters that fit its value ranges."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffa.config import EXPOSURE_KEY, BoostingConfig, CredibilityConfig, GlmConfig, RatingConfig, SimulationConfig
from tariffa.operators import exposure as exposures
from tariffa.operators import attribution, backtest, boosting, features, glm, rating, simulate
from tariffa.operators import credibility as cred
from tariffa.operators.joins import hot_keys
from tariffa.session import prepare
from tariffa.sources.sinks import stored, stored_bucketed
from tariffa.sources.tables import InputTables, from_star_schema

SIMULATION = SimulationConfig(
    delivered_status="F",
    freight_value_cap=7000.0,
    freight_to_price_ratio_cap=3.5,
    high_freight_routes=tuple(f"NATION_{i}_to_NATION_{i + 10}" for i in range(10)),
    category_factors={
        "small_ring": 1.25,
        "blue_bolt": 1.20,
        "hot_gear": 1.15,
        "cold_anvil": 1.15,
        "new_widget": 1.10,
        "old_plate": 1.05,
        "large_gizmo": 1.00,
        "hot_rod": 0.95,
        "blue_widget": 0.90,
        "cold_plate": 0.85,
        "large_anvil": 0.75,
        "old_rod": 0.70,
    },
    refund_price_limit=200.0,
    partial_refund_price_limit=500.0,
)
RATING = RatingConfig(category_min_exposure=300, route_min_exposure=60, seller_min_exposure=200)
CREDIBILITY = CredibilityConfig(k=200.0)
GLM = GlmConfig(category_min_exposure=300, route_min_exposure=60)
BOOSTING = BoostingConfig()
# The first, documented setting of the frequency model; the one chosen from the sweep is BOOSTING.
FIRST_BOOSTING = replace(
    BOOSTING,
    frequency_trees=400,
    frequency_depth=3,
    frequency_step=0.04,
    frequency_subsample=0.85,
    frequency_feature_share="0.85",
    frequency_min_rows=1,
)
# Boosting settings compared side by side; the document gives numbers for the first and the chosen one, directions for the others.
SWEEP = (
    ("current", FIRST_BOOSTING),
    ("shallow_more", replace(FIRST_BOOSTING, frequency_depth=2, frequency_trees=600, frequency_step=0.02)),
    ("depth2", replace(FIRST_BOOSTING, frequency_depth=2)),
    ("depth4", replace(FIRST_BOOSTING, frequency_depth=4)),
    ("regularized", BOOSTING),
    ("weighted", replace(FIRST_BOOSTING, positive_weight=10.0)),
    ("weighted_reg", replace(BOOSTING, positive_weight=10.0)),
)

# An order with this share of all rows would crowd its bucket.
HOT_ORDER = 0.02

# Segmentations of the loss-ratio backtest.
BACKTESTED = [
    (),
    ("purchase_month",),
    ("product_category_name_english",),
    ("route_state",),
    ("seller_risk_tier",),
    ("seller_id",),
]

_CLAIM_INPUT = [
    "order_id",
    "order_item_id",
    "seller_id",
    "product_id",
    "customer_id",
    "order_status",
    "product_category_name_english",
    "price",
    "freight_value",
    "freight_to_price_ratio",
    "product_weight_g",
    "product_volume_cm3",
    "route_state",
    "cross_state_flag",
    "purchase_month",
    "purchase_weekday",
    "estimated_delivery_days",
]

# What the checks, backtests and stress tests read of a table with credibility premiums; what a seller has is looked up again.
PREMIUM_COLUMNS = [
    *EXPOSURE_KEY,
    "product_category_name_english",
    "route_state",
    "purchase_month",
    "claim_eligible_flag",
    "covered_claim_flag",
    "net_loss",
    "baseline_pure_premium",
    "baseline_commercial_premium",
    "glm_expected_loss",
    "glm_commercial_premium",
]
CREDIBILITY_COLUMNS = [*PREMIUM_COLUMNS, "seller_risk_tier", "credibility_expected_loss", "credibility_commercial_premium"]
# What is joined with the baseline on the exposure key or rolled up to orders, and what the baseline is made from.
KEYED_COLUMNS = [
    *EXPOSURE_KEY,
    "claim_eligible_flag",
    "covered_claim_flag",
    "gross_loss",
    "recovery_from_carrier",
    "paid_loss",
    "net_loss",
    "freight_value_capped",
]


@dataclass
class StarStages:
    """Each stage as a lazy DataFrame, built on first use."""

    spark: SparkSession
    folder: str

    @cached_property
    def tables(self) -> InputTables:
        return from_star_schema(prepare(self.spark), self.folder)

    @cached_property
    def exposures(self) -> DataFrame:
        """The exposure table, joined and written once: profiling and simulation scan it many times."""
        return stored(exposures.build_exposure(self.tables), "exposure")

    @cached_property
    def size_statistics(self) -> simulate.SizeStatistics:
        return simulate.size_statistics(simulate.size_counts(self.exposures))

    @property
    def _simulated(self) -> DataFrame:
        return simulate.simulate_claims(self.exposures.select(*_CLAIM_INPUT), SIMULATION, self.size_statistics)

    @cached_property
    def claims(self) -> DataFrame:
        """All columns, bucketed by the exposure key, which identifies a row, so no bucket is crowded."""
        return stored_bucketed(self.__dict__.get("claim_rows", self._simulated), EXPOSURE_KEY, "claims")

    @cached_property
    def keyed_claims(self) -> DataFrame:
        """For what is joined back on the exposure key or rolled up to orders, and no wider than that needs.

        Bucketed by that key: what is derived from it is joined back without an exchange.
        """
        if "claims" in self.__dict__:
            return self.claims
        rows = self.claim_rows if "claim_rows" in self.__dict__ else self._simulated
        return stored_bucketed(rows.select(*KEYED_COLUMNS), EXPOSURE_KEY, "keyed_claims")

    @cached_property
    def claim_rows(self) -> DataFrame:
        """The same rows for all that scans them: written where they are made, so the widest table is not shuffled."""
        return self.claims if "claims" in self.__dict__ else stored(self._simulated, "claim_rows")

    @cached_property
    def baseline(self) -> DataFrame:
        return rating.baseline_pricing(self.claims, RATING)

    @cached_property
    def keyed_baseline(self) -> DataFrame:
        """The baseline of the narrow rows that are dealt by key."""
        return rating.baseline_pricing(self.keyed_claims, RATING)

    @cached_property
    def baseline_rows(self) -> DataFrame:
        """The baseline of the rows that are not dealt by key."""
        return rating.baseline_pricing(self.claim_rows, RATING)

    @cached_property
    def order_rows(self) -> DataFrame:
        """What orders are rolled up from, bucketed by order; where an order is hot, its rows stay dealt by the exposure key."""
        rows = self.keyed_baseline.select(
            *EXPOSURE_KEY, "claim_eligible_flag", "net_loss", "baseline_pure_premium", "baseline_commercial_premium"
        )
        return rows if hot_keys(rows, "order_id", HOT_ORDER) else stored_bucketed(rows, ["order_id"], "orders")

    @cached_property
    def analytic_pricing(self) -> DataFrame:
        """Baseline table with the closed-form expected loss in the place of a model score."""
        return self.baseline_rows.withColumn(
            "glm_expected_loss", F.col("covered_claim_probability") * F.col("freight_value_capped")
        ).withColumn("glm_commercial_premium", F.col("glm_expected_loss") / F.lit(RATING.target_loss_ratio))

    @cached_property
    def analytic_sellers(self) -> DataFrame:
        return stored(cred.seller_credibility(self.analytic_pricing, CREDIBILITY), "sellers")

    @property
    def analytic_credibility_rows(self) -> DataFrame:
        """Every column of the credibility step, worked out where it is read."""
        return cred.credibility_pricing(self.analytic_pricing, self.analytic_sellers, CREDIBILITY)

    @cached_property
    def analytic_credibility(self) -> DataFrame:
        """What the later steps read of it, written once."""
        return stored(self.analytic_credibility_rows.select(*CREDIBILITY_COLUMNS), "credibility")

    @cached_property
    def backtests(self) -> DataFrame:
        """All six segmentations from one scan of the priced table."""
        return stored(backtest.backtests(self.analytic_credibility, BACKTESTED, RATING.target_loss_ratio), "backtests")

    @cached_property
    def glm_model(self) -> glm.TwoPartGlm:
        return glm.fit_two_part(rating.eligible_rows(self.claim_rows), GLM)

    @cached_property
    def glm_pricing(self) -> DataFrame:
        return stored(glm.glm_pricing(self.baseline_rows, config=GLM, model=self.glm_model), "glm")

    @cached_property
    def glm_validation(self) -> DataFrame:
        return stored(glm.validation_scores(self.claim_rows, GLM, self.champion), "glm_validation")

    @cached_property
    def champion(self) -> glm.TwoPartGlm:
        """The regression of the train orders, fitted once for its own validation and for the comparison."""
        split = features.order_split(rating.eligible_rows(self.claim_rows), GLM.test_size, GLM.seed)
        return glm.fit_two_part(split.filter("split = 'train'"), GLM)

    @cached_property
    def _glm_premiums(self) -> DataFrame:
        """What the credibility step reads of the regression's prices; the whole table serves where it is there already."""
        if "glm_pricing" in self.__dict__:
            return self.glm_pricing
        columns = [*PREMIUM_COLUMNS, "freight_value_capped"]
        return stored(glm.glm_pricing(self.baseline_rows, config=GLM, columns=columns, model=self.glm_model), "glm_premiums")

    @cached_property
    def glm_sellers(self) -> DataFrame:
        return stored(cred.seller_credibility(self._glm_premiums, CREDIBILITY), "glm_sellers")

    @cached_property
    def glm_credibility(self) -> DataFrame:
        priced = cred.credibility_pricing(self._glm_premiums, self.glm_sellers, CREDIBILITY)
        return stored(priced.select(*CREDIBILITY_COLUMNS), "glm_credibility")

    @cached_property
    def boosted_validation(self) -> DataFrame:
        self._beside_regression(lambda: (self.champion, self.glm_pricing), lambda: self.challenger_model)
        return boosting.validation_scores(self.glm_pricing, BOOSTING, GLM, self.challenger_model, self.champion)

    @cached_property
    def challenger_pricing(self) -> DataFrame:
        eligible = rating.eligible_rows(self.claim_rows)
        model = self._beside_regression(lambda: self.glm_pricing, lambda: boosting.fit_challenger(eligible, BOOSTING, GLM))
        return boosting.challenger_pricing(self.glm_pricing, BOOSTING, GLM, model=model)

    def _beside_regression(self, regression: Callable[[], object], challenger: Callable[[], object]) -> object:
        """What ``challenger`` gives, worked out while ``regression`` runs; the claims, which both read, come first."""
        _ = self.claim_rows
        return boosting.side_by_side(self.spark, [regression, challenger])[1]

    @cached_property
    def sweep(self) -> boosting.Sweep:
        return boosting.parameter_sweep(self._eligible, SWEEP, GLM)

    @property
    def _eligible(self) -> DataFrame:
        """Eligible claims; a missing part of a label stops the job, as it does in the regression."""
        rows = rating.eligible_rows(self.claim_rows)
        parts = ("cross_state_flag", "purchase_month", "purchase_weekday")
        return rows.withColumns(
            {c: F.coalesce(F.col(c), F.raise_error(F.lit(f"{c} is missing")).cast("int")) for c in parts}
        )

    @cached_property
    def _split(self) -> DataFrame:
        """Rows of the challenger's own fit: it takes nothing from the regression, so it does not wait for one."""
        return features.order_split(self._eligible, GLM.test_size, GLM.seed)

    @cached_property
    def challenger_model(self) -> boosting.Challenger:
        """The validation fit: train orders only."""
        return boosting.fit_challenger(self._split.filter("split = 'train'"), BOOSTING, GLM)

    @cached_property
    def test_features(self) -> DataFrame:
        test = self._split.filter("split = 'test'").drop("category_group", "route_group")
        return self.challenger_model.features(test)

    @cached_property
    def frequency_contributions(self) -> attribution.Contributions:
        model = self.challenger_model
        # a boosted classifier's probability is 1 / (1 + exp(-2 F)), so log-odds are 2 F
        return attribution.contributions(self.test_features, model.frequency_encoder, model.frequency_model, scale=2.0)

    @cached_property
    def severity_contributions(self) -> attribution.Contributions:
        model = self.challenger_model
        claims = features.claims_only(self.test_features)
        return attribution.contributions(claims, model.severity_encoder, model.severity_model)

    @cached_property
    def contribution_table(self) -> DataFrame:
        model = self.challenger_model
        frequency = attribution.contribution_summary(
            self.frequency_contributions, model.frequency_encoder, "frequency", "log_odds_margin"
        )
        return stored(
            frequency.unionByName(
                attribution.contribution_summary(self.severity_contributions, model.severity_encoder, "severity", "log1p_net_loss")
            ),
            "contributions",
        )


def exact_cap_simulation() -> SimulationConfig:
    return replace(SIMULATION, freight_value_cap=None, freight_to_price_ratio_cap=None)
