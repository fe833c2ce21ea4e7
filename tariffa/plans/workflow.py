"""The whole chain from input tables to result tables, step by step.

Each step reads what earlier steps wrote below the output folder and writes its own tables
there, so steps can be run alone, repeated or resumed.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from tariffa.config import BoostingConfig, CredibilityConfig, GlmConfig, RatingConfig, SimulationConfig
from tariffa.operators import (
    attribution,
    backtest,
    boosting,
    exposure,
    features,
    glm,
    profile,
    rating,
    simulate,
    stress,
)
from tariffa.operators import credibility as cred
from tariffa.sources.sinks import stored, write_metrics, write_table
from tariffa.sources.tables import InputTables

CATEGORY, ROUTE = "product_category_name_english", "route_state"


@dataclass
class Workflow:
    tables: InputTables
    folder: str
    simulation: SimulationConfig = field(default_factory=SimulationConfig)
    rating: RatingConfig = field(default_factory=RatingConfig)
    credibility: CredibilityConfig = field(default_factory=CredibilityConfig)
    glm: GlmConfig = field(default_factory=GlmConfig)
    boosting: BoostingConfig = field(default_factory=BoostingConfig)
    table_format: str = "parquet"

    # --- reading and writing below the output folder --------------------------------------

    def path(self, name: str) -> str:
        return os.path.join(self.folder, name)

    def save(self, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
        """A stage table: always Parquet, because later steps read it back."""
        write_table(df, self.path(name), "parquet", partition_by)
        return self.load(name)

    def report(self, df: DataFrame, name: str) -> None:
        """A result table nobody reads back."""
        write_table(df, self.path(name), self.table_format)

    def metrics(self, df: DataFrame, name: str) -> None:
        write_metrics(df, self.path(f"{name}_summary"))

    def load(self, name: str) -> DataFrame:
        return self.tables.items.sparkSession.read.parquet(self.path(name))

    # --- steps ----------------------------------------------------------------------------

    def run_exposure(self) -> None:
        exposure.check_contract(self.tables)
        self.report(exposure.key_audit(self.tables), "key_audit")
        self.report(exposure.join_match_rates(self.tables), "join_match_rates")
        table = self.save(exposure.build_exposure(self.tables), "exposure_table")
        self.metrics(profile.exposure_profile(table), "exposure_table")
        self.report(profile.top_values(table, CATEGORY), "top_categories")
        self.report(profile.top_values(table, ROUTE), "top_routes")

    def run_eda(self) -> None:
        table, status = self.load("exposure_table"), self.simulation.delivered_status
        self.report(profile.numeric_quantiles(table), "eda/numeric_quantiles")
        self.report(profile.missing_report(table), "eda/missing_summary")
        self.report(profile.status_summary(table), "eda/order_status_summary")
        for name, group in (("category", CATEGORY), ("route", ROUTE)):
            summary = profile.grouped_freight_summary(
                table, group, min_exposures=self.rating.freight_summary_min_exposures, delivered_status=status
            )
            self.report(summary, f"eda/{name}_freight_summary")
        self.report(profile.cap_diagnostics(table), "eda/cap_diagnostics")
        self.report(profile.anomaly_checks(table), "eda/anomaly_diagnostics")
        for column in profile.CAPPED_COLUMNS:
            self.report(profile.top_extreme_rows(table, column), f"eda/top_{column}_rows")
        self.report(profile.describe_metrics(table), "eda/metrics")
        self.metrics(profile.exposure_overview(table, status), "eda/exposure_eda")

    def run_claims(self) -> None:
        claims = self.save(simulate.simulate_claims(self.load("exposure_table"), self.simulation), "claims")
        self.metrics(simulate.claims_summary(claims), "claims")
        self.report(simulate.claim_label_counts(claims), "claim_label_counts")

    def run_baseline(self) -> None:
        claims, r = self.load("claims"), self.rating
        priced = self.save(rating.baseline_pricing(claims, r), "pricing_baseline")
        for name, group, limit in (
            ("category", CATEGORY, r.category_min_exposure),
            ("route", ROUTE, r.route_min_exposure),
            ("cross_state", "cross_state_flag", 1),
            ("seller", "seller_id", r.seller_min_exposure),
        ):
            self.report(rating.rating_summary(claims, group, min_exposure=limit, config=r), f"pricing_by_{name}")
        self.metrics(rating.portfolio_metrics(claims, r), "pricing_baseline")
        self.report(rating.credible_group_counts(claims, r), "credible_group_counts")
        self.report(rating.order_premium(priced), "order_premium")
        self.metrics(rating.validate_baseline(priced, claims, r), "pricing_baseline_validation")

    def run_glm(self) -> None:
        baseline = self.load("pricing_baseline")
        spark = baseline.sparkSession
        scored = self.save(glm.validation_scores(baseline, self.glm), "glm_validation_scores")
        self.report(glm.validation_metrics(scored), "glm_validation_metrics")
        for part, table in glm.calibration_tables(scored.filter("split = 'test'")).items():
            self.report(table, f"glm_{part}_calibration")
        model = glm.fit_two_part(rating.eligible_rows(baseline), self.glm)
        priced = self.save(glm.glm_pricing(baseline, config=self.glm, model=model), "pricing_glm")
        self.report(glm.coefficient_table(model.frequency, "frequency", spark), "glm_frequency_coefficients")
        self.report(glm.coefficient_table(model.severity, "severity", spark), "glm_severity_coefficients")
        self.report(glm.fit_statistics(model, spark), "glm_fit_statistics")
        self.metrics(glm.portfolio_report(priced), "glm_pricing")

    def run_credibility(self) -> None:
        pricing = self.load("pricing_glm")
        sellers = self.save(cred.seller_credibility(pricing, self.credibility), "seller_credibility")
        priced = self.save(cred.credibility_pricing(pricing, sellers, self.credibility), "pricing_glm_credibility")
        self.report(cred.tier_summary(sellers), "seller_tier_summary")
        self.report(cred.seller_distribution(sellers), "seller_distribution")
        self.report(cred.k_sensitivity(pricing, config=self.credibility), "credibility_k_sensitivity")
        self.metrics(cred.seller_thresholds(pricing), "seller_thresholds")
        self.metrics(cred.portfolio_report(priced), "seller_credibility")
        self.metrics(cred.validate_credibility(priced), "seller_credibility_validation")

    def run_backtesting(self) -> None:
        pricing, r = self.load("pricing_glm_credibility"), self.rating
        target = r.target_loss_ratio
        segments = (("month", "purchase_month"), ("category", CATEGORY), ("route", ROUTE), ("seller_tier", "seller_risk_tier"), ("seller", "seller_id"))
        all_segments = [(), *[(group,) for _, group in segments]]
        # one scan of the priced table serves all
        tested = stored(backtest.backtests(pricing, all_segments, target), "backtests")
        self.metrics(backtest.one_of(tested, all_segments, ()), "loss_ratio_backtesting")
        tops = {
            CATEGORY: r.category_min_exposure,
            ROUTE: r.route_min_exposure,
            "seller_id": r.seller_min_exposure,
        }
        for name, group in segments:
            own = backtest.one_of(tested, all_segments, (group,))
            table = self.save(backtest.sorted_backtest(own, group), f"backtest_by_{name}")
            if group in tops:
                self.report(
                    backtest.top_segments(table, group, min_exposures=tops[group]), f"top_{name}_high_loss_ratio"
                )
        self.metrics(backtest.segment_counts(pricing), "backtest_segments")
        self.metrics(backtest.validate_backtest(pricing, target), "loss_ratio_backtesting_validation")

    def run_stress(self) -> None:
        pricing, r = self.load("pricing_glm_credibility"), self.rating
        target, n = r.target_loss_ratio, r.watchlist_top_n
        portfolio = self.save(stress.portfolio_stress(pricing, target=target), "stress_test_portfolio")
        tiers = self.save(
            stress.segment_stress(pricing, "seller_risk_tier", "seller_tier", target=target),
            "stress_test_by_seller_tier",
        )
        lists = [
            (
                f"{name}_watchlist",
                stress.watchlist(self.load(f"backtest_by_{name}"), group, min_exposures=limit, n=n),
            )
            for name, group, limit in (
                ("category", CATEGORY, r.category_min_exposure),
                ("route", ROUTE, r.route_min_exposure),
            )
        ]
        listed = self.save(
            stress.watchlist_stress(pricing, lists, target=target), "stress_test_watchlist_segments"
        )
        self.report(stress.worst_scenarios(portfolio, [tiers, listed]), "stress_worst_scenarios")
        self.metrics(stress.validate_stress(portfolio, backtest.backtest(pricing, target=target)), "stress_testing")

    def run_challenger(self) -> None:
        pricing = self.load("pricing_glm")
        scored = boosting.validation_scores(pricing, self.boosting, self.glm)
        comparison = self.save(
            boosting.model_comparison(scored, self.glm.target_loss_ratio), "model_comparison_glm_vs_challenger"
        )
        self.report(boosting.comparison_calibration(scored), "challenger_pure_premium_calibration")
        self.metrics(boosting.best_model(comparison), "challenger_best_model")
        priced = self.save(boosting.challenger_pricing(pricing, self.boosting, self.glm), "pricing_challenger")
        self.metrics(boosting.challenger_report(priced), "challenger")

    def run_interpretability(self) -> None:
        pricing = self.load("pricing_glm")
        spark = pricing.sparkSession
        split = features.order_split(rating.eligible_rows(pricing), self.glm.test_size, self.glm.seed).drop(
            "category_group", "route_group"
        )
        model = boosting.fit_challenger(split.filter("split = 'train'"), self.boosting, self.glm)
        test = model.features(split.filter("split = 'test'"))
        for name, encoder, trees, rows, scale, label in (
            ("frequency", model.frequency_encoder, model.frequency_model, test, 2.0, "log_odds_margin"),
            ("severity", model.severity_encoder, model.severity_model, features.claims_only(test), 1.0, "log1p_net_loss"),
        ):
            self.report(
                attribution.split_importance(trees, encoder, name, spark), f"challenger_{name}_feature_importance"
            )
            parts = attribution.contributions(rows, encoder, trees, scale=scale)
            summary = self.save(
                attribution.contribution_summary(parts, encoder, name, label), f"challenger_{name}_contributions"
            )
            self.report(attribution.base_feature_summary(summary), f"challenger_{name}_base_features")


STEPS: dict[str, Callable[[Workflow], None]] = {
    "exposure": Workflow.run_exposure,
    "eda": Workflow.run_eda,
    "claims": Workflow.run_claims,
    "baseline": Workflow.run_baseline,
    "glm": Workflow.run_glm,
    "credibility": Workflow.run_credibility,
    "backtesting": Workflow.run_backtesting,
    "stress": Workflow.run_stress,
    "challenger": Workflow.run_challenger,
    "interpretability": Workflow.run_interpretability,
}
PHASES = {
    "phase1": ["exposure", "eda", "claims", "baseline"],
    "phase2": ["glm"],
    "phase3": ["credibility", "backtesting", "stress"],
    "phase4": ["challenger", "interpretability"],
    "all": list(STEPS),
}


def run(workflow: Workflow, name: str = "all") -> list[str]:
    """Run a step, a phase or everything; returns the steps that ran."""
    steps = PHASES.get(name, [name])
    for step in steps:
        STEPS[step](workflow)
    return steps
