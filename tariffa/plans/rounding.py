"""Oracle SQL with the same reported decimals as the Spark results."""

from __future__ import annotations

from tariffa.plans import oracles
from tariffa.plans.catalog import NUDGE, digits

# Double columns of each result.
DOUBLE_COLUMNS: dict[str, str] = {
    "exposure_table": (
        "price freight_value freight_to_price_ratio product_weight_g product_length_cm product_height_cm "
        "product_width_cm product_volume_cm3 estimated_delivery_days"
    ),
    "join_match_rates": "match_rate",
    "missing_report": "missing_rate",
    "numeric_quantiles": "mean std min p1 p5 p25 p50 p75 p95 p99 p99.5 max",
    "numeric_quantiles_bucketed": "mean std min p1 p5 p25 p50 p75 p95 p99 p99.5 max",
    "sink_round_trip": "price_sum",
    "cap_diagnostics": "cap_value share_above_cap total_value_above_cap",
    "anomaly_checks": "row_share",
    "status_summary": (
        "freight_mean freight_median freight_to_price_ratio_median estimated_delivery_days_median "
        "exposure_share"
    ),
    "category_freight_summary": (
        "freight_mean freight_max freight_to_price_ratio_max cross_state_rate delivered_rate price_median "
        "freight_median freight_p95 freight_to_price_ratio_median freight_to_price_ratio_p95 "
        "product_weight_g_median product_volume_cm3_median exposure_share"
    ),
    "route_freight_summary": (
        "freight_mean freight_max freight_to_price_ratio_max cross_state_rate delivered_rate price_median "
        "freight_median freight_p95 freight_to_price_ratio_median freight_to_price_ratio_p95 "
        "product_weight_g_median product_volume_cm3_median exposure_share"
    ),
    "route_freight_summary_bucketed": (
        "freight_mean freight_max freight_to_price_ratio_max cross_state_rate delivered_rate price_median "
        "freight_median freight_p95 freight_to_price_ratio_median freight_to_price_ratio_p95 "
        "product_weight_g_median product_volume_cm3_median exposure_share"
    ),
    "metric_by_cross_state": "median mean p95 p99 max",
    "exposure_overview": (
        "delivered_share cross_state_share freight_value_min freight_value_mean freight_value_max ratio_min "
        "ratio_mean ratio_max freight_value_median ratio_median"
    ),
    "top_freight_rows": "price freight_value freight_to_price_ratio product_weight_g product_volume_cm3",
    "top_ratio_rows": "price freight_value freight_to_price_ratio product_weight_g product_volume_cm3",
    "top_weight_rows": "price freight_value freight_to_price_ratio product_weight_g product_volume_cm3",
    "top_volume_rows": "price freight_value freight_to_price_ratio product_weight_g product_volume_cm3",
    "uniform_by_key": "u_return u_severity",
    "winsorise_p99": "freight_value_capped freight_to_price_ratio_capped",
    "impute_by_category_median": "product_weight_g_filled product_volume_cm3_filled",
    "frequency_factors": (
        "return_factor_category return_factor_route return_factor_freight_ratio return_factor_size "
        "return_factor_month"
    ),
    "return_probability": "return_probability",
    "simulated_events": "covered_claim_probability",
    "simulated_losses": "gross_loss recovery_from_carrier paid_loss net_loss",
    "claims_summary": (
        "return_requested_rate_all return_requested_rate_eligible covered_claim_frequency_all "
        "covered_claim_frequency_eligible total_gross_loss total_recovery_from_carrier total_paid_loss "
        "total_net_loss average_paid_loss_among_claims pure_premium_per_all_exposure "
        "pure_premium_per_eligible_exposure"
    ),
    "portfolio_metrics": (
        "total_gross_loss total_recovery_from_carrier total_paid_loss total_net_loss target_loss_ratio "
        "claim_frequency average_severity portfolio_pure_premium portfolio_commercial_premium "
        "total_commercial_premium expected_loss_ratio"
    ),
    "rating_by_category": (
        "total_gross_loss total_recovery_from_carrier total_paid_loss total_net_loss average_freight_value "
        "average_freight_value_capped claim_frequency average_severity pure_premium relativity "
        "commercial_premium"
    ),
    "rating_by_route": (
        "total_gross_loss total_recovery_from_carrier total_paid_loss total_net_loss average_freight_value "
        "average_freight_value_capped claim_frequency average_severity pure_premium relativity "
        "commercial_premium"
    ),
    "rating_by_cross_state": (
        "total_gross_loss total_recovery_from_carrier total_paid_loss total_net_loss average_freight_value "
        "average_freight_value_capped claim_frequency average_severity pure_premium relativity "
        "commercial_premium"
    ),
    "rating_by_seller": (
        "total_gross_loss total_recovery_from_carrier total_paid_loss total_net_loss average_freight_value "
        "average_freight_value_capped claim_frequency average_severity pure_premium relativity "
        "commercial_premium"
    ),
    "top_segments_by_pure_premium": "claim_frequency average_severity pure_premium relativity commercial_premium",
    "baseline_pricing": (
        "target_loss_ratio portfolio_pure_premium portfolio_commercial_premium baseline_pure_premium "
        "baseline_commercial_premium expected_loss expected_loss_ratio_to_freight "
        "expected_portfolio_loss_ratio"
    ),
    "validate_baseline": "total_expected_loss total_commercial_premium expected_loss_ratio",
    "order_premium": "net_loss baseline_pure_premium baseline_commercial_premium",
    "glm_with_baseline": "baseline_pure_premium baseline_commercial_premium",
    "seller_experience": (
        "seller_actual_net_loss seller_glm_expected_loss seller_glm_commercial_premium "
        "seller_average_glm_expected_loss seller_average_glm_commercial_premium seller_observed_frequency "
        "seller_observed_pure_premium seller_glm_pure_premium seller_observed_ae"
    ),
    "seller_credibility": (
        "seller_actual_net_loss seller_glm_expected_loss seller_glm_commercial_premium "
        "seller_average_glm_expected_loss seller_average_glm_commercial_premium seller_observed_frequency "
        "seller_observed_pure_premium seller_glm_pure_premium seller_observed_ae seller_credibility_weight "
        "seller_credibility_relativity_raw seller_credibility_relativity_capped "
        "seller_credibility_normalization_factor seller_credibility_relativity "
        "seller_credibility_expected_loss seller_credibility_commercial_premium seller_credibility_ae"
    ),
    "credibility_pricing": (
        "glm_expected_loss seller_eligible_exposures seller_claim_count seller_actual_net_loss "
        "seller_glm_expected_loss seller_observed_ae seller_credibility_weight "
        "seller_credibility_relativity_raw seller_credibility_relativity_capped "
        "seller_credibility_normalization_factor seller_credibility_relativity credibility_expected_loss "
        "credibility_commercial_premium credibility_expected_loss_ratio_to_glm "
        "credibility_premium_ratio_to_glm credibility_expected_loss_ratio_to_freight"
    ),
    "tier_summary": "actual_net_loss glm_expected_loss credibility_expected_loss glm_ae credibility_ae",
    "seller_distribution": "mean std min p25 p50 p75 p90 p95 p99 max",
    "credibility_portfolio": (
        "actual_total_net_loss glm_expected_total_loss credibility_expected_total_loss "
        "credibility_total_commercial_premium glm_actual_to_expected credibility_actual_to_expected "
        "credibility_expected_loss_ratio portfolio_expected_loss_change_vs_glm"
    ),
    "credibility_k_sensitivity": (
        "credibility_k normalization_factor min_relativity max_relativity mean_credibility_weight "
        "credibility_expected_loss"
    ),
    "backtest_portfolio": (
        "actual_loss baseline_expected_loss glm_expected_loss credibility_expected_loss "
        "baseline_commercial_premium glm_commercial_premium credibility_commercial_premium claim_frequency "
        "average_severity actual_pure_premium baseline_expected_pure_premium baseline_ae baseline_loss_ratio "
        "baseline_loss_ratio_vs_target glm_expected_pure_premium glm_ae glm_loss_ratio "
        "glm_loss_ratio_vs_target credibility_expected_pure_premium credibility_ae credibility_loss_ratio "
        "credibility_loss_ratio_vs_target glm_ae_improvement_vs_baseline credibility_ae_improvement_vs_glm "
        "credibility_expected_loss_change_vs_glm"
    ),
    "backtest_month": (
        "actual_loss baseline_expected_loss glm_expected_loss credibility_expected_loss "
        "baseline_commercial_premium glm_commercial_premium credibility_commercial_premium claim_frequency "
        "average_severity actual_pure_premium baseline_expected_pure_premium baseline_ae baseline_loss_ratio "
        "baseline_loss_ratio_vs_target glm_expected_pure_premium glm_ae glm_loss_ratio "
        "glm_loss_ratio_vs_target credibility_expected_pure_premium credibility_ae credibility_loss_ratio "
        "credibility_loss_ratio_vs_target glm_ae_improvement_vs_baseline credibility_ae_improvement_vs_glm "
        "credibility_expected_loss_change_vs_glm"
    ),
    "backtest_category": (
        "actual_loss baseline_expected_loss glm_expected_loss credibility_expected_loss "
        "baseline_commercial_premium glm_commercial_premium credibility_commercial_premium claim_frequency "
        "average_severity actual_pure_premium baseline_expected_pure_premium baseline_ae baseline_loss_ratio "
        "baseline_loss_ratio_vs_target glm_expected_pure_premium glm_ae glm_loss_ratio "
        "glm_loss_ratio_vs_target credibility_expected_pure_premium credibility_ae credibility_loss_ratio "
        "credibility_loss_ratio_vs_target glm_ae_improvement_vs_baseline credibility_ae_improvement_vs_glm "
        "credibility_expected_loss_change_vs_glm"
    ),
    "backtest_route": (
        "actual_loss baseline_expected_loss glm_expected_loss credibility_expected_loss "
        "baseline_commercial_premium glm_commercial_premium credibility_commercial_premium claim_frequency "
        "average_severity actual_pure_premium baseline_expected_pure_premium baseline_ae baseline_loss_ratio "
        "baseline_loss_ratio_vs_target glm_expected_pure_premium glm_ae glm_loss_ratio "
        "glm_loss_ratio_vs_target credibility_expected_pure_premium credibility_ae credibility_loss_ratio "
        "credibility_loss_ratio_vs_target glm_ae_improvement_vs_baseline credibility_ae_improvement_vs_glm "
        "credibility_expected_loss_change_vs_glm"
    ),
    "backtest_tier": (
        "actual_loss baseline_expected_loss glm_expected_loss credibility_expected_loss "
        "baseline_commercial_premium glm_commercial_premium credibility_commercial_premium claim_frequency "
        "average_severity actual_pure_premium baseline_expected_pure_premium baseline_ae baseline_loss_ratio "
        "baseline_loss_ratio_vs_target glm_expected_pure_premium glm_ae glm_loss_ratio "
        "glm_loss_ratio_vs_target credibility_expected_pure_premium credibility_ae credibility_loss_ratio "
        "credibility_loss_ratio_vs_target glm_ae_improvement_vs_baseline credibility_ae_improvement_vs_glm "
        "credibility_expected_loss_change_vs_glm"
    ),
    "backtest_seller": (
        "actual_loss baseline_expected_loss glm_expected_loss credibility_expected_loss "
        "baseline_commercial_premium glm_commercial_premium credibility_commercial_premium claim_frequency "
        "average_severity actual_pure_premium baseline_expected_pure_premium baseline_ae baseline_loss_ratio "
        "baseline_loss_ratio_vs_target glm_expected_pure_premium glm_ae glm_loss_ratio "
        "glm_loss_ratio_vs_target credibility_expected_pure_premium credibility_ae credibility_loss_ratio "
        "credibility_loss_ratio_vs_target glm_ae_improvement_vs_baseline credibility_ae_improvement_vs_glm "
        "credibility_expected_loss_change_vs_glm"
    ),
    "top_loss_ratio_categories": "actual_loss credibility_expected_loss credibility_ae credibility_loss_ratio",
    "top_loss_ratio_routes": "actual_loss credibility_expected_loss credibility_ae credibility_loss_ratio",
    "top_loss_ratio_sellers": "actual_loss credibility_expected_loss credibility_ae credibility_loss_ratio",
    "validate_backtest": (
        "portfolio_actual_loss portfolio_baseline_expected_loss portfolio_glm_expected_loss "
        "portfolio_credibility_expected_loss"
    ),
    "premium_totals": (
        "actual_loss baseline_commercial_premium glm_commercial_premium credibility_commercial_premium"
    ),
    "stress_portfolio": (
        "portfolio_base_actual_loss segment_base_actual_loss frequency_multiplier severity_multiplier "
        "combined_loss_multiplier segment_stressed_actual_loss segment_stressed_loss_increase "
        "segment_stressed_loss_increase_pct portfolio_stressed_actual_loss portfolio_stressed_loss_increase "
        "portfolio_stressed_loss_increase_pct baseline_commercial_premium baseline_stressed_loss_ratio "
        "baseline_loss_ratio_vs_target glm_commercial_premium glm_stressed_loss_ratio "
        "glm_loss_ratio_vs_target credibility_commercial_premium credibility_stressed_loss_ratio "
        "credibility_loss_ratio_vs_target"
    ),
    "stress_by_tier": (
        "portfolio_base_actual_loss segment_base_actual_loss frequency_multiplier severity_multiplier "
        "combined_loss_multiplier segment_stressed_actual_loss segment_stressed_loss_increase "
        "segment_stressed_loss_increase_pct portfolio_stressed_actual_loss portfolio_stressed_loss_increase "
        "portfolio_stressed_loss_increase_pct baseline_commercial_premium baseline_stressed_loss_ratio "
        "baseline_loss_ratio_vs_target glm_commercial_premium glm_stressed_loss_ratio "
        "glm_loss_ratio_vs_target credibility_commercial_premium credibility_stressed_loss_ratio "
        "credibility_loss_ratio_vs_target"
    ),
    "watchlist": "segment_base_actual_loss credibility_loss_ratio",
    "stress_watchlist": (
        "portfolio_base_actual_loss segment_base_actual_loss frequency_multiplier severity_multiplier "
        "combined_loss_multiplier segment_stressed_actual_loss segment_stressed_loss_increase "
        "segment_stressed_loss_increase_pct portfolio_stressed_actual_loss portfolio_stressed_loss_increase "
        "portfolio_stressed_loss_increase_pct baseline_commercial_premium baseline_stressed_loss_ratio "
        "baseline_loss_ratio_vs_target glm_commercial_premium glm_stressed_loss_ratio "
        "glm_loss_ratio_vs_target credibility_commercial_premium credibility_stressed_loss_ratio "
        "credibility_loss_ratio_vs_target"
    ),
    "worst_scenarios": (
        "portfolio_base_actual_loss segment_base_actual_loss frequency_multiplier severity_multiplier "
        "combined_loss_multiplier segment_stressed_actual_loss segment_stressed_loss_increase "
        "segment_stressed_loss_increase_pct portfolio_stressed_actual_loss portfolio_stressed_loss_increase "
        "portfolio_stressed_loss_increase_pct baseline_commercial_premium baseline_stressed_loss_ratio "
        "baseline_loss_ratio_vs_target glm_commercial_premium glm_stressed_loss_ratio "
        "glm_loss_ratio_vs_target credibility_commercial_premium credibility_stressed_loss_ratio "
        "credibility_loss_ratio_vs_target"
    ),
    "validate_stress": "base_credibility_loss_ratio combined_20_20_multiplier backtesting_credibility_loss_ratio",
    "model_features": (
        "log_price log_freight_value_capped log_freight_to_price_ratio_capped log_product_weight_g_filled "
        "log_product_volume_cm3_filled log_estimated_delivery_days"
    ),
    "frequency_calibration": "actual_frequency predicted_frequency",
    "severity_calibration": (
        "actual_total_loss predicted_total_loss actual_severity predicted_severity actual_to_expected"
    ),
    "pure_premium_calibration": (
        "predicted_claims actual_total_loss predicted_total_loss actual_frequency predicted_frequency "
        "actual_pure_premium predicted_pure_premium actual_to_expected"
    ),
    "exact_auc": "auc",
    "prediction_errors": "actual_mean predicted_mean mae mse rmse",
    "glm_balance": "predicted_claims scaled_severity_total",
    "glm_validation_counts": "actual_frequency actual_total_loss actual_pure_premium actual_severity",
    "glm_pricing_checks": "baseline_expected_total_loss",
    "glm_backtest_actuals": "actual_loss baseline_loss_ratio",
    "model_comparison_actuals": "actual_total_loss",
    "challenger_calibration_identity": "train_actual_to_expected auc_gap_raw_vs_calibrated",
    "challenger_checks": "actual_total_loss calibrated_expected_total_loss",
    "attribution_identity": "split_gap",
    "glm_score_equations": "observed score_gap",
    "month_rerun": "total_net_loss",
    "exposure_table_salted": "freight_loss",
}


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, sql in oracles.build().items():
        columns = DOUBLE_COLUMNS.get(name, "").split()
        if columns:
            replaced = ", ".join(f'round("{c}" + {NUDGE!r}, {digits(c)}) AS "{c}"' for c in columns)
            sql = f"SELECT * REPLACE ({replaced}) FROM (\n{sql}\n)"
        out[name] = sql
    return out
