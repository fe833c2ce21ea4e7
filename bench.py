"""Times the headline queries and prints one JSON line.

Every stage table (exposure, claims, priced tables) is built inside the run and timed as an
entry of its own (``stage_*``), so the total counts all work from the raw tables on.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "exposure_table",
    "key_audit",
    "join_match_rates",
    "exposure_profile",
    "missing_report",
    "numeric_quantiles",
    "cap_diagnostics",
    "anomaly_checks",
    "status_summary",
    "category_freight_summary",
    "route_freight_summary",
    "metric_by_cross_state",
    "top_freight_rows",
    "simulated_losses",
    "claims_summary",
    "portfolio_metrics",
    "rating_by_category",
    "rating_by_route",
    "rating_by_seller",
    "baseline_pricing",
    "order_premium",
    "seller_credibility",
    "seller_distribution",
    "credibility_pricing",
    "backtest_portfolio",
    "backtest_month",
    "backtest_category",
    "backtest_route",
    "backtest_seller",
    "stress_portfolio",
    "stress_by_tier",
    "stress_watchlist",
    "order_split",
    "model_features",
    "score_deciles",
    "pure_premium_calibration",
    "exact_auc",
    "glm_metrics",
    "glm_portfolio",
    "model_comparison",
    "challenger_report",
    "contribution_summary",
]
STAGES = ["exposures", "size_statistics", "claims", "analytic_credibility", "glm_validation", "glm_pricing"]
STAGES += ["challenger_model", "boosted_validation", "challenger_pricing"]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from pyspark.sql import SparkSession

    from tariffa.plans import catalog
    from tariffa.session import RUNTIME_CONF

    builder = SparkSession.builder.master(f"local[{cpus}]").appName("bench").config("spark.ui.enabled", "false")
    builder = builder.config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "12g")
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()

    catalog.forget_stages()
    registered = catalog.queries()
    chosen = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    times: dict[str, float] = {}

    def timed(name: str, job) -> None:
        start = time.perf_counter()
        job()
        times[name] = round(time.perf_counter() - start, 3)

    prepared = catalog.stages(spark, folder)
    for stage in STAGES:
        timed(f"stage_{stage}", lambda stage=stage: getattr(prepared, stage))
    for name in chosen:
        # every row and column is produced, none is brought to the driver
        timed(name, lambda name=name: registered[name](spark, folder).write.format("noop").mode("overwrite").save())
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
