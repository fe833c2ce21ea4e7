"""The whole chain on the smallest tables: every step runs and its checks hold."""

from __future__ import annotations

import json
import os

from tariffa.config import BoostingConfig, GlmConfig, RatingConfig
from tariffa.plans.star import SIMULATION
from tariffa.plans.workflow import PHASES, Workflow, run
from tariffa.sources.tables import from_star_schema


def metrics(folder: str, name: str) -> dict:
    path = os.path.join(folder, f"{name}_summary")
    lines = [line for f in os.listdir(path) if f.endswith(".json") for line in open(os.path.join(path, f))]
    assert len(lines) == 1
    return json.loads(lines[0])


def test_all_steps(spark, folder, tmp_path):
    out = str(tmp_path)
    small = BoostingConfig(
        frequency_trees=2, frequency_step=0.3, frequency_min_rows=5, severity_trees=2, severity_step=0.3, severity_depth=2
    )
    workflow = Workflow(
        from_star_schema(spark, folder),
        out,
        simulation=SIMULATION,
        rating=RatingConfig(category_min_exposure=30, route_min_exposure=5, seller_min_exposure=100),
        glm=GlmConfig(category_min_exposure=30, route_min_exposure=20),
        boosting=small,
        table_format="csv",
    )
    assert run(workflow, "all") == PHASES["all"]
    assert workflow.load("pricing_challenger").count() == 6000
    assert metrics(out, "pricing_baseline_validation")["portfolio_pure_premium_matches"] == 1
    assert metrics(out, "seller_credibility_validation")["portfolio_expected_loss_preserved"] == 1
    assert metrics(out, "loss_ratio_backtesting_validation")["credibility_loss_ratio_equals_target_times_ae"] == 1
    assert metrics(out, "stress_testing")["base_loss_ratio_matches_backtesting"] == 1
    watch = workflow.load("stress_test_watchlist_segments")
    assert 0 < watch.count() <= 10
    header = spark.read.option("header", "true").csv(os.path.join(out, "eda", "numeric_quantiles")).columns
    assert header[:5] == ["field", "count", "missing", "mean", "std"] and header[-1] == "max"
