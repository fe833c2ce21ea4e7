"""Registered queries use what their modules have, found without running each of them."""

from __future__ import annotations

import ast
import inspect
from types import ModuleType

from pyspark.sql import functions as F

from tariffa.plans import catalog, star


def test_queries_name_only_what_their_modules_have():
    tree = ast.parse(inspect.getsource(catalog))
    used = {(n.value.id, n.attr) for n in ast.walk(tree) if isinstance(n, ast.Attribute) and isinstance(n.value, ast.Name)}
    modules = {name: value for name, value in vars(catalog).items() if isinstance(value, ModuleType)}
    assert not [f"{name}.{attr}" for name, attr in used if name in modules and not hasattr(modules[name], attr)]


def test_severity_calibration_ranks_the_claims_alone(spark):
    s = star.StarStages(spark, "unused")
    rows = spark.range(40).select(
        F.col("id").alias("order_id"),
        *[F.lit(1).alias(c) for c in ("order_item_id", "seller_id", "product_id")],
        F.when(F.col("id") < 30, 1).otherwise(0).alias("claim_eligible_flag"),
        (F.col("id") % 2).cast("int").alias("covered_claim_flag"),
        F.when(F.col("id") % 2 == 1, F.when(F.col("id") == 1, 0.0).otherwise(F.col("id") * 2.0)).otherwise(0.0).alias("net_loss"),
        F.lit(0.5).alias("covered_claim_probability"),
        F.col("id").cast("double").alias("freight_value_capped"),
    )
    s.__dict__["claim_rows"] = rows
    found = catalog.severity_calibration(s).collect()
    # 3, 5, ..., 29: eligible rows with a claim and a loss
    assert sum(r["claims"] for r in found) == 14
    assert sum(r["predicted_total_loss"] for r in found) == sum(range(3, 30, 2))
    assert all(abs(r["actual_to_expected"] - 2.0) < 1e-12 for r in found)
    assert sorted({r["prediction_decile"] for r in found}) == list(range(1, 11))
