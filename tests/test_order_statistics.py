"""Quantiles, ranks and AUC against brute force."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tariffa.operators import metrics
from tariffa.operators.quantiles import fine_bucket, quantiles, value_bucket


def frame(n=3000, seed=3):
    rng = np.random.default_rng(seed)
    g = np.where(rng.random(n) < 0.6, "hot", rng.choice(["a", "b", None], n))
    v = np.where(rng.random(n) < 0.35, 7.0, rng.normal(0, 50, n))
    v[rng.random(n) < 0.05] = np.nan
    v[:3] = [np.inf, -1e-9, 1e12]
    return pd.DataFrame({"g": g, "v": v, "w": rng.integers(1, 4, n)})


def spark_frame(spark, pdf):
    rows = [
        (None if g is None else str(g), None if np.isnan(v) else float(v), int(w))
        for g, v, w in pdf.itertuples(index=False)
    ]
    return spark.createDataFrame(rows, "g string, v double, w int")


@pytest.mark.parametrize("weighted", [True, False])
def test_quantiles_equal_numpy(spark, weighted):
    pdf = frame()
    probabilities = [0.0, 0.05, 0.5, 0.95, 1.0]
    got = {
        r["g"]: (r["n"], r["q"])
        for r in quantiles(
            spark_frame(spark, pdf), ["g"], ["v"], probabilities, weight="w" if weighted else None
        ).collect()
    }
    valid = pdf[pdf.v.notna()]
    for key, part in valid.groupby(valid.g.fillna("-"), dropna=False):
        values = np.repeat(part.v, part.w) if weighted else part.v
        n, q = got[None if key == "-" else key]
        assert n == len(values)
        for p, x in zip(probabilities, q, strict=True):
            want = np.quantile(values, p) if p < 1 else max(values)
            assert x == want or abs(x - want) < 1e-9 * max(1, abs(want))


def test_buckets_are_monotone(spark):
    values = [0.0, -0.0, 1e-300, -1e-300, 1.0, 1.0000001, -5.0, 3e8, float("inf"), float("-inf"), 0.25]
    values += [s * (1e9 + i / 7) for i in range(2000) for s in (1, -1)] + [2.0**k for k in range(-40, 40)]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", value_bucket("v"), fine_bucket("v"))
    buckets = [tuple(r)[1:] for r in sorted(rows.collect(), key=lambda r: r["v"])]
    assert buckets == sorted(buckets)
    nan = spark.createDataFrame([(float("nan"),)], "v double").select(value_bucket("v")).first()[0]
    assert nan > max(buckets)[0]


def test_not_a_number_is_skipped_and_infinities_count(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, 3.0, nan, inf, -inf, None)], "v double")
    row = quantiles(df, [], ["v"], [0.0, 0.5, 1.0]).first()
    assert row["n"] == 5 and row["q"] == [-inf, 2.0, inf]
    row = quantiles(df.filter("not isnan(v) and abs(v) < 10"), [], ["v"], [0.0, 0.5, 1.0]).first()
    assert row["n"] == 3 and row["q"] == [1.0, 2.0, 3.0]


def test_values_far_from_zero_stay_in_small_buckets(spark):
    df = spark.range(100_000).select((F.col("id") + 1e9).alias("v"))
    fullest = df.groupBy(value_bucket("v"), fine_bucket("v")).count().agg(F.max("count")).first()[0]
    assert fullest < 50
    assert quantiles(df, [], ["v"], [0.25, 0.9]).first()["q"] == [1e9 + 24_999.75, 1e9 + 89_999.1]


def test_auc_puts_not_a_number_highest(spark):
    rows = [(1.0, 0), (2.0, 1), (3.0, 0), (float("nan"), 1)]
    assert metrics.exact_auc(spark.createDataFrame(rows, "s double, y int"), [], "y", "s").first()["auc"] == 0.75


@pytest.mark.parametrize("n", [1, 2, 5, 10, 15, 37, 400])
@pytest.mark.parametrize("tied", [False, True])
def test_deciles_follow_the_rank_rule(spark, n, tied):
    df = spark.range(n).withColumn("s", F.lit(0.5) if tied else (F.col("id") * 37 % 101).cast("double"))
    got = metrics.score_deciles(df, "s", key=["id"]).collect()
    from tariffa.functions.columns import keyed_uniform
    from tariffa.config import SEED

    ties = {r["id"]: r["u"] for r in df.withColumn("u", keyed_uniform(["id"], "rank_tie", SEED)).collect()}
    order = sorted(got, key=lambda r: (r["s"], ties[r["id"]]))
    for rank, row in enumerate(order, 1):
        want = 1 if n == 1 else max(1, -(-(rank - 1) * 10 // (n - 1)))
        assert row["prediction_decile"] == want


def test_deciles_by_group_with_a_hot_score(spark):
    df = spark.range(600).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 'x' END AS g", "CASE WHEN id % 2 = 0 THEN 1.5D ELSE id / 10.0D END AS s"
    )
    sizes = metrics.score_deciles(df, "s", by=["g"], key=["id"]).groupBy("g", "prediction_decile").count().collect()
    assert len(sizes) == 20
    assert {r["count"] for r in sizes if r["g"] == "x"} <= {20, 21}


def test_auc_with_ties_and_one_class(spark):
    rng = np.random.default_rng(5)
    s, y = np.round(rng.random(800), 2), (rng.random(800) < 0.3).astype(int)
    rows = [("two", int(a), float(b)) for a, b in zip(y, s, strict=True)] + [("one", 1, 0.2), ("one", 1, 0.4)]
    df = spark.createDataFrame(rows, "g string, y int, s double")
    got = {r["g"]: r["auc"] for r in metrics.exact_auc(df, ["g"], "y", "s").collect()}
    pos, neg = s[y == 1], s[y == 0]
    want = np.mean([(p > q) + 0.5 * (p == q) for p in pos for q in neg])
    assert abs(got["two"] - want) < 1e-12 and got["one"] is None


def test_many_groups_without_broadcast(spark, monkeypatch):
    """Too many groups to broadcast: the shuffled join gives the same values."""
    from tariffa.operators import quantiles as module

    monkeypatch.setattr(module, "checked_broadcast", lambda df: df)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(5000).selectExpr("CASE WHEN id % 3 = 0 THEN NULL ELSE id % 700 END AS g", "id * 7 % 911 AS v")
        got = quantiles(df, ["g"], ["v"], [0.3, 0.5])
        want = df.groupBy("g").agg(F.expr("percentile(v, array(0.3D, 0.5D))").alias("q"))
        assert got.count() == want.count()
        pairs = got.withColumnRenamed("q", "a").join(want, got["g"].eqNullSafe(want["g"]))
        gap = pairs.select(F.max(F.abs(F.col("a")[0] - F.col("q")[0]) + F.abs(F.col("a")[1] - F.col("q")[1]))).first()[0]
        assert gap < 1e-9
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
