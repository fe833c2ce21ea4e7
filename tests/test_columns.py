"""Missing-value, division and flag rules on hand-written rows."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tariffa.functions import columns as c


def one(spark, **expressions):
    return spark.range(1).select(*[e.alias(n) for n, e in expressions.items()]).first().asDict()


def test_division_rules(spark):
    row = one(
        spark,
        plain=c.safe_divide(F.lit(3.0), F.lit(2.0)),
        zero=c.safe_divide(F.lit(3.0), F.lit(0.0)),
        default=c.positive_divide(F.lit(3.0), F.lit(0.0), 1.0),
        negative=c.positive_divide(F.lit(3.0), F.lit(-1.0)),
        open_inf=c.open_ratio(F.lit(5.0), F.lit(0.0)),
        open_none=c.open_ratio(F.lit(0.0), F.lit(0.0)),
    )
    assert row["plain"] == 1.5 and row["zero"] == 0.0 and row["default"] == 1.0 and row["negative"] == 0.0
    assert math.isinf(row["open_inf"]) and row["open_none"] is None


def test_caps_keep_missing(spark):
    missing = F.lit(None).cast("double")
    row = one(
        spark,
        cap=c.cap_above(F.lit(9.0), 3.5),
        below=c.cap_above(F.lit(2.0), 3.5),
        cap_missing=c.cap_above(missing, 3.5),
        infinite=c.cap_above(F.lit(float("inf")), 3.5),
        clip=c.clip(F.lit(0.4), 0.01, 0.25),
        clip_missing=c.clip(missing, 0.01, 0.25),
    )
    assert row == {
        "cap": 3.5, "below": 2.0, "cap_missing": None, "infinite": 3.5, "clip": 0.25, "clip_missing": None
    }


def test_adequacy_edges(spark):
    flags = [
        one(spark, f=c.adequacy_flag(F.lit(v), 0.6))["f"] for v in (0.60, 0.6000000000000001, 0.80, 1.00, 1.01)
    ]
    assert flags == ["within_target", "within_target", "above_target", "high_pressure", "premium_inadequate"]


def test_uniform_is_stable_and_even(spark):
    df = spark.range(20000).withColumn("u", c.keyed_uniform(["id"], "s", 1))
    again = df.repartition(7).agg(F.sum("u")).first()[0]
    stats = df.agg(F.sum("u"), F.min("u"), F.max("u"), F.avg("u")).first()
    assert abs(stats[0] - again) < 1e-6
    assert 0 <= stats[1] and stats[2] < 1 and abs(stats[3] - 0.5) < 0.01
    other = spark.range(20000).withColumn("u", c.keyed_uniform(["id"], "t", 1))
    assert df.join(other.withColumnRenamed("u", "v"), "id").filter("u = v").count() == 0


def test_weighted_choice(spark):
    options = (("a", 0.45), ("b", 0.25), ("c", 0.3))
    picks = [one(spark, p=c.weighted_choice(F.lit(u), options))["p"] for u in (0.0, 0.449, 0.45, 0.7, 0.99)]
    assert picks == ["a", "a", "b", "c", "c"]
