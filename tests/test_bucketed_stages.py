"""Hand-off joins and roll-ups on bucketed stage tables: no exchange, the same rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tariffa.config import EXPOSURE_KEY
from tariffa.operators import joins, rating
from tariffa.plans import star
from tariffa.sources.sinks import stored, stored_bucketed


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def shuffled_joins(spark):
    """Nothing here is broadcast, however small."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_join_with_the_baseline_has_no_exchange(spark, folder, shuffled_joins):
    s = star.StarStages(spark, folder)
    joined = rating.with_baseline(s.claims.select(*EXPOSURE_KEY, "covered_claim_flag"), s.baseline)
    text = plan(joined).split("Subquery")[0]
    assert "SortMergeJoin" in text and "Exchange" not in text
    # the plain tables need one on both sides
    plain = stored(s.claims, "plain"), stored(s.baseline, "plain")
    other = rating.with_baseline(plain[0].select(*EXPOSURE_KEY, "covered_claim_flag"), plain[1])
    assert "Exchange" in plan(other)
    assert joined.exceptAll(other).isEmpty() and other.exceptAll(joined).isEmpty()
    assert joined.count() == other.count()


def test_order_roll_up_has_no_exchange(spark, folder):
    s = star.StarStages(spark, folder)
    rolled = rating.order_premium(s.order_rows)
    assert "Exchange" not in plan(rolled)
    rounded = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in rolled.dtypes]
    plain = rating.order_premium(stored(s.baseline, "plain"))
    assert "Exchange" in plan(plain)
    assert rolled.select(*rounded).exceptAll(plain.select(*rounded)).isEmpty() and rolled.count() == plain.count()


def test_a_hot_order_is_not_put_into_one_bucket(spark, folder):
    s = star.StarStages(spark, folder)
    claims = stored(s.claims.withColumn("order_id", F.when(F.col("order_id") % 2 == 0, 0).otherwise(F.col("order_id")).cast("long")), "hot")
    s.__dict__["claims"] = claims
    assert list(joins.hot_keys(claims, "order_id", star.HOT_ORDER)) == [0]
    rolled = rating.order_premium(s.order_rows)
    # partial sums are shuffled instead
    assert "Exchange" in plan(rolled)
    total = rolled.agg(F.sum("exposures")).first()[0]
    assert total == claims.count() and rolled.count() == claims.select("order_id").distinct().count()


def test_bucketed_tables_keep_nulls_repeats_and_empty_tables(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (2, None)], "k long, v string")
    for df in (rows, rows.limit(0)):
        held = stored_bucketed(df, ["k"], "odd names-and.dots", buckets=3)
        assert sorted(map(str, held.collect())) == sorted(map(str, df.collect()))
        assert "Exchange" not in plan(held.groupBy("k").count())
