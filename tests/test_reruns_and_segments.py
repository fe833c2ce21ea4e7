"""Malformed CSV, partition reruns, the leakage probe, and segmentations from one scan."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from tariffa.operators import backtest, features, joins
from tariffa.operators.segments import segment_totals
from tariffa.plans import catalog, star
from tariffa.sources.quarantine import ROW_SHAPE, read_csv_diverting
from tariffa.sources.sinks import rewrite_partitions

ITEMS = """order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value
o1,1,p1,s1,2020-01-02 03:04:05,10.5,2.25
o2,1,p1,s1,2020-01-02 03:04:05,ten,2.25
o3,one,p1,s1,not a date,10.5,
o4,1,p1
o5,1,p1,s1,,,
o6,1,p1,s1,2020-01-02 03:04:05,10.5,2.25,more
"o7, quoted",2,p2,s2,2020-02-30 00:00:00,1,1
"""


def test_malformed_rows_are_kept_apart_with_their_text(spark, tmp_path):
    (tmp_path / "items.csv").write_text(ITEMS)
    found = read_csv_diverting(spark, str(tmp_path / "items.csv"), "items")
    rows = {r["order_id"]: r for r in found.rows.collect()}
    assert set(rows) == {"o1", "o5"} and (rows["o1"]["price"], rows["o1"]["order_item_id"]) == (10.5, 1)
    assert rows["o5"]["price"] is None and rows["o5"]["shipping_limit_date"] is None
    bad = {r["text"].split(",")[0]: r for r in found.quarantine.collect()}
    assert {k: r["columns"] for k, r in bad.items()} == {
        "o2": ["price"], "o3": ["order_item_id", "shipping_limit_date"], "o4": [ROW_SHAPE], "o6": [ROW_SHAPE], '"o7': ["shipping_limit_date"],
    }
    assert bad["o2"]["text"] == ITEMS.splitlines()[2] and {r["table_name"] for r in bad.values()} == {"items"}
    counts = {r["column_name"]: r["row_count"] for r in found.counts().collect()}
    assert counts == {"price": 1, "order_item_id": 1, "shipping_limit_date": 2, ROW_SHAPE: 2}


def test_clean_and_empty_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n".join(ITEMS.splitlines()[:2]) + "\n")
    (tmp_path / "b.csv").write_text(ITEMS.splitlines()[0] + "\n")
    for name, rows in (("a.csv", 1), ("b.csv", 0)):
        found = read_csv_diverting(spark, str(tmp_path / name), "items")
        assert (found.rows.count(), found.quarantine.count(), found.counts().count()) == (rows, 0, 0)


def test_a_month_is_rewritten_alone(spark, tmp_path):
    path = str(tmp_path / "months")
    rows = spark.range(1000).select("id", (F.col("id") % 5).cast("int").alias("month"))
    rewrite_partitions(rows, path, ["month"])
    listed = {m: sorted(os.listdir(f"{path}/month={m}")) for m in range(5)}
    rewrite_partitions(rows.filter("month = 2").withColumn("id", F.col("id") + 10_000).limit(50), path, ["month"])
    rewrite_partitions(rows.limit(0), path, ["month"])
    now = {m: sorted(os.listdir(f"{path}/month={m}")) for m in range(5)}
    assert [m for m in range(5) if now[m] != listed[m]] == [2]
    counts = {r["month"]: (r["n"], r["least"]) for r in spark.read.parquet(path).groupBy("month").agg(F.count("*").alias("n"), F.min("id").alias("least")).collect()}
    assert counts == {0: (200, 0), 1: (200, 1), 2: (50, counts[2][1]), 3: (200, 3), 4: (200, 4)} and counts[2][1] >= 10_000


def test_the_probe_finds_outcomes_under_other_names(spark, folder):
    claims = catalog.stages(spark, folder).claims
    tables = features.level_tables(claims, 30, 20)

    def honest(rows):
        return features.prepare_features(rows, *tables)

    def renamed(rows):
        hidden = rows.withColumn("spend", F.col("net_loss")).withColumn("price", F.col("price") + F.when(F.col("spend") > 0, 0.01).otherwise(0.0))
        return honest(hidden).withColumn("label", F.concat(F.lit("r"), F.col("return_reason")))

    assert {r["leaks"] for r in features.leakage_probe(claims, honest).collect()} == {0}
    found = {r["feature"]: r["leaks"] for r in features.leakage_probe(claims, renamed, [*features.MODEL_FEATURES, "label"]).collect()}
    assert {f for f, leaks in found.items() if leaks} == {"log_price", "label"}


def plain_segments(rows, groups):
    out = {}
    for r in rows:
        out.setdefault(tuple(r[g] for g in groups), []).append(r)
    return {
        k: (sum(r["x"] or 0 for r in v), len({r["a"] for r in v if r["a"] is not None}), len({r["b"] for r in v if r["b"] is not None}))
        for k, v in out.items()
    }


@pytest.mark.parametrize("seed", [1, 2])
def test_segments_against_plain_sets(spark, seed):
    rng = random.Random(seed)
    rows = [
        {"g": rng.choice([None, 1, 2]), "h": rng.choice(["", "x", None]), "a": rng.choice([None, *range(6)]), "b": rng.choice([None, "p", "q"]), "x": rng.choice([None, 1, 5])}
        for _ in range(300)
    ]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "g int, h string, a long, b string, x int")
    cuts = [(), ("g",), ("h",), ("g", "h")]
    table = segment_totals(df, cuts, {"total": F.col("x")}, {"as": "a", "bs": "b"}).collect()
    for k, groups in enumerate(cuts):
        got = {tuple(r[g] for g in groups): (r["total"] or 0, r["as"], r["bs"]) for r in table if r["segmentation"] == k}
        assert got == plain_segments(rows, groups)
    empty = segment_totals(df.limit(0), [()], {"total": F.col("x")}, {"as": "a"}).collect()
    assert [tuple(r) for r in empty] == [(0, None, 0)] and segment_totals(df.limit(0), cuts, {"total": F.col("x")}, {"as": "a"}).count() == 0


def test_all_backtests_come_from_one_scan(spark, folder):
    priced = catalog.stages(spark, folder).analytic_credibility
    plan = backtest.backtests(priced, star.BACKTESTED)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and "Expand" not in plan and "distinct" not in plan


def test_a_hot_key_is_dealt_over_salts(spark):
    fact = spark.range(4000).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 50).alias("k"), "id")
    dimension = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    joined = joins.dimension_join(fact, dimension, "k", row_key=["id"], rows_per_salt=100, may_broadcast=False)
    assert "__salt" in joined._jdf.queryExecution().optimizedPlan().toString()
    assert joined.filter("v <> k * 10 OR v IS NULL").count() == 0 and joined.count() == 4000


def test_segments_do_not_shuffle_pairs(spark, folder):
    """Rows are dealt by identifier; the pairs of a segment and an identifier, eighteen a row, stay where they are made."""
    priced = catalog.stages(spark, folder).analytic_credibility
    plan = backtest.backtests(priced, star.BACKTESTED)._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(dealt) == 2 and sum("__id" in line for line in dealt) == 1
    assert not any("__id" in line and "segmentation" in line for line in dealt)


def test_a_hot_identifier_is_counted_once(spark):
    """One order and one missing order hold most rows: spread over tasks, they are still one identifier and none."""
    rows = [(i % 5, 1 if i % 3 else None if i % 2 else i, i % 7) for i in range(600)]
    df = spark.createDataFrame(rows, "g int, a long, b int")
    table = segment_totals(df, [(), ("g",)], {"n": F.lit(1)}, {"as": "a", "bs": "b"})
    got = {(r["segmentation"], r["g"]): (r["n"], r["as"], r["bs"]) for r in table.collect()}
    for g in (None, *range(5)):
        own = [r for r in rows if g is None or r[0] == g]
        assert got[(int(g is not None), g)] == (len(own), len({r[1] for r in own} - {None}), len({r[2] for r in own}))


def test_rows_that_are_only_scanned_are_not_shuffled(spark, folder):
    """Only what is joined on the exposure key has the claims dealt by it; both tables hold the same rows."""
    s = star.StarStages(spark, folder)
    assert s.analytic_pricing.count() == s.exposures.count()
    assert "claims" not in s.__dict__
    assert s.claims.exceptAll(s.claim_rows).isEmpty() and s.claims.count() == s.claim_rows.count()
    other = star.StarStages(spark, folder)
    assert other.claims is other.claim_rows
