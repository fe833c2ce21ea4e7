"""Exposure table rules, joins with hot keys, key contracts and the CSV path."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tariffa.operators import exposure, joins, profile
from tariffa.sources.tables import InputTables, from_star_schema, read_csv_folder


def tables(spark) -> InputTables:
    return InputTables(
        items=spark.createDataFrame(
            [
                ("o1", 1, "p1", "s1", 10.0, 5.0),
                ("o1", 2, "p2", "s2", 0.0, 5.0),
                ("o2", 1, "p9", "s1", 0.0, 0.0),
                ("o3", 1, "p1", "s3", 20.0, 0.0),
            ],
            "order_id string, order_item_id int, product_id string, seller_id string, price double, freight_value double",
        ),
        orders=spark.createDataFrame(
            [
                ("o1", "c1", "delivered", "2026-05-18 12:00:00", "2026-05-20 00:00:00"),
                ("o2", "c2", "shipped", "garbage", "2026-05-20 00:00:00"),
                ("o3", "c3", "delivered", "2026-05-17 00:00:00", None),
            ],
            "order_id string, customer_id string, order_status string, order_purchase_timestamp string, "
            "order_estimated_delivery_date string",
        ),
        products=spark.createDataFrame(
            [("p1", "brinquedos", 100.0, 2.0, 3.0, 4.0), ("p2", None, None, None, 3.0, 4.0)],
            "product_id string, product_category_name string, product_weight_g double, product_length_cm double, "
            "product_height_cm double, product_width_cm double",
        ),
        translation=spark.createDataFrame(
            [("brinquedos", "toys")], "product_category_name string, product_category_name_english string"
        ),
        customers=spark.createDataFrame(
            [("c1", "x", "SP", 1), ("c2", "y", None, 2), ("c3", "z", "RJ", 3)],
            "customer_id string, customer_city string, customer_state string, customer_zip_code_prefix int",
        ),
        sellers=spark.createDataFrame(
            [("s1", "x", "SP", 1), ("s2", "y", "RJ", 2), ("s3", "z", None, 3)],
            "seller_id string, seller_city string, seller_state string, seller_zip_code_prefix int",
        ),
    )


def test_exposure_rules(spark):
    rows = {(r["order_id"], r["order_item_id"]): r for r in exposure.build_exposure(tables(spark)).collect()}
    first, second, third, fourth = rows["o1", 1], rows["o1", 2], rows["o2", 1], rows["o3", 1]
    assert len(rows) == 4
    assert (first["product_category_name_english"], first["product_volume_cm3"]) == ("toys", 24.0)
    assert second["product_category_name"] == third["product_category_name_english"] == "unknown"
    assert second["product_volume_cm3"] is None and second["freight_to_price_ratio"] == float("inf")
    assert third["freight_to_price_ratio"] is None
    assert [r["cross_state_flag"] for r in (first, second, third, fourth)] == [0, 1, 1, 1]
    assert [r["route_state"] for r in (first, second, third, fourth)] == ["SP_to_SP", "RJ_to_SP", None, None]
    assert (first["purchase_month"], first["purchase_weekday"], first["estimated_delivery_days"]) == (5, 0, 1.5)
    assert third["order_purchase_timestamp"] is None and third["estimated_delivery_days"] is None
    assert fourth["purchase_weekday"] == 6


def test_columns_choose_the_arms(spark, folder):
    star = from_star_schema(spark, folder)
    narrow = exposure.build_exposure(star, ["order_id", "price", "product_weight_g"])
    plan = narrow._jdf.queryExecution().optimizedPlan().toString()
    assert "o_orderkey" not in plan and "s_suppkey" not in plan and 1 <= plan.count("Join") <= 2  # the product arm only
    wide = exposure.build_exposure(star)
    assert wide.agg(F.sum("product_weight_g")).first() == narrow.agg(F.sum("product_weight_g")).first()


@pytest.mark.parametrize("limit", ["10MB", "-1"])
def test_dimension_join_with_a_hot_key(spark, limit):
    fact = spark.range(9000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 1L WHEN id % 50 = 1 THEN NULL ELSE id % 2000 END AS k"
    )
    dimension = spark.range(1900).selectExpr("id AS k", "id * 2 AS v")
    want = fact.join(dimension, "k", "left").agg(F.count("id"), F.count("v"), F.sum("v")).first()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        got = joins.dimension_join(fact, dimension, "k", row_key=["id"])
        assert ("__salt" in got._jdf.queryExecution().analyzed().toString()) == (limit == "-1")
        assert got.agg(F.count("id"), F.count("v"), F.sum("v")).first() == want
        assert list(joins.hot_keys(fact, "k"))[0] == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_contracts_report_and_raise(spark):
    t = tables(spark)
    audit = {r["table_name"]: r for r in exposure.key_audit(t).collect()}
    assert all(r["is_unique"] == 1 for r in audit.values())
    twice = t.sellers.unionByName(t.sellers)
    with pytest.raises(ValueError):
        joins.assert_unique(twice, ["seller_id"], "sellers")
    rates = {r["join_name"]: r["match_rate"] for r in exposure.join_match_rates(t).collect()}
    assert rates["items_to_orders"] == 1.0 and rates["items_to_products"] == 0.75


def test_profile_of_orders(spark):
    row = profile.exposure_profile(exposure.build_exposure(tables(spark))).first()
    assert (row["row_count"], row["unique_exposure_key"], row["unique_order_id"]) == (4, 4, 3)
    assert (row["orders_with_multiple_sellers"], row["max_exposures_per_order"]) == (1, 2)


def test_csv_folder(spark, tmp_path):
    from tariffa.sources.schemas import INPUT_SCHEMAS

    for name, df in tables(spark).by_name().items():
        wanted = [f.split()[0] for f in INPUT_SCHEMAS[name].split(", ")]
        full = df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in wanted])
        full.coalesce(1).write.option("header", "true").csv(str(tmp_path / f"{name}.csv"))
    read = exposure.build_exposure(read_csv_folder(spark, str(tmp_path)))
    assert read.count() == 4
    assert read.filter("product_category_name_english = 'toys'").count() == 2
