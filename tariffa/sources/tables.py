"""The six input tables as one value, and the ways to load them."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffa.sources.schemas import INPUT_SCHEMAS


@dataclass(frozen=True)
class InputTables:
    items: DataFrame
    orders: DataFrame
    products: DataFrame
    translation: DataFrame
    customers: DataFrame
    sellers: DataFrame

    def by_name(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}


# Primary key of each input table.
INPUT_KEYS = {
    "items": ["order_id", "order_item_id"],
    "orders": ["order_id"],
    "products": ["product_id"],
    "translation": ["product_category_name"],
    "customers": ["customer_id"],
    "sellers": ["seller_id"],
}


def read_csv(spark: SparkSession, path: str, name: str) -> DataFrame:
    """CSV with a header row, read with the fixed schema of table ``name``; a malformed row is an error."""
    return (
        spark.read.schema(INPUT_SCHEMAS[name])
        .option("header", "true")
        .option("enforceSchema", "false")
        .option("multiLine", "false")
        .option("mode", "FAILFAST")
        .csv(path)
    )


def read_csv_folder(spark: SparkSession, folder: str, file_names: dict[str, str] | None = None) -> InputTables:
    """Six CSV files, by default named ``items.csv``, ``orders.csv`` and so on."""
    names = {name: f"{name}.csv" for name in INPUT_SCHEMAS} | (file_names or {})
    return InputTables(
        **{name: read_csv(spark, os.path.join(folder, file), name) for name, file in names.items()}
    )


def read_parquet_folder(spark: SparkSession, folder: str) -> InputTables:
    """Six Parquet tables named after the fields of :class:`InputTables`."""
    return InputTables(
        **{f.name: spark.read.parquet(os.path.join(folder, f.name)) for f in fields(InputTables)}
    )


def from_star_schema(spark: SparkSession, folder: str) -> InputTables:
    """Map an order/line-item star schema (Parquet) onto the six input tables.

    Some products get a missing or a zero size and names starting with ``red`` have no
    translation, so that the missing-value branches see data.
    """

    def table(name: str) -> DataFrame:
        return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))

    nation = table("nation").select("n_nationkey", "n_name")
    wanted = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_tax"]
    items = table("lineitem").select(*wanted).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.when(F.col("l_quantity") != 0, F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("freight_value"),
    )
    orders = table("orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderdate").cast("timestamp").alias("order_purchase_timestamp"),
        (
            F.col("o_orderdate").cast("timestamp")
            + F.make_dt_interval(
                days=(F.col("o_orderkey") % 90).cast("int"),
                hours=(F.col("o_orderkey") % 24).cast("int"),
            )
        ).alias("order_estimated_delivery_date"),
    )
    no_size = F.col("p_partkey") % 97 == 0
    products = table("part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_category_name"),
        F.when(~no_size, F.when(F.col("p_partkey") % 89 == 0, 0.0).otherwise(F.col("p_size") * 850.0)).alias(
            "product_weight_g"
        ),
        F.when(~no_size, F.col("p_size") * 2.0).alias("product_length_cm"),
        F.when(~no_size, F.col("p_partkey") % 40 + 1.0).alias("product_height_cm"),
        F.when(~no_size, F.col("p_partkey") % 60 + 1.0).alias("product_width_cm"),
    )
    translation = (
        table("part")
        .filter(~F.col("p_name").startswith("red "))
        .select(F.col("p_name").alias("product_category_name"))
        .distinct()
        .withColumn(
            "product_category_name_english", F.replace(F.col("product_category_name"), F.lit(" "), F.lit("_"))
        )
    )
    customers = (
        table("customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_mktsegment").alias("customer_city"),
            F.col("n_name").alias("customer_state"),
            (F.col("c_nationkey") * 100).cast("int").alias("customer_zip_code_prefix"),
        )
    )
    sellers = (
        table("supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("s_suppkey").alias("seller_id"),
            F.col("s_name").alias("seller_city"),
            F.col("n_name").alias("seller_state"),
            (F.col("s_nationkey") * 100).cast("int").alias("seller_zip_code_prefix"),
        )
    )
    return InputTables(items, orders, products, translation, customers, sellers)
