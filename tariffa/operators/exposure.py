"""The exposure table: one row per order item, with order, product and party attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffa.config import EXPOSURE_KEY
from tariffa.functions.columns import open_ratio
from tariffa.operators.joins import assert_unique, dimension_join, key_uniqueness, match_rate
from tariffa.sources.schemas import EXPOSURE_COLUMNS
from tariffa.sources.tables import INPUT_KEYS, InputTables

_MICROS_PER_DAY = 86_400_000_000


def _timestamp(df: DataFrame, column: str) -> Column:
    """Text is parsed and a bad value becomes missing; a typed column is taken as it is."""
    if df.schema[column].dataType.typeName() == "string":
        return F.try_to_timestamp(F.col(column)).alias(column)
    return F.col(column).cast("timestamp").alias(column)


def orders_with_customers(tables: InputTables, with_customers: bool = True) -> DataFrame:
    orders = tables.orders.select(
        "order_id",
        "customer_id",
        "order_status",
        _timestamp(tables.orders, "order_purchase_timestamp"),
        _timestamp(tables.orders, "order_estimated_delivery_date"),
    )
    if not with_customers:
        return orders
    customers = tables.customers.select(
        "customer_id", "customer_city", "customer_state", "customer_zip_code_prefix"
    )
    return dimension_join(orders, customers, "customer_id", row_key=["order_id"])


def products_with_categories(tables: InputTables) -> DataFrame:
    products = tables.products.select(
        "product_id",
        "product_category_name",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    )
    translation = tables.translation.select("product_category_name", "product_category_name_english")
    joined = dimension_join(products, translation, "product_category_name", row_key=["product_id"])
    return joined.withColumns(
        {
            "product_category_name": F.coalesce("product_category_name", F.lit("unknown")),
            "product_category_name_english": F.coalesce("product_category_name_english", F.lit("unknown")),
            "product_volume_cm3": F.col("product_length_cm")
            * F.col("product_height_cm")
            * F.col("product_width_cm"),
        }
    )


# Columns each arm of the star brings in (directly or through a derived column).
_CUSTOMER_COLUMNS = {"customer_city", "customer_state", "customer_zip_code_prefix", "route_state", "cross_state_flag"}
_ORDER_COLUMNS = _CUSTOMER_COLUMNS | {
    "customer_id",
    "order_status",
    "order_purchase_timestamp",
    "order_estimated_delivery_date",
    "purchase_month",
    "purchase_weekday",
    "estimated_delivery_days",
}
_PRODUCT_COLUMNS = {
    "product_category_name",
    "product_category_name_english",
    "product_weight_g",
    "product_length_cm",
    "product_height_cm",
    "product_width_cm",
    "product_volume_cm3",
}
_SELLER_COLUMNS = {"seller_city", "seller_state", "seller_zip_code_prefix", "route_state", "cross_state_flag"}


def build_exposure(tables: InputTables, columns: Sequence[str] = EXPOSURE_COLUMNS) -> DataFrame:
    """Left star join of the six tables plus the derived columns.

    Keys on the right are unique, so each arm is joined up first (orders with customers,
    products with categories) and the large item table is shuffled once per arm only.  Spark
    cannot know that such a left join keeps every row once, so arms that none of ``columns``
    needs are left out here.
    """
    needed = set(columns)
    key = list(EXPOSURE_KEY)
    items = tables.items.select(*key, "price", "freight_value")
    joined = items
    if needed & _ORDER_COLUMNS:
        orders = orders_with_customers(tables, with_customers=bool(needed & _CUSTOMER_COLUMNS))
        joined = dimension_join(joined, orders, "order_id", key_source=items, row_key=key)
    if needed & _PRODUCT_COLUMNS:
        joined = dimension_join(joined, products_with_categories(tables), "product_id", key_source=items, row_key=key)
    if needed & _SELLER_COLUMNS:
        sellers = tables.sellers.select("seller_id", "seller_city", "seller_state", "seller_zip_code_prefix")
        joined = dimension_join(joined, sellers, "seller_id", key_source=items, row_key=key)

    seller, customer = F.col("seller_state"), F.col("customer_state")
    bought, due = F.col("order_purchase_timestamp"), F.col("order_estimated_delivery_date")
    derived = {
        # an item without a product row has no category either
        "product_category_name": F.coalesce("product_category_name", F.lit("unknown")),
        "product_category_name_english": F.coalesce("product_category_name_english", F.lit("unknown")),
        "freight_to_price_ratio": open_ratio("freight_value", "price"),
        "route_state": F.concat(seller, F.lit("_to_"), customer),
        # a missing side counts as crossing
        "cross_state_flag": F.coalesce(seller != customer, F.lit(True)).cast("int"),
        "purchase_month": F.month(bought),
        "purchase_weekday": F.weekday(bought),
        "estimated_delivery_days": (F.unix_micros(due) - F.unix_micros(bought)) / F.lit(float(_MICROS_PER_DAY)),
    }
    return joined.withColumns({name: expr for name, expr in derived.items() if name in needed}).select(*columns)


def check_contract(tables: InputTables) -> None:
    """Stop if a table on the right of a many-to-one join repeats its key."""
    for name in ("orders", "products", "translation", "customers", "sellers"):
        assert_unique(tables.by_name()[name], INPUT_KEYS[name], name)


def key_audit(tables: InputTables) -> DataFrame:
    """Primary keys of the six tables plus the four-part exposure key."""
    named = {**tables.by_name(), "exposure": tables.items}
    return key_uniqueness(named, {**INPUT_KEYS, "exposure": list(EXPOSURE_KEY)})


def join_match_rates(tables: InputTables) -> DataFrame:
    parts = [
        match_rate(tables.items, tables.orders, "order_id", "items_to_orders"),
        match_rate(tables.items, tables.products, "product_id", "items_to_products"),
        match_rate(tables.items, tables.sellers, "seller_id", "items_to_sellers"),
        match_rate(tables.orders, tables.customers, "customer_id", "orders_to_customers"),
        match_rate(tables.products, tables.translation, "product_category_name", "products_to_translation"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
