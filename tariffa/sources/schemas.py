"""Fixed schemas of the six input tables and the exposure table."""

from __future__ import annotations

# Identifiers are text.  Timestamps are read as text and parsed later, so a bad one becomes missing.
INPUT_SCHEMAS: dict[str, str] = {
    "items": (
        "order_id string, order_item_id int, product_id string, seller_id string, "
        "shipping_limit_date string, price double, freight_value double"
    ),
    "orders": (
        "order_id string, customer_id string, order_status string, "
        "order_purchase_timestamp string, order_approved_at string, "
        "order_delivered_carrier_date string, order_delivered_customer_date string, "
        "order_estimated_delivery_date string"
    ),
    "products": (
        "product_id string, product_category_name string, product_name_lenght int, "
        "product_description_lenght int, product_photos_qty int, product_weight_g double, "
        "product_length_cm double, product_height_cm double, product_width_cm double"
    ),
    "translation": (
        "product_category_name string, product_category_name_english string"
    ),
    "customers": (
        "customer_id string, customer_unique_id string, customer_zip_code_prefix int, "
        "customer_city string, customer_state string"
    ),
    "sellers": (
        "seller_id string, seller_zip_code_prefix int, seller_city string, seller_state string"
    ),
}

EXPOSURE_COLUMNS = [
    "order_id",
    "order_item_id",
    "seller_id",
    "product_id",
    "customer_id",
    "order_status",
    "order_purchase_timestamp",
    "order_estimated_delivery_date",
    "product_category_name",
    "product_category_name_english",
    "price",
    "freight_value",
    "freight_to_price_ratio",
    "product_weight_g",
    "product_length_cm",
    "product_height_cm",
    "product_width_cm",
    "product_volume_cm3",
    "seller_zip_code_prefix",
    "seller_city",
    "seller_state",
    "customer_zip_code_prefix",
    "customer_city",
    "customer_state",
    "route_state",
    "cross_state_flag",
    "purchase_month",
    "purchase_weekday",
    "estimated_delivery_days",
]
