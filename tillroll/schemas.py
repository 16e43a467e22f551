"""Declared schemas: five sources, watermark state, three marts, check results.

Raw batches are written and read with these schemas, so a nullable integer
column cannot drift to double between batches.  Keys are LONG everywhere so
joins never widen implicitly.
"""

from __future__ import annotations

from pyspark.sql.types import (BooleanType, DateType, DoubleType, IntegerType,
                               LongType, MapType, StringType, StructField,
                               StructType, TimestampNTZType)


def _s(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


S, L, I, D = StringType(), LongType(), IntegerType(), DoubleType()
DT, TS, B = DateType(), TimestampNTZType(), BooleanType()

# The column names and types of sources and marts are the data model that
# users' queries and dashboards rely on.
CUSTOMERS = _s(
    ("customer_id", L), ("first_name", S), ("last_name", S), ("email", S),
    ("phone", S), ("city", S), ("country", S), ("signup_date", DT),
    ("customer_tier", S), ("created_at", TS), ("updated_at", TS),
)

PRODUCTS = _s(
    ("product_id", L), ("product_name", S), ("category", S), ("subcategory", S),
    ("brand", S), ("unit_price", D), ("cost_price", D), ("stock_quantity", I),
    ("is_active", B), ("created_at", TS), ("updated_at", TS),
)

ORDERS = _s(
    ("order_id", L), ("customer_id", L), ("order_date", TS), ("status", S),
    ("payment_method", S), ("shipping_city", S), ("shipping_country", S),
    ("discount_pct", D), ("total_amount", D), ("created_at", TS), ("updated_at", TS),
)

ORDER_ITEMS = _s(
    ("item_id", L), ("order_id", L), ("product_id", L), ("quantity", I),
    ("unit_price", D), ("discount_pct", D), ("line_total", D), ("created_at", TS),
)

CLICKSTREAM = _s(
    ("event_id", L), ("session_id", S), ("customer_id", L), ("product_id", L),
    ("event_type", S), ("page_url", S), ("referrer", S), ("device_type", S),
    ("browser", S), ("event_timestamp", TS), ("created_at", TS),
)

SOURCES = {
    "customers": CUSTOMERS,
    "products": PRODUCTS,
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
    "clickstream": CLICKSTREAM,
}

# Primary key and the timestamp column the incremental extract filters on.
SOURCE_KEYS = {
    "customers": "customer_id",
    "products": "product_id",
    "orders": "order_id",
    "order_items": "item_id",
    "clickstream": "event_id",
}

WATERMARK_STATE = _s(("table_name", S), ("last_extracted", TS))

# Mart contracts (the processing stamp is appended by the writer only).
DAILY_SALES = _s(
    ("sale_date", DT), ("category", S), ("num_orders", L), ("units_sold", L),
    ("gross_revenue", D), ("total_cost", D), ("gross_profit", D),
    ("margin_pct", D), ("avg_discount_pct", D),
)

PRODUCT_PERFORMANCE = _s(
    ("product_id", L), ("product_name", S), ("category", S), ("subcategory", S),
    ("brand", S), ("num_orders", L), ("total_units_sold", L),
    ("total_revenue", D), ("avg_selling_price", D), ("avg_discount_pct", D),
    ("unique_customers", L), ("revenue_rank", I),
)

CUSTOMER_LTV = _s(
    ("customer_id", L), ("full_name", S), ("email", S), ("customer_tier", S),
    ("city", S), ("country", S), ("signup_date", DT), ("total_orders", L),
    ("lifetime_value", D), ("avg_order_value", D), ("first_order_date", TS),
    ("last_order_date", TS), ("active_days", L), ("ltv_segment", S),
)

MARTS = {
    "daily_sales": DAILY_SALES,
    "product_performance": PRODUCT_PERFORMANCE,
    "customer_ltv": CUSTOMER_LTV,
}

# One row per data-quality check result.
CHECK_RESULT = _s(
    ("name", S), ("table_name", S), ("column_name", S), ("check_type", S), ("passed", B),
    ("severity", S), ("message", S), ("metric", L), ("details", MapType(S, S)),
)


def with_stamp(schema: StructType) -> StructType:
    """The mart schema as stored: contract columns plus ``_processed_at``."""
    from pyspark.sql.types import TimestampType
    return StructType(schema.fields + [StructField("_processed_at", TimestampType(), True)])
