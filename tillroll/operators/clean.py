"""Cleaning pipelines C1-C7: raw source frame -> clean frame.

Step order is part of the semantics: dedupe runs first, filters after, so a
newest version that fails a filter removes the key entirely.  Casts come between
the two: a value that does not convert is NULL before anything uses it.  ``profile=
"lite"`` gives the notebook variants (fewer filters, no casts).
``deduped=True`` skips step 1 for input that is already one newest row per
key (the incrementally maintained latest tables).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import date_parts, full_name, margin_pct, standardise_domain
from .dedupe import dedupe_latest

# Fixed value domains of the source schema.
TIERS = ("standard", "silver", "gold")
ORDER_STATUSES = ("pending", "processing", "shipped", "delivered", "cancelled")
LTV_SEGMENTS = ("VIP", "High", "Medium", "Low")


def _latest(raw: DataFrame, key: str, ts: str, deduped: bool) -> DataFrame:
    return raw if deduped else dedupe_latest(raw, key, ts)


def _cast(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Casts that give NULL where a value does not convert; they come before any use of the columns."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def clean_customers(raw: DataFrame, profile: str = "full", deduped: bool = False) -> DataFrame:
    df = _latest(raw, "customer_id", "updated_at", deduped)
    if profile != "lite":
        df = _cast(df, {"customer_id": "long", "signup_date": "date", "created_at": "timestamp_ntz"})
        df = df.filter(F.col("first_name").isNotNull())
    return df.filter(F.col("email").isNotNull()).withColumns({
        "customer_tier": standardise_domain("customer_tier", TIERS, "standard"),
        "full_name": full_name("first_name", "last_name"),
    })


def clean_products(raw: DataFrame, profile: str = "full", deduped: bool = False) -> DataFrame:
    df = _latest(raw, "product_id", "updated_at", deduped)
    if profile == "lite":
        df = df.filter(F.col("unit_price") > 0)
    else:
        df = _cast(df, {"product_id": "long", "unit_price": "double", "cost_price": "double", "is_active": "boolean"})
        df = df.filter(F.col("product_name").isNotNull() & (F.col("unit_price") > 0) & (F.col("cost_price") > 0))
    return df.withColumns({"margin_pct": margin_pct("unit_price", "cost_price")})


def clean_orders(raw: DataFrame, profile: str = "full", deduped: bool = False) -> DataFrame:
    df = _cast(_latest(raw, "order_id", "updated_at", deduped), {"order_date": "timestamp_ntz"})
    if profile == "lite":
        return df.filter(F.col("total_amount") >= 0).withColumns(date_parts("order_date", "order", with_day=False))
    df = _cast(df, {"order_id": "long", "customer_id": "long", "discount_pct": "double", "total_amount": "double"})
    df = df.filter(F.col("order_id").isNotNull() & F.col("customer_id").isNotNull() & (F.col("total_amount") >= 0))
    return df.withColumns({"status": standardise_domain("status", ORDER_STATUSES, "unknown"), **date_parts("order_date", "order")})


def clean_order_items(raw: DataFrame, deduped: bool = False) -> DataFrame:
    df = _cast(_latest(raw, "item_id", "created_at", deduped),
               {"item_id": "long", "order_id": "long", "product_id": "long", "quantity": "int",
                "unit_price": "double", "discount_pct": "double", "line_total": "double"})
    return df.filter((F.col("quantity") > 0) & (F.col("line_total") >= 0))


def clean_all(raw: dict[str, DataFrame], deduped: bool = False) -> dict[str, DataFrame]:
    return {
        "customers": clean_customers(raw["customers"], deduped=deduped),
        "products": clean_products(raw["products"], deduped=deduped),
        "orders": clean_orders(raw["orders"], deduped=deduped),
        "order_items": clean_order_items(raw["order_items"], deduped=deduped),
    }
