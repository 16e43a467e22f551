"""Business reports R1-R9 and O2 over the three marts.

All are small aggregations over mart rows (already one row per day x
category / product / customer), so each is a partial+final hash aggregate.
Top-k reports use ``orderBy(...).limit(k)`` which Spark plans as
TakeOrderedAndProject (per-partition top-k, then a merge of k rows per
partition) -- never a full sort.  Every limit has a key tie-break so the
chosen rows are deterministic.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dow_sunday0, exact_avg, exact_sum, money_sum, month_trunc, pct, rounded
from ..session import materialize


def monthly_trend(daily: DataFrame) -> DataFrame:
    """Revenue, profit, unweighted mean margin, orders, units per month."""
    return (daily.groupBy(month_trunc("sale_date").alias("month"))
                 .agg(money_sum("gross_revenue").alias("total_revenue"),
                      money_sum("gross_profit").alias("total_profit"),
                      rounded(exact_avg("margin_pct")).alias("avg_margin_pct"),
                      F.sum("num_orders").cast("long").alias("total_orders"),
                      F.sum("units_sold").cast("long").alias("units_sold"))
                 .orderBy(F.col("month").desc()))


def category_recent(daily: DataFrame, as_of: _dt.date | str | None = None,
                    days: int = 30) -> DataFrame:
    """R2: per category over ``sale_date >= as_of - days`` (inclusive).

    ``as_of`` defaults to today; ``"max"`` uses the newest sale date in the
    mart.  The mart is then stored once and both the anchor (one value) and
    the report read the stored rows, so the mart is not computed twice.
    """
    if as_of is None:
        anchor = F.current_date()
    elif isinstance(as_of, str) and as_of == "max":
        daily = materialize(daily, "daily_sales")
        newest = daily.agg(F.max("sale_date")).first()[0]
        anchor = F.lit(newest).cast("date")
    else:
        anchor = F.lit(as_of).cast("date")
    return (daily.filter(F.col("sale_date") >= F.date_sub(anchor, days))
                 .groupBy("category")
                 .agg(money_sum("gross_revenue").alias("revenue"),
                      money_sum("gross_profit").alias("profit"),
                      rounded(exact_avg("margin_pct")).alias("avg_margin_pct"),
                      F.sum("num_orders").cast("long").alias("orders"))
                 .orderBy(F.col("revenue").desc_nulls_last(), "category"))


def top_products(perf: DataFrame, k: int = 20) -> DataFrame:
    """The k best products by revenue rank (tie-break product_id)."""
    return (perf.orderBy("revenue_rank", "product_id").limit(k)
                .select("revenue_rank", "product_name", "category", "brand", "total_units_sold",
                        rounded("total_revenue").alias("total_revenue"),
                        rounded("avg_selling_price").alias("avg_price"),
                        rounded("avg_discount_pct").alias("avg_discount_pct"),
                        "unique_customers"))


def ltv_segments(ltv: DataFrame) -> DataFrame:
    """Customer count and value per LTV segment."""
    return (ltv.groupBy("ltv_segment")
               .agg(F.count(F.lit(1)).alias("customer_count"),
                    rounded(exact_avg("lifetime_value")).alias("avg_ltv"),
                    money_sum("lifetime_value").alias("total_ltv"),
                    rounded(F.avg("total_orders")).alias("avg_orders"),
                    rounded(exact_avg("avg_order_value")).alias("avg_order_value"))
               .orderBy(F.col("avg_ltv").desc_nulls_last()))


def tier_performance(ltv: DataFrame) -> DataFrame:
    """Customers, mean LTV and mean orders (1 decimal) per tier."""
    return (ltv.groupBy("customer_tier")
               .agg(F.count(F.lit(1)).alias("customers"),
                    rounded(exact_avg("lifetime_value")).alias("avg_ltv"),
                    rounded(F.avg("total_orders"), 1).alias("avg_orders"))
               .orderBy(F.col("avg_ltv").desc_nulls_last()))


def dow_pattern(daily: DataFrame) -> DataFrame:
    """Mean revenue per (day, category) row and mean orders by weekday."""
    return (daily.groupBy(F.dayname("sale_date").alias("day_name"),
                          dow_sunday0("sale_date").alias("dow_num"))
                 .agg(rounded(exact_avg("gross_revenue")).alias("avg_daily_revenue"),
                      rounded(F.avg("num_orders"), 1).alias("avg_orders"))
                 .orderBy("dow_num"))


def vip_customers(ltv: DataFrame, k: int = 50, segment: str = "VIP") -> DataFrame:
    """Top-k customers of a segment by lifetime value."""
    return (ltv.filter(F.col("ltv_segment") == segment)
               .orderBy(F.col("lifetime_value").desc_nulls_last(), "customer_id").limit(k)
               .select("full_name", "email", "customer_tier", "country", "total_orders",
                       rounded("lifetime_value").alias("lifetime_value"),
                       rounded("avg_order_value").alias("avg_order_value"),
                       F.col("first_order_date").cast("date").alias("first_order"),
                       F.col("last_order_date").cast("date").alias("last_order")))


def category_margin(daily: DataFrame) -> DataFrame:
    """Overall margin per category = sum(profit) / sum(revenue)."""
    return (daily.groupBy("category")
                 .agg(money_sum("gross_revenue").alias("total_revenue"),
                      money_sum("gross_profit").alias("total_profit"),
                      pct(exact_sum("gross_profit"), exact_sum("gross_revenue")).alias("overall_margin_pct"))
                 .orderBy(F.col("overall_margin_pct").desc_nulls_last(), "category"))


def latest_daily(daily: DataFrame, k: int = 20) -> DataFrame:
    """The newest k (day, category) rows."""
    return daily.orderBy(F.col("sale_date").desc(), "category").limit(k)


def customers_by_ltv(ltv: DataFrame) -> DataFrame:
    """O2: customers ordered by lifetime value, highest first."""
    return (ltv.select("customer_id", "full_name", "customer_tier", "lifetime_value", "ltv_segment")
               .orderBy(F.col("lifetime_value").desc_nulls_last(), "customer_id"))
