import datetime as dt

from conftest import SF_SMALL
from tillroll.plans import catalog
from tillroll.sources import extract as S
from tillroll.sources.fixtures import fixture_sources


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_watermark_filter_reaches_the_scan(spark):
    src = fixture_sources(spark, SF_SMALL, ["orders"])
    plan = _plan(S.extract(src, "orders", dt.datetime(1998, 1, 1)))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan(o_orderdate" in plan


def test_cancelled_filter_pushed_below_join(spark):
    df = catalog.QUERIES["mart_daily_sales"](spark, SF_SMALL)
    optimized = df._jdf.queryExecution().optimizedPlan().toString()
    join_at = optimized.find("Join Inner")
    assert join_at >= 0 and optimized.find("cancelled", join_at) > join_at


def test_scan_reads_only_needed_columns(spark):
    df = catalog.QUERIES["report_category_margin"](spark, SF_SMALL)
    plan = _plan(df)
    assert "l_returnflag" not in plan and "l_tax" not in plan


def test_hot_order_is_reduced_before_its_join(spark):
    """One order holding a third of all items is one row per category and task after the map side."""
    from pyspark.sql import functions as F
    from tillroll.operators.marts import daily_sales
    n = 300000
    items = spark.range(n).select(
        F.col("id").alias("item_id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50000).alias("order_id"),
        (F.col("id") % 100).alias("product_id"), F.lit(1).alias("quantity"),
        F.lit(2.0).alias("unit_price"), F.lit(0.0).alias("discount_pct"), F.lit(2.0).alias("line_total"))
    orders = spark.range(50000).select(
        F.col("id").alias("order_id"), (F.col("id") % 900).alias("customer_id"),
        F.lit("2000-01-01 00:00:00").cast("timestamp_ntz").alias("order_date"),
        F.lit("delivered").alias("status"), F.lit(0.0).alias("discount_pct"))
    products = spark.range(100).select(
        F.col("id").alias("product_id"), F.lit("p").alias("product_name"),
        (F.col("id") % 5).cast("string").alias("category"), F.lit("s").alias("subcategory"),
        F.lit("b").alias("brand"), F.lit(1.0).alias("cost_price"))
    df = daily_sales(items, orders, products)
    rows = df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert sum(r["units_sold"] for r in rows) == n
    # each order falls in one category (id % 5 is constant per order) except the
    # hot order 7, whose extra items span all five categories
    assert sum(r["num_orders"] for r in rows) == 50000 + 4
    # partial and final sums per (order, category) and per (day, category); no distinct aggregate
    assert "partial_sum" in plan and "distinct" not in plan.lower()


def test_product_mart_has_no_single_partition_over_rows(spark):
    df = catalog.QUERIES["mart_product_performance"](spark, SF_SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange SinglePartition") == 1  # the prefix over one row per range
    assert "__total" in plan[plan.find("Exchange SinglePartition") - 400:plan.find("Exchange SinglePartition")]
