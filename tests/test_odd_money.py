"""NaN, infinity and very large amounts; values that do not convert."""
import math

import pytest
from pyspark.sql import functions as F

from tillroll.functions import exact_avg, exact_sum, money_sum, rounded
from tillroll.operators import clean as C
from tillroll.operators import marts as M

NAN, INF = float("nan"), float("inf")


def same(a, b):
    return a is b is None or a == b or (a is not None and b is not None and math.isnan(a) and math.isnan(b))


@pytest.mark.parametrize(("values", "total", "mean"), [
    ([1.0, 2.0], 3.0, 1.5), ([NAN, 1.0], NAN, NAN), ([INF, 1.0], INF, INF), ([INF, -INF], NAN, NAN), ([-INF, None], -INF, -INF),
    ([2e12, 2e12, 0.01], 4000000000000.01, 4000000000000.01 / 3), ([None, 4.0], 4.0, 4.0), ([None], None, None)])
def test_sums_and_means_are_those_of_doubles(spark, values, total, mean):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
    r = df.agg(exact_sum("x").alias("s"), money_sum("x").alias("m"), exact_avg("x").alias("a"), F.sum("x").alias("plain")).first()
    assert same(r.s, total) and same(r.m, total) and same(r.a, mean)
    assert same(r.plain, total) or abs(r.plain - total) < 1e-3


def test_rounding_keeps_odd_values(spark):
    df = spark.createDataFrame([(NAN,), (INF,), (-INF,), (2.005,), (None,)], "x double")
    got = [r[0] for r in df.select(rounded("x")).collect()]
    assert all(same(a, b) for a, b in zip(got, [NAN, INF, -INF, 2.01, None], strict=True))


def tables(spark, amount, price=10.0):
    orders = spark.createDataFrame([(1, 1, "2024-01-01", "pending", amount), (2, 1, "2024-01-01", "pending", 5.0), (3, 2, "2024-01-02", "pending", 7.0)],
                                   "order_id long, customer_id long, order_date string, status string, total_amount double")
    orders = orders.withColumns({"order_date": F.to_timestamp_ntz("order_date"), "discount_pct": F.lit(0.0), "updated_at": F.to_timestamp_ntz("order_date")})
    items = spark.createDataFrame([(1, 1, 1, 1, price, amount), (2, 2, 1, 1, price, 5.0), (3, 3, 2, 1, price, 7.0)],
                                  "item_id long, order_id long, product_id long, quantity int, unit_price double, line_total double")
    items = items.withColumns({"discount_pct": F.lit(0.0), "created_at": F.current_timestamp().cast("timestamp_ntz")})
    products = spark.createDataFrame([(1, "p", "A", "s", "b", 2.0, 1.0), (2, "q", "A", "s", "b", 2.0, 1.0)],
                                     "product_id long, product_name string, category string, subcategory string, brand string, unit_price double, cost_price double")
    products = products.withColumns({"is_active": F.lit(True), "updated_at": F.current_timestamp().cast("timestamp_ntz")})
    customers = spark.createDataFrame([(1, "a", "b", "e", "gold"), (2, "a", "b", "e", "gold")],
                                      "customer_id long, first_name string, last_name string, email string, customer_tier string")
    customers = customers.withColumns({"city": F.lit("c"), "country": F.lit("n"), "signup_date": F.lit("2020-01-01").cast("date"),
                                       "created_at": F.current_timestamp().cast("timestamp_ntz"), "updated_at": F.current_timestamp().cast("timestamp_ntz")})
    return {"orders": orders, "order_items": items, "products": products, "customers": customers}


@pytest.mark.parametrize("amount", [NAN, 2e12])
def test_marts_take_odd_and_large_amounts(spark, amount):
    c = C.clean_all(tables(spark, amount))
    both = amount + 5.0
    daily = {str(r.sale_date): r for r in M.daily_sales(c["order_items"], c["orders"], c["products"]).collect()}
    assert same(daily["2024-01-01"].gross_revenue, both) and same(daily["2024-01-01"].gross_profit, both - 2)
    assert daily["2024-01-01"].num_orders == 2 and daily["2024-01-02"].gross_revenue == 7.0
    perf = {r.product_id: r for r in M.product_performance(c["order_items"], c["orders"], c["products"]).collect()}
    assert same(perf[1].total_revenue, both) and perf[1].revenue_rank == 1 and perf[2].total_revenue == 7.0
    ltv = {r.customer_id: r for r in M.customer_ltv(c["orders"], c["customers"]).collect()}
    assert same(ltv[1].lifetime_value, both) and same(ltv[1].avg_order_value, both / 2) and ltv[1].total_orders == 2
    assert ltv[2].lifetime_value == 7.0 and ltv[1].ltv_segment == "VIP"


def test_values_that_do_not_convert_are_null_before_they_are_used(spark):
    t = {k: v.select(*[F.col(c).cast("string").alias(c) for c in v.columns]) for k, v in tables(spark, 3.0).items()}
    t["products"] = t["products"].withColumn("cost_price", F.when(F.col("product_id") == "2", "cheap").otherwise(F.col("cost_price")))
    t["orders"] = t["orders"].withColumn("total_amount", F.when(F.col("order_id") == "3", "much").otherwise(F.col("total_amount")))
    t["order_items"] = t["order_items"].withColumns({
        "unit_price": F.when(F.col("item_id") == "1", "?").otherwise(F.col("unit_price")),
        "quantity": F.when(F.col("item_id") == "2", "two").otherwise(F.col("quantity"))})
    c = C.clean_all(t)
    assert [(r.product_id, r.margin_pct) for r in c["products"].collect()] == [(1, 50.0)]
    assert sorted((r.order_id, r.total_amount, r.order_year) for r in c["orders"].collect()) == [(1, 3.0, 2024), (2, 5.0, 2024)]
    assert sorted((r.item_id, r.unit_price) for r in c["order_items"].collect()) == [(1, None), (3, 10.0)]
    assert c["customers"].count() == 2 and dict(c["customers"].dtypes)["signup_date"] == "date"


def test_registering_tables_elsewhere_is_refused(spark):
    from tillroll.session import scratch_path
    from tillroll.sinks import writers as K
    first, second = scratch_path(spark, "t_reg_a"), scratch_path(spark, "t_reg_b")
    K.register_tables(spark, {"x": spark.range(2)}, "t_reg_db", first)
    assert K.register_tables(spark, {"x": spark.range(3)}, "t_reg_db", first)["x"].count() == 3
    with pytest.raises(K.LocationError):
        K.register_tables(spark, {"x": spark.range(2)}, "t_reg_db", second)
