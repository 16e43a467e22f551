import datetime as dt

from tillroll.operators import reports as R

DAILY = ("sale_date date, category string, num_orders long, units_sold long, gross_revenue double, "
         "total_cost double, gross_profit double, margin_pct double, avg_discount_pct double")


def _daily(spark, rows):
    return spark.createDataFrame(rows, DAILY)


def _d(s):
    return dt.date.fromisoformat(s)


def test_recent_window_is_inclusive_of_the_boundary_day(spark):
    df = _daily(spark, [(_d("2001-01-31"), "A", 1, 1, 10.0, 5.0, 5.0, 50.0, 0.0),
                        (_d("2001-01-01"), "A", 1, 1, 20.0, 5.0, 15.0, 75.0, 0.0),   # as_of - 30
                        (_d("2000-12-31"), "A", 1, 1, 40.0, 5.0, 35.0, 87.5, 0.0)])  # as_of - 31
    out = R.category_recent(df, as_of="2001-01-31").first()
    assert out["revenue"] == 30.0 and out["orders"] == 2
    assert R.category_recent(df, as_of="max").first()["revenue"] == 30.0
    assert R.category_recent(df).count() == 0  # default: today, long after these sales


def test_dow_pattern_names_and_sunday_zero(spark):
    df = _daily(spark, [(_d("2024-06-02"), "A", 2, 1, 10.0, 0.0, 10.0, 100.0, 0.0),   # Sunday
                        (_d("2024-06-02"), "B", 3, 1, 30.0, 0.0, 30.0, 100.0, 0.0),
                        (_d("2024-06-08"), "A", 1, 1, 5.0, 0.0, 5.0, 100.0, 0.0)])    # Saturday
    rows = R.dow_pattern(df).collect()
    assert [(r["day_name"], r["dow_num"]) for r in rows] == [("Sun", 0), ("Sat", 6)]
    assert rows[0]["avg_daily_revenue"] == 20.0 and rows[0]["avg_orders"] == 2.5  # per (day, category) row


def test_category_margin_null_revenue_sorts_last(spark):
    df = _daily(spark, [(_d("2001-01-01"), "A", 1, 1, 0.0, 0.0, 0.0, None, 0.0),
                        (_d("2001-01-01"), "B", 1, 1, 10.0, 8.0, 2.0, 20.0, 0.0)])
    rows = R.category_margin(df).collect()
    assert [(r["category"], r["overall_margin_pct"]) for r in rows] == [("B", 20.0), ("A", None)]


def test_monthly_trend_uses_unweighted_mean_margin(spark):
    df = _daily(spark, [(_d("2001-03-01"), "A", 1, 1, 100.0, 90.0, 10.0, 10.0, 0.0),
                        (_d("2001-03-31"), "A", 1, 1, 1.0, 0.5, 0.5, 50.0, 0.0)])
    r = R.monthly_trend(df).first()
    assert str(r["month"]) == "2001-03-01" and r["avg_margin_pct"] == 30.0


def test_top_products_ties_break_by_product_id(spark):
    rows = [(p, f"p{p}", "c", "s", "b", 1, 1, 10.0, 1.0, 0.0, 1, 1) for p in (5, 3, 9)]
    perf = spark.createDataFrame(rows, "product_id long, product_name string, category string, "
                                 "subcategory string, brand string, num_orders long, total_units_sold long, "
                                 "total_revenue double, avg_selling_price double, avg_discount_pct double, "
                                 "unique_customers long, revenue_rank int")
    assert [r["product_name"] for r in R.top_products(perf, k=2).collect()] == ["p3", "p5"]


def test_vip_list_filters_segment_and_casts_dates(spark):
    ts = dt.datetime(2001, 5, 6, 23, 59, 59)
    rows = [(i, f"n{i}", f"e{i}", "gold", "c", "x", dt.date(2000, 1, 1), 3, v, 1.0, ts, ts, 1, seg)
            for i, v, seg in [(1, 6000.0, "VIP"), (2, 9000.0, "VIP"), (3, 100.0, "Low")]]
    ltv = spark.createDataFrame(rows, "customer_id long, full_name string, email string, customer_tier string, "
                                "city string, country string, signup_date date, total_orders long, "
                                "lifetime_value double, avg_order_value double, first_order_date timestamp_ntz, "
                                "last_order_date timestamp_ntz, active_days long, ltv_segment string")
    out = R.vip_customers(ltv).collect()
    assert [r["full_name"] for r in out] == ["n2", "n1"]
    assert out[0]["first_order"] == dt.date(2001, 5, 6)
    assert R.vip_customers(ltv).schema["first_order"].dataType.typeName() == "date"
