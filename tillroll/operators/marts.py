"""Joins and marts (J1, J2, M1-M6) and the amount reconciliations.

Every mart aggregates before anything wide happens: the cancelled filter
is pushed into the orders scan, the items->orders join shuffles on
``order_id`` (both sides partial to their needed columns), products join on
``product_id`` and AQE broadcasts whichever side is measured small at run
time.  Distinct counts are planned by Spark as a two-level aggregate whose
first shuffle is keyed on (group, distinct value), so a hot group never
lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (exact, exact_avg, exact_parts, exact_sum, money_sum, odd, parts_rounded, parts_value,
                         pct, rounded, sum_parts)
from .rank import global_rank

# Fixed LTV segment thresholds (first match wins, on the rounded value).
LTV_THRESHOLDS = (("VIP", 5000), ("High", 1000), ("Medium", 200))
LTV_DEFAULT = "Low"


def ltv_segment(value, thresholds=LTV_THRESHOLDS, default: str = LTV_DEFAULT):
    v = F.col(value) if isinstance(value, str) else value
    expr = None
    for name, floor in thresholds:
        expr = F.when(v >= floor, name) if expr is None else expr.when(v >= floor, name)
    return expr.otherwise(default)


def _items(items: DataFrame) -> DataFrame:
    return items.select("item_id", "order_id", "product_id", "quantity", "unit_price",
                        F.col("discount_pct").alias("item_discount_pct"), "line_total")


def _orders(orders: DataFrame) -> DataFrame:
    return orders.select("order_id", "customer_id", "order_date", "status",
                         F.col("discount_pct").alias("order_discount_pct"))


PRODUCT_ATTRS = ["product_id", "product_name", "category", "subcategory", "brand"]


def enriched_items(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Items joined to their product and order (inner, USING-style).

    Products are joined first and orders last, so the result is hash
    partitioned by ``order_id`` -- which already satisfies the first level of
    every per-order aggregate downstream (no extra item-level shuffle).
    """
    p = products.select(*PRODUCT_ATTRS, "cost_price")
    return _items(items).join(p, "product_id").join(_orders(orders), "order_id")


def not_cancelled(df: DataFrame) -> DataFrame:
    return df.filter(F.col("status") != "cancelled")


def daily_sales(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """M1 / M4: revenue, cost and profit per (day, category).

    An order has one date, so items are reduced to one row per (order, category)
    before orders are joined: that join and the final aggregate see reduced rows,
    distinct orders become a plain count and the mean a weighted one.
    """
    lines = _items(items).join(products.select("product_id", "category", "cost_price"), "product_id")
    per_order = lines.groupBy("order_id", "category").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("quantity").alias("units"),
        exact_parts("line_total").alias("revenue"),
        exact_parts(F.col("quantity") * F.col("cost_price")).alias("cost"))
    dated = not_cancelled(_orders(orders)).select(
        "order_id", F.to_date("order_date").alias("sale_date"), "order_discount_pct")
    discounted = F.when(F.col("order_discount_pct").isNotNull(), F.col("lines"))
    agg = (per_order.join(dated, "order_id").groupBy("sale_date", "category")
           .agg(F.count(F.lit(1)).alias("num_orders"),
                F.sum("units").cast("long").alias("units_sold"),
                parts_rounded(sum_parts("revenue")).alias("gross_revenue"),
                parts_rounded(sum_parts("cost")).alias("total_cost"),
                rounded(F.try_divide(F.coalesce(
                    F.sum(odd("order_discount_pct")),
                    F.sum(exact("order_discount_pct") * F.col("lines").cast("decimal(18,0)")).cast("double")),
                    F.sum(discounted))).alias("avg_discount_pct")))
    profit = rounded(F.col("gross_revenue") - F.col("total_cost"))
    return (agg.withColumn("gross_profit", profit)
               .withColumn("margin_pct", pct("gross_profit", "gross_revenue"))
               .select("sale_date", "category", "num_orders", "units_sold", "gross_revenue",
                       "total_cost", "gross_profit", "margin_pct", "avg_discount_pct"))


def product_totals(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """M2 without the rank: per-product totals.

    Items are joined to orders (drop cancelled) and reduced to one row per
    (product, order) -- an order has one customer -- before anything else,
    so both distinct counts come from plain sums plus one distinct over
    customers.  Product attributes are joined to the per-product totals, a
    join over #products rows rather than #items rows; the inner join keeps
    the semantics of joining products first (unknown products vanish).
    """
    io = _items(items).join(not_cancelled(_orders(orders)), "order_id")
    per_order = (io.groupBy("product_id", "order_id", "customer_id")
                   .agg(F.sum("quantity").alias("q"), exact_parts("line_total").alias("rev"),
                        exact_parts("unit_price").alias("price_sum"), F.count("unit_price").alias("price_n"),
                        exact_parts("item_discount_pct").alias("disc_sum"),
                        F.count("item_discount_pct").alias("disc_n")))

    def mean(total: str, n: str):
        return F.try_divide(parts_value(sum_parts(total)), F.sum(n))

    per_product = (per_order.groupBy("product_id")
                   .agg(F.count(F.lit(1)).alias("num_orders"),
                        F.sum("q").cast("long").alias("total_units_sold"),
                        parts_rounded(sum_parts("rev")).alias("total_revenue"),
                        rounded(mean("price_sum", "price_n")).alias("avg_selling_price"),
                        rounded(mean("disc_sum", "disc_n")).alias("avg_discount_pct"),
                        F.count_distinct("customer_id").alias("unique_customers")))
    return per_product.join(products.select(*PRODUCT_ATTRS), "product_id").select(
        *PRODUCT_ATTRS, "num_orders", "total_units_sold", "total_revenue", "avg_selling_price",
        "avg_discount_pct", "unique_customers")


def product_performance(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """M2: per-product totals plus a global revenue rank (ties share, gaps)."""
    return global_rank(product_totals(items, orders, products), "total_revenue", "revenue_rank", rank_type="int")


def customer_ltv(orders: DataFrame, customers: DataFrame, profile: str = "full") -> DataFrame:
    """M3 / M5: aggregate orders per customer first, then join customers."""
    aggs = [F.count("order_id").alias("total_orders"),
            money_sum("total_amount").alias("lifetime_value"),
            rounded(exact_avg("total_amount")).alias("avg_order_value"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date")]
    if profile != "lite":
        aggs.append(F.count_distinct(F.to_date("order_date")).alias("active_days"))
    per_customer = not_cancelled(orders).groupBy("customer_id").agg(*aggs)
    joined = per_customer.join(customers, "customer_id")
    if profile == "lite":
        return joined.withColumn("ltv_segment", ltv_segment("lifetime_value"))
    return joined.select(
        "customer_id", "full_name", "email", "customer_tier", "city", "country", "signup_date",
        "total_orders", "lifetime_value", "avg_order_value", "first_order_date",
        "last_order_date", "active_days", ltv_segment("lifetime_value").alias("ltv_segment"))


def monthly_summary(daily: DataFrame) -> DataFrame:
    """M6: month of the daily mart -> revenue and orders."""
    return (daily.groupBy(F.trunc("sale_date", "month").alias("month"))
                 .agg(money_sum("gross_revenue").alias("monthly_revenue"),
                      F.sum("num_orders").cast("long").alias("monthly_orders")))


def reconcile_line_total(items: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """line_total vs round(qty * unit_price * (1 - disc/100), 2)."""
    expected = rounded(F.col("quantity") * F.col("unit_price") * (1 - F.col("discount_pct") / 100))
    return (items.select("item_id", "order_id", "line_total", expected.alias("expected_line_total"))
                 .withColumn("diff", rounded(F.col("line_total") - F.col("expected_line_total")))
                 .withColumn("mismatch", F.abs("diff") > F.lit(tolerance)))


def reconcile_order_total(items: DataFrame, orders: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """total_amount vs round(sum(line_total) * (1 - order disc/100), 2).

    An order without items is compared with 0.
    """
    per_order = items.groupBy("order_id").agg(exact_sum("line_total").alias("__sum"))
    expected = rounded(F.col("__lines") * (1 - F.col("discount_pct") / 100))
    return (orders.select("order_id", "total_amount", "discount_pct").join(per_order, "order_id", "left")
                  .withColumn("__lines", F.coalesce("__sum", F.lit(0.0)))
                  .select("order_id", "total_amount",
                          rounded("__lines").alias("items_total"),
                          expected.alias("expected_total"))
                  .withColumn("diff", rounded(F.col("total_amount") - F.col("expected_total")))
                  .withColumn("mismatch", F.abs("diff") > F.lit(tolerance)))


def affected_sale_dates(before: dict[str, DataFrame], after: dict[str, DataFrame],
                        changed: dict[str, DataFrame]) -> DataFrame:
    """Sale dates whose daily-sales rows can differ between two states.

    ``before`` / ``after``: clean ``orders``, ``order_items``, ``products``;
    ``changed``: frames of changed keys (``order_id`` / ``item_id`` /
    ``product_id``).  A date is affected when an order on it (old or new
    version) changed, when a changed item belongs (before or after) to an
    order on it, or when an order on it has an item of a changed product.
    Every step joins against the small change sets, never full table to
    full table.
    """
    def dates(orders: DataFrame, order_ids: DataFrame) -> DataFrame:
        return (orders.join(order_ids, "order_id", "left_semi")
                      .select(F.to_date("order_date").alias("sale_date")))

    def orders_of(items: DataFrame, keys: DataFrame, key: str) -> DataFrame:
        return items.join(keys, key, "left_semi").select("order_id")

    ch_orders = changed["orders"].select("order_id")
    ch_items = changed["order_items"].select("item_id")
    ch_products = changed["products"].select("product_id")
    parts = []
    for state in (before, after):
        touched = (ch_orders
                   .unionByName(orders_of(state["order_items"], ch_items, "item_id"))
                   .unionByName(orders_of(state["order_items"], ch_products, "product_id")))
        parts.append(dates(state["orders"], touched))
    return parts[0].unionByName(parts[1]).distinct()


def refresh_daily_sales(previous: DataFrame, before: dict[str, DataFrame],
                        after: dict[str, DataFrame], changed: dict[str, DataFrame]) -> DataFrame:
    """M1 maintained incrementally: rows of unaffected dates are kept, rows of
    affected dates are recomputed from the current state.  Equal to
    rebuilding the whole mart from ``after``.  Only orders on affected dates
    (and their items) are joined and aggregated.  Orders without a date are a
    date like any other, so dates are compared NULL-safely.
    """
    affected = affected_sale_dates(before, after, changed).withColumnRenamed("sale_date", "__date")
    orders_on = after["orders"].join(
        affected, F.to_date(after["orders"]["order_date"]).eqNullSafe(affected["__date"]), "left_semi")
    recomputed = daily_sales(after["order_items"], orders_on, after["products"])
    kept = previous.join(affected, previous["sale_date"].eqNullSafe(affected["__date"]), "left_anti")
    return kept.unionByName(recomputed)


def affected_products(before: dict[str, DataFrame], after: dict[str, DataFrame], changed: dict[str, DataFrame]) -> DataFrame:
    """Products whose totals can differ: those that changed, and those of changed items and of items of
    changed orders, in the old or the new state."""
    touched = changed["products"].select("product_id")
    for state in (before, after):
        for key, of in (("order_id", "orders"), ("item_id", "order_items")):
            touched = touched.unionByName(state["order_items"].join(changed[of].select(key), key, "left_semi").select("product_id"))
    return touched.filter("product_id IS NOT NULL").distinct()


def affected_customers(before: dict[str, DataFrame], after: dict[str, DataFrame], changed: dict[str, DataFrame]) -> DataFrame:
    """Customers that changed or whose orders did, in the old or the new state."""
    touched = changed["customers"].select("customer_id")
    for state in (before, after):
        touched = touched.unionByName(
            state["orders"].join(changed["orders"].select("order_id"), "order_id", "left_semi").select("customer_id"))
    return touched.filter("customer_id IS NOT NULL").distinct()


def refresh_product_performance(previous: DataFrame, before: dict[str, DataFrame],
                                after: dict[str, DataFrame], changed: dict[str, DataFrame]) -> DataFrame:
    """M2 maintained incrementally: totals of the products touched by changed orders,
    items or products are recomputed, the others kept; ranks are assigned anew.
    Equal to rebuilding the whole mart from ``after``.
    """
    touched = affected_products(before, after, changed)
    recomputed = product_totals(after["order_items"].join(touched, "product_id", "left_semi"), after["orders"],
                                after["products"].join(touched, "product_id", "left_semi"))
    kept = previous.drop("revenue_rank").join(touched, "product_id", "left_anti")
    return global_rank(kept.unionByName(recomputed), "total_revenue", "revenue_rank", rank_type="int")


def refresh_customer_ltv(previous: DataFrame, before: dict[str, DataFrame],
                         after: dict[str, DataFrame], changed: dict[str, DataFrame]) -> DataFrame:
    """M3 maintained incrementally: rows of the customers that changed or whose orders
    did, in the old or the new state, are recomputed.  Equal to a full rebuild.
    """
    touched = affected_customers(before, after, changed)
    recomputed = customer_ltv(after["orders"].join(touched, "customer_id", "left_semi"),
                              after["customers"].join(touched, "customer_id", "left_semi"))
    return previous.join(touched, "customer_id", "left_anti").unionByName(recomputed)
