"""DuckDB twins of the registered queries (independent SQL, not generated
from the Spark plans).

Only the driver's base tables are registered in DuckDB, so every statement
carries the views it needs as a ``WITH`` prefix.  ``sql_for(body)`` pulls in
exactly the CTEs the body references (transitively), in definition order.
"""

from __future__ import annotations

import re

from .. import schemas


def mr(x: str, scale: int = 2) -> str:
    """Money rounding, same rule as ``tillroll.functions.money_round``."""
    return f"CAST(round(CAST(({x}) AS DECIMAL(38,6)), {scale}) AS DOUBLE)"


def xsum(x: str) -> str:
    """Sum of values fixed to six decimals: independent of the order of rows."""
    return f"sum(CAST({x} AS DECIMAL(18,6)))"


def xavg(x: str) -> str:
    return f"CAST({xsum(x)} AS DOUBLE) / NULLIF(count({x}), 0)"


def _cols(schema) -> list[str]:
    return [f.name for f in schema.fields]


def dedupe_sql(src: str, key: str, order_col: str, columns: list[str]) -> str:
    """Newest row per key; ties broken by every other column, all DESC NULLS LAST."""
    rest = [c for c in columns if c not in (key, order_col)]
    order = ", ".join(f"{c} DESC NULLS LAST" for c in [order_col, *rest])
    cols = ", ".join(columns)
    return (f"SELECT {cols} FROM (SELECT {cols}, row_number() OVER "
            f"(PARTITION BY {key} ORDER BY {order}) AS rn__ FROM {src}) d WHERE rn__ = 1")


CUST_COLS = _cols(schemas.CUSTOMERS)
PROD_COLS = _cols(schemas.PRODUCTS)
ORD_COLS = _cols(schemas.ORDERS)
ITEM_COLS = _cols(schemas.ORDER_ITEMS)

CTES: dict[str, str] = {}

# ---- adapter (FIXTURES.md section D, DuckDB spelling) -----------------------
CTES["src_customers"] = """
SELECT customer_id, first_name, last_name, email, phone, city, country, signup_date, customer_tier,
       CAST(signup_date AS TIMESTAMP) AS created_at,
       CAST(signup_date + ver AS TIMESTAMP) AS updated_at
FROM (
  SELECT c_custkey AS customer_id,
         split_part(c_name, '#', 1) AS first_name,
         split_part(c_name, '#', 2) AS last_name,
         CASE WHEN c_custkey % 50 = 49 THEN NULL
              ELSE concat(lower(replace(c_name, '#', '.')), '@example.com') END AS email,
         CAST(NULL AS VARCHAR) AS phone,
         n_name AS city, r_name AS country,
         DATE '1994-01-01' + CAST(c_custkey % 365 AS INT) AS signup_date,
         CASE WHEN ver = 1 THEN 'gold' WHEN c_mktsegment = 'MACHINERY' THEN 'silver'
              WHEN c_mktsegment = 'BUILDING' THEN 'standard' ELSE lower(c_mktsegment) END AS customer_tier,
         ver
  FROM customer
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN (SELECT 0 AS ver UNION ALL SELECT 1 AS ver) v ON ver = 0 OR c_custkey % 10 = 0
) t"""

CTES["src_products"] = """
SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
       CASE WHEN p_size <= 15 THEN 'small' WHEN p_size <= 35 THEN 'medium' ELSE 'large' END AS subcategory,
       p_brand AS brand,
       CASE WHEN p_partkey % 100 = 99 THEN CAST(0 AS DOUBLE) ELSE p_retailprice END AS unit_price,
       CAST(round(CAST(p_retailprice * 0.6 AS DECIMAL(18,6)), 2) AS DOUBLE) AS cost_price,
       p_size AS stock_quantity, p_partkey % 20 <> 0 AS is_active,
       CAST(DATE '1994-01-01' AS TIMESTAMP) AS created_at,
       CAST(DATE '1994-01-01' + CAST(p_partkey % 365 AS INT) AS TIMESTAMP) AS updated_at
FROM part"""

CTES["src_orders"] = """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_date,
       CASE WHEN o_orderkey % 97 = 0 THEN 'returned'
            WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'cancelled'
            WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 'pending'
            WHEN o_orderstatus = 'F' THEN 'delivered'
            WHEN o_orderstatus = 'O' THEN 'processing' ELSE 'shipped' END AS status,
       CASE o_orderkey % 3 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'paypal' ELSE 'upi' END AS payment_method,
       CAST(NULL AS VARCHAR) AS shipping_city, CAST(NULL AS VARCHAR) AS shipping_country,
       CAST((o_orderkey % 5) * 5 AS DOUBLE) AS discount_pct,
       CASE WHEN o_orderkey % 101 = 0 THEN CAST(-1 AS DOUBLE)
            ELSE CAST(round(CAST(o_totalprice / 1000 AS DECIMAL(18,6)), 2) AS DOUBLE) END AS total_amount,
       o_orderdate AS created_at, o_orderdate AS updated_at
FROM orders"""

CTES["src_order_items"] = """
SELECT l_orderkey * 10 + l_linenumber AS item_id, l_orderkey AS order_id, l_partkey AS product_id,
       CAST(l_quantity AS INT) AS quantity,
       CAST(round(CAST(l_extendedprice / l_quantity AS DECIMAL(18,6)), 2) AS DOUBLE) AS unit_price,
       CAST(round(CAST(l_discount * 100 AS DECIMAL(18,6)), 2) AS DOUBLE) AS discount_pct,
       CAST(round(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,6)), 2) AS DOUBLE) AS line_total,
       l_shipdate AS created_at
FROM lineitem"""

CTES["src_clickstream"] = """
SELECT event_id, concat(CAST(user_id AS VARCHAR), '-', CAST(CAST(ts AS DATE) AS VARCHAR)) AS session_id,
       CASE WHEN event_id % 3 = 0 THEN NULL ELSE user_id END AS customer_id,
       CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_id % 100 END AS product_id,
       CASE event_type WHEN 'click' THEN 'add_to_cart' WHEN 'error' THEN 'remove_from_cart'
                       WHEN 'purchase' THEN 'purchase' ELSE 'page_view' END AS event_type,
       concat('/product/', CAST(event_id % 100 AS VARCHAR)) AS page_url,
       'direct' AS referrer,
       CASE event_id % 3 WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' ELSE 'tablet' END AS device_type,
       'Chrome' AS browser, ts AS event_timestamp, ts AS created_at
FROM events"""

# ---- cleaning ---------------------------------------------------------------
CTES["dd_customers"] = dedupe_sql("src_customers", "customer_id", "updated_at", CUST_COLS)
CTES["dd_products"] = dedupe_sql("src_products", "product_id", "updated_at", PROD_COLS)
CTES["dd_orders"] = dedupe_sql("src_orders", "order_id", "updated_at", ORD_COLS)
CTES["dd_order_items"] = dedupe_sql("src_order_items", "item_id", "created_at", ITEM_COLS)

TIER_SQL = ("CASE WHEN customer_tier IN ('standard', 'silver', 'gold') "
            "THEN customer_tier ELSE 'standard' END")
STATUS_SQL = ("CASE WHEN status IN ('pending', 'processing', 'shipped', 'delivered', 'cancelled') "
              "THEN status ELSE 'unknown' END")
MARGIN_SQL = mr("(unit_price - cost_price) / NULLIF(unit_price, 0) * 100")

CTES["clean_customers"] = f"""
SELECT customer_id, first_name, last_name, email, phone, city, country, signup_date,
       {TIER_SQL} AS customer_tier, created_at, updated_at,
       concat_ws(' ', first_name, last_name) AS full_name
FROM dd_customers WHERE email IS NOT NULL AND first_name IS NOT NULL"""

CTES["clean_products"] = f"""
SELECT product_id, product_name, category, subcategory, brand, unit_price, cost_price,
       stock_quantity, is_active, created_at, updated_at, {MARGIN_SQL} AS margin_pct
FROM dd_products WHERE product_name IS NOT NULL AND unit_price > 0 AND cost_price > 0"""

CTES["clean_orders"] = f"""
SELECT order_id, customer_id, order_date, {STATUS_SQL} AS status, payment_method, shipping_city,
       shipping_country, discount_pct, total_amount, created_at, updated_at,
       CAST(year(order_date) AS INTEGER) AS order_year,
       CAST(month(order_date) AS INTEGER) AS order_month,
       CAST(day(order_date) AS INTEGER) AS order_day,
       CAST(dayofweek(order_date) + 1 AS INTEGER) AS order_dow
FROM dd_orders
WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND total_amount >= 0"""

CTES["clean_order_items"] = """
SELECT item_id, order_id, product_id, quantity, unit_price, discount_pct, line_total, created_at
FROM dd_order_items WHERE quantity > 0 AND line_total >= 0"""

CTES["lite_customers"] = f"""
SELECT customer_id, first_name, last_name, email, phone, city, country, signup_date,
       {TIER_SQL} AS customer_tier, created_at, updated_at,
       concat_ws(' ', first_name, last_name) AS full_name
FROM dd_customers WHERE email IS NOT NULL"""

CTES["lite_products"] = f"""
SELECT {', '.join(PROD_COLS)}, {MARGIN_SQL} AS margin_pct
FROM dd_products WHERE unit_price > 0"""

CTES["lite_orders"] = f"""
SELECT {', '.join(ORD_COLS)},
       CAST(year(order_date) AS INTEGER) AS order_year,
       CAST(month(order_date) AS INTEGER) AS order_month,
       CAST(dayofweek(order_date) + 1 AS INTEGER) AS order_dow
FROM dd_orders WHERE total_amount >= 0"""

# ---- joins and marts --------------------------------------------------------
ENRICHED_SELECT = """
SELECT i.item_id, i.order_id, i.product_id, i.quantity, i.unit_price,
       i.discount_pct AS item_discount_pct, i.line_total,
       o.customer_id, o.order_date, o.status, o.discount_pct AS order_discount_pct,
       p.product_name, p.category, p.subcategory, p.brand, p.cost_price
FROM {items} i JOIN {orders} o ON i.order_id = o.order_id
JOIN {products} p ON i.product_id = p.product_id"""

CTES["enriched"] = ENRICHED_SELECT.format(items="clean_order_items", orders="clean_orders",
                                          products="clean_products")
CTES["enriched_lite"] = ENRICHED_SELECT.format(items="src_order_items", orders="lite_orders",
                                               products="lite_products")

DAILY_BODY = f"""
SELECT sale_date, category, num_orders, units_sold, gross_revenue, total_cost,
       {mr('gross_revenue - total_cost')} AS gross_profit,
       {mr(f"{mr('gross_revenue - total_cost')} / NULLIF(gross_revenue, 0) * 100")} AS margin_pct,
       avg_discount_pct
FROM (
  SELECT CAST(order_date AS DATE) AS sale_date, category,
         CAST(count(DISTINCT order_id) AS BIGINT) AS num_orders,
         CAST(sum(quantity) AS BIGINT) AS units_sold,
         {mr(xsum('line_total'))} AS gross_revenue,
         {mr(xsum('quantity * cost_price'))} AS total_cost,
         {mr(xavg('order_discount_pct'))} AS avg_discount_pct
  FROM {{src}} WHERE status <> 'cancelled'
  GROUP BY CAST(order_date AS DATE), category
) a"""

CTES["daily_sales"] = DAILY_BODY.format(src="enriched")
CTES["daily_sales_lite"] = DAILY_BODY.format(src="enriched_lite")

CTES["product_perf"] = f"""
SELECT product_id, product_name, category, subcategory, brand, num_orders, total_units_sold,
       total_revenue, avg_selling_price, avg_discount_pct, unique_customers,
       CAST(rank() OVER (ORDER BY total_revenue DESC NULLS LAST) AS INTEGER) AS revenue_rank
FROM (
  SELECT product_id, product_name, category, subcategory, brand,
         CAST(count(DISTINCT order_id) AS BIGINT) AS num_orders,
         CAST(sum(quantity) AS BIGINT) AS total_units_sold,
         {mr(xsum('line_total'))} AS total_revenue,
         {mr(xavg('unit_price'))} AS avg_selling_price,
         {mr(xavg('item_discount_pct'))} AS avg_discount_pct,
         CAST(count(DISTINCT customer_id) AS BIGINT) AS unique_customers
  FROM enriched WHERE status <> 'cancelled'
  GROUP BY product_id, product_name, category, subcategory, brand
) a"""

LTV_SEGMENT_SQL = ("CASE WHEN lifetime_value >= 5000 THEN 'VIP' WHEN lifetime_value >= 1000 THEN 'High' "
                   "WHEN lifetime_value >= 200 THEN 'Medium' ELSE 'Low' END")

CTES["customer_ltv"] = f"""
SELECT a.customer_id, c.full_name, c.email, c.customer_tier, c.city, c.country, c.signup_date,
       a.total_orders, a.lifetime_value, a.avg_order_value, a.first_order_date, a.last_order_date,
       a.active_days, {LTV_SEGMENT_SQL} AS ltv_segment
FROM (
  SELECT customer_id, CAST(count(order_id) AS BIGINT) AS total_orders,
         {mr(xsum('total_amount'))} AS lifetime_value,
         {mr(xavg('total_amount'))} AS avg_order_value,
         min(order_date) AS first_order_date, max(order_date) AS last_order_date,
         CAST(count(DISTINCT CAST(order_date AS DATE)) AS BIGINT) AS active_days
  FROM clean_orders WHERE status <> 'cancelled' GROUP BY customer_id
) a JOIN clean_customers c ON a.customer_id = c.customer_id"""

CTES["customer_ltv_lite"] = f"""
SELECT a.customer_id, a.total_orders, a.lifetime_value, a.avg_order_value, a.first_order_date,
       a.last_order_date, c.first_name, c.last_name, c.email, c.phone, c.city, c.country,
       c.signup_date, c.customer_tier, c.created_at, c.updated_at, c.full_name,
       {LTV_SEGMENT_SQL} AS ltv_segment
FROM (
  SELECT customer_id, CAST(count(order_id) AS BIGINT) AS total_orders,
         {mr(xsum('total_amount'))} AS lifetime_value,
         {mr(xavg('total_amount'))} AS avg_order_value,
         min(order_date) AS first_order_date, max(order_date) AS last_order_date
  FROM lite_orders WHERE status <> 'cancelled' GROUP BY customer_id
) a JOIN lite_customers c ON a.customer_id = c.customer_id"""


def _deps(sql: str) -> list[str]:
    words = set(re.findall(r"[A-Za-z_][A-Za-z0-9_]*", sql))
    return [n for n in CTES if n in words]


def sql_for(body: str) -> str:
    """Prefix ``body`` with the CTEs it needs, dependencies first."""
    needed: set[str] = set()
    stack = _deps(body)
    while stack:
        name = stack.pop()
        if name in needed:
            continue
        needed.add(name)
        stack.extend(d for d in _deps(CTES[name]) if d != name)
    ordered = [n for n in CTES if n in needed]
    if not ordered:
        return body.strip()
    prefix = ",\n".join(f"{n} AS ({CTES[n].strip()})" for n in ordered)
    return f"WITH {prefix}\n{body.strip()}"


ORACLE: dict[str, str] = {}


def register(key: str, body: str) -> None:
    ORACLE[key] = sql_for(body)


# ---- registrations: cleaning and marts ---------------------------------------
register("clean_customers", "SELECT * FROM clean_customers")
register("clean_products", "SELECT * FROM clean_products")
register("clean_orders", "SELECT * FROM clean_orders")
register("clean_order_items", "SELECT * FROM clean_order_items")
register("clean_customers_lite", "SELECT * FROM lite_customers")
register("clean_products_lite", "SELECT * FROM lite_products")
register("clean_orders_lite", "SELECT * FROM lite_orders")
register("enriched_items", "SELECT * FROM enriched")
register("mart_daily_sales", "SELECT * FROM daily_sales")
register("mart_product_performance", "SELECT * FROM product_perf")
register("mart_customer_ltv", "SELECT * FROM customer_ltv")
register("mart_daily_sales_lite", "SELECT * FROM daily_sales_lite")
register("mart_customer_ltv_lite", "SELECT * FROM customer_ltv_lite")


# ---- registrations: reports, summaries, reconciliation, rank -----------------
register("monthly_summary", f"""
SELECT CAST(date_trunc('month', sale_date) AS DATE) AS month,
       {mr(xsum('gross_revenue'))} AS monthly_revenue,
       CAST(sum(num_orders) AS BIGINT) AS monthly_orders
FROM daily_sales_lite GROUP BY 1""")

register("report_monthly_trend", f"""
SELECT CAST(date_trunc('month', sale_date) AS DATE) AS month,
       {mr(xsum('gross_revenue'))} AS total_revenue, {mr(xsum('gross_profit'))} AS total_profit,
       {mr(xavg('margin_pct'))} AS avg_margin_pct,
       CAST(sum(num_orders) AS BIGINT) AS total_orders, CAST(sum(units_sold) AS BIGINT) AS units_sold
FROM daily_sales GROUP BY 1""")

register("report_category_30d", f"""
SELECT category, {mr(xsum('gross_revenue'))} AS revenue, {mr(xsum('gross_profit'))} AS profit,
       {mr(xavg('margin_pct'))} AS avg_margin_pct, CAST(sum(num_orders) AS BIGINT) AS orders
FROM daily_sales
WHERE sale_date >= (SELECT max(sale_date) FROM daily_sales) - INTERVAL 30 DAY
GROUP BY category""")

register("report_top_products", f"""
SELECT revenue_rank, product_name, category, brand, total_units_sold,
       {mr('total_revenue')} AS total_revenue, {mr('avg_selling_price')} AS avg_price,
       {mr('avg_discount_pct')} AS avg_discount_pct, unique_customers
FROM product_perf ORDER BY revenue_rank, product_id LIMIT 20""")

register("report_ltv_segments", f"""
SELECT ltv_segment, CAST(count(*) AS BIGINT) AS customer_count,
       {mr(xavg('lifetime_value'))} AS avg_ltv, {mr(xsum('lifetime_value'))} AS total_ltv,
       {mr('avg(total_orders)')} AS avg_orders, {mr(xavg('avg_order_value'))} AS avg_order_value
FROM customer_ltv GROUP BY ltv_segment""")

register("report_tier_performance", f"""
SELECT customer_tier, CAST(count(*) AS BIGINT) AS customers,
       {mr(xavg('lifetime_value'))} AS avg_ltv, {mr('avg(total_orders)', 1)} AS avg_orders
FROM customer_ltv GROUP BY customer_tier""")

register("report_dow_pattern", f"""
SELECT left(dayname(sale_date), 3) AS day_name, CAST(dayofweek(sale_date) AS INTEGER) AS dow_num,
       {mr(xavg('gross_revenue'))} AS avg_daily_revenue, {mr('avg(num_orders)', 1)} AS avg_orders
FROM daily_sales GROUP BY 1, 2""")

register("report_vip_customers", f"""
SELECT full_name, email, customer_tier, country, total_orders,
       {mr('lifetime_value')} AS lifetime_value, {mr('avg_order_value')} AS avg_order_value,
       CAST(first_order_date AS DATE) AS first_order, CAST(last_order_date AS DATE) AS last_order
FROM customer_ltv WHERE ltv_segment = 'VIP'
ORDER BY customer_ltv.lifetime_value DESC NULLS LAST, customer_id LIMIT 50""")

register("report_category_margin", f"""
SELECT category, {mr(xsum('gross_revenue'))} AS total_revenue, {mr(xsum('gross_profit'))} AS total_profit,
       {mr(f"CAST({xsum('gross_profit')} AS DOUBLE) / NULLIF(CAST({xsum('gross_revenue')} AS DOUBLE), 0) * 100")} AS overall_margin_pct
FROM daily_sales GROUP BY category""")

register("report_latest_daily", """
SELECT * FROM daily_sales_lite ORDER BY sale_date DESC, category LIMIT 20""")

register("customers_by_ltv", """
SELECT customer_id, full_name, customer_tier, lifetime_value, ltv_segment FROM customer_ltv_lite""")

register("reconcile_line_total", f"""
SELECT item_id, order_id, line_total, expected_line_total,
       {mr('line_total - expected_line_total')} AS diff,
       abs({mr('line_total - expected_line_total')}) > 0.01 AS mismatch
FROM (SELECT item_id, order_id, line_total,
             {mr('quantity * unit_price * (1 - discount_pct / 100)')} AS expected_line_total
      FROM clean_order_items) x""")

register("reconcile_order_total", f"""
SELECT order_id, total_amount, items_total, expected_total,
       {mr('total_amount - expected_total')} AS diff,
       abs({mr('total_amount - expected_total')}) > 0.01 AS mismatch
FROM (SELECT o.order_id, o.total_amount, {mr('coalesce(s.lines, 0)')} AS items_total,
             {mr('coalesce(s.lines, 0) * (1 - o.discount_pct / 100)')} AS expected_total
      FROM clean_orders o
      LEFT JOIN (SELECT order_id, CAST({xsum('line_total')} AS DOUBLE) AS lines FROM clean_order_items GROUP BY order_id) s
        ON o.order_id = s.order_id) x""")

register("global_revenue_rank", """
SELECT item_id, order_id, line_total,
       CAST(rank() OVER (ORDER BY line_total DESC NULLS LAST) AS BIGINT) AS revenue_rank
FROM clean_order_items""")

register("ltv_segment", f"""
SELECT customer_id, lifetime_value, {LTV_SEGMENT_SQL} AS ltv_segment FROM customer_ltv""")


# ---- registrations: primitives and scalar functions ---------------------------
register("dedupe_latest", "SELECT * FROM dd_customers")
register("dedupe_incremental", "SELECT * FROM dd_customers")
register("filter_not_null", "SELECT * FROM src_customers WHERE email IS NOT NULL AND first_name IS NOT NULL")
register("filter_range", "SELECT * FROM src_orders WHERE total_amount >= 0")
register("standardise_domain", f"SELECT order_id, status AS raw_status, {STATUS_SQL} AS status FROM src_orders")
register("full_name", "SELECT customer_id, updated_at, concat_ws(' ', first_name, last_name) AS full_name "
                      "FROM src_customers")
register("product_margin", f"SELECT product_id, unit_price, cost_price, {MARGIN_SQL} AS margin_pct FROM src_products")
register("order_date_parts", """
SELECT order_id, order_date, CAST(year(order_date) AS INTEGER) AS order_year,
       CAST(month(order_date) AS INTEGER) AS order_month, CAST(day(order_date) AS INTEGER) AS order_day,
       CAST(dayofweek(order_date) + 1 AS INTEGER) AS order_dow
FROM src_orders""")
register("cast_schema", "SELECT * FROM src_orders")
register("money_round", f"""
SELECT item_id, {mr('line_total / 3')} AS third_2, {mr('line_total / 7', 1)} AS seventh_1
FROM clean_order_items""")
register("safe_divide", "SELECT order_id, total_amount / NULLIF(discount_pct, 0) AS amount_per_pct FROM clean_orders")
register("month_trunc", """
SELECT order_id, CAST(date_trunc('month', order_date) AS DATE) AS order_month_start FROM clean_orders""")


# ---- registrations: data quality -----------------------------------------------
DOUBLE_COLUMNS = {"gross_revenue", "gross_profit", "total_revenue", "lifetime_value", "total_amount",
                  "unit_price", "cost_price"}


def _check_sql(table: str, src: str, kind: str, column: str | None, severity: str,
               minimum: int | None = None, values: tuple = ()) -> str:
    """One result row of a check, in plain SQL."""
    col = column or ""
    if kind == "row_count":
        metric = "count(*)"
        name, passed = f"{table}_min_row_count", f"m >= {minimum}"
        message = f"'Expected >= {minimum} rows, got ' || CAST(m AS VARCHAR)"
    else:
        if kind == "no_nulls":
            bad = f"{col} IS NULL" + (f" OR isnan({col})" if col in DOUBLE_COLUMNS else "")
            metric = f"COALESCE(sum(CASE WHEN {bad} THEN 1 ELSE 0 END), 0)"
            suffix, text = "no_nulls", f" null values in {col}"
        elif kind == "no_negative":
            metric = f"COALESCE(sum(CASE WHEN {col} < 0 THEN 1 ELSE 0 END), 0)"
            suffix, text = "no_negative", f" negative values in {col}"
        elif kind == "unique":
            metric = (f"count(*) - (count(DISTINCT {col}) + "
                      f"CASE WHEN count(*) > count({col}) THEN 1 ELSE 0 END)")
            suffix, text = "unique", f" duplicate values in {col}"
        elif kind == "value_set":
            vals = ", ".join(f"'{v}'" for v in values)
            metric = f"COALESCE(sum(CASE WHEN {col} IN ({vals}) THEN 0 ELSE 1 END), 0)"
            suffix, text = "valid_values", f" rows with invalid {col} values"
        else:
            raise ValueError(kind)
        name, passed = f"{table}_{col}_{suffix}", "m = 0"
        message = f"CAST(m AS VARCHAR) || '{text}'"
    column_sql = f"'{col}'" if column else "CAST(NULL AS VARCHAR)"
    return (f"SELECT '{name}' AS name, '{table}' AS table_name, {column_sql} AS column_name, "
            f"'{kind}' AS check_type, {passed} AS passed, '{severity}' AS severity, "
            f"{message} AS message, m AS metric "
            f"FROM (SELECT CAST({metric} AS BIGINT) AS m FROM {src}) x")


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


DS, PP, CL = "daily_sales", "product_performance", "customer_ltv"
SEGMENTS = ("VIP", "High", "Medium", "Low")
SUITES = {
    DS: [(DS, "daily_sales", "row_count", None, "critical", 100),
         *[(DS, "daily_sales", "no_nulls", c, "critical") for c in ("sale_date", "category", "gross_revenue")],
         (DS, "daily_sales", "no_negative", "gross_revenue", "warning"),
         (DS, "daily_sales", "no_negative", "gross_profit", "warning")],
    PP: [(PP, "product_perf", "row_count", None, "critical", 50),
         (PP, "product_perf", "unique", "product_id", "critical"),
         *[(PP, "product_perf", "no_nulls", c, "critical") for c in ("product_id", "product_name", "total_revenue")],
         (PP, "product_perf", "no_negative", "total_revenue", "warning")],
    CL: [(CL, "customer_ltv", "row_count", None, "critical", 500),
         (CL, "customer_ltv", "unique", "customer_id", "critical"),
         *[(CL, "customer_ltv", "no_nulls", c, "critical") for c in ("customer_id", "email", "lifetime_value")],
         (CL, "customer_ltv", "value_set", "ltv_segment", "warning", None, SEGMENTS)],
}


def _suite_sql(specs) -> str:
    return _union([_check_sql(*s) for s in specs])


def _pick(kind: str) -> list[tuple]:
    return [s for suite in SUITES.values() for s in suite if s[2] == kind]


register("dq_row_count", _suite_sql(_pick("row_count")))
register("dq_no_nulls", _suite_sql(_pick("no_nulls")))
register("dq_no_negative", _suite_sql(_pick("no_negative")))
register("dq_unique", _suite_sql(_pick("unique")))
register("dq_value_set", _suite_sql(_pick("value_set")))
register("dq_suite_daily_sales", _suite_sql(SUITES[DS]))
register("dq_suite_product_performance", _suite_sql(SUITES[PP]))
register("dq_suite_customer_ltv", _suite_sql(SUITES[CL]))
register("dq_incremental", _suite_sql([s for suite in SUITES.values() for s in suite]))
register("dq_gate_summary", f"""
SELECT severity, passed, CAST(count(*) AS BIGINT) AS n_checks FROM (
{_suite_sql([s for suite in SUITES.values() for s in suite])}
) r GROUP BY severity, passed""")


def _fk_sql(name: str, table: str, key: str, child: str, parent: str) -> str:
    return (f"SELECT '{name}' AS name, '{table}' AS table_name, '{key}' AS column_name, "
            f"'foreign_key' AS check_type, m = 0 AS passed, 'critical' AS severity, "
            f"CAST(m AS VARCHAR) || ' orphan values in {key}' AS message, m AS metric FROM "
            f"(SELECT CAST(count(*) AS BIGINT) AS m FROM {child} ch WHERE ch.{key} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {parent} pa WHERE pa.{key} = ch.{key})) x")


_SRC_NOT_NULL = {"customers": ["first_name", "last_name", "email", "signup_date"],
                 "products": ["product_name", "category", "unit_price", "cost_price"],
                 "orders": ["order_date", "status"], "order_items": ["quantity", "unit_price"]}
_SRC_PK = {"customers": "customer_id", "products": "product_id", "orders": "order_id",
           "order_items": "item_id"}
_ri = [
    _fk_sql("orders_customer_id_fk", "orders", "customer_id", "dd_orders", "dd_customers"),
    _fk_sql("order_items_order_id_fk", "order_items", "order_id", "dd_order_items", "dd_orders"),
    _fk_sql("order_items_product_id_fk", "order_items", "product_id", "dd_order_items", "dd_products"),
]
for _t, _cols in _SRC_NOT_NULL.items():
    _ri += [_check_sql(_t, f"dd_{_t}", "no_nulls", c, "critical") for c in _cols]
    _ri.append(_check_sql(_t, f"dd_{_t}", "unique", _SRC_PK[_t], "critical"))
_ri.append(_check_sql("customers", "dd_customers", "unique", "email", "critical"))
register("dq_referential_integrity", _union(_ri))


# ---- registrations: ingestion --------------------------------------------------
WM = {"customers": "1994-07-01", "products": "1994-07-01", "orders": "1998-01-01",
      "order_items": "1998-01-01", "clickstream": "2024-01-15"}


def _ts(v: str) -> str:
    return f"TIMESTAMP '{v}'"


register("extract_customers", f"SELECT * FROM src_customers WHERE updated_at > {_ts(WM['customers'])}")
register("extract_products", f"SELECT * FROM src_products WHERE updated_at > {_ts(WM['products'])}")
register("extract_orders", f"SELECT * FROM src_orders WHERE updated_at > {_ts(WM['orders'])}")
register("extract_order_items", f"""
SELECT i.* FROM src_order_items i JOIN src_orders o ON i.order_id = o.order_id
WHERE o.updated_at > {_ts(WM['order_items'])}""")
register("extract_clickstream", f"SELECT * FROM src_clickstream WHERE event_timestamp > {_ts(WM['clickstream'])}")

_OLD = {t: v for t, v in WM.items() if t != "products"}
_old_rows = " UNION ALL ".join(f"SELECT '{t}' AS table_name, {_ts(v)} AS last_extracted"
                               for t, v in _OLD.items())
_all_tables = " UNION ALL ".join(f"SELECT '{t}' AS table_name" for t in WM)
_EPOCH = "TIMESTAMP '1970-01-01'"


def _batch_max(table: str, items: str) -> str:
    old = _ts(_OLD[table]) if table in _OLD else _EPOCH
    if table == "order_items":
        return (f"SELECT max({items}) FROM src_order_items i JOIN src_orders o "
                f"ON i.order_id = o.order_id WHERE o.updated_at > {old}")
    ts = {"customers": "updated_at", "products": "updated_at", "orders": "updated_at",
          "clickstream": "event_timestamp"}[table]
    return f"SELECT max({ts}) FROM src_{table} WHERE {ts} > {old}"


for _key, _items in (("watermark_advance", "o.updated_at"), ("watermark_advance_reference", "i.created_at")):
    _bm_rows = " UNION ALL ".join(f"SELECT '{t}' AS table_name, ({_batch_max(t, _items)}) AS batch_max" for t in WM)
    register(_key, f"""
SELECT a.table_name,
       CASE WHEN b.batch_max IS NULL THEN a.last_extracted
            ELSE greatest(a.last_extracted, b.batch_max) END AS last_extracted
FROM (SELECT t.table_name, COALESCE(o.last_extracted, {_EPOCH}) AS last_extracted
      FROM ({_all_tables}) t LEFT JOIN ({_old_rows}) o ON t.table_name = o.table_name) a
LEFT JOIN ({_bm_rows}) b ON a.table_name = b.table_name""")

# All that two runs must land: every item that has an order.
register("extract_two_runs", """
SELECT DISTINCT i.* FROM src_order_items i WHERE EXISTS (SELECT 1 FROM src_orders o WHERE o.order_id = i.order_id)""")
register("extract_late_rows", "SELECT * FROM src_orders")
register("raw_read_nested", "SELECT * FROM src_orders")
register("extract_stream_available_now", "SELECT * FROM src_clickstream")
register("raw_read_all", "SELECT * FROM src_orders")
register("raw_row_counts", """
SELECT 'customers' AS table_name, CAST(count(*) AS BIGINT) AS rows FROM src_customers
UNION ALL SELECT 'products', CAST(count(*) AS BIGINT) FROM src_products
UNION ALL SELECT 'orders', CAST(count(*) AS BIGINT) FROM src_orders
UNION ALL SELECT 'order_items', CAST(count(*) AS BIGINT) FROM src_order_items""")
register("union_by_name_read", f"""
SELECT order_id, customer_id, order_date, status, CAST(NULL AS VARCHAR) AS payment_method, shipping_city,
       shipping_country, discount_pct, total_amount, created_at, updated_at
FROM src_orders WHERE updated_at <= {_ts(WM['orders'])}
UNION ALL
SELECT {', '.join(ORD_COLS)} FROM src_orders WHERE updated_at > {_ts(WM['orders'])}""")
register("extract_manifest", """
SELECT 'customers' AS table_name, CAST(count(*) AS BIGINT) AS rows, 'success' AS status FROM src_customers
UNION ALL SELECT 'products', CAST(count(*) AS BIGINT), 'success' FROM src_products
UNION ALL SELECT 'orders', CAST(count(*) AS BIGINT), 'success' FROM src_orders
UNION ALL SELECT 'order_items', CAST(count(*) AS BIGINT), 'success'
          FROM src_order_items i WHERE EXISTS (SELECT 1 FROM src_orders o WHERE o.order_id = i.order_id)
UNION ALL SELECT 'clickstream', CAST(count(*) AS BIGINT), 'success' FROM src_clickstream""")


# ---- registrations: sinks ---------------------------------------------------------
register("land_raw", "SELECT *, DATE '2024-02-01' AS ingest_date FROM src_clickstream")
register("write_layer", "SELECT * FROM clean_products")
register("write_orders_partitioned", "SELECT * FROM clean_orders")
register("load_mart_full_refresh", """
SELECT sale_date AS SALE_DATE, category AS CATEGORY, num_orders AS NUM_ORDERS, units_sold AS UNITS_SOLD,
       gross_revenue AS GROSS_REVENUE, total_cost AS TOTAL_COST, gross_profit AS GROSS_PROFIT,
       margin_pct AS MARGIN_PCT, avg_discount_pct AS AVG_DISCOUNT_PCT
FROM daily_sales""")
register("load_by_name_permissive", "SELECT * FROM clean_order_items WHERE discount_pct <> 0")
register("mart_schema_conform", "SELECT * FROM daily_sales")
register("load_by_name_rejects", """
SELECT item_id, 'none' AS discount_pct,
       (SELECT CAST(count(*) AS BIGINT) FROM clean_order_items WHERE discount_pct <> 0) AS accepted,
       (SELECT CAST(count(*) AS BIGINT) FROM clean_order_items WHERE discount_pct = 0) AS rejected
FROM clean_order_items WHERE discount_pct = 0""")
for _m, _src in (("product_performance", "product_perf"), ("customer_ltv", "customer_ltv")):
    register(f"load_{_m}_full_refresh", "SELECT " + ", ".join(f"{f.name} AS {f.name.upper()}" for f in schemas.MARTS[_m].fields)
             + f" FROM {_src}")
    register(f"{_m}_schema_conform", f"SELECT * FROM {_src}")
register("register_mart_tables", "SELECT * FROM daily_sales_lite")
register("register_mart_tables_ltv", "SELECT * FROM customer_ltv_lite")
for _m, _src in (("daily_sales", "daily_sales"), ("product_performance", "product_perf"), ("customer_ltv", "customer_ltv")):
    register(f"refresh_{_m}", f"SELECT * FROM {_src}")
    register(f"pipeline_full_{_m}", f"SELECT * FROM {_src}")
register("pipeline_incremental_daily_sales", "SELECT * FROM daily_sales")


# ---- registrations: pipelines ------------------------------------------------------
_PROCESS_COUNTS = """
SELECT 'processed' AS layer, 'customers' AS dataset, CAST(count(*) AS BIGINT) AS rows FROM clean_customers
UNION ALL SELECT 'processed', 'products', CAST(count(*) AS BIGINT) FROM clean_products
UNION ALL SELECT 'processed', 'orders', CAST(count(*) AS BIGINT) FROM clean_orders
UNION ALL SELECT 'processed', 'order_items', CAST(count(*) AS BIGINT) FROM clean_order_items
UNION ALL SELECT 'marts', 'daily_sales', CAST(count(*) AS BIGINT) FROM daily_sales
UNION ALL SELECT 'marts', 'product_performance', CAST(count(*) AS BIGINT) FROM product_perf
UNION ALL SELECT 'marts', 'customer_ltv', CAST(count(*) AS BIGINT) FROM customer_ltv"""
register("pipeline_process", _PROCESS_COUNTS)
_EXTRACTED = ORACLE["extract_manifest"]
_PUBLISHED = f"""SELECT 'raw' AS layer, table_name AS dataset, rows FROM ({_EXTRACTED}) e
UNION ALL SELECT layer, dataset, rows FROM ({_PROCESS_COUNTS}) q"""
register("publish_layers", _PUBLISHED)
register("publish_raw_orders", "SELECT * FROM src_orders")
register("publish_processed_orders", "SELECT * FROM clean_orders")
register("publish_marts_customer_ltv", "SELECT * FROM customer_ltv")
register("pipeline_incremental_processed", "SELECT * FROM clean_orders")
register("pipeline_full", f"""
SELECT 'extract' AS stage, table_name AS dataset, rows, status FROM ({_EXTRACTED}) e
UNION ALL SELECT 'process', dataset, rows, 'success' FROM ({_PROCESS_COUNTS}) p
UNION ALL SELECT 'quality', 'checks', CAST(18 AS BIGINT), 'success'
UNION ALL SELECT 'publish', layer || '/' || dataset, rows, 'success' FROM ({_PUBLISHED}) u""")
