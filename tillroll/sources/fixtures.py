"""Adapter from the driver's TPC-H-like tables to the five retail sources.

Planted dirt (by key modulo): a second, newer version of every tenth
customer, NULL emails, unknown tiers and statuses, zero prices, negative
totals, anonymous clicks.  Item ids repeat naturally.  The DuckDB twin of
each view lives in ``tillroll.plans.oracle``.

Only narrow projections of the base tables are read.  nation/region are the
25/5-row dimension tables; the planner broadcasts them by their measured
file size (a checked bound), so no hint is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import money_round

BASE_DATE = "1994-01-01"


# Declared schemas of the driver's tables: reading with them skips footer
# inference at planning time.
BASE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": ("p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
             "p_retailprice double"),
    "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                 "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                 "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
    "events": ("event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
               "props string"),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in BASE_SCHEMAS:
        reader = reader.schema(BASE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _day(offset) -> F.Column:
    return F.date_add(F.lit(BASE_DATE).cast("date"), offset)


def src_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    # Version 0 for everyone, version 1 (newer, 'gold') for every tenth key;
    # the union comes first so the dimension joins run once.
    both = (c.withColumn("ver", F.lit(0))
             .unionByName(c.filter(F.col("c_custkey") % 10 == 0).withColumn("ver", F.lit(1))))
    versions = (both.join(n, both.c_nationkey == n.n_nationkey)
                    .join(r, n.n_regionkey == r.r_regionkey)
                    .select("c_custkey", "c_name", "c_mktsegment", "n_name", "r_name", "ver"))
    signup = _day((F.col("c_custkey") % 365).cast("int"))
    tier = (F.when(F.col("ver") == 1, "gold")
             .when(F.col("c_mktsegment") == "MACHINERY", "silver")
             .when(F.col("c_mktsegment") == "BUILDING", "standard")
             .otherwise(F.lower("c_mktsegment")))
    email = (F.when(F.col("c_custkey") % 50 == 49, F.lit(None).cast("string"))
              .otherwise(F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))),
                                  F.lit("@example.com"))))
    return versions.select(
        F.col("c_custkey").alias("customer_id"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
        email.alias("email"),
        F.lit(None).cast("string").alias("phone"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("country"),
        signup.alias("signup_date"),
        tier.alias("customer_tier"),
        signup.cast("timestamp_ntz").alias("created_at"),
        F.date_add(signup, F.col("ver")).cast("timestamp_ntz").alias("updated_at"),
    ).to(schemas.CUSTOMERS)


def src_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    size = F.col("p_size")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.when(size <= 15, "small").when(size <= 35, "medium").otherwise("large").alias("subcategory"),
        F.col("p_brand").alias("brand"),
        F.when(F.col("p_partkey") % 100 == 99, F.lit(0.0))
         .otherwise(F.col("p_retailprice")).alias("unit_price"),
        money_round(F.col("p_retailprice") * 0.6).alias("cost_price"),
        size.alias("stock_quantity"),
        (F.col("p_partkey") % 20 != 0).alias("is_active"),
        F.lit(BASE_DATE).cast("date").cast("timestamp_ntz").alias("created_at"),
        _day((F.col("p_partkey") % 365).cast("int")).cast("timestamp_ntz").alias("updated_at"),
    ).to(schemas.PRODUCTS)


def src_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    k, st, pr = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderpriority")
    status = (F.when(k % 97 == 0, "returned")
               .when((st == "P") & (pr == "5-LOW"), "cancelled")
               .when((st == "P") & (pr == "1-URGENT"), "pending")
               .when(st == "F", "delivered")
               .when(st == "O", "processing")
               .otherwise("shipped"))
    payment = F.when(k % 3 == 0, "credit_card").when(k % 3 == 1, "paypal").otherwise("upi")
    total = (F.when(k % 101 == 0, F.lit(-1.0))
              .otherwise(money_round(F.col("o_totalprice") / 1000)))
    return o.select(
        k.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"),
        status.alias("status"),
        payment.alias("payment_method"),
        F.lit(None).cast("string").alias("shipping_city"),
        F.lit(None).cast("string").alias("shipping_country"),
        ((k % 5) * 5).cast("double").alias("discount_pct"),
        total.alias("total_amount"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderdate").alias("updated_at"),
    ).to(schemas.ORDERS)


def src_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        money_round(F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        money_round(F.col("l_discount") * 100).alias("discount_pct"),
        money_round(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("line_total"),
        F.col("l_shipdate").alias("created_at"),
    ).to(schemas.ORDER_ITEMS)


def src_clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    eid = F.col("event_id")
    etype = (F.when(F.col("event_type") == "click", "add_to_cart")
              .when(F.col("event_type") == "error", "remove_from_cart")
              .when(F.col("event_type") == "purchase", "purchase")
              .otherwise("page_view"))
    return e.select(
        eid,
        F.concat(F.col("user_id").cast("string"), F.lit("-"),
                 F.col("ts").cast("date").cast("string")).alias("session_id"),
        F.when(eid % 3 == 0, F.lit(None).cast("long")).otherwise(F.col("user_id")).alias("customer_id"),
        F.when(eid % 11 == 0, F.lit(None).cast("long")).otherwise(eid % 100).alias("product_id"),
        etype.alias("event_type"),
        F.concat(F.lit("/product/"), (eid % 100).cast("string")).alias("page_url"),
        F.lit("direct").alias("referrer"),
        F.when(eid % 3 == 0, "desktop").when(eid % 3 == 1, "mobile").otherwise("tablet").alias("device_type"),
        F.lit("Chrome").alias("browser"),
        F.col("ts").alias("event_timestamp"),
        F.col("ts").alias("created_at"),
    ).to(schemas.CLICKSTREAM)


BUILDERS = {
    "customers": src_customers,
    "products": src_products,
    "orders": src_orders,
    "order_items": src_order_items,
    "clickstream": src_clickstream,
}


def fixture_source(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return BUILDERS[table](spark, sf_dir)


def fixture_sources(spark: SparkSession, sf_dir: str, tables=None) -> dict[str, DataFrame]:
    return {t: BUILDERS[t](spark, sf_dir) for t in (tables or BUILDERS)}
