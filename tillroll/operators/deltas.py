"""The additive columns of the marts as sums that changes are added to (M1, M2).

Beside a version of the marts lie sums that are neither rounded nor divided: of the daily mart
per (date, category), of the product mart per product.  The old and the new row of every
changed key give signed contributions of the orders they belong to; added to the sums they
give those of the new state, so neither the old state nor groups that did not change are
read, and a product sold every day is not summed anew every day.  Distinct customers of a
product come from orders per (product, customer), kept as deltas that are only added to.

A sum can be taken back exactly: values are fixed to six decimals, and NaN and infinities are
counted beside them, as are the values that are not NULL.  A sum is three whole numbers (``_PARTS``),
as adding LONGs costs a fraction of adding DECIMALs; only the marts make a DECIMAL of them.

Orders stand as a whole: the touched ones are those that changed or that have, in either
state, a changed item or an item of a changed product.  Their unchanged items and orders
count in both states, so the old state of them is the new one without the changed keys and with
the changes' old rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exact, millionths, money_round, pct, rounded
from ..session import materialize
from .dedupe import of_keys
from .marts import PRODUCT_ATTRS, customer_ltv, not_cancelled
from .rank import global_rank

#: A sum in millionths, thousands and 10^12, of the lower two 0 to 10^9 - 1 each.  Sums reach 9 * 10^30, and 9 * 10^9 rows
#: of a key can be added at once; beyond either LONG overflows, which is an error.
_PARTS = ("low", "mid", "high")
_FIELDS = (*_PARTS, "n", "nan", "up", "down")
_BASE = 10 ** 9
_INF = float("inf")

ITEM_COLUMNS = ["item_id", "order_id", "product_id", "quantity", "unit_price", "discount_pct", "line_total"]
ORDER_COLUMNS = ["order_id", "customer_id", "order_date", "status", "discount_pct"]
PRODUCT_COLUMNS = ["product_id", "category", "cost_price"]


@dataclass
class Sums:
    """How a table of sums is keyed, which columns are counts and which sums of values."""

    keys: list[str]
    counts: list[str]
    values: list[str]


DAILY = Sums(["sale_date", "category"], ["num_orders"], ["units", "revenue", "cost", "discount"])
PRODUCTS = Sums(["product_id"], ["num_orders", "unique_customers"], ["units", "revenue", "price", "discount"])
PAIRS = Sums(["product_id", "customer_id"], ["num_orders"], [])


@dataclass
class Changes:
    """The keys changed between two states and their clean rows in each (no row: not there, or cleaned away).

    ``mark``: the column of the new state's frames that says whether a row's key has changed, if they have one.
    ``same``: the clean rows whose keys have not changed, if they are at hand; then the states are put together from these.
    """

    keys: dict[str, DataFrame]
    old: dict[str, DataFrame]
    new: dict[str, DataFrame]
    mark: str | None = None
    same: dict[str, DataFrame] | None = None


def changes_between(before: dict[str, DataFrame], after: dict[str, DataFrame], keys: dict[str, DataFrame],
                    mark: str | None = None) -> Changes:
    """The changes of two whole states that are at hand.

    ``mark``: a column of both states that is true in the rows of ``keys``; without one the rows are found by joins.
    """
    def rows(state):
        if mark:
            return {t: state[t].filter(F.col(mark)).drop(mark) for t in keys}
        return {t: materialize(of_keys(state[t], k), f"changes_{t}") for t, k in keys.items()}
    return Changes(keys, rows(before), rows(after), mark)


# ---- sums that can be taken back ----------------------------------------------------------------
def _div(x: Column, n: int) -> Column:
    return F.call_function("div", x, F.lit(n).cast("long"))


def _parts(x: Column) -> list[Column]:
    """The three parts of one value, all of its sign; NULL for NULL and odd values."""
    whole, right = millionths(x)
    e = exact(x)
    rest = e % F.lit(Decimal(10 ** 12))
    return [F.when(right, whole % F.lit(_BASE)).otherwise((rest % F.lit(Decimal(1000)) * F.lit(Decimal(10 ** 6))).cast("long")),
            F.when(right, _div(whole, _BASE)).otherwise(F.call_function("div", rest, F.lit(Decimal(1000)))),
            F.when(right, F.lit(0).cast("long")).otherwise(F.call_function("div", e, F.lit(Decimal(10 ** 12))))]


def _carried(low: Column, mid: Column, high: Column) -> list[Column]:
    """Added-up parts with the lower two brought to 0 to 10^9 - 1, so that equal sums have equal parts."""
    base = F.lit(_BASE).cast("long")
    mid = mid + _div(low - F.pmod(low, base), _BASE)
    high = high + _div(mid - F.pmod(mid, base), _BASE)
    return [x.alias(name) for x, name in zip((F.pmod(low, base), F.pmod(mid, base), high), _PARTS, strict=True)]


def _value(c: Column | str) -> Column:
    """Sum of a column as a struct of numbers that all add up."""
    x = F.col(c) if isinstance(c, str) else c
    d = x.cast("double")
    return F.struct(*_carried(*[F.coalesce(F.sum(p), F.lit(0).cast("long")) for p in _parts(x)]),
                    F.count(x).alias("n"), F.count_if(F.isnan(d)).alias("nan"),
                    F.count_if(d == F.lit(_INF)).alias("up"), F.count_if(d == F.lit(-_INF)).alias("down"))


def _times(x: Column, n: Column) -> Column:
    """One value ``n`` times, as such a struct."""
    def when(hit: Column) -> Column:
        return F.when(hit, n).otherwise(F.lit(0)).cast("long")
    d = x.cast("double")
    return F.struct(*_carried(*[F.coalesce(p * n, F.lit(0).cast("long")) for p in _parts(x)]),
                    when(x.isNotNull()).alias("n"), when(F.isnan(d)).alias("nan"),
                    when(d == F.lit(_INF)).alias("up"), when(d == F.lit(-_INF)).alias("down"))


def _sum(v: str) -> Column:
    """The sum without odd values as DECIMAL(38,6)."""
    low = F.col(f"{v}.low").cast("decimal(20,0)") * F.lit(Decimal("0.000001"))
    mid = F.col(f"{v}.mid").cast("decimal(20,0)") * F.lit(Decimal(1000))
    return (low + mid + F.col(f"{v}.high").cast("decimal(20,0)") * F.lit(Decimal(10 ** 12))).cast("decimal(38,6)")


def _odd(v: str) -> Column:
    """What the odd values of a sum make of it, NULL if there are none."""
    up, down = F.col(f"{v}.up") > 0, F.col(f"{v}.down") > 0
    return (F.when((F.col(f"{v}.nan") > 0) | (up & down), F.lit(float("nan")))
             .when(up, F.lit(_INF)).when(down, F.lit(-_INF)))


def _total(v: str) -> Column:
    """The sum as DOUBLE; NULL if there was no value."""
    return F.when(F.col(f"{v}.n") > 0, F.coalesce(_odd(v), _sum(v).cast("double")))


def _rounded(v: str) -> Column:
    return F.when(F.col(f"{v}.n") > 0, F.coalesce(_odd(v), money_round(_sum(v))))


def _mean(v: str) -> Column:
    return rounded(F.try_divide(_total(v), F.col(f"{v}.n")))


def _columns(s: Sums) -> list[str]:
    return [*s.keys, *s.counts, *s.values]


def add_up(rows: DataFrame, s: Sums) -> DataFrame:
    """One row per key: all numbers added."""
    return rows.groupBy(*s.keys).agg(
        *[F.sum(c).cast("long").alias(c) for c in s.counts],
        *[F.struct(*_carried(*[F.sum(f"{v}.{f}") for f in _PARTS]),
                   *[F.sum(f"{v}.{f}").alias(f) for f in _FIELDS[len(_PARTS):]]).alias(v) for v in s.values])


def _negative(rows: DataFrame, s: Sums) -> DataFrame:
    return rows.select(*s.keys, *[(-F.col(c)).alias(c) for c in s.counts],
                       *[F.struct(*[(-F.col(f"{v}.{f}")).alias(f) for f in _FIELDS]).alias(v) for v in s.values])


def difference(new: DataFrame, old: DataFrame, s: Sums) -> DataFrame:
    """What is to be added to sums over ``old`` to get those over ``new``."""
    return add_up(new.select(_columns(s)).unionByName(_negative(old, s)), s)


def apply_delta(sums: DataFrame, delta: DataFrame, s: Sums) -> DataFrame:
    """The sums of the new state; keys without orders go."""
    return add_up(sums.select(_columns(s)).unionByName(delta.select(_columns(s))), s).filter(F.col("num_orders") > 0)


# ---- contributions of orders ---------------------------------------------------------------------
def daily_rows(p: dict[str, DataFrame]) -> DataFrame:
    """Of each order and category one row of the daily sums.

    Orders are joined to the narrow lines and the sums, which are wide, made where the lines lie by order, so lines
    are shuffled by order once; a hot order is split by the join (``skewJoin``) and added up before the next shuffle.
    """
    lines = p["order_items"].select(ITEM_COLUMNS).join(p["products"].select(PRODUCT_COLUMNS), "product_id")
    lines = lines.select("order_id", "category", "quantity", "line_total", "cost_price")
    dated = not_cancelled(p["orders"].select(ORDER_COLUMNS)).select(
        "order_id", F.to_date("order_date").alias("sale_date"), F.col("discount_pct").alias("order_discount"))
    per_order = lines.join(dated, "order_id").groupBy("order_id", "category", "sale_date", "order_discount").agg(
        F.count(F.lit(1)).alias("lines"), _value("quantity").alias("units"), _value("line_total").alias("revenue"),
        _value(F.col("quantity") * F.col("cost_price")).alias("cost"))
    return per_order.select(
        "sale_date", "category", F.lit(1).cast("long").alias("num_orders"), "units", "revenue", "cost",
        _times(F.col("order_discount"), F.col("lines")).alias("discount"))


def product_rows(p: dict[str, DataFrame]) -> DataFrame:
    """Of each product and order one row of the product sums (without distinct customers), with its customer."""
    orders = not_cancelled(p["orders"].select(ORDER_COLUMNS)).select("order_id", "customer_id")
    lines = p["order_items"].select(ITEM_COLUMNS).filter("product_id IS NOT NULL").join(orders, "order_id")
    return (lines.groupBy("product_id", "order_id", "customer_id")
                 .agg(_value("quantity").alias("units"), _value("line_total").alias("revenue"),
                      _value("unit_price").alias("price"), _value("discount_pct").alias("discount"))
                 .withColumns({"num_orders": F.lit(1).cast("long"), "unique_customers": F.lit(0).cast("long")}))


def pairs_of(rows: DataFrame) -> DataFrame:
    """Orders per (product, customer) of ``product_rows``; those without a customer count for no customer."""
    return add_up(rows.filter("customer_id IS NOT NULL"), PAIRS)


def _customers(pairs: DataFrame, count: Column) -> DataFrame:
    """Rows of the product sums that hold distinct customers only."""
    nothing = F.struct(*[F.lit(0).cast("long").alias(f) for f in _FIELDS])
    return pairs.groupBy("product_id").agg(F.sum(count).cast("long").alias("unique_customers")).select(
        "product_id", F.lit(0).cast("long").alias("num_orders"), "unique_customers", *[nothing.alias(v) for v in PRODUCTS.values])


def with_customers(sums: DataFrame, pairs: DataFrame) -> DataFrame:
    """Product sums of a whole state with the distinct customers of its pairs."""
    return add_up(sums.select(_columns(PRODUCTS)).unionByName(_customers(pairs, F.lit(1))), PRODUCTS)


def customers_delta(delta: DataFrame, stored: DataFrame) -> DataFrame:
    """What changed pairs do to the distinct customers: +1 where a first order came, -1 where the last went.

    ``stored``: the pairs of the old state, any number of deltas to be added.  Only pairs in ``delta`` are looked up.
    """
    had = stored.join(delta.select(*PAIRS.keys), PAIRS.keys, "left_semi").groupBy(*PAIRS.keys).agg(F.sum("num_orders").alias("had"))
    both = delta.join(had, PAIRS.keys, "left").withColumn("had", F.coalesce("had", F.lit(0)))
    step = (F.col("had") + F.col("num_orders") > 0).cast("int") - (F.col("had") > 0).cast("int")
    return _customers(both, step)


def product_deltas(now: DataFrame, was: DataFrame, stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What two states of the touched orders (``product_rows``) add to the product sums and to the pairs."""
    pairs = materialize(difference(pairs_of(now), pairs_of(was), PAIRS).filter("num_orders <> 0"), "pairs_delta")
    return difference(now, was, PRODUCTS).unionByName(customers_delta(pairs, stored)), pairs


# ---- the two states of the touched orders --------------------------------------------------------
def _replaced(now: DataFrame, keys: DataFrame, old: DataFrame, columns: list[str], mark: str | None) -> DataFrame:
    """The old state of ``now``: without the changed keys, with their old rows."""
    stay = now.filter(~F.col(mark)).select(columns) if mark else of_keys(now.select(columns), keys, "left_anti")
    return stay.unionByName(old.select(columns))


def touched_states(after: dict[str, DataFrame], ch: Changes) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """The touched orders with all their items, before and after the changes; products in both states.

    The items are read twice, once for those of changed products; the old state is not read.
    """
    ids = ch.keys["orders"].select("order_id")
    for rows in (ch.old["order_items"], ch.new["order_items"],
                 after["order_items"].join(ch.keys["products"], "product_id", "left_semi")):
        ids = ids.unionByName(rows.select("order_id"))
    touched = materialize(ids.filter("order_id IS NOT NULL").distinct(), "touched_orders")
    columns = {"order_items": ITEM_COLUMNS, "orders": ORDER_COLUMNS, "products": PRODUCT_COLUMNS}
    if ch.same:  # changed items and orders belong to touched orders, so only the others are looked for
        stay = {t: ch.same[t].select(c) for t, c in columns.items()}
        stay |= {t: materialize(stay[t].join(touched, "order_id", "left_semi"), f"touched_{t}") for t in ("order_items", "orders")}
        return tuple({t: stay[t].unionByName(rows[t].select(c)) for t, c in columns.items()} for rows in (ch.old, ch.new))
    state = {t: after[t].select(*c, *[ch.mark] * bool(ch.mark)) for t, c in columns.items()}
    items = materialize(state["order_items"].join(touched, "order_id", "left_semi"), "touched_items")
    orders = materialize(state["orders"].join(touched, "order_id", "left_semi"), "touched_rows")
    now = {"order_items": items, "orders": orders, "products": state["products"]}
    was = {t: _replaced(now[t], ch.keys[t], ch.old[t], c, ch.mark) for t, c in columns.items()}
    return was, now


# ---- marts from their sums -----------------------------------------------------------------------
def daily_sales(sums: DataFrame) -> DataFrame:
    """M1 from its sums."""
    out = sums.select("sale_date", "category", "num_orders", F.when(F.col("units.n") > 0, _sum("units")).cast("long").alias("units_sold"),
                      _rounded("revenue").alias("gross_revenue"), _rounded("cost").alias("total_cost"), _mean("discount").alias("avg_discount_pct"))
    return (out.withColumn("gross_profit", rounded(F.col("gross_revenue") - F.col("total_cost")))
               .withColumn("margin_pct", pct("gross_profit", "gross_revenue"))
               .select("sale_date", "category", "num_orders", "units_sold", "gross_revenue",
                       "total_cost", "gross_profit", "margin_pct", "avg_discount_pct"))


def product_performance(sums: DataFrame, products: DataFrame) -> DataFrame:
    """M2 from its sums; attributes are those of the clean products, ranks are assigned anew."""
    totals = sums.select("product_id", "num_orders", F.when(F.col("units.n") > 0, _sum("units")).cast("long").alias("total_units_sold"),
                         _rounded("revenue").alias("total_revenue"), _mean("price").alias("avg_selling_price"),
                         _mean("discount").alias("avg_discount_pct"), "unique_customers")
    joined = totals.join(products.select(*PRODUCT_ATTRS), "product_id").select(
        *PRODUCT_ATTRS, "num_orders", "total_units_sold", "total_revenue", "avg_selling_price", "avg_discount_pct", "unique_customers")
    return global_rank(joined, "total_revenue", "revenue_rank", rank_type="int")


def touched_customers(ch: Changes) -> DataFrame:
    """Customers that changed or whose orders did, from the changed rows alone."""
    ids = ch.keys["customers"].select("customer_id")
    for rows in (ch.old["orders"], ch.new["orders"]):
        ids = ids.unionByName(rows.select("customer_id"))
    return ids.filter("customer_id IS NOT NULL").distinct()


def refreshed_ltv(previous: DataFrame, after: dict[str, DataFrame], touched: DataFrame) -> DataFrame:
    """M3: rows of the touched customers anew (first and last dates and active days do not add up)."""
    anew = customer_ltv(after["orders"].join(touched, "customer_id", "left_semi"),
                        after["customers"].join(touched, "customer_id", "left_semi"))
    return previous.join(touched, "customer_id", "left_anti").unionByName(anew)
