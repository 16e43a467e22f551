import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tillroll.operators import clean as C
from tillroll.operators import deltas as D
from tillroll.operators.marts import (affected_sale_dates, customer_ltv, daily_sales, product_performance,
                                      refresh_customer_ltv, refresh_daily_sales, refresh_product_performance)
from tillroll.session import scratch_path
from tillroll.sources.fixtures import fixture_sources


@pytest.fixture(scope="module")
def states(spark):
    src = fixture_sources(spark, SF_SMALL, ["products", "orders", "order_items"])
    before = {"orders": C.clean_orders(src["orders"]), "order_items": C.clean_order_items(src["order_items"]),
              "products": C.clean_products(src["products"])}
    # A day of changes: orders move date / get cancelled, items change quantity or
    # move to another order, products change cost or fail the price filter.
    o = src["orders"]
    orders_after = (o.withColumn("order_date", F.when(F.col("order_id") % 37 == 1, F.col("order_date") + F.expr("INTERVAL 3 DAYS"))
                                 .otherwise(F.col("order_date")))
                     .withColumn("status", F.when(F.col("order_id") % 41 == 2, F.lit("cancelled")).otherwise(F.col("status"))))
    i = src["order_items"]
    items_after = (i.withColumn("quantity", F.when(F.col("item_id") % 53 == 3, F.col("quantity") + 1).otherwise(F.col("quantity")))
                    .withColumn("order_id", F.when(F.col("item_id") % 59 == 4, F.col("order_id") + 32).otherwise(F.col("order_id"))))
    p = src["products"]
    products_after = (p.withColumn("cost_price", F.when(F.col("product_id") % 43 == 5, F.col("cost_price") + 1).otherwise(F.col("cost_price")))
                       .withColumn("unit_price", F.when(F.col("product_id") % 47 == 6, F.lit(0.0)).otherwise(F.col("unit_price"))))
    after = {"orders": C.clean_orders(orders_after), "order_items": C.clean_order_items(items_after),
             "products": C.clean_products(products_after)}
    changed = {"orders": o.filter((F.col("order_id") % 37 == 1) | (F.col("order_id") % 41 == 2)).select("order_id"),
               "order_items": i.filter((F.col("item_id") % 53 == 3) | (F.col("item_id") % 59 == 4)).select("item_id"),
               "products": p.filter((F.col("product_id") % 43 == 5) | (F.col("product_id") % 47 == 6)).select("product_id")}
    return before, after, changed


def _mart(state):
    return daily_sales(state["order_items"], state["orders"], state["products"])


def test_refresh_equals_full_rebuild(spark, states):
    before, after, changed = states
    previous = _mart(before)
    refreshed = refresh_daily_sales(previous, before, after, changed)
    assert sorted(refreshed.collect()) == sorted(_mart(after).collect())


def test_only_a_part_of_the_dates_is_recomputed(spark, states):
    before, after, changed = states
    affected = affected_sale_dates(before, after, changed).count()
    total = _mart(after).select("sale_date").distinct().count()
    assert 0 < affected < total


def test_no_changes_keep_the_mart(spark, states):
    before, _, changed = states
    none = {k: v.limit(0) for k, v in changed.items()}
    previous = _mart(before)
    assert sorted(refresh_daily_sales(previous, before, before, none).collect()) == sorted(previous.collect())


def test_refreshed_products_and_customers_equal_full_rebuilds(spark, states):
    before, after, changed = states
    src = fixture_sources(spark, SF_SMALL, ["customers"])
    c = src["customers"]
    moved = c.withColumn("city", F.when(F.col("customer_id") % 19 == 3, F.lit("elsewhere")).otherwise(F.col("city")))
    was, now = before | {"customers": C.clean_customers(c)}, after | {"customers": C.clean_customers(moved)}
    keys = changed | {"customers": c.filter(F.col("customer_id") % 19 == 3).select("customer_id").distinct()}
    perf = product_performance(was["order_items"], was["orders"], was["products"])
    got = refresh_product_performance(perf, was, now, keys)
    assert sorted(got.collect()) == sorted(product_performance(now["order_items"], now["orders"], now["products"]).collect())
    got = refresh_customer_ltv(customer_ltv(was["orders"], was["customers"]), was, now, keys)
    assert sorted(got.collect()) == sorted(customer_ltv(now["orders"], now["customers"]).collect())


def test_order_that_gets_a_date_leaves_the_row_without_one(spark, states):
    before, _, changed = states
    hit = F.col("order_id") % 31 == 1
    was = before | {"orders": before["orders"].withColumn(
        "order_date", F.when(hit, F.lit(None).cast("timestamp_ntz")).otherwise(F.col("order_date")))}
    none = {k: v.limit(0) for k, v in changed.items()} | {"orders": before["orders"].filter(hit).select("order_id")}
    got = refresh_daily_sales(_mart(was), was, before, none)
    assert sorted(got.collect()) == sorted(_mart(before).collect())


# ---- marts from sums and signed deltas ------------------------------------------------------------
def _by_deltas(states):
    before, after, keys = states
    ch = D.changes_between(before, after, keys)
    was, now = D.touched_states(after, ch)
    daily = D.apply_delta(D.add_up(D.daily_rows(before), D.DAILY), D.difference(D.daily_rows(now), D.daily_rows(was), D.DAILY), D.DAILY)
    rows = D.product_rows(before)
    totals, _ = D.product_deltas(D.product_rows(now), D.product_rows(was), D.pairs_of(rows))
    perf = D.apply_delta(D.with_customers(rows, D.pairs_of(rows)), totals, D.PRODUCTS)
    return D.daily_sales(daily), D.product_performance(perf, after["products"])


def _rows(df):
    return sorted(map(repr, df.collect()))


def test_marts_from_deltas_equal_full_rebuilds(spark, states):
    _, after, _ = states
    daily, perf = _by_deltas(states)
    assert daily.dtypes == _mart(after).dtypes and _rows(daily) == _rows(_mart(after))
    want = product_performance(after["order_items"], after["orders"], after["products"])
    assert perf.dtypes == want.dtypes and _rows(perf) == _rows(want)


def test_odd_values_can_be_taken_back(spark, states):
    """NaN, infinities, large and missing values that come and go, rows without dates and keys."""
    before, _, keys = states
    items, orders = before["order_items"], before["orders"]
    odd = F.when(F.col("item_id") % 5 == 0, float("nan")).when(F.col("item_id") % 5 == 1, float("inf")).when(
        F.col("item_id") % 5 == 2, 2e12).when(F.col("item_id") % 5 == 3, F.lit(None).cast("double")).otherwise(float("-inf"))
    hit = F.col("item_id") % 53 == 3
    strange = before | {"order_items": items.withColumns({c: F.when(hit, odd).otherwise(F.col(c)) for c in ("line_total", "unit_price", "discount_pct")})
                        .withColumn("item_id", F.when(F.col("item_id") == 3, F.lit(None).cast("long")).otherwise(F.col("item_id"))),
                        "orders": orders.withColumn("discount_pct", F.when(F.col("order_id") % 37 == 1, float("nan")).otherwise(F.col("discount_pct")))
                        .withColumn("order_date", F.when(F.col("order_id") % 41 == 2, F.lit(None).cast("timestamp_ntz")).otherwise(F.col("order_date")))}
    null = keys["order_items"].limit(1).select(F.lit(None).cast("long").alias("item_id"))
    keys = keys | {"order_items": keys["order_items"].unionByName(null).unionByName(null.select(F.lit(3).cast("long").alias("item_id"))).distinct()}
    for a, b in ((before, strange), (strange, before)):
        daily, perf = _by_deltas((a, b, keys))
        assert _rows(daily) == _rows(_mart(b))
        assert _rows(perf) == _rows(product_performance(b["order_items"], b["orders"], b["products"]))


def test_emptied_and_first_filled_states(spark, states):
    before, _, _ = states
    none = {t: df.limit(0) for t, df in before.items()}
    keys = {t: before[t].select(k).distinct() for t, k in (("orders", "order_id"), ("order_items", "item_id"), ("products", "product_id"))}
    for a, b in ((none, before), (before, none)):
        daily, perf = _by_deltas((a, b, keys))
        assert _rows(daily) == _rows(_mart(b))
        assert _rows(perf) == _rows(product_performance(b["order_items"], b["orders"], b["products"]))


def test_the_old_state_is_not_read(spark, states):
    """Contributions before the changes come from the new state and the changed rows."""
    before, after, keys = states
    where = {}
    for name, state in (("before", before), ("after", after)):
        for t, df in state.items():
            where[name, t] = scratch_path(spark, f"t_{name}_{t}")
            df.write.parquet(where[name, t])
    stored = {n: {t: spark.read.parquet(where[n, t]) for t in before} for n in ("before", "after")}
    was, now = D.touched_states(stored["after"], D.changes_between(before, after, keys))
    for state in (was, now):
        for df in (D.daily_rows(state), D.product_rows(state)):
            plan = df._jdf.queryExecution().optimizedPlan().toString()
            assert not any(where["before", t] in f for t in before for f in df.inputFiles()), plan
            assert not any(where["after", "order_items"].removeprefix("file:") in f for f in df.inputFiles()), "only the touched items"


def test_versions_of_sums_over_runs(spark, monkeypatch):
    """Marts from deltas over four runs, one that publishes nothing and one that adds up the pairs, equal a full rebuild."""
    import datetime as dt
    from tillroll.operators.quality import QualityGateError
    from tillroll.plans import pipeline, sums
    from tillroll.sources.extract import ntz
    monkeypatch.setattr(sums, "CHAIN", 2)
    src = fixture_sources(spark, SF_SMALL)
    base, top = scratch_path(spark, "t_sums"), src["orders"].agg(F.max("updated_at")).first()[0]
    called = []
    real = sums.write_changed
    monkeypatch.setattr(sums, "write_changed", lambda *a: called.append(a[3]) or real(*a))
    for day in range(4):
        if day:
            hit = F.col("order_id") % 11 == day
            src = src | {"orders": src["orders"].withColumns({
                "status": F.when(hit, F.lit("cancelled")).otherwise(F.col("status")),
                "customer_id": F.when(F.col("order_id") % 22 == day, F.lit(7).cast("long")).otherwise(F.col("customer_id")),
                "updated_at": F.when(hit, ntz(top + dt.timedelta(days=day))).otherwise(F.col("updated_at"))})}
        pipeline.run_full(spark, src, base, {"customer_ltv": 100}, "t_sums_db", dt.date(2024, 3, 1 + day), incremental=True)
    assert called == [2, 3, 4]
    assert sums.pair_versions(spark, base, 4) == [3, 4]  # version 3 has added up its predecessors
    p = pipeline.read_processed(spark, base)
    want = pipeline.build_marts(p)
    for m, df in pipeline.read_marts(spark, base).items():
        assert _rows(df.drop("_processed_at")) == _rows(want[m]), m
    # a run that the gate stops leaves sums that no later run builds on
    with pytest.raises(QualityGateError):
        pipeline.run_full(spark, src, base, {"customer_ltv": 10**9}, "t_sums_db", dt.date(2024, 3, 8), incremental=True)
    later = src | {"orders": src["orders"].withColumns({
        "total_amount": F.when(F.col("order_id") % 11 == 5, F.lit(3.0)).otherwise(F.col("total_amount")),
        "updated_at": F.when(F.col("order_id") % 11 == 5, ntz(top + dt.timedelta(days=9))).otherwise(F.col("updated_at"))})}
    pipeline.run_full(spark, later, base, {"customer_ltv": 100}, "t_sums_db", dt.date(2024, 3, 9), incremental=True)
    want = pipeline.build_marts(pipeline.read_processed(spark, base))
    for m, df in pipeline.read_marts(spark, base).items():
        assert _rows(df.drop("_processed_at")) == _rows(want[m]), m


# ---- both states from one dedupe (F5) --------------------------------------------------------------
def _versioned(spark):
    """Keys with early, late, equal, missing stamps and a missing key; rows that come twice."""
    rows = [(1, "1997-01-01", "a"), (1, "1997-06-01", "b"), (2, "1997-01-01", "c"), (2, "1999-01-01", "d"), (2, "1999-01-01", "e"),
            (3, "1999-01-01", "f"), (4, None, "g"), (5, None, "z"), (5, "1997-01-01", "h"), (6, "1997-01-01", None), (6, "1997-01-01", None),
            (None, "1997-01-01", "i"), (None, "1999-01-01", "j"), (7, None, "k"), (7, "1999-01-01", "l")]
    return spark.createDataFrame(rows, "k long, ts string, v string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def test_two_states_from_one_pass_equal_two_dedupes(spark):
    from tillroll.operators.dedupe import dedupe_latest, latest_in_two_states
    from tillroll.sources.extract import ntz
    df, split = _versioned(spark), ntz("1998-01-01")
    both = latest_in_two_states(df, "k", "ts", split)
    for state, rows in (("in_before", df.filter(F.col("ts") <= split)), ("in_after", df)):
        got = both.filter(state).select("k", "ts", "v")
        assert _rows(got) == _rows(dedupe_latest(rows, "k", "ts"))
    keys = both.filter("changed AND in_after").select("k")
    assert _rows(keys) == _rows(df.filter(F.col("ts") > split).select("k").distinct())


def test_marked_changes_equal_joined_ones(spark, states):
    before, after, keys = states
    marked = []
    for state in (before, after):
        marked.append({t: df.join(keys[t].distinct().withColumn("hit", F.lit(True)), keys[t].columns[0], "left")
                      .withColumn("hit", F.coalesce("hit", F.lit(False))) for t, df in state.items()})
    ch = D.changes_between(*marked, keys, "hit")
    was, now = D.touched_states(marked[1], ch)
    plan = D.daily_rows(was)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" not in plan
    want = D.touched_states(after, D.changes_between(before, after, keys))
    for got, other in zip((was, now), want, strict=True):
        assert _rows(D.daily_rows(got)) == _rows(D.daily_rows(other))
        assert _rows(D.product_rows(got)) == _rows(D.product_rows(other))


def test_refresh_shuffles_each_table_once_for_both_states(spark):
    """The states of items are one written table, and rows of changed keys are found in it without a join."""
    from tillroll.plans import catalog
    before, after, changed = catalog._states(spark, SF_SMALL)
    for t in before:
        assert sorted(before[t].inputFiles()) == sorted(after[t].inputFiles()) == sorted(changed[t].inputFiles())
    ch = D.changes_between(before, after, changed, "changed")
    assert "Join" not in ch.new["order_items"]._jdf.queryExecution().optimizedPlan().toString()


def test_lines_are_shuffled_by_order_once(spark, states):
    before, _, _ = states
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = D.daily_rows(before)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("hashpartitioning(order_id") == 2, plan  # lines and orders, for the join and the sums
