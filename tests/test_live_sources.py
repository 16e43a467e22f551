"""Extraction from sources that change while they are read, and from late ones."""
import datetime as dt
import glob
import os
import threading

import pytest
from pyspark.sql import functions as F

from tillroll import schemas
from tillroll.session import scratch_path
from tillroll.sinks.log import append_log, newest_rows, newest_version, read_log
from tillroll.sources import extract as S
from tillroll.sources.raw import read_raw_all

T = [dt.datetime(2024, 1, d) for d in range(1, 20)]
DAY = [dt.date(2024, 2, d) for d in range(1, 6)]


def order(oid, ts, status="pending"):
    return (oid, 1, ts, status, "card", "c", "n", 0.0, 10.0, ts, ts)


def item(iid, oid, ts=T[0]):
    return (iid, oid, 1, 1, 10.0, 0.0, 10.0, ts)


class Source(dict):
    """Source tables that read their rows anew each time they are asked for."""

    def __init__(self, spark, orders, items, after_each_read=lambda self, table: None):
        super().__init__(orders=orders, order_items=items)
        self.spark, self.hook = spark, after_each_read

    def __getitem__(self, table):
        rows = spark_rows(self.spark, table, list(super().__getitem__(table)))
        self.hook(self, table)
        return rows

    def rows(self, table):
        return super().__getitem__(table)


def spark_rows(spark, table, rows):
    return spark.createDataFrame(rows, schemas.SOURCES[table])


def run(spark, source, root, day, **kw):
    out = S.run_extract(spark, source, f"{root}/raw", f"{root}/state", ["orders", "order_items"], day, fail_on_error=True, **kw)
    return {r["table_name"]: r["rows"] for r in out.collect()}


def landed(spark, root, table):
    return sorted(r[0] for r in read_raw_all(spark, f"{root}/raw", table, schemas.SOURCES[table]).collect())


def test_rows_that_arrive_during_a_run_are_landed_by_the_next(spark):
    """Whatever read a new order comes after, its item is landed, and only once."""
    lock = threading.Lock()
    for at in range(1, 7):
        reads = []

        def arrive(self, table, at=at, reads=reads):
            with lock:
                reads.append(table)
                if len(reads) == at:
                    self.rows("orders").append(order(2, T[5]))
                    self.rows("order_items").append(item(20, 2))

        root = scratch_path(spark, f"t_live_{at}")
        source = Source(spark, [order(1, T[1])], [item(10, 1)], arrive)
        for day in DAY[:3]:
            run(spark, source, root, day)
        assert landed(spark, root, "orders") == [1, 2] and landed(spark, root, "order_items") == [10, 20], at


def test_rows_that_share_the_marks_stamp_arrive_in_run_two(spark):
    root = scratch_path(spark, "t_ties")
    source = Source(spark, [order(1, T[3])], [item(10, 1)])
    assert run(spark, source, root, DAY[0]) == {"orders": 1, "order_items": 1}
    source.rows("orders").append(order(2, T[3]))
    source.rows("order_items").append(item(20, 2))
    assert run(spark, source, root, DAY[1]) == {"orders": 1, "order_items": 1}
    assert run(spark, source, root, DAY[2]) == {"orders": 0, "order_items": 0}
    assert landed(spark, root, "orders") == [1, 2] and landed(spark, root, "order_items") == [10, 20]
    strict = scratch_path(spark, "t_ties_strict")
    source = Source(spark, [order(1, T[3])], [item(10, 1)])
    run(spark, source, strict, DAY[0])
    source.rows("orders").append(order(2, T[3]))
    assert run(spark, source, strict, DAY[1], overlap=None) == {"orders": 0, "order_items": 0}  # as the original


def test_late_rows_are_found_in_the_window_and_only_there(spark):
    root = scratch_path(spark, "t_late")
    source = Source(spark, [order(1, T[10])], [item(10, 1)])
    run(spark, source, root, DAY[0])
    source.rows("orders").extend([order(2, T[8]), order(3, T[2]), order(1, T[8], "older version")])
    source.rows("order_items").extend([item(20, 2), item(30, 3), item(11, 1)])
    got = run(spark, source, root, DAY[1], overlap=dt.timedelta(days=4))
    assert got == {"orders": 2, "order_items": 2}  # 2 and the other version of 1; the items 20 and 11
    assert landed(spark, root, "orders") == [1, 1, 2] and landed(spark, root, "order_items") == [10, 11, 20]
    assert run(spark, source, root, DAY[2], overlap=dt.timedelta(days=4)) == {"orders": 0, "order_items": 0}
    assert run(spark, source, root, DAY[3], overlap=dt.timedelta(days=9)) == {"orders": 1, "order_items": 1}


def test_late_rows_of_a_lake_from_before_the_ledger(spark):
    """State without batches: everything landed is looked at."""
    from tillroll.sinks.writers import land_raw
    root = scratch_path(spark, "t_no_ledger")
    land_raw(spark_rows(spark, "orders", [order(1, T[3])]), f"{root}/raw", "orders", DAY[0], "updated_at")
    S.commit_state(spark, f"{root}/state", S.state_frame(spark, {"orders": T[3], "order_items": T[3]}))
    source = Source(spark, [order(1, T[3]), order(2, T[3])], [])
    assert run(spark, source, root, DAY[1])["orders"] == 1
    assert landed(spark, root, "orders") == [1, 2]


def test_the_ledger_names_every_batch_and_its_files(spark):
    root = scratch_path(spark, "t_ledger")
    source = Source(spark, [order(1, T[1])], [item(10, 1)])
    run(spark, source, root, DAY[0])
    source.rows("orders").append(order(2, T[2]))
    run(spark, source, root, DAY[0])  # the same day
    ledger = S.read_ledger(spark, f"{root}/state").filter("table_name = 'orders'").orderBy("last_extracted").collect()
    assert [(r.rows, r.ingest_date, r.last_extracted) for r in ledger] == [(1, DAY[0], T[1]), (1, DAY[0], T[2])]
    from tillroll.sources.raw import read_batches
    for r, oid in zip(ledger, (1, 2), strict=True):
        assert [x.order_id for x in read_batches(spark, f"{root}/raw/orders", schemas.ORDERS, [(r.ingest_date, r.batch)]).collect()] == [oid]


def test_tables_are_extracted_side_by_side_with_one_commit(spark):
    """All tables are under way at once; one that fails leaves the others."""
    together = threading.Barrier(2, timeout=60)

    def meet():
        together.wait()
        return spark.range(3).count()

    assert S.side_by_side({"a": meet, "b": meet}) == {"a": 3, "b": 3}
    root = scratch_path(spark, "t_side")
    source = {"orders": spark_rows(spark, "orders", [order(1, T[1])]),
              "order_items": spark_rows(spark, "order_items", [item(10, 1)]).withColumn("quantity", F.raise_error(F.lit("x")).cast("int"))}
    rows = {r.table_name: r for r in S.run_extract(spark, source, f"{root}/raw", f"{root}/state", ["orders", "order_items"]).collect()}
    assert rows["orders"].status == "success" and rows["order_items"].status == "error"
    assert newest_version(spark, f"{root}/state") == 1
    marks = {r.table_name: r.last_extracted for r in S.read_state(spark, f"{root}/state").collect()}
    assert marks["orders"] == T[1] and marks["order_items"] == S.EPOCH


def test_reading_a_log_writes_nothing(spark, tmp_path):
    from tillroll.streaming.incremental import committed_version
    where = str(tmp_path / "log")
    assert newest_version(spark, where) is None and newest_rows(spark, where, "version long, x int") == []
    assert S.read_state(spark, where).count() == 0 and committed_version(spark, where) is None
    assert not os.path.exists(where)
    append_log(spark, where, [(1, 7), (1, 8)], "version long, x int")
    append_log(spark, where, [(2, 9)], "version long, x int")
    files = sorted(glob.glob(f"{where}/**", recursive=True))
    for _ in range(3):
        assert newest_version(spark, where) == 2
        assert [r.x for r in newest_rows(spark, where, "version long, x int")] == [9]
        assert read_log(spark, where, "version long, x int").count() == 3
    assert sorted(glob.glob(f"{where}/**", recursive=True)) == files


def test_interval_is_closed_above(spark):
    source = {"orders": spark_rows(spark, "orders", [order(1, T[1]), order(2, T[2]), order(3, T[3])])}
    assert [r.order_id for r in S.extract(source, "orders", T[1], T[2]).collect()] == [2]
    assert S.upper_marks(source, {"orders": T[1]}) == {"orders": T[3]}
    assert S.upper_marks(source, {"orders": T[3]}) == {"orders": None}
    with pytest.raises(KeyError):
        raise S.upper_marks(source, {"products": T[1]})["products"]


def test_few_changed_orders_are_counted_first_and_items_are_not_shuffled(spark, monkeypatch):
    """What decides is the number of keys in the window, not the size of all orders or of the keys' files."""
    source = {t: spark_rows(spark, t, rows) for t, rows in (("orders", [order(i, T[i % 9]) for i in range(200)]),
                                                            ("order_items", [item(i, i % 250) for i in range(500)]))}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for most, join in ((1000, "BroadcastHashJoin"), (3, "SortMergeJoin")):
            monkeypatch.setattr(S, "BROADCAST_KEYS", most)
            df = S.extract(source, "order_items", T[3], T[5], store=True)
            assert join in df._jdf.queryExecution().executedPlan().toString()
            assert sorted(df.collect()) == sorted(S.extract(source, "order_items", T[3], T[5]).collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_landed_items_of_other_orders_are_not_compared(spark):
    source = {"orders": spark_rows(spark, "orders", [order(1, T[1]), order(2, T[4]), order(3, T[4])]),
              "order_items": spark_rows(spark, "order_items", [item(1, 1), item(2, 2), item(3, 2), item(4, 3), item(None, 3), item(6, None)])}
    landed = spark_rows(spark, "order_items", [item(1, 1), item(2, 2), item(3, 9), item(None, 3), item(6, None)])
    late = S.late_rows(source, "order_items", T[4], dt.timedelta(0), landed)
    assert sorted(r.item_id for r in late.collect()) == [3, 4]
    plan = late._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftSemi") == 2  # items and landed rows, both by the window's orders


def test_distinct_rows_equal_distinct_and_shuffle_hashes(spark):
    from tillroll.operators.dedupe import distinct_rows
    rows = [(1, "a", 0.0), (1, "a", -0.0), (1, None, None), (1, None, None), (None, "a", float("nan")), (None, "a", float("nan")),
            (2, "b", 1.0), (3, None, 1.0), (None, None, None), (1, "a", 2.0)]
    df = spark.createDataFrame(rows, "k long, s string, x double")
    got = distinct_rows(df)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, df.distinct().collect()))
    alone = distinct_rows(df.filter("x = 2.0 OR k = 3"))
    assert alone.count() == 2
