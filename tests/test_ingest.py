import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tillroll import schemas
from tillroll.session import scratch_path
from tillroll.sinks import writers as K
from tillroll.sources import extract as S
from tillroll.sources.fixtures import fixture_sources
from tillroll.sources.raw import NoRawFilesError, read_raw_all
from tillroll.streaming.incremental import ingest_available_now, read_sink


@pytest.fixture(scope="module")
def sources(spark):
    return fixture_sources(spark, SF_SMALL)


def test_second_extract_run_finds_nothing(spark, sources):
    root = scratch_path(spark, "t_extract")
    first = {r["table_name"]: r for r in S.run_extract(spark, sources, f"{root}/raw", f"{root}/state").collect()}
    assert all(r["status"] == "success" for r in first.values())
    second = S.run_extract(spark, sources, f"{root}/raw", f"{root}/state").collect()
    assert {r["status"] for r in second} == {"skipped"} and sum(r["rows"] for r in second) == 0
    landed = read_raw_all(spark, f"{root}/raw", "orders", schemas.ORDERS)
    assert landed.count() == first["orders"]["rows"] == sources["orders"].count()


def test_incremental_batches_union_to_full_load(spark, sources):
    orders = sources["orders"]
    wm = dt.datetime(1998, 1, 1)
    old = orders.filter(F.col("updated_at") <= S.ntz(wm))
    new = S.extract(sources, "orders", wm)
    assert sorted(old.unionByName(new).collect()) == sorted(orders.collect())


def test_strict_watermark_skips_equal_timestamp(spark, sources):
    top = sources["orders"].agg(F.max("updated_at")).first()[0]
    assert S.extract(sources, "orders", top).count() == 0


def test_missing_state_row_starts_at_epoch(spark):
    state = S.state_frame(spark, {"orders": dt.datetime(2000, 1, 1)})
    assert S.watermark_value(state, "products") == S.EPOCH
    assert S.watermark_value(state, "orders") == dt.datetime(2000, 1, 1)


def test_advance_keeps_mark_on_empty_batch(spark):
    state = S.state_frame(spark, {"orders": dt.datetime(2000, 1, 1)})
    bm = spark.createDataFrame([("orders", None)], "table_name string, batch_max timestamp_ntz")
    out = {r["table_name"]: r["last_extracted"] for r in S.advance(state, bm).collect()}
    assert out["orders"] == dt.datetime(2000, 1, 1) and out["customers"] == S.EPOCH


def test_error_in_one_table_does_not_stop_others(spark, sources):
    root = scratch_path(spark, "t_err")
    broken = dict(sources)
    broken["products"] = sources["products"].withColumn("updated_at", F.lit("x").cast("int"))
    rows = {r["table_name"]: r for r in S.run_extract(spark, broken, f"{root}/raw", f"{root}/state").collect()}
    assert rows["products"]["status"] == "error" and rows["orders"]["status"] == "success"
    with pytest.raises(Exception):
        S.run_extract(spark, broken, f"{root}/raw2", f"{root}/state2", fail_on_error=True)


def test_raw_reader_raises_when_nothing_landed(spark):
    with pytest.raises(NoRawFilesError):
        read_raw_all(spark, scratch_path(spark, "t_none"), "orders", schemas.ORDERS)


def test_nested_layout_reads_every_batch(spark, sources):
    root = scratch_path(spark, "t_nested")
    o = sources["orders"]
    o.filter("order_id % 2 = 0").write.parquet(f"{root}/orders/2024/01/01")
    o.filter("order_id % 2 = 1").write.parquet(f"{root}/orders/2024/01/02")
    assert read_raw_all(spark, root, "orders", schemas.ORDERS, layout="nested").count() == o.count()


def test_stream_available_now_is_exactly_once(spark, sources):
    root = scratch_path(spark, "t_stream")
    clicks = sources["clickstream"]
    K.land_raw(clicks.filter("event_id % 2 = 0"), f"{root}/raw", "clickstream", "2024-02-01")
    args = (spark, f"{root}/raw/clickstream", schemas.CLICKSTREAM, f"{root}/sink", f"{root}/ckpt")
    first = ingest_available_now(*args)
    assert ingest_available_now(*args) == 0
    K.land_raw(clicks.filter("event_id % 2 = 1"), f"{root}/raw", "clickstream", "2024-02-02")
    second = ingest_available_now(*args)
    assert first + second == clicks.count()
    assert read_sink(spark, f"{root}/sink", schemas.CLICKSTREAM).count() == clicks.count()


def test_permissive_load_splits_rejects(spark):
    df = spark.createDataFrame([("1", "2"), ("x", "3"), (None, "4")], "ITEM_ID string, Quantity string")
    ok, bad = K.load_by_name_permissive(df, schemas.ORDER_ITEMS)
    assert ok.count() == 2 and bad.count() == 1 and bad.first()["ITEM_ID"] == "x"


def test_drifting_raw_batches_read_with_declared_schema(spark):
    root = scratch_path(spark, "t_drift")
    spark.createDataFrame([(1, 2)], "item_id long, order_id long").write.parquet(f"{root}/order_items/b=1")
    spark.createDataFrame([(3, None)], "item_id long, order_id string").write.parquet(f"{root}/order_items/b=2")
    with pytest.raises(Exception):
        spark.read.parquet(f"{root}/order_items").collect()


def test_extract_lands_declared_types(spark, sources):
    root = scratch_path(spark, "t_declared")
    drifting = dict(sources)
    # A source whose quantity arrives as BIGINT: landed as the declared INT.
    drifting["order_items"] = sources["order_items"].withColumn("quantity", F.col("quantity").cast("long"))
    S.run_extract(spark, drifting, f"{root}/raw", f"{root}/state", tables=["orders", "order_items"],
                  fail_on_error=True)
    import glob
    import pyarrow.parquet as pq
    files = glob.glob(root.replace("file:", "") + "/raw/order_items/*/*.parquet")
    assert files and all(str(pq.read_schema(f).field("quantity").type) == "int32" for f in files)


def test_backlog_is_consumed_in_bounded_batches(spark, sources):
    root = scratch_path(spark, "t_batches")
    clicks = sources["clickstream"]
    for day in range(3):
        K.land_raw(clicks.filter(F.col("event_id") % 3 == day), f"{root}/raw", "clickstream",
                   f"2024-02-0{day + 1}")
    rows = ingest_available_now(spark, f"{root}/raw/clickstream", schemas.CLICKSTREAM,
                                f"{root}/sink", f"{root}/ckpt", max_files_per_batch=1)
    assert rows == clicks.count()
    import glob
    batches = glob.glob(root.replace("file:", "") + "/sink/batch_id=*")
    assert len(batches) >= 3


def test_parent_policy_advances_on_order_stamp(spark, sources):
    wm = dt.datetime(1998, 1, 1)
    hw = S.batch_high_water(sources, "order_items", wm, "parent").first()["batch_max"]
    want = (sources["orders"].join(sources["order_items"].select("order_id"), "order_id", "left_semi")
            .filter(F.col("updated_at") > S.ntz(wm)).agg(F.max("updated_at")).first()[0])
    assert hw == want


def test_incremental_latest_keeps_filtered_newest_versions(spark):
    from tillroll.operators.clean import clean_customers
    from tillroll.streaming.incremental import maintain_latest, read_latest
    root = scratch_path(spark, "t_latest")
    T1, T2, T0 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), dt.datetime(2023, 12, 31)

    def row(cid, email, ts):
        return (cid, "F", "L", email, None, "c", "n", dt.date(2020, 1, 1), "gold", ts, ts)

    batches = [[row(1, "a@x", T1), row(2, "b@x", T1)],
               [row(1, None, T2)],                       # newest version of 1 is invalid
               [row(1, "late@x", T0), row(3, "c@x", T0)]]  # late, older version of 1
    every = []
    for day, rows in enumerate(batches, start=1):
        every += rows
        K.land_raw(spark.createDataFrame(rows, schemas.CUSTOMERS), f"{root}/raw", "customers",
                   f"2024-02-0{day}")
        maintain_latest(spark, f"{root}/raw/customers", schemas.CUSTOMERS, "customer_id", "updated_at",
                        f"{root}/latest", f"{root}/ckpt")
        latest = read_latest(spark, f"{root}/latest", schemas.CUSTOMERS)
        full = clean_customers(spark.createDataFrame(every, schemas.CUSTOMERS))
        assert sorted(clean_customers(latest, deduped=True).collect()) == sorted(full.collect())
    assert {r["customer_id"] for r in clean_customers(latest, deduped=True).collect()} == {2, 3}


def test_incremental_pipeline_matches_full_history(spark):
    from tillroll.plans.pipeline import run_full
    floors = {"customer_ltv": 100}
    full = run_full(spark, fixture_sources(spark, SF_SMALL), scratch_path(spark, "t_full_a"), floors,
                    database="t_full_a")
    inc = run_full(spark, fixture_sources(spark, SF_SMALL), scratch_path(spark, "t_full_b"), floors,
                   database="t_full_b", incremental=True)
    assert sorted(full.collect()) == sorted(inc.collect())


def test_latest_survives_lost_checkpoint_and_keeps_two_copies(spark, sources):
    import glob
    from tillroll.streaming.incremental import maintain_latest, read_latest
    root = scratch_path(spark, "t_latest_ckpt")
    orders = sources["orders"]
    K.land_raw(orders, f"{root}/raw", "orders", "2024-02-01")
    args = (spark, f"{root}/raw/orders", schemas.ORDERS, "order_id", "updated_at", f"{root}/latest")
    for ckpt in ("a", "a", "b", "c"):  # a second run, then two fresh checkpoints re-reading everything
        maintain_latest(*args, f"{root}/{ckpt}")
    latest = read_latest(spark, f"{root}/latest", schemas.ORDERS)
    assert sorted(latest.collect()) == sorted(orders.collect())
    copies = [f.rsplit("=", 1)[1] for f in glob.glob(root.replace("file:", "") + "/latest/rows/v=*/bucket=*")]
    assert all(copies.count(b) <= 2 for b in copies)


def test_incremental_pipeline_over_two_days_matches_full_rebuild(spark):
    import datetime as dt2
    from tillroll.plans.pipeline import MART_NAMES, read_marts, run_full
    floors = {"customer_ltv": 100}
    day1 = fixture_sources(spark, SF_SMALL)
    # Day 2: every seventh order is cancelled with a newer stamp; the rest is unchanged.
    day2 = dict(day1)
    hit = F.col("order_id") % 7 == 0
    day2["orders"] = (day1["orders"]
                      .withColumn("status", F.when(hit, F.lit("cancelled")).otherwise(F.col("status")))
                      .withColumn("updated_at", F.when(hit, F.col("updated_at") + F.expr("INTERVAL 40 DAYS"))
                                  .otherwise(F.col("updated_at"))))
    inc = scratch_path(spark, "t_two_days")
    run_full(spark, day1, inc, floors, database="t_inc_a", ingest_date=dt2.date(2024, 3, 1), incremental=True)
    manifest = {(r["stage"], r["dataset"]): r["rows"] for r in run_full(
        spark, day2, inc, floors, database="t_inc_a", ingest_date=dt2.date(2024, 3, 2), incremental=True).collect()}
    top = day1["orders"].agg(F.max("updated_at")).first()[0]
    assert manifest[("extract", "orders")] == day2["orders"].filter(hit & (F.col("updated_at") > S.ntz(top))).count() > 0
    full = scratch_path(spark, "t_two_days_full")
    # what the second day's stamps let through, on top of the first day
    seen = dict(day1)
    late = day2["orders"].filter(hit & (F.col("updated_at") > S.ntz(top)))
    seen["orders"] = day1["orders"].join(late, "order_id", "left_anti").unionByName(late)
    run_full(spark, seen, full, floors, database="t_inc_b")
    got, want = read_marts(spark, inc), read_marts(spark, full)
    for name in MART_NAMES:
        a = sorted(got[name].drop("_processed_at").collect())
        b = sorted(want[name].drop("_processed_at").collect())
        assert a == b, name


def test_items_of_every_order_are_landed_over_two_runs(spark, sources):
    """Items are found by their order's stamp, and the watermark follows that stamp."""
    split = S.ntz("1998-01-01")
    early = dict(sources)
    early["orders"] = sources["orders"].filter(F.col("updated_at") <= split)
    landed = {}
    for policy in ("parent", "reference"):
        root = scratch_path(spark, f"t_two_{policy}")
        for day, src in (("2024-03-01", early), ("2024-03-02", sources)):
            S.run_extract(spark, src, f"{root}/raw", f"{root}/state", ["orders", "order_items"],
                          dt.date.fromisoformat(day), policy, fail_on_error=True)
        landed[policy] = read_raw_all(spark, f"{root}/raw", "order_items", schemas.ORDER_ITEMS).select("item_id").distinct().count()
    assert landed["parent"] == (sources["order_items"].join(sources["orders"], "order_id", "left_semi")
                                .select("item_id").distinct().count())
    assert landed["reference"] < landed["parent"]  # why it is not the default


def test_watermark_literal_does_not_depend_on_the_hosts_zone(spark, monkeypatch):
    import time
    rows = spark.createDataFrame([("1998-01-01 03:00:00",)], "t string").select(F.col("t").cast("timestamp_ntz").alias("updated_at"))
    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        assert S.extract({"orders": rows}, "orders", dt.datetime(1998, 1, 1)).count() == 1
        assert S.extract({"orders": rows}, "orders", dt.datetime(1998, 1, 1, 3)).count() == 0
    finally:
        monkeypatch.undo()
        time.tzset()


def test_failed_extract_stops_a_full_run_and_keeps_the_whole_message(spark, sources):
    from tillroll.plans.pipeline import run_full
    root = scratch_path(spark, "t_fail")
    broken = dict(sources)
    broken["products"] = sources["products"].withColumn("updated_at", F.raise_error(F.lit("x" * 3000)).cast("timestamp_ntz"))
    with pytest.raises(S.ExtractError):
        run_full(spark, broken, root, {"customer_ltv": 100}, "t_fail_db")
    rows = S.run_extract(spark, broken, f"{root}/raw", f"{root}/other_state").collect()
    assert max(len(r["error"] or "") for r in rows) > 3000


def test_partial_version_is_never_read(spark, sources):
    """Rows that a broken fold left behind are of a version that was not committed."""
    from tillroll.streaming.incremental import committed_version, maintain_latest, read_latest
    root = scratch_path(spark, "t_partial")
    orders = sources["orders"]
    K.land_raw(orders, f"{root}/raw", "orders", "2024-02-01")
    args = (spark, f"{root}/raw/orders", schemas.ORDERS, "order_id", "updated_at", f"{root}/latest", f"{root}/ckpt")
    v = maintain_latest(*args)
    orders.limit(3).write.mode("append").parquet(f"{root}/latest/rows/v={v + 1}/bucket=0")
    assert committed_version(spark, f"{root}/latest") == v
    K.land_raw(orders.limit(5), f"{root}/raw", "orders", "2024-02-02")
    assert maintain_latest(*args) == v + 1
    assert sorted(read_latest(spark, f"{root}/latest", schemas.ORDERS).collect()) == sorted(orders.collect())


def test_failed_gate_leaves_the_marts_of_the_last_run(spark, sources):
    from tillroll.operators.quality import QualityGateError
    from tillroll.plans.pipeline import read_marts, run_full
    root = scratch_path(spark, "t_gate")
    run_full(spark, sources, root, {"customer_ltv": 100}, "t_gate_db")
    before = {m: sorted(df.drop("_processed_at").collect()) for m, df in read_marts(spark, root).items()}
    with pytest.raises(QualityGateError):
        run_full(spark, sources, root, {"customer_ltv": 10 ** 6}, "t_gate_db")
    assert {m: sorted(df.drop("_processed_at").collect()) for m, df in read_marts(spark, root).items()} == before
    assert spark.table("t_gate_db.daily_sales").count() == len(before["daily_sales"])


def test_batches_of_a_failed_run_are_published_by_the_next(spark, sources):
    import datetime as dt2

    from tillroll.operators.quality import QualityGateError
    from tillroll.plans.pipeline import run_full, unpublished
    from tillroll.sources.raw import read_folder
    root = scratch_path(spark, "t_late_publish")
    with pytest.raises(QualityGateError):
        run_full(spark, sources, root, {"customer_ltv": 10 ** 6}, "t_late_db", dt2.date(2024, 3, 1))
    run_full(spark, sources, root, {"customer_ltv": 50}, "t_late_db", dt2.date(2024, 3, 2))
    for t in schemas.SOURCES:
        landed, published = (read_folder(spark, f"{root}/{at}/{t}") for at in ("raw", "published/raw"))
        assert published is not None and published.count() == landed.count() > 0
        assert landed.exceptAll(published.select(landed.columns)).isEmpty()
        assert unpublished(spark, landed, f"{root}/published/raw/{t}").isEmpty()
    K.land_raw(sources["orders"].limit(5), f"{root}/raw", "orders", "2024-03-01")
    late = unpublished(spark, read_folder(spark, f"{root}/raw/orders"), f"{root}/published/raw/orders")
    assert late.count() == sources["orders"].count() + 5


def test_runs_leave_no_stage_tables(spark, sources):
    from tillroll import session
    from tillroll.plans.pipeline import process
    held = len(session._STAGES)
    process(spark, {t: sources[t] for t in ("customers", "products", "orders", "order_items")}, scratch_path(spark, "t_stages"))
    assert len(session._STAGES) == held


def test_union_by_name_of_an_empty_folder_is_an_empty_frame(spark, tmp_path):
    from tillroll.sources.raw import read_union_by_name
    (tmp_path / "none").mkdir()
    for name in ("none", "missing"):
        df = read_union_by_name(spark, str(tmp_path / name))
        assert df.columns == [] and df.count() == 0


def test_a_fold_shuffles_rows_once_and_keeps_the_newest(spark):
    from tillroll.operators.dedupe import merge_latest
    from tillroll.streaming.incremental import bucket_of
    rows = [(k, s, f"v{s}") for k in (1, 2, 3, None) for s in (1, 3, 2)]
    df = spark.createDataFrame(rows, "id long, stamp int, v string").withColumn("bucket", bucket_of("id", 4))
    merged = merge_latest(df.filter("stamp = 1"), df.filter("stamp > 1"), ["bucket", "id"], "stamp", deal_by="bucket")
    assert sorted((r.id or 0, r.v) for r in merged.collect()) == [(0, "v3"), (1, "v3"), (2, "v3"), (3, "v3")]
    assert merged._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Exchange hashpartitioning(bucket") == 1
    assert "hashpartitioning(id" not in merged._jdf.queryExecution().executedPlan().toString()


def test_the_first_fold_stores_its_rows_once_in_buckets_by_size(spark, tmp_path, monkeypatch):
    from tillroll.streaming import incremental as I
    monkeypatch.setattr(I, "BUCKET_BYTES", 100)
    c, latest = fixture_sources(spark, SF_SMALL, ["customers"])["customers"], f"{tmp_path}/latest"
    K.land_raw(c, f"{tmp_path}/raw", "customers", "2024-02-01")
    args = (spark, f"{tmp_path}/raw/customers", schemas.CUSTOMERS, "customer_id", "updated_at", latest, f"{tmp_path}/ckpt")
    assert I.maintain_latest(*args) == 0
    assert I.committed_buckets(spark, latest) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert not (tmp_path / "latest/changes").exists()
    old, new = I.changed_rows(spark, latest, schemas.CUSTOMERS, 0)
    assert old.isEmpty() and sorted(new.collect(), key=str) == sorted(I.read_latest(spark, latest, schemas.CUSTOMERS).collect(), key=str)
    K.land_raw(c.filter("customer_id < 5").withColumn("city", F.lit("x")), f"{tmp_path}/raw", "customers", "2024-02-02")
    assert I.maintain_latest(*args) == 1
    assert I.changed_rows(spark, latest, schemas.CUSTOMERS, 0) is None
    assert all(not df.isEmpty() for df in I.changed_rows(spark, latest, schemas.CUSTOMERS, 1))
