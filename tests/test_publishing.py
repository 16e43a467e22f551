"""The published version: batches copied once, partitions rewritten once, marts switched at once."""
import datetime as dt
import glob
import os

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from tillroll import schemas
from tillroll.plans import pipeline, processed, publishing
from tillroll.session import scratch_path
from tillroll.sources import extract as S
from tillroll.sources.fixtures import fixture_sources

FLOORS = {"customer_ltv": 100}
DAYS = [dt.date(2024, 3, d) for d in (1, 2, 3)]


@pytest.fixture(scope="module")
def sources(spark):
    return fixture_sources(spark, SF_SMALL)


def with_cancelled(spark, sources, n, days):
    """A later state of the sources: every n-th order cancelled ``days`` after the newest stamp, a month earlier."""
    top = sources["orders"].agg(F.max("updated_at")).first()[0]
    hit = F.col("order_id") % n == 0
    orders = sources["orders"].withColumns({
        "status": F.when(hit, F.lit("cancelled")).otherwise(F.col("status")),
        "order_date": F.when(hit, F.col("order_date") - F.expr("INTERVAL 35 DAYS")).otherwise(F.col("order_date")),
        "updated_at": F.when(hit, S.ntz(top + dt.timedelta(days=days))).otherwise(F.col("updated_at"))})
    return sources | {"orders": orders}


def contents(marts):
    return {m: sorted(df.drop("_processed_at").collect(), key=repr) for m, df in marts.items()}


def tables(spark, database):
    return {m: spark.table(f"{database}.{m}") for m in publishing.MARTS}


def plain(path):
    """The local path of a folder of the tests."""
    return path.removeprefix("file:")


def valid_order(sources):
    """One order that cleaning keeps."""
    return sources["orders"].filter("customer_id IS NOT NULL AND total_amount >= 0 AND order_date IS NOT NULL").orderBy("order_id").limit(1)


STEPS = ["publish_raw", "publish_processed", "publish_mart_copies", "switch", "register_views", "drop_superseded"]


def test_a_run_killed_at_any_step_leaves_three_marts_of_one_run(spark, sources, monkeypatch):
    base, database = scratch_path(spark, "t_steps"), "t_steps_db"
    pipeline.run_full(spark, sources, base, FLOORS, database, DAYS[0])
    marts = publishing.read_marts(spark, base)
    old = contents(marts)
    assert contents(tables(spark, database)) == old
    # the next run has landed its batch and built its marts
    S.run_extract(spark, with_cancelled(spark, sources, 5, 1), f"{base}/raw", f"{base}/state/watermarks", ingest_date=DAYS[1])
    frames = {m: df.limit(20) for m, df in marts.items()}
    switched = STEPS.index("switch") + 1
    for n, step in enumerate(STEPS):
        monkeypatch.setattr(publishing, step, lambda *args, **kw: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            publishing.publish_all(spark, base, frames, database)
        monkeypatch.undo()
        got = contents(publishing.read_marts(spark, base))
        assert contents(tables(spark, database)) == got
        assert {m: len(rows) for m, rows in got.items()} == {m: min(20, len(rows)) if n >= switched else len(rows) for m, rows in old.items()}
    publishing.publish_all(spark, base, frames, database)
    assert len(glob.glob(f"{plain(base)}/warehouse/daily_sales/version=*")) == 2
    for t in schemas.SOURCES:  # what broken runs have landed is in the lake, each batch once
        raw, copy = (spark.read.parquet(f"{base}/{at}/{t}") for at in ("raw", "published/raw"))
        assert raw.count() == copy.count() and raw.exceptAll(copy.select(raw.columns)).isEmpty()


def test_a_second_run_reads_no_raw_file_but_its_own(spark, sources):
    base, database = scratch_path(spark, "t_own"), "t_own_db"
    pipeline.run_full(spark, sources, base, FLOORS, database, DAYS[0], incremental=True)
    for t in schemas.SOURCES:  # unreadable from now on: the files of the first run
        for f in glob.glob(f"{plain(base)}/raw/{t}/*/batch-*.parquet"):
            with open(f, "wb") as out:
                out.write(b"not a Parquet file")
    later = with_cancelled(spark, sources, 5, 1)
    late_only = {t: df if t != "orders" else df.filter("status = 'cancelled'") for t, df in later.items()}
    ran = []

    def no_overlap(*args, **kw):
        ran.append(1)
        return S.run_extract(*args, **kw, overlap=None)

    pipeline.run_extract = no_overlap
    try:
        manifest = pipeline.run_full(spark, late_only, base, FLOORS, database, DAYS[1], incremental=True)
    finally:
        pipeline.run_extract = S.run_extract
    rows = {(r.stage, r.dataset): r.rows for r in manifest.collect()}
    assert ran and rows["publish", "raw/orders"] == rows["extract", "orders"] > 0 and rows["publish", "raw/products"] == 0


def test_untouched_partitions_keep_their_files(spark, sources):
    base, database = scratch_path(spark, "t_parts_inc"), "t_parts_inc_db"
    pipeline.run_full(spark, sources, base, FLOORS, database, DAYS[0], incremental=True)

    def files(at):
        return {t: {os.path.dirname(f): os.path.basename(f) for f in glob.glob(f"{plain(base)}/{at}/{t}/**/*.parquet", recursive=True)}
                for t in processed.TABLES}

    before = {at: files(at) for at in ("processed", "published/processed")}
    # one order moves to a month of its own
    top = sources["orders"].agg(F.max("updated_at")).first()[0]
    moved = valid_order(sources).withColumns(
        {"order_date": F.col("order_date") - F.expr("INTERVAL 1000 MONTHS"), "updated_at": S.ntz(top + dt.timedelta(days=1))})
    later = sources | {"orders": sources["orders"].unionByName(moved)}
    pipeline.run_full(spark, later, base, FLOORS, database, DAYS[1], incremental=True)
    for at, was in before.items():
        now = files(at)
        for t in ("customers", "products"):
            assert now[t] == was[t]
        changed = {p for p in now["orders"].keys() | was["orders"].keys() if now["orders"].get(p) != was["orders"].get(p)}
        assert 1 <= len(changed) <= 2, changed
    full = scratch_path(spark, "t_parts_full")
    latest = pipeline.refresh_latest(spark, base)
    processed.write_whole(spark, pipeline.C.clean_all(latest, deduped=True), full)
    for t, df in processed.read_processed(spark, base).items():
        want = processed.read_processed(spark, full)[t]
        assert sorted(df.select(want.columns).collect(), key=repr) == sorted(want.collect(), key=repr)
        copy = spark.read.parquet(f"{base}/published/processed/{t}").select(want.columns)
        assert sorted(copy.collect(), key=repr) == sorted(want.collect(), key=repr)


def test_an_empty_month_goes(spark, sources):
    """A month whose only order moves away has no folder afterwards, here and in the lake."""
    base, database = scratch_path(spark, "t_month"), "t_month_db"
    far = valid_order(sources).withColumn("order_date", F.lit("2090-05-05").cast("timestamp_ntz"))
    start = sources | {"orders": sources["orders"].join(far, "order_id", "left_anti").unionByName(far)}
    pipeline.run_full(spark, start, base, FLOORS, database, DAYS[0], incremental=True)
    month = "order_year=2090/order_month=5"
    assert all(os.path.isdir(f"{plain(base)}/{at}/orders/{month}") for at in ("processed", "published/processed"))
    rows = processed.read_processed(spark, base)["orders"].count()
    top = sources["orders"].agg(F.max("updated_at")).first()[0]
    back = far.withColumns({"order_date": F.lit(None).cast("timestamp_ntz"), "status": F.lit("cancelled"), "updated_at": S.ntz(top + dt.timedelta(days=2))})
    pipeline.run_full(spark, start | {"orders": start["orders"].unionByName(back)}, base, FLOORS, database, DAYS[1], incremental=True)
    assert not any(os.path.isdir(f"{plain(base)}/{at}/orders/{month}") for at in ("processed", "published/processed"))
    orders = processed.read_processed(spark, base)["orders"]
    assert orders.filter("order_year IS NULL").count() == 1 and orders.count() == rows


def test_a_one_key_batch_rewrites_one_bucket(spark, sources):
    from tillroll.sinks.writers import land_raw
    from tillroll.streaming.incremental import COMMITTED, maintain_latest, read_latest
    from tillroll.sinks.log import newest_rows
    root, orders = scratch_path(spark, "t_bucket"), sources["orders"]
    args = (spark, f"{root}/raw/orders", schemas.ORDERS, "order_id", "updated_at", f"{root}/latest", f"{root}/ckpt")
    land_raw(orders, f"{root}/raw", "orders", "2024-02-01")
    maintain_latest(*args)
    one = orders.limit(1).withColumn("updated_at", F.col("updated_at") + F.expr("INTERVAL 9000 DAYS"))
    land_raw(one, f"{root}/raw", "orders", "2024-02-02")
    assert maintain_latest(*args) == 1
    row = newest_rows(spark, f"{root}/latest/committed", COMMITTED)[0]
    assert row.version == 1 and len(row.rewritten) == 1 and row.buckets > 1
    assert len(glob.glob(f"{plain(root)}/latest/rows/v=1/bucket=*")) == 1
    latest = read_latest(spark, f"{root}/latest", schemas.ORDERS)
    want = orders.join(one, "order_id", "left_anti").unionByName(one)
    assert sorted(latest.collect()) == sorted(want.collect())


def test_a_table_of_the_same_name_is_refused(spark, sources):
    base = scratch_path(spark, "t_taken")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS t_taken_db LOCATION '{base}/warehouse'")
    spark.range(3).write.saveAsTable("t_taken_db.daily_sales")
    with pytest.raises(ValueError, match="table of its own"):
        publishing.register_views(spark, base, "t_taken_db")
    from tillroll.sinks.writers import LocationError
    with pytest.raises(LocationError):
        publishing.register_views(spark, scratch_path(spark, "t_taken_b"), "t_taken_db")


def test_views_have_the_declared_columns(spark, sources):
    base, database = scratch_path(spark, "t_views"), "t_views_db"
    pipeline.run_full(spark, sources, base, FLOORS, database, DAYS[0])
    for m, df in tables(spark, database).items():
        assert [(f.name, f.dataType) for f in df.schema.fields] == [(f.name, f.dataType) for f in schemas.with_stamp(schemas.MARTS[m]).fields]
