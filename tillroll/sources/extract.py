"""Incremental extraction by high-water mark.

The source tables are DataFrames (a JDBC read, a landing folder, or the
fixture adapter).  The watermark filter is a plain predicate, so it is pushed
into the Parquet scan / JDBC query.  Watermark state is a small log with one row
per source table and run: reading it to the driver is fine.

Sources change while they are read.  A run therefore fixes the upper mark of every
table before it reads any, and extracts ``low < stamp <= high``; rows that arrive
meanwhile are above the mark and wait for the next run.  Rows that arrive late, with a
stamp at or below the mark, are found by reading a window below it again: what was
not landed yet (anti join on key, stamp and row hash) is landed now.

Commit protocol (at-least-once, made exact by dedupe): land the batches,
then append the new state version (the commit point), which also names the batches,
so it is the ledger that publishing goes by.  A crash in between re-extracts the same
rows next time; ``dedupe_latest`` in cleaning absorbs the replay.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..session import materialize, stage_scope
from ..sinks.log import newest_version, read_log
from ..sinks.writers import conform, land_raw
from .raw import read_batches, read_folder

EPOCH = _dt.datetime(1970, 1, 1)


def ntz(value: _dt.datetime | _dt.date | str) -> Column:
    """A zone-less timestamp literal.

    Built from text: a datetime object would become an instant in the host's zone
    first, and the same state would then filter differently on another host.
    """
    text = value.isoformat(sep=" ") if isinstance(value, _dt.datetime) else str(value)
    return F.lit(text).cast("timestamp_ntz")


class ExtractError(RuntimeError):
    """Some tables could not be extracted; the message names each with its error."""


# The column that tells when a row of a source table changed.
TS_COLUMNS = {
    "customers": "updated_at",
    "products": "updated_at",
    "orders": "updated_at",
    "order_items": "created_at",
    "clickstream": "event_timestamp",
}
TABLES = list(TS_COLUMNS)


#: So many keys come to some 10 MB in memory, Spark's own bound for broadcasts.  The size of their files does not
#: tell, as keys in order compress to less than a byte each.
BROADCAST_KEYS = 250_000


def _of_window(sources: dict[str, DataFrame], inside: Callable[[Column], Column], store: bool) -> DataFrame:
    """Keys of the orders whose stamp is ``inside``.

    ``store``: written and counted first, so that the join to the items is planned by their number and not by the
    size of all orders: up to ``BROADCAST_KEYS`` are broadcast and items are not shuffled for them.
    """
    orders = sources["orders"].filter(inside(F.col("updated_at"))).select("order_id")
    if not store:
        return orders
    stored, n = materialize(orders, "window_orders", with_rows=True)
    return F.broadcast(stored) if n <= BROADCAST_KEYS else stored.hint("merge")


def _stamped(sources: dict[str, DataFrame], table: str, inside: Callable[[Column], Column], orders: DataFrame | None = None) -> DataFrame:
    """The rows of ``table`` whose stamp is ``inside``; items go by their order's stamp (``orders``: the keys of those orders)."""
    if table == "order_items":
        return sources["order_items"].join(_of_window(sources, inside, False) if orders is None else orders, "order_id", "left_semi")
    return sources[table].filter(inside(F.col(TS_COLUMNS[table])))


def extract(sources: dict[str, DataFrame], table: str, watermark, upper=None, store: bool = False) -> DataFrame:
    """Rows changed strictly after ``watermark`` and, if given, not after ``upper``.

    order_items has no update stamp: an item is extracted when its parent
    order changed (left-semi join; the order key is unique, so semi = inner).
    ``store``: the changed orders' keys are written before items are read.
    """
    low = ntz(watermark)

    def inside(ts: Column) -> Column:
        return ts > low if upper is None else (ts > low) & (ts <= ntz(upper))

    return _stamped(sources, table, inside, _of_window(sources, inside, True) if store and table == "order_items" else None)


def late_rows(sources: dict[str, DataFrame], table: str, watermark, overlap: _dt.timedelta, landed: DataFrame) -> DataFrame:
    """Rows with a stamp from ``watermark - overlap`` up to ``watermark`` that are not in ``landed``.

    Rows that share the watermark's stamp belong to them, also with an overlap of zero.
    A row counts as landed if its key, its stamp and the hash of all its columns are.
    Of landed items only those of the window's orders are looked at: an equal item has the same order.
    """
    low, high = ntz(watermark - overlap), ntz(watermark)

    def inside(stamp: Column) -> Column:
        return (stamp >= low) & (stamp <= high)

    orders = _of_window(sources, inside, True) if table == "order_items" else None
    again = conform(_stamped(sources, table, inside, orders), schemas.SOURCES[table])
    key, ts = schemas.SOURCE_KEYS[table], TS_COLUMNS[table]

    def marked(df: DataFrame) -> DataFrame:
        return df.withColumn("__hash", F.xxhash64(*schemas.SOURCES[table].fieldNames()))

    recent = landed.filter(F.col(ts) >= low) if orders is None else landed.join(orders, "order_id", "left_semi")
    known = marked(recent).select(
        F.col(key).alias("__key"), F.col(ts).alias("__ts"), F.col("__hash").alias("__known")).distinct()
    new = marked(again)
    same = new[key].eqNullSafe(known["__key"]) & new[ts].eqNullSafe(known["__ts"]) & (new["__hash"] == known["__known"])
    return new.join(known, same, "left_anti").drop("__hash")


def upper_marks(sources: dict[str, DataFrame], lows: dict[str, _dt.datetime]) -> dict[str, _dt.datetime | None]:
    """The newest stamp of each table above its low mark, fixed before any row is read; None without one.

    Items have the mark of the orders.  Failures are kept as the table's value.
    """
    stamped = {t: "orders" if t == "order_items" else t for t in lows}
    least = {s: min(lows[t] for t in lows if stamped[t] == s) for s in set(stamped.values())}
    newest = side_by_side({s: lambda s=s: sources[s].filter(F.col(TS_COLUMNS[s]) > ntz(least[s]))
                           .agg(F.max(TS_COLUMNS[s])).first()[0] for s in least})
    return {t: newest[stamped[t]] for t in lows}


def side_by_side(jobs: dict[str, Callable[[], object]]) -> dict[str, object]:
    """Results of some independent Spark jobs, run at once; a failed one gives its exception.

    Each runs in a scheduler pool of its own name, so with ``spark.scheduler.mode=FAIR``
    a large table does not hold up the small ones.
    """
    from pyspark import SparkContext

    def run(name: str) -> object:
        context = SparkContext._active_spark_context
        if context is not None:
            context.setLocalProperty("spark.scheduler.pool", name)
        try:
            return jobs[name]()
        except Exception as e:  # noqa: BLE001 -- the caller decides what a failure means
            return e
        finally:
            if context is not None:
                context.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max(len(jobs), 1)) as pool:
        inherit = inheritable_thread_target(SparkSession.active())
        futures = {name: pool.submit(inherit(run), name) for name in jobs}
        return {name: f.result() for name, f in futures.items()}


def all_done(jobs: dict[str, Callable[[], object]]) -> dict[str, object]:
    """As ``side_by_side`` for jobs that must all succeed: the first failure is raised once all have ended."""
    results = side_by_side(jobs)
    for result in results.values():
        if isinstance(result, Exception):
            raise result
    return results


def batch_high_water(sources: dict[str, DataFrame], table: str, watermark,
                     ts_policy: str = "parent") -> DataFrame:
    """max timestamp of one extracted batch, as a one-row frame.

    ``ts_policy="parent"`` advances order_items on the changed orders'
    ``updated_at``, the column the filter uses, so no item is passed over;
    ``"reference"`` advances on the items' own ``created_at`` as the original
    did, which skips items of orders that change before the newest item.
    """
    if table == "order_items" and ts_policy == "parent":
        wm = ntz(watermark)
        changed = sources["orders"].filter(F.col("updated_at") > wm)
        with_items = changed.join(sources["order_items"].select("order_id"), "order_id", "left_semi")
        hw = with_items.agg(F.max("updated_at").alias("batch_max"))
    else:
        hw = extract(sources, table, watermark).agg(F.max(TS_COLUMNS[table]).alias("batch_max"))
    return hw.select(F.lit(table).alias("table_name"), "batch_max")


def state_frame(spark: SparkSession, values: dict[str, _dt.datetime | None]) -> DataFrame:
    """A watermark state table from explicit values (missing tables omitted)."""
    rows = [(t, v) for t, v in values.items() if v is not None]
    return spark.createDataFrame(rows, schemas.WATERMARK_STATE)


def current_watermarks(state: DataFrame, tables=TABLES) -> DataFrame:
    """S6 read: one row per table; a table without a state row starts at epoch."""
    spark = state.sparkSession
    wanted = spark.createDataFrame([(t,) for t in tables], "table_name string")
    latest = state.groupBy("table_name").agg(F.max("last_extracted").alias("last_extracted"))
    return (wanted.join(latest, "table_name", "left")
                  .select("table_name", F.coalesce("last_extracted", ntz(EPOCH))
                          .alias("last_extracted")))


def advance(state: DataFrame, batch_max: DataFrame, tables=TABLES) -> DataFrame:
    """S6 advance: new mark = max of a non-empty batch; unchanged otherwise."""
    cur = current_watermarks(state, tables)
    joined = cur.join(batch_max, "table_name", "left")
    return joined.select("table_name",
                         F.when(F.col("batch_max").isNull(), F.col("last_extracted"))
                          .otherwise(F.greatest("last_extracted", "batch_max")).alias("last_extracted"))


def watermark_value(state: DataFrame, table: str) -> _dt.datetime:
    row = current_watermarks(state, [table]).first()
    return row["last_extracted"]


#: A run adds one row per table: the mark it leaves, and the batch it has landed, if any.
STATE_VERSIONS = "table_name string, last_extracted timestamp_ntz, batch string, ingest_date date, rows long, version int"


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """Newest committed version of the watermark state (empty if none).

    The state is append-only: every run writes a new ``version=<n>`` folder;
    a version exists only once its write committed, so a crashed run leaves
    the previous version in force.
    """
    newest = newest_version(spark, path)
    versions = read_log(spark, path, STATE_VERSIONS)
    return versions.filter(F.col("version") == F.lit(newest)).select("table_name", "last_extracted")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Every batch that a committed run has landed: table_name, ingest_date, batch, rows, last_extracted."""
    return (read_log(spark, path, STATE_VERSIONS).filter("batch IS NOT NULL")
            .select("table_name", "ingest_date", "batch", "rows", "last_extracted"))


def commit_state(spark: SparkSession, path: str, state: DataFrame) -> int:
    """Append ``state`` as the next version; returns the version number."""
    version = (newest_version(spark, path) or 0) + 1
    (state.withColumn("version", F.lit(version)).coalesce(1)
          .write.mode("append").partitionBy("version").parquet(path))
    return version


def _landed(spark: SparkSession, raw_base: str, state_path: str, table: str, since: _dt.datetime) -> DataFrame | None:
    """Rows that committed runs have landed with stamps from ``since`` on; None if there are none."""
    schema = schemas.SOURCES[table]
    ledger = read_ledger(spark, state_path).filter(F.col("table_name") == table)
    batches = ledger.filter(F.col("last_extracted") >= ntz(since)).collect()  # one row per run inside the window
    if batches:
        return read_batches(spark, f"{raw_base}/{table}", schema, [(r.ingest_date, r.batch) for r in batches])
    if ledger.isEmpty() and read_folder(spark, f"{raw_base}/{table}") is not None:  # landed before there was a ledger
        return spark.read.schema(schema).parquet(f"{raw_base}/{table}").select(*schema.fieldNames())
    return None


def run_extract(spark: SparkSession, sources: dict[str, DataFrame], raw_base: str,
                state_path: str, tables=None, ingest_date: _dt.date | None = None,
                ts_policy: str = "parent", fail_on_error: bool = False,
                overlap: _dt.timedelta | None = _dt.timedelta(0)) -> DataFrame:
    """Extract every table, land it, advance its watermark; manifest out.

    Marks are fixed first, then the tables are extracted side by side.  ``overlap``: how
    far below the mark to look again for rows that came late; None looks strictly above it.

    One table failing does not stop the others: its row says ``error``, and with
    ``fail_on_error`` an ``ExtractError`` follows once the state of the others is
    committed.  The state is written once per run, after every landed batch: the
    write of the state is the commit point.
    """
    tables = list(tables or TABLES)
    ingest_date = ingest_date or _dt.date.today()
    run = uuid.uuid4().hex[:12]
    marks = {r.table_name: r.last_extracted for r in
             current_watermarks(read_state(spark, state_path), sorted(set(TABLES) | set(tables))).collect()}  # one row per table
    uppers = upper_marks(sources, {t: marks[t] for t in tables})

    def land(table: str) -> dict:
        low, high, schema = marks[table], uppers[table], schemas.SOURCES[table]
        if isinstance(high, Exception):
            raise high
        # Land with the declared schema so raw types cannot drift between
        # batches (an unsafe cast fails here instead of at read time).
        batch = conform(extract(sources, table, low, low if high is None else high, store=True), schema)
        if overlap is not None and low > EPOCH:
            landed = _landed(spark, raw_base, state_path, table, low - overlap)
            if landed is not None:
                batch = batch.unionByName(late_rows(sources, table, low, overlap, landed))
        info = land_raw(batch, raw_base, table, ingest_date, TS_COLUMNS[table], run)
        by_item = table == "order_items" and ts_policy == "reference"
        return info | {"mark": max(low, info["max"]) if by_item and info["max"] else high or low}

    with stage_scope(spark):
        results = side_by_side({t: lambda t=t: land(t) for t in tables})
    manifest, state = [], []
    for table, mark in marks.items():
        result = results.get(table)
        landed = isinstance(result, dict) and result["rows"] > 0
        state.append((table, result["mark"], run, ingest_date, result["rows"]) if landed else (table, mark, None, None, None))
        if table not in results:
            continue
        if isinstance(result, Exception):
            manifest.append((table, 0, "error", None, f"{type(result).__name__}: {result}"))
        elif landed:
            manifest.append((table, result["rows"], "success", f"{raw_base}/{table}", None))
        else:
            manifest.append((table, 0, "skipped", None, None))
    manifest.sort(key=lambda row: tables.index(row[0]))
    commit_state(spark, state_path, _state_rows(spark, state))
    failed = [f"{row[0]}: {row[4]}" for row in manifest if row[2] == "error"]
    if failed and fail_on_error:
        raise ExtractError("; ".join(failed))
    return spark.createDataFrame(
        manifest, "table_name string, rows long, status string, path string, error string")


def _state_rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, STATE_VERSIONS.removesuffix(", version int"))
