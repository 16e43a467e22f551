"""End-to-end runs.

Stages talk through Parquet written to shared storage: each mart is built
from the processed layer read back from disk, so a lost executor costs a
re-read of one stage, never a recomputation from the sources.  Order is
write -> audit -> publish: a run's marts are written as a new version, which is
switched on only after the quality gate passed (``publishing``), so a failed
run leaves the marts of the last good one.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import clean as C
from ..operators import marts as M
from ..operators import quality as Q
from ..session import delete_path, path_exists, stage_scope
from ..sinks.writers import ordered_for_write, write_layer
from ..sources.extract import TS_COLUMNS, all_done, run_extract
from ..sources.raw import read_folder, read_raw_all
from ..streaming.incremental import committed_version, maintain_latest, read_version
from . import processed as P
from . import sums
from .processed import read_processed
from .publishing import MARTS as MART_NAMES
from .publishing import built_from, mart_path, next_version, publish_all, published_version, read_marts, unpublished  # noqa: F401
from .publishing import read_version as read_mart_version

PROCESSED = P.TABLES

_MANIFEST = "stage string, dataset string, rows long, status string"


def refresh_latest(spark: SparkSession, base: str, tables=PROCESSED) -> dict[str, DataFrame]:
    """Fold raw batches landed since the last run into the per-key latest
    tables (exactly-once, via the stream checkpoint) and return them.

    Equivalent to deduplicating the whole raw history, at the cost of the
    new rows and the buckets of the latest table that they touch.  The tables are folded side by side.
    """
    def fold(t: str) -> DataFrame:
        v = maintain_latest(spark, f"{base}/raw/{t}", schemas.SOURCES[t], schemas.SOURCE_KEYS[t],
                            TS_COLUMNS[t], f"{base}/latest/{t}", f"{base}/state/latest_{t}")
        return read_version(spark, f"{base}/latest/{t}", schemas.SOURCES[t], v)

    return all_done({t: lambda t=t: fold(t) for t in tables})


def latest_versions(spark: SparkSession, base: str) -> dict[str, int | None]:
    return {t: committed_version(spark, f"{base}/latest/{t}") for t in PROCESSED}


def build_marts(p: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The three marts from the processed tables."""
    return {"daily_sales": M.daily_sales(p["order_items"], p["orders"], p["products"]),
            "product_performance": M.product_performance(p["order_items"], p["orders"], p["products"]),
            "customer_ltv": M.customer_ltv(p["orders"], p["customers"])}


def refresh_marts(spark: SparkSession, base: str, after: dict[str, DataFrame],
                  version: int) -> tuple[dict[str, DataFrame], dict[str, DataFrame]] | None:
    """The three marts from the sums of the last run's and the rows changed since, and of each the
    partitions of its check state that can differ.  The new sums are written as of ``version``.

    None if there are no sums of the last run, or if they are not of the versions
    just before the newest ones: then only a full build is right.
    """
    last = published_version(spark, base)
    if not sums.has_sums(spark, base, last):
        return None
    ch = sums.changes(spark, base, built_from(spark, base), latest_versions(spark, base))
    if ch is None:
        return None
    ltv = read_marts(spark, base)["customer_ltv"].drop("_processed_at")
    return sums.write_changed(spark, base, last, version, after, ch, ltv)


def changed_parts(before: dict[str, DataFrame], after: dict[str, DataFrame], changed: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Of each mart the partitions (column ``part``) of its check state with rows that can differ."""
    touched = {"daily_sales": M.affected_sale_dates(before, after, changed),
               "product_performance": M.affected_products(before, after, changed),
               "customer_ltv": M.affected_customers(before, after, changed)}
    return {m: df.select(Q.state_part(m).alias("part")).distinct() for m, df in touched.items()}


def _write_marts(built: dict[str, DataFrame], base: str, version: int | None) -> list[tuple]:
    built = built | {"daily_sales": ordered_for_write(built["daily_sales"], "sale_date", "category")}
    return [("marts", m, write_layer(built[m], f"{base}/marts/{m}" if version is None else mart_path(base, m, version)))
            for m in MART_NAMES]


def process(spark: SparkSession, raw: dict[str, DataFrame], base: str, deduped: bool = False,
            mart_version: int | None = None, incremental: bool = False) -> DataFrame:
    """Four cleans, then three marts.  Manifest (layer, dataset, rows).

    ``deduped``: ``raw`` already holds one newest row per key (latest tables).
    ``mart_version``: the version that the marts are written as, by default they go to ``<base>/marts``.
    ``incremental``: ``raw`` are the newest versions of the latest tables; only the
    partitions that changed keys touch are rewritten (their rows are what the manifest
    counts), and a version of the marts is made from the last run's sums where that is possible.
    """
    with stage_scope(spark):
        written = P.refresh(spark, base) if incremental else P.write_whole(spark, C.clean_all(raw, deduped=deduped), base)
        rows = [("processed", t, w.rows) for t, w in written.items()]
        p = read_processed(spark, base)
        summed = incremental and mart_version is not None
        refreshed = refresh_marts(spark, base, p, mart_version) if summed else None
        built = refreshed[0] if refreshed else sums.write_whole(spark, base, mart_version, p) if summed else build_marts(p)
        rows += _write_marts(built, base, mart_version)
        if mart_version is not None:
            parts = check_path(base, "changed_parts", mart_version)
            delete_path(spark, parts)
            if refreshed:
                for mart, df in refreshed[1].items():
                    df.select(F.lit(mart).alias("table_name"), "part").write.mode("append").parquet(parts)
    return spark.createDataFrame(rows, "layer string, dataset string, rows long")


def candidate_marts(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """What ``process`` has written to ``<base>/marts`` (a missing mart is a frame without
    columns); in a lake without that folder the published marts."""
    if not path_exists(spark, f"{base}/marts") and published_version(spark, base) is not None:
        return read_marts(spark, base)
    return {m: Q.read_mart(spark, f"{base}/marts/{m}") for m in MART_NAMES}


def audit(spark: SparkSession, marts: dict[str, DataFrame], base: str, floors: dict[str, int] | None = None) -> DataFrame:
    """The check results over marts, written to ``<base>/quality/results`` and read back."""
    results = Q.run_all({k: v.drop("_processed_at") if "_processed_at" in v.columns else v for k, v in marts.items()}, floors)
    results.write.mode("overwrite").parquet(f"{base}/quality/results")
    return spark.read.parquet(f"{base}/quality/results")


def check_path(base: str, what: str, version: int) -> str:
    return f"{base}/warehouse/{what}/version={version}"


def audit_version(spark: SparkSession, base: str, version: int, floors: dict[str, int] | None = None) -> DataFrame:
    """The check results over a version of the marts, from per-partition counts stored beside it.

    If the version was refreshed from the published one, only partitions with changed rows are
    counted anew; the counts of the others are those of the published version.
    """
    marts, suites = read_mart_version(spark, base, version), Q.mart_suites(floors)
    last, parts = published_version(spark, base), read_folder(spark, check_path(base, "changed_parts", version))
    stored = None if last is None or parts is None else read_folder(spark, check_path(base, "checks", last))
    where = check_path(base, "checks", version)
    delete_path(spark, where)
    for m, checks in suites.items():
        df = marts[m].drop("_processed_at")
        state = Q.suite_state(df, m, checks) if stored is None else Q.refresh_state(
            stored, df, m, checks, parts.filter(F.col("table_name") == m).select("part"))
        state.coalesce(1).write.mode("append").parquet(where)
    state = spark.read.schema(Q.STATE).parquet(where)
    results = [Q.state_results(state, checks, marts[m].columns) for m, checks in suites.items()]
    for n, r in enumerate(results):
        r.write.mode("append" if n else "overwrite").parquet(f"{base}/quality/results")
    return spark.read.parquet(f"{base}/quality/results")


def run_full(spark: SparkSession, sources: dict[str, DataFrame], base: str,
             floors: dict[str, int] | None = None, database: str = "tillroll_marts",
             ingest_date: _dt.date | None = None, incremental: bool = False,
             ts_policy: str = "parent", fail_on_error: bool = True) -> DataFrame:
    """Extract -> land raw -> process -> quality gate -> publish.

    ``incremental``: process from the latest tables (``refresh_latest``), rewrite the
    processed partitions and refresh the marts that the changed keys touch, instead of
    deduplicating the whole raw history and rebuilding everything.
    ``fail_on_error``: stop before processing if a table could not be extracted.

    Returns the stage manifest (stage, dataset, rows, status).  Raises
    ``QualityGateError`` (after writing the check results) when a critical
    check fails; nothing is published in that case and the published marts stay.
    """
    out = []
    ingest_date = ingest_date or _dt.date.today()
    extracted = run_extract(spark, sources, f"{base}/raw", f"{base}/state/watermarks",
                            ingest_date=ingest_date, ts_policy=ts_policy, fail_on_error=fail_on_error)
    for r in extracted.collect():  # one row per source table
        out.append(("extract", r["table_name"], r["rows"], r["status"]))
    if incremental:
        raw = refresh_latest(spark, base)
    else:
        raw = {t: read_raw_all(spark, f"{base}/raw", t, schemas.SOURCES[t]).drop("ingest_date")
               for t in PROCESSED}
    version = next_version(spark, base)
    for r in process(spark, raw, base, deduped=incremental, mart_version=version,
                     incremental=incremental).collect():  # one row per dataset
        out.append(("process", r["dataset"], r["rows"], "success"))
    results = audit_version(spark, base, version, floors)
    checks = results.count()
    Q.gate(results)
    out.append(("quality", "checks", checks, "success"))
    built = {t: v for t, v in latest_versions(spark, base).items() if v is not None} if incremental else {}
    for m in publish_all(spark, base, version, database, built):
        out.append(("publish", f"{m['layer']}/{m['dataset']}", m["rows"], "success"))
    return spark.createDataFrame(out, _MANIFEST)
