"""The processed layer (P1, C1-C4), kept up by partitions.

After an incremental run only the partitions that hold a changed key are rewritten:
for orders the months a changed order was in before or is in now, for the other
tables the key buckets of the latest table.  A log row per table and run says which
version of the latest table the layer shows and which partitions the run has
rewritten; publishing copies those.  Rewriting is idempotent: a run that breaks off
leaves the log behind the files, and the next run rewrites the same partitions.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import clean as C
from ..session import delete_path, materialize, path_exists
from ..sinks.log import append_log, newest_rows, newest_version, read_log
from ..sinks.writers import write_layer, write_observed, write_orders_partitioned
from ..sources.extract import all_done
from ..streaming.incremental import bucket_of, changed_keys, changed_rows, committed_buckets, committed_version, read_rewritten, read_version

TABLES = ("customers", "products", "orders", "order_items")
CLEAN = {"customers": C.clean_customers, "products": C.clean_products, "orders": C.clean_orders, "order_items": C.clean_order_items}
MONTH = ["order_year", "order_month"]
BUCKET = "key_bucket"
#: ``latest`` is null when the layer was not written from a latest table; ``whole``: not only ``partitions``.
LOG = "version long, dataset string, latest long, whole boolean, partitions array<string>"


@dataclass
class Written:
    """What a run has written of one table."""

    rows: int
    whole: bool = True
    partitions: list[str] = field(default_factory=list)
    latest: int | None = None


def _log(base: str) -> str:
    return f"{base}/state/processed"


def read_processed(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{base}/processed/{t}").drop("_processed_at", BUCKET) for t in TABLES}


def record(spark: SparkSession, base: str, written: dict[str, Written]) -> int:
    """Commit what a run has written; returns the layer's version."""
    version = (newest_version(spark, _log(base)) or 0) + 1
    append_log(spark, _log(base), [(version, t, w.latest, w.whole, w.partitions) for t, w in written.items()], LOG)
    return version


def rewritten_since(spark: SparkSession, base: str, version: int | None) -> dict[str, tuple[bool, list[str]]]:
    """Of each table whether it was rewritten whole after ``version``, else which partitions were."""
    rows = read_log(spark, _log(base), LOG).filter(F.col("version") > F.lit(-1 if version is None else version)).collect()  # a row per table and run
    return {t: (any(r.whole for r in rows if r.dataset == t), sorted({p for r in rows if r.dataset == t for p in r.partitions}))
            for t in TABLES}


def write_whole(spark: SparkSession, cleaned: dict[str, DataFrame], base: str) -> dict[str, Written]:
    """All four tables from clean frames; tables other than orders in one folder each."""
    out = {}
    for t in TABLES:
        path = f"{base}/processed/{t}"
        out[t] = Written(write_orders_partitioned(cleaned[t], path) if t == "orders" else write_layer(cleaned[t], path))
    record(spark, base, out)
    return out


def refresh(spark: SparkSession, base: str) -> dict[str, Written]:
    """Bring the layer to the newest version of the latest tables, side by side."""
    shown = {r.dataset: r.latest for r in newest_rows(spark, _log(base), LOG)}

    def bring(t: str) -> Written:
        v, old = committed_version(spark, f"{base}/latest/{t}"), shown.get(t)
        if old is None or v is None or not old <= v <= old + 1:
            out = _all(spark, base, t, v)
        elif v == old:
            out = Written(0, False)
        else:
            out = _months(spark, base, v) if t == "orders" else _buckets(spark, base, t, v)
        out.latest = v
        return out

    out = all_done({t: lambda t=t: bring(t) for t in TABLES})
    record(spark, base, out)
    return out


def _all(spark: SparkSession, base: str, t: str, v: int | None) -> Written:
    latest = f"{base}/latest/{t}"
    cleaned = CLEAN[t](read_version(spark, latest, schemas.SOURCES[t], v), deduped=True)
    path = f"{base}/processed/{t}"
    if t == "orders":
        return Written(write_orders_partitioned(cleaned, path))
    # A file of the latest table holds one bucket, so the rows are together as they are read.
    dealt = cleaned.withColumn(BUCKET, bucket_of(schemas.SOURCE_KEYS[t], committed_buckets(spark, latest)))
    return Written(write_layer(dealt, path, [BUCKET]))


def _buckets(spark: SparkSession, base: str, t: str, v: int) -> Written:
    """The buckets that version ``v`` of the latest table has rewritten, cleaned anew."""
    rows, hit = read_rewritten(spark, f"{base}/latest/{t}", schemas.SOURCES[t], v)
    cleaned = CLEAN[t](rows, deduped=True).withColumnRenamed("bucket", BUCKET)
    return _replace(spark, cleaned, f"{base}/processed/{t}", [BUCKET], [f"{BUCKET}={b}" for b in hit])


def _spec(year: int | None, month: int | None) -> str:
    nothing = "__HIVE_DEFAULT_PARTITION__"
    return "/".join(f"{c}={nothing if x is None else x}" for c, x in zip(MONTH, (year, month), strict=True))


def _months(spark: SparkSession, base: str, v: int) -> Written:
    """The months that the changed orders were in or are in: their other orders stay, the changed ones come anew."""
    latest, schema, path = f"{base}/latest/orders", schemas.ORDERS, f"{base}/processed/orders"
    keys = changed_keys(spark, latest, schema, "order_id", v)
    hit = read_rewritten(spark, latest, schema, v)[1]
    rows = changed_rows(spark, latest, schema, v)
    if rows is None:  # a version from before they were stored
        rows = (read_version(spark, latest, schema, v - 1, hit).join(keys, "order_id", "left_semi"),
                read_rewritten(spark, latest, schema, v)[0].drop("bucket").join(keys, "order_id", "left_semi"))
    was, new = (C.clean_orders(df, deduped=True) for df in rows)
    new = materialize(new, "changed_orders")
    months = [(r[0], r[1]) for r in new.select(*MONTH).unionByName(was.select(*MONTH)).distinct().collect()]  # a row per month
    there = [p for p in (f"{path}/{_spec(*m)}" for m in months) if path_exists(spark, p)]
    if there:
        old = spark.read.option("basePath", path).schema(new.schema).parquet(*there)
        stay = old.join(keys, "order_id", "left_anti").select(new.columns)
        content = materialize(stay.unionByName(new), "months")
    else:
        content = new
    return _replace(spark, content.repartitionByRange(*MONTH, "order_id"), path, MONTH, [_spec(*m) for m in months])


def _replace(spark: SparkSession, content: DataFrame, path: str, by: list[str], partitions: list[str]) -> Written:
    """Overwrite exactly ``partitions``; those without rows in ``content`` go."""
    stamped = content.withColumn("_processed_at", F.current_timestamp())
    holds = {_path_of(r, by) for r in content.select(*by).distinct().collect()}  # at most one row per partition
    rows = write_observed(stamped, path, "overwrite", by, only_partitions=True)["rows"] if holds else 0
    for p in partitions:
        if p not in holds:
            delete_path(spark, f"{path}/{p}")
    return Written(rows, False, partitions)


def _path_of(row, by: list[str]) -> str:
    return "/".join(f"{c}={'__HIVE_DEFAULT_PARTITION__' if row[c] is None else row[c]}" for c in by)
