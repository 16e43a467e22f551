"""Publishing (K4, K6, K7): what is new goes to the lake, and one commit switches the marts.

Raw batches are copied once: the extract's ledger against the log of published batches
tells which are due, and only their files are read.  Of the processed layer the
partitions rewritten since the last publish are copied.  The marts of a run are
written to ``<base>/warehouse/<mart>/version=<v>`` and stay there; the tables of the
database are views of the version that ``<base>/warehouse/published`` names, so one
appended row switches all three at once, and a run that breaks off before or after it
leaves three marts of one run.  The lake's copy is switched in the same way.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..session import delete_glob, delete_path, path_exists
from ..sinks.log import append_log, newest_rows, newest_version, read_log
from ..sinks.writers import conform, require_location, write_layer, write_observed
from ..sources.extract import all_done, read_ledger
from ..sources.raw import read_batches, read_folder
from . import processed, sums

log = logging.getLogger("tillroll")

MARTS = ("daily_sales", "product_performance", "customer_ltv")
#: One row per published run: the version of the marts and the state of the layers they are of.
PUBLISHED = "version long, processed long, built_from map<string,long>"
BATCHES = "version long, dataset string, ingest_date date, batch string, rows long"


def mart_path(base: str, mart: str, version: int) -> str:
    return f"{base}/warehouse/{mart}/version={version}"


def _pointer(base: str) -> str:
    return f"{base}/warehouse/published"


def published_version(spark: SparkSession, base: str) -> int | None:
    return newest_version(spark, _pointer(base))


def next_version(spark: SparkSession, base: str) -> int:
    """The version that the next marts get; files of a run that broke off are overwritten."""
    return (published_version(spark, base) or 0) + 1


def built_from(spark: SparkSession, base: str) -> dict[str, int]:
    """Versions of the latest tables that the published marts were built from."""
    rows = newest_rows(spark, _pointer(base), PUBLISHED)
    return dict(rows[0].built_from or {}) if rows else {}


def read_version(spark: SparkSession, base: str, version: int) -> dict[str, DataFrame]:
    return {m: spark.read.parquet(mart_path(base, m, version)) for m in MARTS}


def read_marts(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The published marts; before the first publish those that ``process`` has written to ``<base>/marts``."""
    version = published_version(spark, base)
    if version is None:
        return {m: spark.read.parquet(f"{base}/marts/{m}") for m in MARTS}
    return read_version(spark, base, version)


def due_batches(spark: SparkSession, base: str) -> dict[str, list[tuple]]:
    """Of each raw table the landed batches (ingest_date, batch) that are not published yet."""
    ledger = read_ledger(spark, f"{base}/state/watermarks").withColumnRenamed("table_name", "dataset")
    done = read_log(spark, f"{base}/state/published_raw", BATCHES)
    due = ledger.join(done, ["dataset", "ingest_date", "batch"], "left_anti").collect()  # a row per batch since the last publish
    return {t: sorted((r.ingest_date, r.batch) for r in due if r.dataset == t) for t in schemas.SOURCES}


def _by_day(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows and the sum of their hashes of each ingest_date."""
    return df.groupBy("ingest_date").agg(F.count(F.lit(1)).alias("rows"),
                                         F.sum(F.xxhash64(*columns).cast("decimal(20,0)")).alias("sum"))


def unpublished(spark: SparkSession, raw: DataFrame, published: str) -> DataFrame:
    """For raw folders without a ledger: the rows of ``raw`` whose ingest_date is not in the
    folder ``published``, or has other rows there.  Reads both."""
    done = read_folder(spark, published)
    if done is None or set(done.columns) != set(raw.columns):
        return raw
    here, there = (_by_day(df, raw.columns) for df in (raw, done))
    days = here.join(there, ["ingest_date", "rows", "sum"], "left_anti").select("ingest_date").collect()  # one row per day
    return raw.filter(F.col("ingest_date").isin([r[0] for r in days]))


def publish_raw(spark: SparkSession, base: str) -> list[dict]:
    """Copy the batches that are due, file names and all, the tables side by side, and commit them to the log."""
    without_ledger = read_ledger(spark, f"{base}/state/watermarks").isEmpty()

    def copied(t: str, batches: list[tuple]) -> tuple[dict | None, list[tuple]]:
        source, target, rows, done = f"{base}/raw/{t}", f"{base}/published/raw/{t}", 0, []
        if without_ledger:
            landed = read_folder(spark, source)
            if landed is None:
                return None, done
            rows = write_observed(unpublished(spark, landed, target), target, "overwrite", ["ingest_date"], only_partitions=True)["rows"]
        for day, batch in batches:
            delete_glob(spark, f"{target}/ingest_date={day}/batch-{batch}-*")  # of a run that broke off
            copy = read_batches(spark, source, schemas.SOURCES[t], [(day, batch)]).withColumn("ingest_date", F.lit(str(day)).cast("date"))
            n = write_observed(copy, target, "append", ["ingest_date"], file_prefix=f"batch-{batch}")["rows"]
            done.append((t, day, batch, n))
            rows += n
        return ({"layer": "raw", "dataset": t, "rows": rows, "path": target} if path_exists(spark, target) else None), done

    copies = all_done({t: lambda t=t, b=b: copied(t, b) for t, b in due_batches(spark, base).items()}).values()
    out, done = [row for row, _ in copies if row], [d for _, of in copies for d in of]
    if done:
        version = (newest_version(spark, f"{base}/state/published_raw") or 0) + 1
        append_log(spark, f"{base}/state/published_raw", [(version, *d) for d in done], BATCHES)
    return out


def publish_processed(spark: SparkSession, base: str, since: int | None) -> list[dict]:
    """Copy the partitions of the processed layer rewritten after its version ``since``, the tables side by side."""
    def copied(t: str, whole: bool, partitions: list[str]) -> dict:
        source, target = f"{base}/processed/{t}", f"{base}/published/processed/{t}"
        if whole or not path_exists(spark, target):
            df = spark.read.parquet(source)
            by = processed.MONTH if t == "orders" else [c for c in df.columns if c == processed.BUCKET]
            rows = write_observed(df, target, "overwrite", by)["rows"]
        else:
            there = [p for p in partitions if path_exists(spark, f"{source}/{p}")]
            rows = 0
            if there:
                by = [c.split("=")[0] for c in there[0].split("/")]
                schema = spark.read.parquet(source).schema  # the partition columns' types are those of the whole table
                df = spark.read.option("basePath", source).schema(schema).parquet(*[f"{source}/{p}" for p in there])
                rows = write_observed(df, target, "overwrite", by, only_partitions=True)["rows"]
            for p in set(partitions) - set(there):
                delete_path(spark, f"{target}/{p}")
        return {"layer": "processed", "dataset": t, "rows": rows, "path": target}

    return list(all_done({t: lambda t=t, r=r: copied(t, *r) for t, r in processed.rewritten_since(spark, base, since).items()}).values())


def publish_mart_copies(spark: SparkSession, base: str, version: int) -> list[dict]:
    """The lake's copy of a version of the marts; its log row makes it the one in force."""
    out = []
    for m, df in read_version(spark, base, version).items():
        path = f"{base}/published/marts/{m}/version={version}"
        out.append({"layer": "marts", "dataset": m, "rows": write_observed(df, path)["rows"], "path": path})
    append_log(spark, f"{base}/published/versions", [(version,)], "version long")
    return out


def switch(spark: SparkSession, base: str, version: int, built: dict[str, int]) -> None:
    """Make ``version`` the published one: the row appended here is the commit of a run."""
    layer = newest_version(spark, f"{base}/state/processed")
    append_log(spark, _pointer(base), [(version, layer, built)], PUBLISHED)


def register_views(spark: SparkSession, base: str, database: str) -> None:
    """The database's tables: views of the published version, with the declared columns and types."""
    location = f"{base}/warehouse"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    require_location(spark, f"DATABASE {database}", location)
    for mart, schema in schemas.MARTS.items():
        name = f"{database}.{mart}"
        if spark.catalog.tableExists(name):
            if spark.catalog.getTable(name).tableType != "VIEW":
                raise ValueError(f"{name} is a table of its own, not a view of published versions; "
                                 "publish to another database or drop the table first")
            continue
        columns = ", ".join(f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in schemas.with_stamp(schema).fields)
        spark.sql(f"CREATE VIEW {name} AS SELECT {columns} FROM parquet.`{location}/{mart}` "
                  f"WHERE version = (SELECT max(version) FROM parquet.`{_pointer(base)}`)")


def drop_superseded(spark: SparkSession, base: str, version: int) -> None:
    """Versions before the last one go; that one stays for readers that have begun."""
    sums.drop_unused(spark, base, version)
    for m in (*MARTS, "checks", "changed_parts", *sums.OWN, *sums.FORMER):
        for place in (f"{base}/warehouse/{m}", f"{base}/published/marts/{m}"):
            delete_glob(spark, f"{place}/version=*", lambda name: int(name.split("=")[1]) < version - 1)


def publish_all(spark: SparkSession, base: str, marts: dict[str, DataFrame] | int, database: str,
                built: dict[str, int] | None = None) -> list[dict]:
    """K7: what is new of the raw and processed layers and the marts to ``<base>/published``,
    and the marts as the tables of ``database``.

    ``marts``: the version that holds them, or frames, which become a version.
    ``built``: versions of the latest tables that the marts are of.
    """
    if isinstance(marts, int):
        version = marts
    else:
        version = next_version(spark, base)
        for m, df in marts.items():
            write_layer(conform(df, schemas.MARTS[m]), mart_path(base, m, version))
    last = newest_rows(spark, _pointer(base), PUBLISHED)
    out = publish_raw(spark, base)
    out += publish_processed(spark, base, last[0].processed if last else None)
    out += publish_mart_copies(spark, base, version)
    switch(spark, base, version, built or {})
    register_views(spark, base, database)
    drop_superseded(spark, base, version)
    return out
