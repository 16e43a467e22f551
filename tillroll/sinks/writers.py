"""Writers (K1-K9).

Row counts come from ``DataFrame.observe`` during the write itself, so a
write never re-runs its plan just to log how many rows it wrote.  Paths are
Hadoop URIs (local, HDFS, ``s3a://`` ...): the same code publishes to a lake.
"""

from __future__ import annotations

import datetime as _dt
import logging
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import try_cast_to
from ..sources.raw import read_folder

log = logging.getLogger("tillroll")

# Lake files are written once and scanned many times: zstd trades a little
# write CPU for markedly smaller files (less I/O on every later scan).
COMPRESSION = "zstd"


def write_observed(df: DataFrame, path: str, mode: str = "overwrite",
                   partition_by: list[str] | None = None, max_col: str | None = None,
                   fmt: str = "parquet", only_partitions: bool = False, file_prefix: str | None = None) -> dict:
    """Write ``df`` and return {"rows": n, "max": max(max_col)} from the same pass.

    ``only_partitions``: an overwrite replaces the partitions that ``df`` holds, no others.
    ``file_prefix``: how the files' names begin instead of ``part``.
    """
    obs = Observation(f"w_{uuid.uuid4().hex[:8]}")
    metrics = [F.count(F.lit(1)).alias("rows")]
    if max_col:
        metrics.append(F.max(max_col).alias("max"))
    observed = df.observe(obs, *metrics)
    writer = observed.write.mode(mode).format(fmt)
    if fmt == "parquet":
        writer = writer.option("compression", COMPRESSION)
    if file_prefix:
        writer = writer.option("mapreduce.output.basename", file_prefix)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
        if only_partitions:
            writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.save(path)
    got = obs.get
    return {"rows": int(got.get("rows", 0) or 0), "max": got.get("max")}


def write_layer(df: DataFrame, path: str, partition_by: list[str] | None = None,
                stamp: bool = True) -> int:
    """K2: full overwrite of one dataset (with the processing stamp)."""
    if stamp:
        df = df.withColumn("_processed_at", F.current_timestamp())
    return write_observed(df, path, "overwrite", partition_by)["rows"]


def ordered_for_write(df: DataFrame, *cols: str) -> DataFrame:
    """O1: files laid out in (cols) order without a single-task sort.

    Range partitioning gives each task a contiguous key range and the
    per-partition sort orders it, so reading the part files in name order
    yields the full order.
    """
    return df.repartitionByRange(*cols).sortWithinPartitions(*cols)


def write_orders_partitioned(orders: DataFrame, path: str) -> int:
    """K3: clean orders partitioned by order_year / order_month.

    Range partitioning on (year, month, order_id) clusters each month into
    contiguous tasks, so a task writes into one or two directories, while a
    month holding a third of all orders is still split across many tasks
    (hash partitioning on the month alone would give it to one task).
    """
    clustered = orders.repartitionByRange("order_year", "order_month", "order_id")
    return write_layer(clustered, path, ["order_year", "order_month"])


def land_raw(df: DataFrame, raw_base: str, table: str, ingest_date: _dt.date | str,
             ts_col: str | None = None, batch: str | None = None) -> dict:
    """K1: append one extracted batch under ``<raw>/<table>/ingest_date=<d>/``.

    Hive-style folders keep the history prunable by ingest date; append mode
    keeps every earlier batch.  ``batch`` names the files of this one, so that they can
    be read by themselves (``read_batches``).  Returns rows and max(ts_col) of the batch.
    """
    rows = df.withColumn("ingest_date", F.lit(str(ingest_date)).cast("date"))
    if ts_col:
        rows = rows.sortWithinPartitions(ts_col)
    return write_observed(rows, f"{raw_base}/{table}", "append", ["ingest_date"], ts_col,
                          file_prefix=f"batch-{batch}" if batch else None)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """K6: reorder / select to a declared schema, matching names case-insensitively.

    Extra columns are dropped, a contract column the frame lacks comes out as
    NULL (as in a by-name load), and a type that cannot be cast safely fails.
    """
    by_lower = {c.lower(): c for c in df.columns}
    renamed = df.select(*[F.col(f"`{by_lower[f.name.lower()]}`").alias(f.name)
                          for f in schema.fields if f.name.lower() in by_lower])
    return renamed.to(schema)


def upper_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def load_full_refresh(spark: SparkSession, source_path: str, table: str, target_path: str,
                      schema: StructType, upper: bool = True) -> DataFrame | None:
    """K4: replace a catalog table with the mart read from ``source_path``.

    Skips (returns None) when the folder is missing or holds no data files.
    """
    mart = read_folder(spark, source_path)
    if mart is None:
        log.warning("%s holds no Parquet files -- skipping load of %s", source_path, table)
        return None
    out = conform(mart, schema)
    if upper:
        out = upper_case_columns(out)
    out.write.mode("overwrite").option("path", target_path).saveAsTable(table)
    return spark.table(table)


def load_by_name_permissive(df: DataFrame, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """K5: by-name, case-insensitive load that skips bad rows.

    Returns (accepted, rejected).  A row is rejected when some value was
    present but did not convert to the declared type.
    """
    by_lower = {c.lower(): c for c in df.columns}
    bad = F.lit(False)
    for f in schema.fields:
        src = by_lower.get(f.name.lower())
        if src is not None:
            value = F.col(f"`{src}`")
            bad = bad | (value.isNotNull() & value.try_cast(f.dataType).isNull())
    with_flag = df.withColumn("__rejected", bad)
    accepted = try_cast_to(with_flag.filter(~F.col("__rejected")), schema)
    rejected = with_flag.filter(F.col("__rejected")).drop("__rejected")
    return accepted, rejected


def load_permissive(df: DataFrame, schema: StructType, target: str, rejects: str) -> dict[str, int]:
    """K5 as a load: append the accepted rows to ``target``, the rejected ones, as they
    came, to ``rejects``; the number of each, counted during the writes."""
    accepted, rejected = load_by_name_permissive(df, schema)
    return {"accepted": write_observed(accepted, target, "append")["rows"],
            "rejected": write_observed(rejected, rejects, "append")["rows"]}


def publish(datasets: dict[tuple[str, str], DataFrame], lake_uri: str,
            partitions: dict[tuple[str, str], list[str]] | None = None) -> list[dict]:
    """K7: write every (layer, dataset) under ``<lake>/<layer>/<dataset>``.

    ``partitions``: the partition columns of datasets that have some, kept in the copy.
    Of the raw layer only the partitions given are replaced, so a run can publish
    just the batch it has landed.
    """
    manifest = []
    for (layer, name), df in datasets.items():
        path = f"{lake_uri.rstrip('/')}/{layer}/{name}"
        by = (partitions or {}).get((layer, name))
        rows = write_observed(df, path, "overwrite", by, only_partitions=layer == "raw")["rows"]
        manifest.append({"layer": layer, "dataset": name, "rows": rows, "path": path})
    return manifest


class LocationError(ValueError):
    """A database or table exists at another place than the one asked for."""


def require_location(spark: SparkSession, what: str, location: str) -> None:
    """``what``: ``DATABASE name`` or ``TABLE EXTENDED name``."""
    rows = spark.sql(f"DESCRIBE {what}").collect()  # one row per column or property
    found = next(r[1] for r in rows if r[0] == "Location")

    def plain(uri: str) -> str:
        return uri.removeprefix("file:").rstrip("/").replace("//", "/")

    if plain(found) != plain(location):
        raise LocationError(f"{what.split()[-1]} is at {found}, not at {location}")


def setup_mart_tables(spark: SparkSession, database: str, location: str,
                      marts: dict[str, StructType] | None = None) -> list[str]:
    """K6 setup: create the database and each mart table with its declared
    schema (plus ``_processed_at``) if it does not exist yet.  Idempotent.

    Raises if the database or a table is at another location: rows would silently
    go to the other lake."""
    from ..schemas import MARTS, with_stamp
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    require_location(spark, f"DATABASE {database}", location)
    created = []
    for name, schema in (marts or MARTS).items():
        table = f"{database}.{name}"
        if not spark.catalog.tableExists(table):
            spark.catalog.createTable(table, path=f"{location}/{name}", source="parquet",
                                      schema=with_stamp(schema))
            created.append(table)
        else:
            require_location(spark, f"TABLE EXTENDED {table}", f"{location}/{name}")
    return created


def publish_marts(spark: SparkSession, marts: dict[str, DataFrame], database: str,
                  location: str) -> dict[str, int]:
    """K4 + K6 for the pipeline: ensure the contract tables exist, then
    replace each table's rows (truncate-and-load) with the mart conformed to
    its declared schema.  Returns rows written per table (observed)."""
    from ..schemas import MARTS, with_stamp
    setup_mart_tables(spark, database, location)
    written = {}
    for name, df in marts.items():
        contract = with_stamp(MARTS[name])
        existing = spark.table(f"{database}.{name}").schema
        if [(f.name.lower(), f.dataType) for f in existing.fields] != \
                [(f.name.lower(), f.dataType) for f in contract.fields]:
            raise ValueError(f"{database}.{name} exists with a schema other than the mart contract; "
                             "publish to another database or drop the table first")
        obs = Observation(f"p_{uuid.uuid4().hex[:8]}")
        conformed = conform(df, contract)
        conformed.observe(obs, F.count(F.lit(1)).alias("rows")).write.insertInto(
            f"{database}.{name}", overwrite=True)
        written[name] = int(obs.get["rows"])
    return written


def register_tables(spark: SparkSession, marts: dict[str, DataFrame], database: str,
                    location: str, row_counts: dict[str, int] | None = None) -> dict[str, DataFrame]:
    """K9: create the database and (re)register each mart as a table.

    Raises if the database or a table is at another location, as ``setup_mart_tables`` does.
    If ``row_counts`` is given it receives the rows written per table,
    observed during the write.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    require_location(spark, f"DATABASE {database}", location)
    out = {}
    for name, df in marts.items():
        if spark.catalog.tableExists(f"{database}.{name}"):
            require_location(spark, f"TABLE EXTENDED {database}.{name}", f"{location}/{name}")
        obs = Observation(f"t_{uuid.uuid4().hex[:8]}")
        (df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
           .option("path", f"{location}/{name}").saveAsTable(f"{database}.{name}"))
        if row_counts is not None:
            row_counts[name] = int(obs.get["rows"])
        out[name] = spark.table(f"{database}.{name}")
    return out
