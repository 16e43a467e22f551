"""Readers of the raw and processed layers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import path_exists


class NoRawFilesError(FileNotFoundError):
    pass


def read_folder(spark: SparkSession, path: str, **options: str) -> DataFrame | None:
    """The Parquet files below ``path``; None if the folder is missing or holds none.

    Without a declared schema Spark reads one footer and fails when there is no
    file, so no list of files comes to Python.
    """
    if not path_exists(spark, path):
        return None
    try:
        return spark.read.options(**options).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise


def read_raw_all(spark: SparkSession, base: str, table: str, schema: StructType,
                 layout: str = "hive") -> DataFrame:
    """Every batch ever landed for ``table``, read with its declared schema.

    ``layout="hive"`` reads ``<base>/<table>/ingest_date=.../`` folders (the
    layout ``land_raw`` writes; ``ingest_date`` stays available for pruning).
    ``layout="nested"`` reads arbitrary nested folders such as ``YYYY/MM/DD``
    via recursive listing.  Raises when no data file exists.
    """
    path = f"{base.rstrip('/')}/{table}"
    options = {"recursiveFileLookup": "true"} if layout == "nested" else {}
    if read_folder(spark, path, **options) is None:
        raise NoRawFilesError(f"{table}: nothing has been landed below {path}")
    return spark.read.options(**options).schema(schema).parquet(path)


def read_batches(spark: SparkSession, path: str, schema: StructType, batches: list[tuple]) -> DataFrame:
    """The files of some landed batches, (ingest_date, batch) each, and of no others."""
    globs = [f"{path}/ingest_date={day}/batch-{batch}-*" for day, batch in batches]
    return spark.read.schema(schema).parquet(*globs)


def raw_row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """One row (table_name, rows) per raw table, one aggregate each."""
    out = None
    for name, df in frames.items():
        c = df.agg(F.count(F.lit(1)).cast("long").alias("rows")).select(
            F.lit(name).alias("table_name"), "rows")
        out = c if out is None else out.unionByName(c)
    return out


def read_union_by_name(spark: SparkSession, path: str) -> DataFrame:
    """All parquet files under ``path`` unioned by column name.

    Files that lack a column contribute NULLs for it (schema merge); a missing or
    empty folder is a frame without columns and rows.
    """
    df = read_folder(spark, path, mergeSchema="true")
    return spark.createDataFrame([], StructType([])) if df is None else df
