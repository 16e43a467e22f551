"""Small append-only tables that say what is in force: the commit points of the engine.

A commit appends one file, so it is there as a whole or not at all; readers take the
newest ``version``.  A folder that does not exist is an empty log, and reading never
writes.  Logs hold a few rows per run, so their rows may come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..session import path_exists


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All rows ever committed; ``schema`` has a column ``version``."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def newest_version(spark: SparkSession, path: str) -> int | None:
    """The version in force; None before the first commit."""
    return read_log(spark, path, "version long").agg(F.max("version")).first()[0]


def newest_rows(spark: SparkSession, path: str, schema: str) -> list[Row]:
    """The rows of the version in force."""
    log = read_log(spark, path, schema)
    return log.join(log.agg(F.max("version").alias("version")), "version").select(*log.columns).collect()


def append_log(spark: SparkSession, path: str, rows: list[tuple] | DataFrame, schema: str) -> None:
    """Commit some rows at once."""
    frame = rows if isinstance(rows, DataFrame) else spark.createDataFrame(rows, schema)
    frame.coalesce(1).write.mode("append").parquet(path)
