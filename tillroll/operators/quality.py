"""Data-quality checks Q1-Q10 as Spark aggregations.

A suite is evaluated in ONE aggregation pass over its table: every check
contributes one aggregate expression to a single ``agg``; the one-row
result is then turned into one result row per check.  The gate reads only
the result rows (one per check, a fixed small number), never the data.

Semantics kept from the pandas originals:
  * no-nulls counts NULL and NaN; a missing column fails as ``<t>_<c>_exists``
  * no-negative counts ``< 0`` (NULL/NaN are not negative); missing -> pass
  * unique counts rows beyond the first per value, NULLs equal each other;
    missing -> fail
  * value-set counts NULL as invalid; missing -> pass
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..schemas import CHECK_RESULT
from ..sources.raw import read_union_by_name
from .clean import LTV_SEGMENTS

log = logging.getLogger("tillroll")


@dataclass(frozen=True)
class Check:
    kind: str                 # row_count | no_nulls | no_negative | unique | value_set
    table: str
    column: str | None = None
    severity: str = "critical"
    minimum: int | None = None
    values: tuple = field(default_factory=tuple)


def row_count(table, minimum, severity="critical"):
    return [Check("row_count", table, None, severity, minimum=minimum)]


def no_nulls(table, columns, severity="critical"):
    return [Check("no_nulls", table, c, severity) for c in columns]


def no_negative(table, column, severity="warning"):
    return [Check("no_negative", table, column, severity)]


def unique(table, column, severity="critical"):
    return [Check("unique", table, column, severity)]


def value_set(table, column, values, severity="warning"):
    return [Check("value_set", table, column, severity, values=tuple(values))]


# Suites with the fixed floors and columns of the original pipeline.
def daily_sales_suite(min_rows: int = 100) -> list[Check]:
    return [*row_count("daily_sales", min_rows),
            *no_nulls("daily_sales", ["sale_date", "category", "gross_revenue"]),
            *no_negative("daily_sales", "gross_revenue"),
            *no_negative("daily_sales", "gross_profit")]


def product_performance_suite(min_rows: int = 50) -> list[Check]:
    return [*row_count("product_performance", min_rows),
            *unique("product_performance", "product_id"),
            *no_nulls("product_performance", ["product_id", "product_name", "total_revenue"]),
            *no_negative("product_performance", "total_revenue")]


def customer_ltv_suite(min_rows: int = 500) -> list[Check]:
    return [*row_count("customer_ltv", min_rows),
            *unique("customer_ltv", "customer_id"),
            *no_nulls("customer_ltv", ["customer_id", "email", "lifetime_value"]),
            *value_set("customer_ltv", "ltv_segment", LTV_SEGMENTS)]


def _name(ck: Check, present: bool) -> str:
    if ck.kind == "row_count":
        return f"{ck.table}_min_row_count"
    suffix = {"no_nulls": "no_nulls" if present else "exists", "no_negative": "no_negative",
              "unique": "unique", "value_set": "valid_values"}[ck.kind]
    return f"{ck.table}_{ck.column}_{suffix}"


def _metric(df: DataFrame, ck: Check) -> Column:
    if ck.kind == "row_count":
        return F.count(F.lit(1))
    c = F.col(f"`{ck.column}`")
    if ck.kind == "no_nulls":
        dtype = df.schema[ck.column].dataType
        bad = c.isNull() | F.isnan(c) if isinstance(dtype, (DoubleType, FloatType)) else c.isNull()
        return F.count_if(bad)
    if ck.kind == "no_negative":
        return F.count_if(c < 0)
    if ck.kind == "unique":
        # struct(c) makes NULL one value of its own, as pandas duplicated() does.
        return F.count(F.lit(1)) - F.count_distinct(F.struct(c))
    if ck.kind == "value_set":
        return F.count_if(~F.coalesce(c.isin(list(ck.values)), F.lit(False)))
    raise ValueError(ck.kind)


def _result(ck: Check, m: Column | None) -> Column:
    """One result struct; ``m`` is the metric column or None (column missing)."""
    s = F.lit
    if m is None:
        passed = ck.kind in ("no_negative", "value_set")
        # Names and messages of results are compared by their readers.
        message = {"no_nulls": f"Column '{ck.column}' not found in {ck.table}",
                   "unique": f"Column {ck.column} not found"}.get(ck.kind, "Column not present")
        return F.struct(s(_name(ck, False)).alias("name"), s(ck.table).alias("table_name"),
                        s(ck.column).cast("string").alias("column_name"), s(ck.kind).alias("check_type"),
                        s(passed).alias("passed"), s(ck.severity).alias("severity"),
                        s(message).alias("message"), s(None).cast("long").alias("metric"),
                        F.create_map().cast("map<string,string>").alias("details"))
    ms = m.cast("string")
    if ck.kind == "row_count":
        passed = m >= ck.minimum
        message = F.concat(s(f"Expected >= {ck.minimum} rows, got "), ms)
        details = F.create_map(s("actual"), ms, s("minimum"), s(str(ck.minimum)))
    else:
        passed = m == 0
        text, key = {"no_nulls": (f" null values in {ck.column}", "null_count"),
                     "no_negative": (f" negative values in {ck.column}", "negative_count"),
                     "unique": (f" duplicate values in {ck.column}", "duplicate_count"),
                     "value_set": (f" rows with invalid {ck.column} values", "invalid_count")}[ck.kind]
        message = F.concat(ms, s(text))
        if ck.kind == "value_set":
            details = F.create_map(s(key), ms, s("valid_set"), s(",".join(ck.values)))
        else:
            details = F.create_map(s(key), ms)
    return F.struct(s(_name(ck, True)).alias("name"), s(ck.table).alias("table_name"),
                    s(ck.column).cast("string").alias("column_name"), s(ck.kind).alias("check_type"),
                    passed.alias("passed"), s(ck.severity).alias("severity"),
                    message.alias("message"), m.cast("long").alias("metric"),
                    details.alias("details"))


def run_suite(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All checks of one table in a single aggregation pass."""
    present = [ck for ck in checks if ck.column is None or ck.column in df.columns]
    metrics = df.agg(*[_metric(df, ck).alias(f"m{i}") for i, ck in enumerate(present)]) \
        if present else df.sparkSession.range(1)
    idx = {id(ck): i for i, ck in enumerate(present)}
    structs = [_result(ck, F.col(f"m{idx[id(ck)]}") if id(ck) in idx else None) for ck in checks]
    return metrics.select(F.explode(F.array(*structs)).alias("r")).select("r.*").to(CHECK_RESULT)


#: How the state of a mart's checks is dealt: a partition holds all rows of a value that must be unique.
BUCKETS = 64


def _bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("string")


def state_part(mart: str) -> Column:
    """The partition of a mart's row: the month of a sale date, the bucket of a key."""
    if mart == "daily_sales":
        return F.coalesce(F.date_format("sale_date", "yyyy-MM"), F.lit("none"))
    return _bucket({"product_performance": "product_id", "customer_ltv": "customer_id"}[mart])


STATE = "table_name string, part string, check string, metric long"


def suite_state(df: DataFrame, mart: str, checks: list[Check]) -> DataFrame:
    """The metric of every check in every partition of a mart: counts, which add up over partitions.

    (Duplicates too: equal keys are in one partition.)  A check of a missing column has no rows.
    """
    present = [ck for ck in checks if ck.column is None or ck.column in df.columns]
    counts = df.groupBy(state_part(mart).alias("part")).agg(*[_metric(df, ck).alias(f"m{i}") for i, ck in enumerate(present)])
    rows = F.array(*[F.struct(F.lit(_name(ck, True)).alias("check"), F.col(f"m{i}").cast("long").alias("metric"))
                     for i, ck in enumerate(present)])
    return counts.select(F.lit(mart).alias("table_name"), "part", F.explode(rows).alias("r")).select("table_name", "part", "r.*")


def refresh_state(previous: DataFrame, df: DataFrame, mart: str, checks: list[Check], changed: DataFrame) -> DataFrame:
    """The state of ``df`` from that of its last version and the partitions (column ``part``) changed
    since: only their rows are read."""
    kept = previous.filter(F.col("table_name") == mart).join(changed, "part", "left_anti").select(*_state_columns())
    rows = df.withColumn("__part", state_part(mart)).join(changed.select(F.col("part").alias("__part")).distinct(), "__part", "left_semi")
    return kept.unionByName(suite_state(rows.drop("__part"), mart, checks))


def _state_columns() -> list[str]:
    return [c.split(" ")[0] for c in STATE.split(", ")]


def state_results(state: DataFrame, checks: list[Check], columns: list[str]) -> DataFrame:
    """The result rows of a suite from its merged state; ``columns``: those of the mart."""
    merged = state.agg(*[F.coalesce(F.sum(F.when((F.col("table_name") == ck.table) & (F.col("check") == _name(ck, True)), F.col("metric"))),
                                    F.lit(0)).alias(f"m{i}") for i, ck in enumerate(checks)])
    structs = [_result(ck, F.col(f"m{i}") if ck.column is None or ck.column in columns else None) for i, ck in enumerate(checks)]
    return merged.select(F.explode(F.array(*structs)).alias("r")).select("r.*").to(CHECK_RESULT)


def mart_suites(floors: dict[str, int] | None = None) -> dict[str, list[Check]]:
    """The three suites by mart, with their floors of rows."""
    floors = floors or {}
    return {"daily_sales": daily_sales_suite(floors.get("daily_sales", 100)),
            "product_performance": product_performance_suite(floors.get("product_performance", 50)),
            "customer_ltv": customer_ltv_suite(floors.get("customer_ltv", 500))}


def run_all(marts: dict[str, DataFrame], floors: dict[str, int] | None = None) -> DataFrame:
    """Q9: the three suites (18 results)."""
    out = None
    for name, checks in mart_suites(floors).items():
        r = run_suite(marts[name], checks)
        out = r if out is None else out.unionByName(r)
    return out


def summary(results: DataFrame) -> DataFrame:
    """Counts of results by (severity, passed)."""
    return results.groupBy("severity", "passed").agg(F.count(F.lit(1)).alias("n_checks"))


class QualityGateError(ValueError):
    pass


def gate(results: DataFrame) -> list[str]:
    """Raise if any critical check failed; return failed warning names.

    Reads only the result rows (one per check), so it is bounded by the
    number of checks, not by the data.
    """
    failed = (results.filter(~F.col("passed")).select("name", "severity")
                     .orderBy("severity", "name").collect())
    critical = [r["name"] for r in failed if r["severity"] == "critical"]
    warnings = [r["name"] for r in failed if r["severity"] != "critical"]
    if warnings:
        log.warning("%d warning-level checks failed (pipeline continues): %s",
                    len(warnings), ", ".join(warnings))
    if critical:
        raise QualityGateError(
            f"{len(critical)} critical checks did not pass, nothing is published: " + ", ".join(critical))
    return [r["name"] for r in failed]


# The constraints declared by the source schema.
SOURCE_NOT_NULL = {
    "customers": ["first_name", "last_name", "email", "signup_date"],
    "products": ["product_name", "category", "unit_price", "cost_price"],
    "orders": ["order_date", "status"],
    "order_items": ["quantity", "unit_price"],
}
SOURCE_PRIMARY_KEYS = {"customers": "customer_id", "products": "product_id",
                       "orders": "order_id", "order_items": "item_id"}
SOURCE_UNIQUE = {"customers": ["email"]}
SOURCE_FOREIGN_KEYS = [("orders", "customer_id", "customers"),
                       ("order_items", "order_id", "orders"),
                       ("order_items", "product_id", "products")]


def constrained_columns(table: str) -> list[str]:
    """The columns of a source table that some constraint looks at."""
    keys = [key for child, key, _ in SOURCE_FOREIGN_KEYS if child == table]
    return list(dict.fromkeys([SOURCE_PRIMARY_KEYS[table], *SOURCE_NOT_NULL[table], *SOURCE_UNIQUE.get(table, []), *keys]))


def source_constraint_checks(table: str) -> list[Check]:
    checks = no_nulls(table, SOURCE_NOT_NULL[table]) + unique(table, SOURCE_PRIMARY_KEYS[table])
    for col in SOURCE_UNIQUE.get(table, []):
        checks += unique(table, col)
    return checks


def referential_integrity(customers: DataFrame, products: DataFrame, orders: DataFrame,
                          items: DataFrame) -> DataFrame:
    """Q10: the source schema's constraints, checked on deduplicated source tables.

    (Cleaned tables would not do: cleaning drops parents and so makes orphans.)
    NOT NULL / PRIMARY KEY / UNIQUE are one aggregation pass per table.  Each
    FOREIGN KEY is one left-anti join of counted child keys: a key that a third of
    the children share is one row per task.  A NULL key refers to nothing.
    """
    frames = {"customers": customers, "products": products, "orders": orders, "order_items": items}
    parts = []
    for child, key, parent in SOURCE_FOREIGN_KEYS:
        children = frames[child].filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        orphans = (children.join(frames[parent].select(key), key, "left_anti")
                   .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("m")))
        parts.append(_fk_row(orphans, f"{child}_{key}_fk", key))
    for table, df in frames.items():
        parts.append(run_suite(df, source_constraint_checks(table)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _fk_row(metric_df: DataFrame, name: str, key: str) -> DataFrame:
    m = F.col("m")
    table = name.split(f"_{key}")[0]
    return metric_df.select(
        F.lit(name).alias("name"), F.lit(table).alias("table_name"), F.lit(key).alias("column_name"),
        F.lit("foreign_key").alias("check_type"), (m == 0).alias("passed"),
        F.lit("critical").alias("severity"),
        F.concat(m.cast("string"), F.lit(f" orphan values in {key}")).alias("message"),
        m.cast("long").alias("metric"),
        F.create_map(F.lit("orphan_count"), m.cast("string")).alias("details")).to(CHECK_RESULT)


def read_mart(spark, path: str) -> DataFrame:
    """A mart folder as a frame; a missing or file-less folder gives a frame
    with no columns and no rows (so column checks report missing columns)."""
    return read_union_by_name(spark, path)
