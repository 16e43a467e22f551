"""The sums behind the marts' versions (K4, P2): written with each version, changed by signed deltas.

``<base>/warehouse/sums_by_day`` and ``sums_by_product`` hold one table of sums per version of the
marts.  Orders per (product, customer), as many rows as the items at worst, are never
rewritten: a version adds a delta, and a list beside it names the versions whose deltas add up to
its state.  After ``CHAIN`` deltas they are added up into one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import schemas
from ..operators import clean as C
from ..operators import deltas as D
from ..operators import marts as M
from ..operators import quality as Q
from ..session import delete_glob, materialize, path_exists
from ..sinks.writers import write_observed
from ..streaming.incremental import changed_keys, changed_rows, unchanged_rows

DAILY, PRODUCTS, PAIRS, PAIR_VERSIONS = "sums_by_day", "sums_by_product", "sums_pairs", "sums_pair_versions"
#: Tables of which a version needs no other (the pairs' deltas go by ``drop_unused``).
OWN = (DAILY, PRODUCTS, PAIR_VERSIONS)
#: Where sums lay while they were DECIMAL; they are not read, so the next run of such a lake is a full build.
FORMER = ("sums_daily", "sums_products")
CHAIN = 16


def _path(base: str, what: str, version: int) -> str:
    return f"{base}/warehouse/{what}/version={version}"


def _write(df: DataFrame, base: str, what: str, version: int) -> None:
    write_observed(df, _path(base, what, version), "overwrite")


def _read(spark: SparkSession, base: str, what: str, version: int) -> DataFrame:
    return spark.read.parquet(_path(base, what, version))


def pair_versions(spark: SparkSession, base: str, version: int) -> list[int]:
    """The versions whose deltas of pairs add up to those of ``version`` (at most ``CHAIN``)."""
    return sorted(r[0] for r in _read(spark, base, PAIR_VERSIONS, version).collect())


def read_pairs(spark: SparkSession, base: str, version: int) -> DataFrame:
    return spark.read.parquet(*[_path(base, PAIRS, v) for v in pair_versions(spark, base, version)])


def _write_pairs(spark: SparkSession, pairs: DataFrame, base: str, version: int, of: list[int]) -> None:
    _write(pairs, base, PAIRS, version)
    _write(spark.createDataFrame([(v,) for v in of], "of long").coalesce(1), base, PAIR_VERSIONS, version)


def has_sums(spark: SparkSession, base: str, version: int | None) -> bool:
    return version is not None and all(path_exists(spark, _path(base, what, version)) for what in OWN)


def drop_unused(spark: SparkSession, base: str, version: int) -> None:
    """Deltas of pairs that neither this version nor the one before needs go."""
    if not has_sums(spark, base, version):
        return
    used = {v for x in (version - 1, version) if has_sums(spark, base, x) for v in pair_versions(spark, base, x)}
    delete_glob(spark, f"{base}/warehouse/{PAIRS}/version=*", lambda name: int(name.split("=")[1]) not in used)


def changes(spark: SparkSession, base: str, shown: dict[str, int], newest: dict[str, int | None]) -> D.Changes | None:
    """What has changed since the versions ``shown`` of the latest tables; None if that cannot be told
    from the newest versions alone."""
    ch, same = D.Changes({}, {}, {}), {}
    for t, v in newest.items():
        known = shown.get(t)
        if known is None or v is None or not known <= v <= known + 1:
            return None
        folder, schema = f"{base}/latest/{t}", schemas.SOURCES[t]
        rows = changed_rows(spark, folder, schema, v if v > known else None)
        if rows is None:
            return None
        ch.keys[t] = changed_keys(spark, folder, schema, schemas.SOURCE_KEYS[t], v if v > known else None)
        ch.old[t], ch.new[t] = rows
        same[t] = unchanged_rows(spark, folder, schema, v, v > known)
    ch.old, ch.new = C.clean_all(ch.old, deduped=True), C.clean_all(ch.new, deduped=True)
    if all(df is not None for df in same.values()):
        ch.same = C.clean_all(same, deduped=True)
    return ch


def write_whole(spark: SparkSession, base: str, version: int, p: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The sums of a version from the whole processed layer, and the marts from them."""
    _write(D.add_up(D.daily_rows(p), D.DAILY), base, DAILY, version)
    rows = materialize(D.product_rows(p), "product_orders")
    _write_pairs(spark, D.pairs_of(rows), base, version, [version])
    _write(D.with_customers(rows, _read(spark, base, PAIRS, version)), base, PRODUCTS, version)
    return _marts(spark, base, version, p) | {"customer_ltv": M.customer_ltv(p["orders"], p["customers"])}


def write_changed(spark: SparkSession, base: str, last: int, version: int, after: dict[str, DataFrame], ch: D.Changes,
                  previous_ltv: DataFrame) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """The sums of a version from those of ``last`` and the changes since; the marts from them, and of
    each mart the partitions (column ``part``) of its check state with rows that can differ."""
    was, now = D.touched_states(after, ch)
    daily = materialize(D.difference(D.daily_rows(now), D.daily_rows(was), D.DAILY), "daily_delta")
    _write(D.apply_delta(_read(spark, base, DAILY, last), daily, D.DAILY), base, DAILY, version)
    rows = {n: materialize(D.product_rows(p), f"product_orders_{n}") for n, p in (("now", now), ("was", was))}
    stored, of = read_pairs(spark, base, last), pair_versions(spark, base, last)
    totals, delta = D.product_deltas(rows["now"], rows["was"], stored)
    if len(of) < CHAIN:
        _write_pairs(spark, delta, base, version, [*of, version])
    else:
        _write_pairs(spark, D.apply_delta(stored, delta, D.PAIRS), base, version, [version])
    _write(D.apply_delta(_read(spark, base, PRODUCTS, last), totals, D.PRODUCTS), base, PRODUCTS, version)
    customers = materialize(D.touched_customers(ch), "touched_customers")
    ids = rows["now"].select("product_id").unionByName(rows["was"].select("product_id")).unionByName(ch.keys["products"].select("product_id"))
    touched = {"daily_sales": daily, "product_performance": ids, "customer_ltv": customers}
    parts = {m: df.select(Q.state_part(m).alias("part")).distinct() for m, df in touched.items()}
    return _marts(spark, base, version, after) | {"customer_ltv": D.refreshed_ltv(previous_ltv, after, customers)}, parts


def _marts(spark: SparkSession, base: str, version: int, p: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {"daily_sales": D.daily_sales(_read(spark, base, DAILY, version)),
            "product_performance": D.product_performance(_read(spark, base, PRODUCTS, version), p["products"])}
