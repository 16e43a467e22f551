"""Keyed dedupe that keeps the newest row, deterministically.

``max(struct(order_cols..., other cols...))`` per key: the struct compares
field by field (NULL lowest), so the survivor is the row with the greatest
timestamp, ties broken by the remaining columns -- the same row as
``row_number() OVER (PARTITION BY key ORDER BY ts DESC NULLS LAST, c1 DESC
NULLS LAST, ...) = 1``.  Written as an aggregate instead of a window, Spark
runs it with a map-side partial aggregate: a key that holds a third of all
rows is collapsed to one row per input partition before the shuffle, so no
task ever receives the whole hot group.  Structs are not fixed-width, so both
halves are sort aggregates: each task sorts its rows by key, as the window form
would; the gain is the hot key, not the sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize


#: Columns of ``merge_latest`` that tell what a batch has changed.
CHANGED, OLD = "__changed", "__old"


def dedupe_latest(df: DataFrame, keys: Sequence[str] | str,
                  order_by: Sequence[str] | str = ()) -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    order_by = [order_by] if isinstance(order_by, str) else list(order_by)
    columns = df.columns
    rest = [c for c in columns if c not in keys and c not in order_by]
    ranked = order_by + rest
    if not ranked:
        return df.select(*keys).distinct()
    packed = "max(struct({})) AS __best".format(", ".join(f"`{c}`" for c in ranked))
    best = df.groupBy(*keys).agg(F.expr(packed))
    return best.selectExpr(*[f"`{c}`" if c in keys else f"__best.`{c}` AS `{c}`" for c in columns])


def merge_latest(previous: DataFrame | None, batch: DataFrame, keys: Sequence[str] | str,
                 order_by: Sequence[str] | str = (), deal_by: str | None = None, marked: bool = False) -> DataFrame:
    """Newest version per key of ``previous`` (already one row per key) plus
    ``batch``.

    The survivor is a max under a total order, and max is associative, so
    folding batches in one at a time gives exactly ``dedupe_latest`` over the
    whole history -- late rows with older timestamps included -- while each
    run reads only the latest table and the new rows.  ``previous`` must be
    kept before any filter (a filtered-out newest version must still win).
    ``deal_by``: one of ``keys``; rows are shuffled by it alone and come out so, for
    batches that hold few rows of a key (they are not combined before the shuffle).
    ``marked``: with the columns ``CHANGED``, whether the key is in ``batch``, and for those ``OLD``, the other columns of
    its row in ``previous`` (NULL without one), so that neither has to be looked up by a join.
    """
    if marked:
        previous, batch = previous.withColumn(CHANGED, F.lit(False)), batch.withColumn(CHANGED, F.lit(True))
    both = batch if previous is None else previous.unionByName(batch.select(*previous.columns))
    if deal_by is not None:
        both = both.repartition(deal_by)
    if not marked:
        return dedupe_latest(both, keys, order_by)
    keys, order_by = ([x] if isinstance(x, str) else list(x) for x in (keys, order_by))
    columns = [c for c in both.columns if c != CHANGED]
    row = F.struct(*order_by, *[c for c in columns if c not in keys and c not in order_by])
    best = both.groupBy(*keys).agg(F.max(row).alias("__best"), F.max(F.when(~F.col(CHANGED), row)).alias(OLD), F.max(CHANGED).alias(CHANGED))
    return best.select(*[c if c in keys else F.col(f"__best.`{c}`").alias(c) for c in columns],
                       CHANGED, F.when(F.col(CHANGED), F.col(OLD)).alias(OLD))


def distinct_rows(df: DataFrame) -> DataFrame:
    """``df.distinct()`` for stored rows of which few come more than once.

    Rows are hashed, and only those whose hash comes more than once are compared whole: what is shuffled
    of the others is a hash.  Reads ``df`` three times.
    """
    hashed = df.withColumn("__hash", F.xxhash64(*df.columns))
    more = materialize(hashed.groupBy("__hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("__hash"), "repeated_hashes")
    once, again = (hashed.join(more, "__hash", how).select(*df.columns) for how in ("left_anti", "left_semi"))
    return once.unionByName(again.distinct())


def latest_in_two_states(df: DataFrame, key: str, stamp: str, split: Column) -> DataFrame:
    """What ``dedupe_latest`` keeps of the rows stamped up to ``split`` and what it keeps of all rows, from
    one shuffle of the rows.

    One row per key and version kept, with ``in_before`` and ``in_after``: which of the two states it
    belongs to (a key without later rows has one row, in both), and ``changed``: whether the key has a later row.
    """
    early, later = F.coalesce(F.col(stamp) <= split, F.lit(False)), F.coalesce(F.col(stamp) > split, F.lit(False))
    rest = [c for c in df.columns if c not in (key, stamp)]
    marked = df.withColumns({"__row": F.struct(stamp, *rest), "__early": early, "__later": later})
    best = marked.groupBy(key).agg(F.max(F.when(F.col("__early"), F.col("__row"))).alias("__was"),
                                   F.max(F.when(~F.col("__early"), F.col("__row"))).alias("__other"),
                                   F.max("__later").alias("changed"))
    stays = F.col("__other").isNull() | F.coalesce(F.col("__was") > F.col("__other"), F.lit(False))
    versions = F.array(F.struct(F.col("__was").alias("row"), F.lit(True).alias("in_before"), stays.alias("in_after")),
                       F.struct(F.col("__other").alias("row"), F.lit(False).alias("in_before"), (~stays).alias("in_after")))
    rows = best.select(key, "changed", F.explode(versions).alias("__v")).filter(
        F.col("__v.row").isNotNull() & (F.col("__v.in_before") | F.col("__v.in_after")))
    return rows.select(*[key if c == key else F.col(f"__v.row.{c}") for c in df.columns], "__v.in_before", "__v.in_after", "changed")


def of_keys(df: DataFrame, keys: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows of the keys in ``keys`` (one column); those of no such key with ``left_anti``.  NULL is a key."""
    name = keys.columns[0]
    return df.join(keys.select(F.col(name).alias("__key")), df[name].eqNullSafe(F.col("__key")), how)
