"""Global ``rank()`` without moving every row to one task.

A plain ``rank().over(Window.orderBy(...))`` plans an Exchange to a single
partition: one task sorts the whole table.  Instead, at every size:

1. The input is written once, unless it is a plain scan of written files: it
   is read twice, for the counts and for the join back.
2. Counts: one row per distinct value with its multiplicity (hash aggregate
   with map-side combine, so a value shared by a third of the rows costs one
   row per input partition), range-partitioned by value and written, which
   pins the ranges.
3. Each range computes local prefix sums; a prefix over the totals of the
   ranges (one row per range) gives each range's offset.

rank(v) = 1 + number of rows ordered strictly before v, so ties share a rank
and leave gaps, exactly like SQL ``rank()``; NULLs sort last.  The rank is
joined back on the value with a NULL-safe equi-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def _order(col: str, descending: bool) -> Column:
    c = F.col(col)
    return c.desc_nulls_last() if descending else c.asc_nulls_last()


def rank_table(df: DataFrame, col: str, rank_col: str = "rank", descending: bool = True,
               num_ranges: int | None = None, rank_type: str = "long") -> DataFrame:
    """(value, rank) for every distinct value of ``col``."""
    spark = df.sparkSession
    parts = num_ranges or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2)
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("__n"))
    ranged = materialize(counts.repartitionByRange(parts, _order(col, descending))
                               .withColumn("__part", F.spark_partition_id()), "rank_ranges")
    local_before = (Window.partitionBy("__part").orderBy(_order(col, descending))
                    .rowsBetween(Window.unboundedPreceding, -1))
    local = ranged.withColumn("__before", F.coalesce(F.sum("__n").over(local_before), F.lit(0)))
    # One row per range: bounded by ``parts``, whatever the data.
    totals = ranged.groupBy("__part").agg(F.sum("__n").alias("__total"))
    part_before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__part", F.coalesce(F.sum("__total").over(part_before), F.lit(0)).alias("__offset"))
    return (local.join(F.broadcast(offsets), "__part")
                 .select(col, (F.col("__offset") + F.col("__before") + 1).cast(rank_type).alias(rank_col)))


def global_rank(df: DataFrame, col: str, rank_col: str = "rank", descending: bool = True,
                num_ranges: int | None = None, rank_type: str = "long",
                input_is_stored: bool = False) -> DataFrame:
    """``df`` with ``rank_col`` = SQL rank() over the whole frame by ``col``.

    ``rank_type`` is LONG by default: row-level ranks at scale exceed INT.
    ``input_is_stored``: ``df`` is a plain scan of written files.
    """
    if not input_is_stored:
        df = materialize(df, "rank_input")
    ranks = rank_table(df, col, "__rank", descending, num_ranges, rank_type).withColumnRenamed(col, "__value")
    joined = df.join(ranks, df[col].eqNullSafe(ranks["__value"]), "inner")
    return joined.select(*[df[c] for c in df.columns], F.col("__rank").alias(rank_col))
