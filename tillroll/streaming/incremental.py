"""Exactly-once incremental ingestion with Structured Streaming.

The file source keeps the set of already-processed files in its checkpoint,
so a run-once (``availableNow``) query reads only files landed since the last
run -- the streaming equivalent of the high-water-mark extract, without its
strict-``>`` and equal-timestamp pitfalls.  Each micro-batch is written by
``foreachBatch`` into a folder named after its batch id with overwrite
mode: if a batch is replayed after a failure it rewrites the same folder,
so the sink stays exactly-once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StructField, StructType

from ..operators.dedupe import CHANGED, OLD, dedupe_latest, merge_latest
from ..session import delete_glob, delete_path, folder_bytes, path_exists
from ..sinks.log import append_log, newest_rows, newest_version, read_log
from ..sinks.writers import write_observed
from ..sources.raw import read_folder


def ingest_available_now(spark: SparkSession, source_dir: str, schema: StructType,
                         sink_dir: str, checkpoint_dir: str, max_files_per_batch: int = 1000) -> int:
    """Process every file not yet seen, then stop.  Returns rows written.

    A large backlog is consumed in micro-batches of at most
    ``max_files_per_batch`` files (``availableNow`` honours the limit), so no
    single batch has to hold the whole backlog.  Duplicates across batches are the
    business of ``maintain_latest``.
    """
    written: list[int] = []

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # Rows counted during the write itself (the progress log keeps only
        # the most recent batches).
        written.append(write_observed(batch, f"{sink_dir}/batch_id={batch_id}", "overwrite")["rows"])

    _run_available(spark, source_dir, schema, checkpoint_dir, max_files_per_batch, write_batch)
    return int(sum(written))


def _run_available(spark, source_dir, schema, checkpoint_dir, max_files, write_batch) -> None:
    query = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(source_dir)
             .writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint_dir)
             .foreachBatch(write_batch).start())
    query.awaitTermination()


def read_sink(spark: SparkSession, sink_dir: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(sink_dir).select(*[F.col(f.name) for f in schema.fields])


#: A fold adds one row: the version, into how many buckets keys are dealt, and which of them it has rewritten.
COMMITTED = "version long, buckets int, rewritten array<int>"
#: A bucket is one task's: at the first fold there are as many as hold about this much of the waiting files each.
BUCKET_BYTES = 8 << 20


def committed_version(spark: SparkSession, latest_dir: str) -> int | None:
    """The newest version whose write has ended; None before the first.

    Versions count only once they are in this log, to which a fold adds a row after
    its files are complete.  Files that a broken write left are of a version that is
    not in it, so they are never read.
    """
    return newest_version(spark, f"{latest_dir}/committed")


def _placements(spark: SparkSession, latest_dir: str, v: int | None) -> dict[int, int]:
    """Of each bucket the version that wrote it last, as of version ``v`` (at most ``buckets`` entries)."""
    rows = read_log(spark, f"{latest_dir}/committed", COMMITTED).filter(F.col("version") <= F.lit(v))
    newest = rows.select("version", F.explode("rewritten").alias("bucket")).groupBy("bucket").agg(F.max("version").alias("version"))
    return {r.bucket: r.version for r in newest.collect()}


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _read_buckets(spark: SparkSession, latest_dir: str, schema: StructType, placed: dict[int, int]) -> DataFrame:
    paths = [f"{latest_dir}/rows/v={v}/bucket={b}" for b, v in sorted(placed.items())]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_version(spark: SparkSession, latest_dir: str, schema: StructType, v: int | None,
                 buckets: list[int] | None = None) -> DataFrame:
    """A version of the table, the newest committed one or the one before it; only some buckets if given."""
    placed = {} if v is None else _placements(spark, latest_dir, v)
    return _read_buckets(spark, latest_dir, schema, placed if buckets is None else {b: placed[b] for b in buckets if b in placed})


def committed_buckets(spark: SparkSession, latest_dir: str) -> int:
    """Into how many buckets the table's keys are dealt (1 before the first fold)."""
    rows = newest_rows(spark, f"{latest_dir}/committed", COMMITTED)
    return rows[0].buckets if rows else 1


def read_rewritten(spark: SparkSession, latest_dir: str, schema: StructType, v: int) -> tuple[DataFrame, list[int]]:
    """The rows of the buckets that version ``v`` has rewritten, with their ``bucket``, and those buckets."""
    path = f"{latest_dir}/rows/v={v}"
    hit = read_log(spark, f"{latest_dir}/committed", COMMITTED).filter(F.col("version") == v).first().rewritten
    rows = spark.read.schema(StructType([*schema.fields, StructField("bucket", IntegerType())])).parquet(path)
    return rows, sorted(hit)


def read_latest(spark: SparkSession, latest_dir: str, schema: StructType) -> DataFrame:
    """The newest version of a table kept by ``maintain_latest``."""
    return read_version(spark, latest_dir, schema, committed_version(spark, latest_dir))


def changed_keys(spark: SparkSession, latest_dir: str, schema: StructType, key: str, v: int | None) -> DataFrame:
    """Keys of the rows that were folded into version ``v`` (none for None)."""
    kind = StructType([schema[key]])
    if v is None:
        return spark.createDataFrame([], kind)
    return spark.read.schema(kind).parquet(f"{latest_dir}/changed/version={v}")


def changed_rows(spark: SparkSession, latest_dir: str, schema: StructType, v: int | None) -> tuple[DataFrame, DataFrame] | None:
    """The old and the new rows of the keys folded into version ``v`` (none for None).

    None if the version has none stored; only the newest version's are kept.
    """
    if v is None:
        return spark.createDataFrame([], schema), spark.createDataFrame([], schema)
    where = f"{latest_dir}/changes/version={v}"
    if v == 0 and committed_version(spark, latest_dir) == 0:  # all its rows are new
        return spark.createDataFrame([], schema), read_version(spark, latest_dir, schema, v)
    if not path_exists(spark, where):
        return None
    rows = spark.read.schema(StructType([*schema.fields, StructField("is_new", BooleanType())])).parquet(where)
    return tuple(rows.filter(F.col("is_new") == F.lit(new)).drop("is_new") for new in (False, True))


def unchanged_rows(spark: SparkSession, latest_dir: str, schema: StructType, v: int | None, changed: bool) -> DataFrame | None:
    """The rows of version ``v``, the newest one, without those of the keys folded into it (if it is ``changed``; else all).

    A scan by the mark that the fold has left in its rows; None if they have no mark.
    """
    if v is None or not changed:
        return read_version(spark, latest_dir, schema, v)
    placed = _placements(spark, latest_dir, v)
    others = _read_buckets(spark, latest_dir, schema, {b: old for b, old in placed.items() if old != v})
    if v == 0:  # all its rows are new
        return others
    marked = _marked_rows(spark, latest_dir, schema, v)
    return None if marked is None else others.unionByName(marked.filter(~F.col(CHANGED)).select(*schema.fieldNames()))


def _marked_rows(spark: SparkSession, latest_dir: str, schema: StructType, v: int) -> DataFrame | None:
    """The rows that version ``v`` has rewritten with the marks of the fold; None if it has left none."""
    rows = spark.read.parquet(f"{latest_dir}/rows/v={v}")
    return rows if CHANGED in rows.columns else None


def _fold(spark: SparkSession, latest_dir: str, schema: StructType, key: str, order_col: str) -> None:
    """Merge the waiting batches into the next version, commit it, drop the batches.

    Only buckets that hold a key of the batches are read and written.  Folding is
    idempotent: a crash at any point leaves the committed version and the batches, and
    the next fold does the same again.
    """
    waiting = read_folder(spark, f"{latest_dir}/waiting")
    if waiting is None:
        return
    batches = spark.read.schema(schema).parquet(f"{latest_dir}/waiting").select(*schema.fieldNames())
    log, newest = f"{latest_dir}/committed", committed_version(spark, latest_dir)
    v = 0 if newest is None else newest + 1
    placed = {} if newest is None else _placements(spark, latest_dir, newest)
    first = newest_rows(spark, log, COMMITTED)
    buckets = first[0].buckets if first else max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), 2, folder_bytes(spark, f"{latest_dir}/waiting") // BUCKET_BYTES)
    hit = sorted(r[0] for r in batches.select(bucket_of(key, buckets).alias("b")).distinct().collect())  # at most ``buckets`` rows
    previous = None if newest is None else _read_buckets(spark, latest_dir, schema, {b: placed[b] for b in hit if b in placed})
    # A key has one row in each batch by now, so rows cross the network once, by bucket, and are merged there.
    by_bucket = [None if df is None else df.withColumn("bucket", bucket_of(key, buckets)) for df in (previous, batches)]
    merged = merge_latest(*by_bucket, ["bucket", key], order_col, deal_by="bucket", marked=previous is not None)
    write_observed(merged, f"{latest_dir}/rows/v={v}", "overwrite", ["bucket"])
    if previous is None:
        changed = spark.read.schema(schema).parquet(f"{latest_dir}/rows/v={v}")
    else:
        changed = _marked_rows(spark, latest_dir, schema, v).filter(CHANGED)
        old = changed.filter(F.col(OLD).isNotNull()).select(*[c if c == key else F.col(f"{OLD}.`{c}`").alias(c) for c in schema.fieldNames()])
        changes = changed.select(*schema.fieldNames()).withColumn("is_new", F.lit(True)).unionByName(old.withColumn("is_new", F.lit(False)))
        write_observed(changes, f"{latest_dir}/changes/version={v}", "overwrite")
    write_observed(changed.select(key), f"{latest_dir}/changed/version={v}", "overwrite")
    append_log(spark, log, [(v, buckets, hit)], COMMITTED)
    # What neither this version nor the one before reads can go.
    for b, old in (_placements(spark, latest_dir, newest - 1) if newest else {}).items():
        if placed.get(b) != old:
            delete_path(spark, f"{latest_dir}/rows/v={old}/bucket={b}")
    delete_glob(spark, f"{latest_dir}/changes/version=*", lambda name: int(name.split("=")[1]) < v)
    delete_path(spark, f"{latest_dir}/waiting")


def maintain_latest(spark: SparkSession, raw_dir: str, schema: StructType, key: str,
                    order_col: str, latest_dir: str, checkpoint_dir: str,
                    max_files_per_batch: int = 1000) -> int | None:
    """Keep ``latest_dir`` = newest version per key of every raw file landed.

    Each micro-batch of new raw files is deduplicated and set aside; at the end of
    the run all of them are merged (``merge_latest``) into the newest version of
    the table at once.  The table is dealt into buckets by the hash of its key (their
    number is that of the shuffle partitions at the first fold, or more if its files are large), and a version rewrites
    only buckets that hold a changed key; the others are read from the version that
    wrote them, and the version before stays readable.  Merging is associative and
    idempotent, so a replayed batch (or a lost stream checkpoint that re-reads old
    files) leaves the same table.  Daily cost is the new rows and their buckets, not
    the whole raw history.  The old and the new rows of the changed keys are stored beside
    the version (``changed_rows``).  Returns the newest committed version.
    """
    _fold(spark, latest_dir, schema, key, order_col)  # batches of a run that broke off

    def set_aside(batch: DataFrame, batch_id: int) -> None:
        newest = dedupe_latest(batch.select(*schema.fieldNames()), key, order_col)
        write_observed(newest, f"{latest_dir}/waiting/batch_id={batch_id}", "overwrite")

    _run_available(spark, raw_dir, schema, checkpoint_dir, max_files_per_batch, set_aside)
    _fold(spark, latest_dir, schema, key, order_col)
    return committed_version(spark, latest_dir)
