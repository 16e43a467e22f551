"""Spark session and shared-storage helpers.

The library never hard-codes cluster settings: on a cluster the session is
built by the platform and we only read from it.  ``local_session`` exists for
tests, the bench and the smoke entry point.
"""

from __future__ import annotations

import atexit
import contextlib
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import SparkSession

# Settings every job relies on for correct results (not tuning knobs).
REQUIRED_CONF = {
    # Day boundaries of zone-less timestamps must not depend on the host.
    "spark.sql.session.timeZone": "UTC",
    # An overflow or a bad cast must fail, not turn into NULL or wrap round.
    "spark.sql.ansi.enabled": "true",
    # Runtime re-planning: broadcast small join sides by measured size,
    # coalesce tiny shuffle partitions, split skewed join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when the split costs one more shuffle for
    # the aggregate that follows (the item marts join on order_id and then
    # aggregate per order); acts only when a skewed partition is detected.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Settings that bound what one task holds, so that it does not grow with the tables: a dedupe
# sorts, before and after its shuffle, all rows of a task.  Smaller values of a session stay.
TASK_BYTES = {
    # What a task reads of files.
    "spark.sql.files.maxPartitionBytes": 16 << 20,
    # Up to what size AQE gives neighbouring shuffle partitions to one task.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20,
    # From what size on a partition can count as skewed and be split.
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": 64 << 20,
}
#: Into how many partitions AQE cuts a shuffle at least, before it puts small ones together.  Up to so
#: many (``spark.shuffle.sort.bypassMergeThreshold``) a task writes rows as they come and holds none.
SHUFFLE_PARTS = 200


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "tillroll") -> SparkSession:
    """A local session configured like the tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_required_conf(spark)
    return spark


def apply_required_conf(spark: SparkSession) -> None:
    """Set the runtime SQL settings the operators assume (idempotent)."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    for k, most in TASK_BYTES.items():
        if _bytes(spark.conf.get(k)) > most:
            spark.conf.set(k, str(most))
    parts = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if int(spark.conf.get(parts, None) or spark.conf.get("spark.sql.shuffle.partitions")) < SHUFFLE_PARTS:
        spark.conf.set(parts, str(SHUFFLE_PARTS))


def _bytes(size: str) -> int:
    """A size as Spark's settings name it (``64m``, ``67108864b``, ``1GB``) in bytes."""
    number, unit = re.fullmatch(r"(-?\d+)([kmgtp]?)b?", size.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


_LOCAL_DIRS: dict[int, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Base folder on storage every executor can reach.

    Uses the cluster's ``spark.checkpoint.dir`` (or the checkpoint folder
    already set on the context).  Only when neither is set and the master is
    local -- tests -- do we create one of our own; on a cluster a folder of
    one machine would lose rows, so that is an error.
    Works on sessions without a ``SparkContext`` handle (Spark Connect).
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = _context(spark)
    current = context.getCheckpointDir() if context is not None else None
    if current:
        return current.rstrip("/")
    if context is None or not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if id(spark) not in _LOCAL_DIRS:
        local = tempfile.mkdtemp(prefix="tillroll-ckpt-")
        context.setCheckpointDir(local)
        _LOCAL_DIRS[id(spark)] = local
    return _LOCAL_DIRS[id(spark)]


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 -- no context handle (Spark Connect)
        return None


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique folder under the shared directory."""
    return "/".join([shared_dir(spark), "tillroll", *parts, uuid.uuid4().hex[:12]])


# Stage tables written by this application and not deleted yet.
_STAGES: list[str] = []


def _hadoop(spark: SparkSession, path: str):
    """The store that ``path`` is on and the path as that store's object."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(context._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    store, target = _hadoop(spark, path)
    return store.exists(target)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """What the files below a folder come to."""
    store, target = _hadoop(spark, path)
    return store.getContentSummary(target).getLength()


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever store it is on; nothing happens if it is not there."""
    store, target = _hadoop(spark, path)
    store.delete(target, True)


def delete_glob(spark: SparkSession, pattern: str, only: Callable[[str], bool] = lambda name: True) -> None:
    """Delete the files and folders that match and whose name is wanted; nothing happens if there are none."""
    store, target = _hadoop(spark, pattern)
    for status in store.globStatus(target) or []:
        if only(status.getPath().getName()):
            store.delete(status.getPath(), True)


def drop_stages(spark: SparkSession, since: int = 0) -> None:
    """Delete the stage tables written after the first ``since`` ones.

    Frames that read them are of no use afterwards.
    """
    while len(_STAGES) > since:
        delete_path(spark, _STAGES.pop())


@contextlib.contextmanager
def stage_scope(spark: SparkSession) -> Iterator[None]:
    """Stage tables written inside are deleted at the end, also after an error.

    For runs whose results are written tables, not for frames still to be read.
    """
    since = len(_STAGES)
    try:
        yield
    finally:
        drop_stages(spark, since)


@atexit.register
def _drop_all() -> None:
    """What lazily read results have kept goes when the application ends."""
    spark = SparkSession.getActiveSession()
    if spark is not None and _STAGES:
        with contextlib.suppress(Exception):  # the JVM may have gone first
            drop_stages(spark)


def materialize(df, name: str = "stage", with_rows: bool = False):
    """Write ``df`` once to the shared folder and return the read-back frame.

    Cuts the lineage in one pass (``checkpoint()`` computes its input twice
    unless it is cached first) and survives executor loss: later stages
    re-read files instead of recomputing the plan.  Row order inside the
    files is fixed, so anything sampled from the result is reproducible.
    With ``with_rows`` also returns the row count, observed during the write.
    """
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    spark = df.sparkSession
    path = scratch_path(spark, "stage", name)
    obs = Observation(f"stage_{uuid.uuid4().hex[:8]}")
    (df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
       .option("compression", "zstd").parquet(path))
    _STAGES.append(path)
    out = spark.read.parquet(path)
    return (out, int(obs.get["rows"])) if with_rows else out
