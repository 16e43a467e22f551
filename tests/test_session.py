from pyspark.sql import functions as F

from tillroll.session import REQUIRED_CONF, SHUFFLE_PARTS, apply_required_conf, materialize, scratch_path, shared_dir


def test_shared_dir_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    base = shared_dir(spark)
    if configured:
        assert base == configured.rstrip("/")
    assert scratch_path(spark, "x").startswith(base + "/tillroll/x/")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_materialize_writes_once_under_the_shared_dir(spark):
    df = spark.range(1000).withColumn("v", F.col("id") % 7)
    stored, rows = materialize(df, "t_stage", with_rows=True)
    assert rows == 1000
    assert sorted(stored.collect()) == sorted(df.collect())
    from urllib.parse import urlparse
    base = urlparse(shared_dir(spark)).path
    assert all(urlparse(f).path.startswith(base) for f in stored.inputFiles())


def test_required_settings_are_applied(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    apply_required_conf(spark)
    for key, value in REQUIRED_CONF.items():
        assert spark.conf.get(key) == value


def test_tasks_are_bounded_and_smaller_settings_stay(spark):
    read, joined = "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    parts = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    was = {k: spark.conf.get(k, None) for k in (read, joined, parts)}
    try:
        spark.conf.set(read, "128MB")
        spark.conf.set(joined, "4m")
        spark.conf.set(parts, "8")
        apply_required_conf(spark)
        assert spark.conf.get(read) == str(16 << 20) and spark.conf.get(joined) == "4m"
        assert spark.conf.get(parts) == str(SHUFFLE_PARTS)
        spark.conf.set(parts, "5000")
        apply_required_conf(spark)
        assert spark.conf.get(parts) == "5000"
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_cluster_without_a_shared_folder_is_an_error(monkeypatch):
    import pytest
    from tillroll import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())


def test_stage_scope_deletes_what_was_written_inside(spark):
    from tillroll.session import stage_scope
    import os
    with stage_scope(spark):
        path = materialize(spark.range(5), "t_scope").inputFiles()[0].removeprefix("file://")
        assert os.path.exists(path)
    assert not os.path.exists(path)
