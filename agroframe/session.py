"""Session construction and cluster-safe housekeeping."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults for a session we create ourselves.  On a cluster the submitter's
# settings win: getOrCreate() returns the existing session untouched.
_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Suggested settings for a large cluster (~100 TB input, ~1000 executors).
# The library never forces them on an existing session; pass them at submit
# time or through ``get_session(extra=CLUSTER_CONF)`` when it creates one.
CLUSTER_CONF = {
    # start shuffles wide and let AQE coalesce to ~256 MB partitions, so no
    # reducer holds more than a few hundred MB whatever the scale factor
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # scan splits of 512 MB: about 200k input tasks for 100 TB of Parquet
    "spark.sql.files.maxPartitionBytes": "512m",
    # skewed join partitions (e.g. rows joined to a hot group) are split at runtime
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    # broadcast only what AQE measured small; bounded tables carry explicit hints
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    # Arrow batches for the pandas functions (covariance partials, scoring)
    "spark.sql.execution.arrow.maxRecordsPerBatch": "20000",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "agroframe", extra: dict | None = None) -> SparkSession:
    """Return (or create) a SparkSession with AQE on and the UI off."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(_DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure reliable checkpoints have a home.

    The cluster names a shared folder in ``spark.checkpoint.dir``; we use it
    as is.  Only when nothing is configured *and* the master is local (tests,
    benches) do we fall back to a fresh temporary folder.  On a cluster with
    no setting we refuse rather than write to a machine-local path.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            configured = None
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        configured = tempfile.mkdtemp(prefix="agroframe-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def materialize(df, name: str = "stage", **options):
    """Write *df* once as a Parquet table in the shared checkpoint folder and read it back.

    Used where one compact intermediate (e.g. the weekly grain of the raw
    panel) feeds several branches of a plan: every branch then reads the
    table instead of re-scanning the raw input, and the lineage is cut so a
    lost executor recomputes nothing upstream of it.  Unlike an RDD
    checkpoint this is a single job, and the read-back scan keeps column
    pruning and size statistics (so small sides can still be broadcast).
    *options* are the writer's (e.g. ``compression="zstd"``).
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.parquet(path)


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession):
    """Within it, a query's shuffle files go when the query ends, not when the driver happens to collect its garbage.

    For queries that write what is read later: their shuffles would stay on disk beside those of the next ones.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def shared_path(spark: SparkSession, name: str) -> str:
    """A path in the shared checkpoint folder that nothing else uses."""
    path = os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def kept(spark: SparkSession, name: str, write) -> str:
    """Path of the artefact *name* of this session in the shared folder; ``write(path)`` makes it if it is not there.

    It is written beside its place and renamed, so a path that exists is whole.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = os.path.join(ensure_checkpoint_dir(spark), f"{name}-{spark.sparkContext.applicationId}")
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(conf)
    if not fs.exists(target):
        fresh = f"{path}-{uuid.uuid4().hex}"
        write(fresh)
        if not fs.rename(jvm.org.apache.hadoop.fs.Path(fresh), target) and not fs.exists(target):
            raise OSError(f"cannot rename {fresh}")
        _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


_WRITTEN: dict[str, list[str]] = {}


def drop_materialized(spark) -> int:
    """Delete what ``materialize`` and ``kept`` have written in this session; returns the number of folders.

    For long sessions, between jobs: frames that still read them must not be used afterwards.
    """
    paths = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        drop_path(spark, path)
    return len(paths)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete the folder *path*, which this session wrote and nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
