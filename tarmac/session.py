"""Session construction and shared scratch locations.

Scratch data (stream checkpoints, per-batch tables, lineage cuts) lives
under the cluster's shared ``spark.checkpoint.dir``.  A directory of our
own is made only when the session has none (local tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = "local[8]", shuffle_partitions: int | None = 8,
                  app_name: str = "tarmac", extra: dict | None = None,
                  driver_memory: str | None = None) -> SparkSession:
    """A session with the settings every job here assumes.

    On a cluster pass ``master=None`` (spark-submit decides) and size
    ``shuffle_partitions`` to the data (about 128-256 MB of shuffle per
    partition, e.g. 20000+ at 100 TB); AQE coalesces small ones and splits
    skewed join partitions at run time.
    """
    b = SparkSession.builder.appName(app_name)
    if master:  # None: keep what spark-submit / the cluster sets
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:  # local mode: the executors live in the driver JVM too
        b = b.config("spark.driver.memory", driver_memory)
    b = (
        b.config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory, creating a local one only if unset."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not conf:  # one machine: a local folder is shared by all tasks
        conf = tempfile.mkdtemp(prefix="tarmac-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint directory."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/tarmac/{name}-{uuid.uuid4().hex[:12]}"


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its file system named: a bare path means the cluster's default one, not a task's own disk."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString()
