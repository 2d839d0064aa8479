"""Spark session construction and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the plans rely on.  AQE re-plans joins from runtime sizes (the
# size-checked broadcast), coalesces small shuffle partitions and splits
# skewed join partitions.  Timestamps are wall-clock (NTZ) and the session
# zone is pinned so nothing depends on the host.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.ui.enabled": "false",
    "spark.python.sql.dataFrameDebugging.enabled": "false",       # no call site for every column: plans are built faster
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "skuflow", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with :data:`DEFAULT_CONF`.

    On a cluster pass ``master=None`` and let the launcher decide; tests pass
    ``local[*]``.  ``spark.checkpoint.dir`` is left to the cluster unless unset,
    see :func:`checkpoint_dir`.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    Read from the session (``spark.checkpoint.dir``, or a directory already set
    on the context).  Only when nothing is configured on a ``local`` master
    -- tests -- a scratch folder is created and registered; on a cluster an
    unset folder is an error, never a machine-local fallback.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set; point it at a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="skuflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return str(configured).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
