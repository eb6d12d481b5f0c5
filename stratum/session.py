"""Session construction and shared-storage locations.

Cluster jobs must only write scratch data to shared storage.  The location
comes from ``spark.checkpoint.dir`` of the running session; only when it is
unset (local tests) do we create one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale.  Shuffle partitions are a starting point:
# AQE coalesces small partitions and splits skewed ones at runtime.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[8]", app: str = "stratum",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint dir.  Unset, a local session gets a
    temporary one; a cluster fails, since its nodes share no local folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="stratum-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


def shared_dir(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A folder next to the checkpoint dir (shared storage on a cluster)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = "/".join([base, "stratum", *parts])
    if unique:
        path = f"{path}/{uuid.uuid4().hex}"
    return path


def local_path(uri: str) -> str:
    """Strip a ``file:`` scheme (only used by local tests)."""
    if uri.startswith("file:"):
        uri = uri[len("file:"):]
        while uri.startswith("//"):
            uri = uri[1:]
    return os.path.abspath(uri)
