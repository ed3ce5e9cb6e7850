"""Session construction and the shared work folder.

Sinks, stream checkpoints and lineage cuts write below one shared folder:
the one the cluster names in ``spark.checkpoint.dir``.  Only when that is
unset (local runs, tests) do we create our own and register it.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Settings for the large cluster (about 100 TB of input, ~1000 executors).
# AQE starts from many shuffle partitions and coalesces them to ~256 MB each,
# splits skewed join partitions and hot rebalance partitions; scans read
# 256 MB splits; runtime broadcast only below 64 MB of measured size.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "16000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.files.maxRecordsPerFile": "20000000",
}


def build_session(master: str | None = "local[8]", shuffle_partitions: int | None = 8,
                  app_name: str = "ledgerlake", extra: dict | None = None) -> SparkSession:
    """A session with the pipeline's defaults.

    ``master=None`` keeps whatever the launcher configured (a cluster);
    ``shuffle_partitions=None`` keeps the configured value.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # Spark Connect
        pass
    return spark


def work_root(spark: SparkSession) -> str:
    """The shared folder for sinks and checkpoints.

    Read from the session; fall back to a fresh local folder only when the
    cluster names none (local runs and tests), and register it so that
    ``DataFrame.checkpoint()`` uses the same place.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session has no SparkContext
        sc = None
    root = sc.getCheckpointDir() if sc is not None else None
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[[^]]*\])?", master):
            raise RuntimeError("spark.checkpoint.dir is unset: a cluster needs a folder that all executors share")
        root = tempfile.mkdtemp(prefix="ledgerlake-")
        if sc is not None:
            sc.setCheckpointDir(root)
            root = sc.getCheckpointDir() or root
        else:
            spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, never-used folder below the work root (no clearing needed)."""
    return f"{work_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python code can inspect a local path."""
    if path.startswith("file:"):
        path = path[5:]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)
