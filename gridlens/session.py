"""Session settings shared by the library, tests and the bench."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings the library relies on: UTC wall clock for every timestamp, AQE for
# runtime re-planning (partition coalescing, skew splits, broadcast switch).
_CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
    # Python call-site capture for error context costs a JVM round-trip per
    # Column call while plans are built; batch jobs do not need it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, *, shuffle_partitions: int = 8,
                  app_name: str = "gridlens", extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster, pass the cluster's own settings via ``extra``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_CORE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("GRIDLENS_DRIVER_MEMORY", "8g"))
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Every operator assumes the session clock is UTC (timestamps are UTC instants)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    Uses the cluster's ``spark.checkpoint.dir`` when set.  Where it is unset, a
    single-machine session (tests, the bench) gets a scratch folder of its own;
    a cluster must name a folder that all executors share, so there it is an error.
    """
    sc = spark.sparkContext
    configured = sc.getCheckpointDir()
    if not configured:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured and re.fullmatch(r"local(\[.*\])?", sc.master):
            configured = tempfile.mkdtemp(prefix="gridlens-ckpt-")
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(configured)
        configured = sc.getCheckpointDir() or configured
    return configured.rstrip("/")
