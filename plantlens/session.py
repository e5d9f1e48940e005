"""Session construction and cluster-wide settings."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings every job in the library assumes.  The time zone matters: HOUR(),
# CAST(ts AS DATE) and DATE_TRUNC depend on it.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # timestamps of files without a zone are instants in the session's zone (UTC),
    # as every job casts them; read so, their filters reach the scan
    "spark.sql.parquet.inferTimestampNTZ.enabled": "false",
}


def is_local(master: str | None) -> bool:
    return bool(master) and master.startswith("local") and not master.startswith("local-cluster")


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "plantlens", extra: dict | None = None) -> SparkSession:
    """A session.  Sizes (shuffle partitions, driver memory, broadcast threshold)
    are set for a local ``master`` only, or where given; on a cluster the
    submitter's values stand."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        **REQUIRED_CONF,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if is_local(master):
        conf |= {
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": os.environ.get("PLANTLENS_DRIVER_MEMORY", "16g"),
            "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
        }
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf |= extra or {}
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the library depends on to an existing session."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str = "/tmp/plantlens-checkpoints") -> str:
    """Shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    The setting is only read, never overwritten.  ``fallback`` is a folder of
    this machine, so it serves local masters only (tests); elsewhere a missing
    setting is an error, as executors would write to their own disks."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if d:
        return d
    if not is_local(spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return fallback
