"""SparkSession helpers.

On a cluster the session comes from the caller; these helpers only add what a
local run needs and never override what the cluster already configured.
"""

from __future__ import annotations

import math
import os
import tempfile

from pyspark.sql import SparkSession

# SQL settings the pipeline relies on (runtime-settable on any session)
LOCAL_SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
_LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    **LOCAL_SQL_CONF,
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "pipewright") -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("PIPEWRIGHT_DRIVER_MEMORY", "8g"))
    )
    for k, v in _LOCAL_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints and written tables.

    Reads ``spark.checkpoint.dir`` from the session.  Only a local-mode
    session (tests) without that setting gets a private scratch folder; on a
    cluster an unset folder is an error, as executors cannot share a
    machine-local path.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="pipewright-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scale_conf(input_bytes: int, total_cores: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """SQL settings for a large run, sized from the input volume.

    The shuffle starts with about one partition per ``partition_bytes`` of
    input (at least two per core, so every core has work) and AQE coalesces
    small ones and splits skewed ones at run time.  Broadcasts stay decided by
    AQE on runtime sizes below the threshold.
    """
    shuffle = max(2 * total_cores, math.ceil(input_bytes / partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # on a shared cluster coalesce to the advisory size instead of many
        # small tasks (measured slower on a single local machine, so the local
        # session keeps Spark's default)
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes // 2),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.session.timeZone": "UTC",
    }


def apply_conf(spark: SparkSession, conf: dict[str, str]) -> None:
    """Set runtime SQL settings on a live session."""
    for k, v in conf.items():
        spark.conf.set(k, v)
