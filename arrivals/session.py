"""Session and scratch-space helpers.

Everything heavy runs through the DataFrame API; this module only builds a
session for local runs/tests and resolves the shared scratch folder that
queries writing intermediate files must use.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


# Settings for the cluster profile (about 100 TB of raw input, ~1000 executors).
# AQE re-plans at run time: it coalesces the many shuffle partitions to the
# advisory size, turns joins whose measured side is small into broadcast
# joins, and splits skewed partitions of sort-merge joins and rebalanced
# writes. AQE merges small shuffle partitions but splits only skewed ones, so
# their number follows the input (SHUFFLE_PARTITION_BYTES each).
SHUFFLE_PARTITION_BYTES = 256 << 20
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.session.timeZone": "UTC",
}


def apply_cluster_conf(spark: SparkSession, input_gb: float | None = None) -> None:
    """Set the runtime SQL settings of the cluster profile on a session.

    With the size of the input the shuffles get a partition per 256 MB of it
    (100 TB: 390 625), never fewer than the session has; without it the
    session's own number stays.
    """
    for k, v in CLUSTER_CONF.items():
        spark.conf.set(k, v)
    if input_gb:
        have = int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.conf.set("spark.sql.shuffle.partitions", str(max(have, round(input_gb * 1e9 / SHUFFLE_PARTITION_BYTES))))


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "arrivals") -> SparkSession:
    """A local session configured like the cluster profile (AQE on, UTC, no UI)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is a distributed file system path every executor can
    reach, and it must be configured: a machine-local folder would not
    survive the loss of the machine. Only a local-mode session without one
    (a test) gets a private temporary folder, registered as its checkpoint
    dir.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        try:
            base = spark.sparkContext.getCheckpointDir()
        except Exception:  # Spark Connect has no SparkContext
            base = None
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; set it to a shared folder (e.g. on HDFS or an object store)"
            )
        base = tempfile.mkdtemp(prefix="arrivals-checkpoint-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared scratch folder."""
    return f"{scratch_root(spark)}/arrivals/{name}-{uuid.uuid4().hex}"


def unique_table_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"
