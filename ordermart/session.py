"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
_LOCAL_ROOTS: dict[str, str] = {}  # scratch folder of a local session without the setting


def build_session(master: str | None = None, app: str = "ordermart",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session with the settings every job here assumes.

    AQE re-plans joins and coalesces/splits shuffle partitions from runtime
    sizes; skew-join splitting handles a key holding a large share of rows.
    Timestamps are zone-less (TIMESTAMP_NTZ) end to end; UTC keeps the few
    zone-aware conversions neutral.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.sources.partitionOverwriteMode": "static",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(total_cores: int, advisory_mb: int = 256) -> dict[str, str]:
    """Settings for a large cluster (pass as ``extra`` to ``build_session``).

    Shuffles start with enough partitions to keep each well under executor
    memory at the largest stage (several per core), and AQE coalesces small
    ones to ``advisory_mb`` after measuring them; files are split into
    ``advisory_mb`` scan tasks. A skewed partition (5x the median and above
    the advisory size) of a sort-merge join is split by AQE, and a
    rebalance before a write splits a heavy partition value.
    """
    initial = max(200, 4 * total_cores)
    size = f"{advisory_mb}m"
    return {
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": size,
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor": "0.2",
    }


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and materialised intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session (on a cluster this must
    name shared storage). Only when it is unset and Spark runs in local mode
    (tests, the bench) a scratch folder is created and registered.
    """
    conf_root = spark.conf.get(CHECKPOINT_CONF, None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the checkpoint folder
        if not conf_root:
            raise RuntimeError("spark.checkpoint.dir is not set; point it at shared storage")
        return conf_root.rstrip("/")
    root = conf_root or _LOCAL_ROOTS.get(sc.applicationId) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at shared storage")
        root = _LOCAL_ROOTS.setdefault(sc.applicationId, tempfile.mkdtemp(prefix="ordermart-ckpt-"))
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    return os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")
