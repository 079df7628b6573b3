"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import math
import tempfile

from pyspark.sql import SparkSession

#: Session settings every job relies on: AQE re-plans joins and splits skewed partitions at
#: run time; the UI stays off (no server); timestamps are UTC so dates never shift.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # keep small shuffles spread over the cores: rows here are text-heavy CPU work per byte
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "sheetfold",
                  conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Point ``checkpoint()`` at the cluster's shared folder (``spark.checkpoint.dir``).

    Only a local-mode session without that setting (tests, the bench) gets a fresh temp folder;
    on a cluster a missing setting is an error, never a machine-local fallback. A session
    without a local SparkContext (Spark Connect) uses the server's setting as is.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: no SparkContext on the client
        if not configured:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = configured or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="sheetfold-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


#: Target bytes per input split and per shuffle partition.
TARGET_PARTITION_BYTES = 128 * 1024 * 1024
#: Upper bound on shuffle partitions (map-output bookkeeping grows with maps × partitions). Inputs
#: beyond 12.8 TB meet it: their partitions are larger than the target (1 GB at 100 TB) and sort
#: and aggregate steps may spill.
MAX_SHUFFLE_PARTITIONS = 100_000


def scale_conf(input_bytes: int, total_cores: int) -> dict[str, str]:
    """Partition sizing for an input of ``input_bytes`` on ``total_cores`` cores: ~128 MB per
    split and per shuffle partition (rounded up to whole waves of tasks) up to
    :data:`MAX_SHUFFLE_PARTITIONS`; AQE then coalesces small partitions and splits skewed ones at run time."""
    waves = max(1, math.ceil(input_bytes / TARGET_PARTITION_BYTES / max(total_cores, 1)))
    return {
        "spark.sql.shuffle.partitions": str(min(waves * max(total_cores, 1), MAX_SHUFFLE_PARTITIONS)),
        "spark.sql.files.maxPartitionBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES),
    }
