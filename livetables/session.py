"""Session helpers: build a session for local runs and find shared folders.

On a cluster the caller owns the session. The library only reads settings
from it; when `spark.checkpoint.dir` is unset it registers a temp folder for
local masters only (local runs and tests) and refuses on a cluster.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on. AQE re-plans joins and coalesces shuffle
# partitions at run time; skew join splits hot partitions.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "true",
    # remove reliable-checkpoint files once their DataFrame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Spark broadcasts a side only if its bytes are known to be small: 10 MB of
    # files when planning, 64 MB of measured shuffle output at run time. No
    # operator forces a broadcast.
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
}


# Starting points for a large cluster (about 1000 executors, 100 TB inputs).
# Scans: 256 MB splits keep the task count near 400k for 100 TB while each
# task's input still fits executor memory comfortably. Shuffles: start wide
# (AQE coalesces small partitions to the advisory size after each stage), so
# a 20 TB shuffle still lands near 256 MB per reducer; skewed partitions
# larger than 5x the median and 512 MB are split by AQE. Broadcasts: see
# RECOMMENDED_CONF.
CLUSTER_CONF = {
    **RECOMMENDED_CONF,
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
}


def apply_conf(spark: SparkSession, conf: dict[str, str] = CLUSTER_CONF) -> None:
    """Apply the runtime-changeable settings of `conf` to a running session."""
    for k, v in conf.items():
        if k.startswith("spark.sql."):          # core settings are fixed at start-up
            spark.conf.set(k, v)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "livetables",
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    """A local session with the recommended settings (tests, bench)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", "8g"))
    for k, v in {**RECOMMENDED_CONF, **(extra_conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    Reads `spark.checkpoint.dir`; only when it is unset (local runs) a folder
    under the system temp directory is chosen and registered.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        try:
            set_by_caller = spark.sparkContext.getCheckpointDir()
        except Exception:          # a Spark Connect session has no context here
            set_by_caller = None
        if set_by_caller:          # setCheckpointDir adds a folder of its own per application
            return set_by_caller
    if not configured:
        master = spark.conf.get("spark.master", "") or ""
        if not master.startswith("local"):
            # a machine-local folder is not shared by executors on a cluster
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        # Core settings cannot be changed on a running session; register the
        # folder with the context instead (local runs and tests only).
        configured = os.path.join(tempfile.gettempdir(), "livetables-checkpoints")
    try:
        sc = spark.sparkContext
    except Exception:          # a Spark Connect session has no context here
        return configured
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return configured


def session_key(spark: SparkSession) -> str:
    """An id of the running application (per-session caches key on it)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:
        return spark.conf.get("spark.app.id", None) or str(id(spark))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder, unique per call."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/livetables/{name}-{uuid.uuid4().hex[:12]}"


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"
