"""Session helpers: one place for the configuration the library relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# While it is set, a write's shuffle files go as soon as the write has ended.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Settings every job wants regardless of cluster size.  Shuffle partition
# count is left to the caller (cluster default or ``shuffle_partitions``);
# AQE coalesces small partitions and splits skewed ones at runtime.
_BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "recbrook",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's base configuration."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def scale_conf(input_bytes: int, total_cores: int,
               target_partition_bytes: int = 128 << 20) -> dict[str, str]:
    """Settings for a cluster run over ``input_bytes`` of input.

    Shuffle partitions: enough that each holds about
    ``target_partition_bytes`` of the largest shuffle (taken as the input
    size), and at least two per core; AQE then coalesces small ones and
    splits skewed ones.  Scans split at the same size.  For 100 TB on 1000
    executors x 8 cores this gives ~800k partitions of 128 MB.
    """
    parts = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        # explicit broadcasts are bounded by construction; the automatic
        # threshold stays at a size every executor can hold
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, reading ``spark.checkpoint.dir`` first.

    On a cluster the folder must be shared storage named by the cluster
    configuration.  Only a local-mode session without that setting (tests)
    gets a private scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="recbrook-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is unset; point it at shared storage before "
        "running iterative or streaming jobs on a cluster")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for intermediate tables, under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "recbrook-tables", name)
