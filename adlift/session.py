"""Session settings the engine relies on, and where it may write checkpoints."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings that change results, not only speed. Day boundaries are UTC and column
# names resolve case-insensitively (campaignId and campaignid are one column).
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.caseSensitive": "false",
}

# Settings for the physical plan: runtime re-planning, skew splitting and
# rebalanced partitioned writes.
PLAN_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Let AQE coalesce and split inside persisted plans too.
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Pin the runtime SQL settings the engine's semantics depend on."""
    for key, value in {**RESULT_SETTINGS, **PLAN_SETTINGS}.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session. Only a local-mode session
    (tests, a laptop) without one gets a private temporary folder; on a cluster a
    machine-local folder would not survive the loss of that machine, so it is an
    error instead.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/object store) for this cluster")
    path = tempfile.mkdtemp(prefix="adlift-ckpt-")
    sc.setCheckpointDir(path)
    return path


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "adlift",
                  min_partition_size: str = "64k") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Test-scale tables shuffle well under a megabyte; AQE's default 1 MB
        # minimum would coalesce every stage into one task on one core.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", min_partition_size)
    )
    for key, value in {**RESULT_SETTINGS, **PLAN_SETTINGS}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
