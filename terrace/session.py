"""SparkSession factory and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app_name: str = "terrace", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """Session tuned for the medallion jobs. The master is set only when the caller names one, so
    that ``spark-submit --master`` and the cluster's defaults hold otherwise.

    AQE is on so that shuffle widths coalesce to the data, skewed join partitions are split at
    run time, and a join side whose *measured* shuffle output is under
    ``spark.sql.adaptive.autoBroadcastJoinThreshold`` is turned into a broadcast join (the size
    check happens on real bytes, so nothing is broadcast that grows past the limit).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if (master or "").startswith("local"):
        # all executors live in the driver JVM, so it gets half of the machine, 16 GB at most
        half = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES") // 2**31
        builder = builder.config("spark.driver.memory", os.environ.get("TERRACE_DRIVER_MEMORY", f"{max(1, min(16, half))}g"))
    builder = (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "64MB")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    local = spark.sparkContext.master.startswith("local")
    # one machine: a partition per core; a cluster: start wide and let AQE coalesce to the advisory
    # size, so a 100 TB shuffle gets thousands of 256 MB partitions and a small one just a few
    parts = shuffle_partitions or int(os.environ.get("TERRACE_SHUFFLE_PARTITIONS", str((os.cpu_count() or 8) if local else 4000)))
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    if not local:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256MB")
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only when the setting is absent (unit tests, a laptop) is a private folder created.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="terrace-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    spark.sparkContext.setCheckpointDir(configured)
    return configured


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Within, a statement's shuffle files go when it ends; else they stay until the driver's garbage
    collector comes to them, and a job of many writes has all of its exchanges on disk at once."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
