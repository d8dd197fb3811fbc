"""Session construction and session-level settings."""

from __future__ import annotations

import tempfile
from functools import cache

from pyspark.sql import SparkSession

# AQE splits skewed join partitions, re-sizes the output of REBALANCE hints and
# coalesces small shuffle partitions at run time, so the static partition count
# only has to be large enough; it is left to the cluster's own configuration.
_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build_session(app_name: str = "meterline", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators rely on.

    ``master`` is only for local runs; on a cluster the submitter names it.
    Extra settings are keyword arguments with ``__`` in place of dots.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in _SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return pin_session(builder.getOrCreate())


# Listing tasks per core when the folders of a partitioned table are listed.
_LISTING_WAVES = 4


def pin_session(spark: SparkSession) -> SparkSession:
    """Runtime options of a session built elsewhere.

    Results depend on the time zone.  Partition folders are listed by a few tasks
    per core instead of one task per folder.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    tasks = min(_LISTING_WAVES * spark.sparkContext.defaultParallelism, 10_000)
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(tasks))
    return spark


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"meterline-{application}-")


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back on a temporary folder: on a cluster the
    executors do not share the driver's disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _local_folder(spark.sparkContext.applicationId)
    raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
