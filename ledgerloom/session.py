"""Session settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE re-plans joins from measured shuffle sizes: it broadcasts a side only when its real size is under the
# threshold, splits skewed join partitions and merges small ones. No operator forces a broadcast by hint.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    # call-site capture per column operation costs seconds on plans of this width
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName("ledgerloom")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()
