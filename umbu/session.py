"""Session settings the jobs are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution is what splits a hot join key, evens out the files of a
# rebalanced write and merges small shuffle partitions; the shuffle width is
# only a ceiling for it, so it can be generous on a cluster; ``WIDTH`` is for some
# hundred gigabytes of shuffle, and a parameter for more.
WIDTH = "2000"
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": WIDTH,
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def build_session(app_name: str, master: str | None = None, **extra: str) -> SparkSession:
    """Session with the settings above; ``extra`` adds or replaces some."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
