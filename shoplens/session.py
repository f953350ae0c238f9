"""Session construction."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

# Cluster-neutral settings. Executor count, memory and the initial shuffle
# width belong to the submit command: set spark.sql.shuffle.partitions (or
# spark.sql.adaptive.coalescePartitions.initialPartitionNum) high there, and
# adaptive execution merges what a query does not need.
DEFAULTS: Mapping[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def create_session(
    app_name: str,
    master: str | None = None,
    config: Mapping[str, str] | None = None,
    log_level: str = "WARN",
) -> SparkSession:
    """Start (or join) a session; without ``master`` the submit command decides."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(config or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel(log_level)
    return spark
