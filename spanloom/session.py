"""A local session with the settings the jobs are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Merges the sessions of a key before the shuffle.
MERGE_SESSIONS = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"


def local_session(cores: str = "8", name: str = "spanloom", memory: str = "8g") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config(MERGE_SESSIONS, "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Building trees costs more processor time than its bytes suggest: keep partitions small.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .getOrCreate()
    )
