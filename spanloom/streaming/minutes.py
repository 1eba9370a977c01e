"""Call-chain statistics per minute, merged over the batches of the trace stream.

Every batch writes the measures of its traces; a minute may get traces from several batches. Here the
measures are a stream of their own: a minute's row is given out once, when the watermark has passed
it, and its state goes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from spanloom.operators.stats import chain_stats

#: Measures of a trace, as ``Forest.summary`` writes them.
SUMMARY_SCHEMA = (
    "traceid string, api string, trace_md5 string, duration bigint, start_ms bigint, "
    "start_day bigint, minute_start bigint, day_start bigint, error_status boolean, "
    "rest_times bigint, mysql_times bigint, redis_times bigint, region string, steps_total bigint"
)


def summaries(
    spark: SparkSession, path: str, max_files: int | None = None, max_bytes: int | None = None
) -> DataFrame:
    """Streaming measures of a written summary table, oldest files first.

    A batch takes at most ``max_files`` files, or files of about ``max_bytes``; not both. Bytes are the
    better bound where files are small: every batch opens the state of all partitions.
    """
    limits = {"maxFilesPerTrigger": max_files, "maxBytesPerTrigger": max_bytes}
    given = {k: v for k, v in limits.items() if v is not None}
    return spark.readStream.schema(SUMMARY_SCHEMA).options(**given).parquet(path)


def closed_minutes(summary: DataFrame, delay: str) -> DataFrame:
    """Streaming chain statistics per minute; write with output mode ``append``.

    Traces whose minute is more than ``delay`` behind the newest are left out by Spark, so it must
    cover the time that traces wait for their spans.
    """
    timed = summary.withColumn("minute", F.timestamp_seconds("minute_start"))
    chains = chain_stats(timed.withWatermark("minute", delay), "minute")
    return chains.withColumn("minute_start", F.unix_seconds("minute")).drop("minute")
