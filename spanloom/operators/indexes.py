"""Trace lookup tables: every trace by chain and by API, failed traces by time and by API."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from spanloom.functions import has_text, to_seconds
from spanloom.operators.stats import step_json
from spanloom.operators.tree import Forest
from spanloom.schemas import UNNAMED_API


def later_segment() -> Column:
    """The end of the row key of a long tree's later rows; the first row has the plain key."""
    return F.when(F.col("segment") > 0, F.col("segment"))


def _failed(rows: DataFrame) -> DataFrame:
    return rows.where(
        F.col("error_status") & has_text(F.col("api")) & (F.col("api") != UNNAMED_API)
    )


def failed_by_time(forest: Forest) -> DataFrame:
    start = to_seconds(F.col("start_ms"))
    return _failed(forest.summary()).select(
        F.concat_ws(":", start, "traceid").alias("rowkey"),
        start.alias("starttime"), "traceid", "api", "region",
    )


def failed_by_api(forest: Forest) -> DataFrame:
    start = to_seconds(F.col("start_ms"))
    rows = forest.segments("api", "start_ms", "error_status", "region")
    return _failed(rows).select(
        F.concat_ws(":", "api", start, "traceid", later_segment()).alias("rowkey"),
        "segment", step_json("steps").alias("spans"),
        "traceid", start.alias("starttime"), "api", "region",
    )


def trace_results(forest: Forest) -> DataFrame:
    """Every trace as a call-chain result of one call, with its steps as JSON segments."""
    return forest.segments(
        "api", "trace_md5", "duration", "start_ms", "minute_start", "error_status",
        "rest_times", "mysql_times", "redis_times", "region",
    ).select(
        F.col("api"),
        F.lit(1).cast("bigint").alias("times"),
        "duration", "segment", step_json("steps").alias("spans"),
        F.concat_ws(".", "minute_start", "trace_md5").alias("bucket_md5"),
        F.col("traceid").alias("max_latency_trace"), F.col("traceid").alias("min_latency_trace"),
        F.col("duration").alias("max_latency"), F.col("duration").alias("min_latency"),
        "traceid", "error_status", "start_ms",
        "rest_times", "mysql_times", "redis_times", "region",
    )


def _all_rows(forest: Forest) -> DataFrame:
    return forest.segments(
        "api", "trace_md5", "start_ms", "minute_start", "duration", "region"
    ).select(
        "api", "trace_md5", "segment",
        step_json("steps").alias("spans"),
        "traceid",
        to_seconds(F.col("start_ms")).alias("starttime"),
        F.concat_ws(".", "minute_start", "trace_md5").alias("bucket_md5"),
        "duration", "region",
    )


def all_by_key(forest: Forest, indexes: tuple[str, ...] = ("md5", "api")) -> DataFrame:
    """The lookup rows of every trace segment in one pass: by chain, by API, or both."""
    keys = {"md5": "trace_md5", "api": "api"}
    keyed = F.explode(
        F.array(*[
            F.struct(F.lit(i).alias("index"), F.col(keys[i]).alias("key")) for i in indexes
        ])
    )
    rows = _all_rows(forest).withColumn("k", keyed)
    return rows.select(
        F.col("k.index").alias("index"),
        F.concat_ws(":", "k.key", "starttime", "traceid", later_segment()).alias("rowkey"),
        "segment", "spans", "traceid", "starttime", "bucket_md5", "duration", "region",
    )
