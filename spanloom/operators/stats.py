"""Call-chain statistics per minute or day, per step, per step name and per address."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from spanloom.functions import has_text
from spanloom.operators.skew import join_sized
from spanloom.operators.tree import SEGMENT_STEPS, Forest
from spanloom.staging import stage

# Weighted means are sum over count with one truncation, so they do not depend on the order
# in which partial results meet. Ties for the slowest (fastest) trace go to the largest
# (smallest) trace id.


def whole_mean(total: Column, count: Column) -> Column:
    return F.call_function("div", total, count)


def chain_stats(summary: DataFrame, bucket: str) -> DataFrame:
    """One row per (bucket, call chain): calls, mean duration, slowest and fastest trace.

    The region is only known for chains called once, as merging results does not carry it.
    """
    timed = F.struct("duration", "traceid")
    grouped = summary.groupBy(bucket, "trace_md5", "api").agg(
        F.count("*").alias("times"),
        F.sum("duration").alias("total"),
        F.max(timed).alias("slowest"),
        F.min(timed).alias("fastest"),
        F.sum("rest_times").alias("rest_times"),
        F.sum("mysql_times").alias("mysql_times"),
        F.sum("redis_times").alias("redis_times"),
        F.max("region").alias("any_region"),
    )
    return grouped.select(
        bucket, "trace_md5", "api", "times",
        whole_mean(F.col("total"), F.col("times")).alias("duration"),
        F.col("slowest.duration").alias("max_latency"),
        F.col("slowest.traceid").alias("max_latency_trace"),
        F.col("fastest.duration").alias("min_latency"),
        F.col("fastest.traceid").alias("min_latency_trace"),
        "rest_times", "mysql_times", "redis_times",
        F.when(F.col("times") == 1, F.col("any_region")).alias("region"),
    )


def chain_steps(forest: Forest, bucket: str) -> DataFrame:
    """One row per step of every call chain: mean duration and errors.

    The descriptive fields are those of the chain's trace with the smallest id.
    """
    steps = forest.steps(bucket, "trace_md5")
    described = F.min(F.struct("traceid", "name", "spanid", "level", "parent", "span_type"))
    return (
        steps.groupBy(bucket, "trace_md5", "pos")
        .agg(
            whole_mean(F.sum(F.col("end") - F.col("begin")), F.count("*")).alias("duration"),
            F.sum("error_count").alias("error_count"),
            described.alias("d"),
        )
        .select(
            bucket, "trace_md5", "pos",
            F.col("d.name").alias("span_name"), F.col("d.spanid").alias("span_id"),
            "duration", F.col("d.level").alias("level"), F.col("d.parent").alias("parent"),
            "error_count", F.col("d.span_type").alias("span_type"),
        )
    )


def step_profile(forest: Forest, bucket: str | None = None) -> DataFrame:
    """Mean time per step name of every call chain: the name's total over the chain's calls."""
    keys = ["trace_md5"] if bucket is None else [bucket, "trace_md5"]
    names = (
        forest.steps(*keys).groupBy(*keys, F.col("name").alias("span_name"))
        .agg(
            F.sum(F.col("end") - F.col("begin")).alias("total"),
            F.count("*").alias("steps"),
            F.count_if(F.col("pos") == 0).alias("roots"),
        )
    )
    # Every call has one root step, so a chain's calls are the sum over its names.
    names = stage(names, "step-names")
    calls = names.groupBy(*keys).agg(F.sum("roots").alias("times"), F.count("*").alias("_size"))
    return join_sized(names, calls, keys, "_size").select(
        *keys, "span_name", "times", "steps",
        whole_mean(F.col("total"), F.col("times")).alias("duration"),
    )


def chain_profile(summary: DataFrame) -> DataFrame:
    """Calls, mean duration, slowest and fastest trace per chain over the whole input.

    A slowest trace needs more than 1 ms and a fastest one less than 9,999,999 ms; without
    one the trace is empty and the latency keeps that bound.
    """
    slow = F.max(F.when(F.col("duration") > 1, F.struct("duration", "traceid")))
    fast = F.min(F.when(F.col("duration") < 9_999_999, F.struct("duration", "traceid")))
    return (
        summary.groupBy("trace_md5", "api")
        .agg(F.count("*").alias("times"), F.sum("duration").alias("total"),
             slow.alias("slow"), fast.alias("fast"))
        .select(
            "api", "trace_md5", "times",
            whole_mean(F.col("total"), F.col("times")).alias("duration"),
            F.coalesce("slow.duration", F.lit(1)).alias("max_latency"),
            F.coalesce("slow.traceid", F.lit("")).alias("max_latency_trace"),
            F.coalesce("fast.duration", F.lit(9_999_999)).alias("min_latency"),
            F.coalesce("fast.traceid", F.lit("")).alias("min_latency_trace"),
        )
    )


def address_totals(forest: Forest) -> DataFrame:
    """Calls and their total duration per (chain, span name, minute, address).

    The root counts for its own address, other spans for the host they called; spans without
    an address are left out. The forest must carry ``ip`` and ``http_host``.
    """
    own = F.col("traceid") == F.col("spanid")
    address = F.when(own, F.col("ip")).otherwise(F.col("http_host"))
    steps = forest.steps("minute_start", "trace_md5").withColumn("address", address)
    return (
        steps.where(has_text(F.col("address")))
        .groupBy("trace_md5", F.col("name").alias("span_name"), "minute_start",
                 F.col("address").alias("ip"))
        .agg(
            F.sum(F.col("end") - F.col("begin")).alias("total_duration"),
            F.count("*").alias("times"),
        )
    )


def address_latency(forest: Forest) -> DataFrame:
    """The same with the mean duration in place of the total."""
    mean = whole_mean(F.col("total_duration"), F.col("times")).alias("avg_duration")
    return address_totals(forest).select(
        "trace_md5", "span_name", "minute_start", "ip", mean, "times"
    )


def step_json(steps: str | Column) -> Column:
    """JSON text of an array of steps; unset fields are left out."""
    return F.to_json(
        F.transform(
            steps,
            lambda t: F.struct(
                t["name"].alias("spanName"),
                t["spanid"].alias("spanId"),
                (t["end"] - t["begin"]).alias("duration"),
                t["level"].alias("level"),
                t["parent"].alias("parent"),
                t["error_count"].alias("errorCount"),
                t["span_type"].alias("spanType"),
            ),
        )
    )


def chain_table(forest: Forest, bucket: str) -> DataFrame:
    """Call-chain statistics with the merged steps as JSON, in segments of bounded length.

    One pass: the first step of every segment carries the measures of its trace.
    """
    steps = forest.steps(
        bucket, "trace_md5", "api", "duration", "rest_times", "mysql_times", "redis_times", "region"
    )
    head = F.col("pos") % SEGMENT_STEPS == 0

    def once(value: str | Column) -> Column:
        return F.when(head, value)

    timed = F.struct("duration", "traceid")
    described = F.min(F.struct("traceid", "name", "spanid", "level", "parent", "span_type"))
    merged = steps.groupBy(bucket, "trace_md5", "api", "pos").agg(
        F.count("*").alias("calls"),
        F.sum(F.col("end") - F.col("begin")).alias("step_total"),
        F.sum("error_count").alias("error_count"),
        described.alias("d"),
        F.sum(once(F.col("duration"))).alias("total"),
        F.max(once(timed)).alias("slowest"),
        F.min(once(timed)).alias("fastest"),
        F.sum(once(F.col("rest_times"))).alias("rest_times"),
        F.sum(once(F.col("mysql_times"))).alias("mysql_times"),
        F.sum(once(F.col("redis_times"))).alias("redis_times"),
        F.max(once(F.col("region"))).alias("any_region"),
    )
    step = F.struct(
        "pos",
        F.col("d.name").alias("spanName"), F.col("d.spanid").alias("spanId"),
        whole_mean(F.col("step_total"), F.col("calls")).alias("duration"),
        F.col("d.level").alias("level"), F.col("d.parent").alias("parent"),
        F.col("error_count").alias("errorCount"), F.col("d.span_type").alias("spanType"),
    )
    first = F.struct(
        F.col("calls").alias("times"), "total", "slowest", "fastest", "rest_times",
        "mysql_times", "redis_times", "any_region",
    )
    segments = merged.groupBy(
        bucket, "trace_md5", "api", F.expr(f"pos div {SEGMENT_STEPS}").alias("segment")
    ).agg(
        F.sort_array(F.collect_list(step)).alias("steps"), F.max(once(first)).alias("m")
    )
    return segments.select(
        bucket, "trace_md5", "api", "segment", "m.times",
        whole_mean(F.col("m.total"), F.col("m.times")).alias("duration"),
        F.col("m.slowest.duration").alias("max_latency"),
        F.col("m.slowest.traceid").alias("max_latency_trace"),
        F.col("m.fastest.duration").alias("min_latency"),
        F.col("m.fastest.traceid").alias("min_latency_trace"),
        "m.rest_times", "m.mysql_times", "m.redis_times",
        F.when(F.col("m.times") == 1, F.col("m.any_region")).alias("region"),
        F.to_json(F.transform("steps", lambda s: s.dropFields("pos"))).alias("spans"),
    )
