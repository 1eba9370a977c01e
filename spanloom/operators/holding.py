"""When is a trace complete: late, held, released and ready traces.

Spans of a trace may sit on both sides of a batch border, so traces with very recent spans
wait for the next batch. Flags are combined per trace on the map side; the spans then meet
their trace's verdict in a join, so no trace is collected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from spanloom.operators.skew import join_sized


@dataclass(frozen=True)
class HoldRules:
    """Times in milliseconds. The release window is one to two batch intervals."""

    late_ms: int = 120_000
    hold_ms: int = 3_000
    release_from_ms: int = 60_000
    release_until_ms: int = 120_000


def _as_column(value: int | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def trace_times(spans: DataFrame, rules: HoldRules = HoldRules()) -> DataFrame:
    """One row per trace with all that the rules ask: does any span lie too close to its
    receive time, when did the last one end, when did the first and last arrive?"""
    recent = F.col("receive") - F.col("end") < rules.hold_ms
    return spans.groupBy("traceid").agg(
        F.count("*").alias("spans"),
        F.bool_or(recent).alias("held"),
        F.max("end").alias("last_end"),
        F.min("receive").alias("first_in"),
        F.max("receive").alias("last_in"),
    )


def is_late(as_of: int | Column, rules: HoldRules) -> Column:
    """The last span of the trace ended ``late_ms`` or longer ago."""
    return _as_column(as_of) - F.col("last_end") >= rules.late_ms


def is_due(as_of: int | Column, rules: HoldRules) -> Column:
    """All spans of the trace were received in the release window."""
    now = _as_column(as_of)
    return (now - F.col("last_in") >= rules.release_from_ms) & (
        now - F.col("first_in") < rules.release_until_ms
    )


def on_time(spans: DataFrame, as_of: int | Column, rules: HoldRules = HoldRules()) -> DataFrame:
    """Leave out the spans of late traces."""
    times = trace_times(spans, rules).select(
        "traceid", F.col("spans").alias("_size"), is_late(as_of, rules).alias("_late")
    )
    return join_sized(spans, times, "traceid", "_size").where(~F.col("_late")).select(*spans.columns)


def held_traces(spans: DataFrame, rules: HoldRules = HoldRules()) -> DataFrame:
    return trace_times(spans, rules).where("held").select("traceid")


def released_traces(
    spans: DataFrame, as_of: int | Column, rules: HoldRules = HoldRules()
) -> DataFrame:
    """Held traces that the release window lets go."""
    return trace_times(spans, rules).where(F.col("held") & is_due(as_of, rules)).select("traceid")


def ready_traces(
    spans: DataFrame, as_of: int | Column, rules: HoldRules = HoldRules()
) -> DataFrame:
    """Traces complete in their batch together with the held ones now released."""
    times = trace_times(spans, rules)
    return times.where(~F.col("held") | is_due(as_of, rules)).select("traceid", "spans")


READY, WAITING, DROPPED = "ready", "waiting", "dropped"


def assemble(
    fresh: DataFrame, pending: DataFrame, as_of: int | Column, rules: HoldRules = HoldRules()
) -> DataFrame:
    """One batch step: the spans of the batch and those waiting, with ``state``.

    A trace with a recent span waits with all its spans, added to those already waiting. A
    trace seen again without a recent span is ready and takes its waiting spans along. A
    waiting trace that nothing new reached for one batch interval is ready, once. The new spans
    of late traces are dropped, which is a state like the others.
    """
    now = _as_column(as_of)
    rows = fresh.withColumn("is_new", F.lit(True)).unionByName(
        pending.withColumn("is_new", F.lit(False))
    )
    is_new = F.col("is_new")
    recent = is_new & (F.col("receive") - F.col("end") < rules.hold_ms)
    verdicts = (
        rows.groupBy("traceid")
        .agg(
            F.count("*").alias("_size"),
            F.max(F.when(is_new, F.col("end"))).alias("new_end"),
            F.bool_or(recent).alias("recent"),
            F.max(F.when(~is_new, F.col("receive"))).alias("last_in"),
        )
        .select(
            "traceid",
            "_size",
            F.coalesce(now - F.col("new_end") < rules.late_ms, F.lit(False)).alias("live"),
            F.when(F.col("recent"), WAITING).otherwise(READY).alias("live_state"),
            F.when(now - F.col("last_in") >= rules.release_from_ms, READY)
            .otherwise(WAITING).alias("idle_state"),
        )
    )
    state = (
        F.when(F.col("live"), F.col("live_state"))
        .when(is_new, DROPPED)
        .otherwise(F.col("idle_state"))
    )
    return (
        join_sized(rows, verdicts, "traceid", "_size")
        .withColumn("state", state)
        .select(*fresh.columns, "state")
    )
