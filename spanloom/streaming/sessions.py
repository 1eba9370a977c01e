"""Trace assembly by session windows over the stored spans.

The state per trace is a count and two times, not its spans: when a session closes, the
spans are fetched from the span table by a join. Partial sessions are merged before
the shuffle, so a busy trace costs each task one row, in a session with ``MERGE_SESSIONS`` set
(the sessions that this package opens have it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from spanloom.operators.skew import join_sized


def closed_sessions(
    spans: DataFrame, gap: str = "60 seconds", delay: str = "120 seconds"
) -> DataFrame:
    """Streaming (traceid, first_end, last_end, spans) of traces that went quiet.

    Spans later than ``delay`` are dropped; a trace closes when ``gap`` has passed without a
    span of its own.
    """
    return (
        spans.select("traceid", "end", F.timestamp_millis("end").alias("end_ts"))
        .withWatermark("end_ts", delay)
        .groupBy("traceid", F.session_window("end_ts", gap))
        .agg(F.min("end").alias("first_end"), F.max("end").alias("last_end"),
             F.count("*").alias("spans"))
        .select("traceid", "first_end", "last_end", "spans")
    )


def spans_of_sessions(sessions: DataFrame, store: DataFrame) -> DataFrame:
    """The stored spans of closed sessions; the time bounds also prune the scan."""
    bounds = sessions.agg(F.min("first_end").alias("lo"), F.max("last_end").alias("hi")).first()
    if bounds.lo is None:
        return store.limit(0)
    near = store.where(F.col("end").between(bounds.lo, bounds.hi))
    # A trace may have closed twice in a batch, so its sessions come as one short list.
    spells = sessions.groupBy("traceid").agg(
        F.collect_list(F.struct("first_end", "last_end")).alias("_spells"),
        F.sum("spans").alias("_size"),
    )
    inside = F.exists(
        "_spells", lambda s: F.col("end").between(s["first_end"], s["last_end"])
    )
    return join_sized(near, spells, "traceid", "_size").where(inside).select(*store.columns)
