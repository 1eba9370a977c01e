"""Spans derived from the ``events`` table: one trace per user and day.

The spans of a trace are in time order and form a binary tree: the parent of span *i* is
span *i div 2*.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from spanloom.functions import hex_id
from spanloom.operators.skew import HeavyKeys, heavy_keys, row_number_in_group
from spanloom.staging import stage

# Traces with more spans than this are built by joins instead of inside one row.
INLINE_SPANS = 2048
# Events that one task numbers and gives parents: about 130 MB of memory. The bytes shuffled, which adaptive
# execution goes by, are a small part of that.
TASK_ROWS = 100_000
# Fewer are not worth a task.
LEAST_ROWS = 5_000


@dataclass(frozen=True)
class SpanTable:
    """Tagged span rows plus the list of traces too large to collect into one row."""

    rows: DataFrame
    heavy: HeavyKeys | None


#: Other ways to cut the events into traces: all events of a user, and all of a type.
USER_TRACES = "user_id"
TYPE_TRACES = "cast(ascii(event_type) * 100 + length(event_type) as bigint)"
DAY_TRACES = "user_id * 1000 + dayofyear(ts)"
#: A user's events of ten days.
LONG_TRACES = "user_id * 1000 + dayofyear(ts) div 10"

#: Which span of its trace is the parent of span ``idx``: a binary tree, or a chain.
BINARY, CHAIN = "idx div 2", "idx - 1"


def event_spans(
    spark: SparkSession, sf_dir: str, inline_spans: int = INLINE_SPANS, trace_no: str = DAY_TRACES,
    parent_idx: str = BINARY,
) -> SpanTable:
    """One shuffle: everything after it is grouped by the trace id or by more than that."""
    trace_no = F.expr(trace_no)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    traced = events.withColumn("tno", trace_no).withColumn("traceid", hex_id(F.col("tno")))

    heavy = heavy_keys(traced, "tno", inline_spans)
    heavy = heavy and heavy.spelled("traceid", hex_id(F.col("tno")))
    if heavy is None:
        traced = _spread(traced, events.count(), "traceid")
    numbered = row_number_in_group(traced, "traceid", ["ts", "event_id"], "idx", heavy)
    spanid = F.when(F.col("idx") == 1, F.col("traceid")).otherwise(
        hex_id(F.lit(1_000_000_000) + F.col("event_id"))
    )
    # Every span stands once under its own number and once under its parent's, so a parent
    # meets its children in a group of two or three rows.
    places = F.explode(
        F.array(
            F.struct(F.col("idx").alias("slot"), F.lit(True).alias("own")),
            F.struct(F.expr(parent_idx).alias("slot"), F.lit(False).alias("own")),
        )
    )
    placed = numbered.withColumn("spanid", spanid).select("*", places.alias("p")).select(
        "*", F.col("p.slot").alias("slot"), F.col("p.own").alias("own")
    )
    family = Window.partitionBy("traceid", "slot")
    child = placed.withColumn(
        "parent", F.max(F.when(F.col("own"), F.col("spanid"))).over(family)
    ).where(~F.col("own"))

    # The wall clock of the table is UTC, whatever the time zone of the session.
    moment = F.from_utc_timestamp(F.col("ts").cast("timestamp"), F.current_timezone())
    child = child.withColumn("begin", F.unix_millis(moment)).withColumn(
        "k", F.get_json_object("props", "$.k").cast("int")
    )
    k, idx, user = F.col("k"), F.col("idx"), F.col("user_id")
    rows = child.select(
        "tno", "idx", "event_id", "traceid", "spanid", "parent",
        F.when(k == 99, F.lit("http:/"))
        .when(idx == 1, F.concat(F.lit("http:/"), "event_type"))
        .otherwise(F.col("event_type")).alias("name"),
        "begin",
        (F.col("begin") + F.floor("value").cast("bigint")).alias("end"),
        F.expr("(begin div 86400000 + 1) * 86400000").alias("receive"),
        F.when((idx == 1) | (k % 10 == 0), "sr").otherwise("cs").alias("event"),
        F.concat(F.lit("svc"), (user % 7).cast("string")).alias("service"),
        F.concat(F.lit("10.1.0."), (user % 50).cast("string")).alias("ip"),
        F.when(k % 5 == 0, "redis").when(k % 5 == 1, "mysql").alias("tag_lc"),
        F.when(k % 5 == 2, "http://h/x").alias("tag_http_url"),
        F.when(k % 4 == 0, F.concat(F.lit("10.0.0."), k.cast("string"))).alias("tag_http_host"),
        F.when(F.col("event_type") == "error", "boom").alias("tag_error"),
        F.when(user % 2 == 0, "r1").alias("tag_region"),
        F.when(k % 3 == 0, F.concat(F.lit("iFP"), (user % 10).cast("string")))
        .when(k % 3 == 1, F.concat(F.lit("aFP"), (user % 10).cast("string")))
        .alias("tag_from_page"),
    )
    # Ordinary and large traces go two ways from here, which should not both derive all spans.
    return SpanTable(stage(rows, "event-spans") if heavy else rows, heavy)


def _spread(rows: DataFrame, count: int, key: str) -> DataFrame:
    """Rows partitioned by a key without large groups, so that no task has many more than ``TASK_ROWS``."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    tasks = max(-(-count // TASK_ROWS), min(cores, -(-count // LEAST_ROWS)), 1)
    return rows.repartition(tasks, key)


# Spans of one trace sent together in a message, at most.
SPANS_PER_MESSAGE = 50


def event_messages(spark: SparkSession, sf_dir: str, trace_no: str = DAY_TRACES) -> DataFrame:
    """The same spans nested into messages, as hosts send them.

    A message holds a bounded run of one trace's spans, so no group grows with the data.
    """
    spans = event_spans(spark, sf_dir, trace_no=trace_no).rows
    tags = F.map_filter(
        F.create_map(
            F.lit("lc"), "tag_lc", F.lit("http.url"), "tag_http_url",
            F.lit("http.host"), "tag_http_host", F.lit("error"), "tag_error",
            F.lit("region"), "tag_region", F.lit("fromPage"), "tag_from_page",
        ),
        lambda _, value: value.isNotNull(),
    )
    no_parents = F.array().cast("array<bigint>")
    parent_id = F.conv("parent", 16, -10).cast("bigint")
    span = F.struct(
        F.col("begin"),
        F.col("end"),
        F.col("name"),
        F.lit(0).cast("bigint").alias("traceIdHigh"),
        F.col("tno").alias("traceId"),
        F.conv("spanid", 16, -10).cast("bigint").alias("spanId"),
        F.when(F.col("parent").isNull(), no_parents).otherwise(F.array(parent_id)).alias("parents"),
        F.lit(False).alias("remote"),
        F.lit(True).alias("exportable"),
        F.concat(F.lit("Proc-"), "service").alias("processId"),
        ((F.col("end") - F.col("begin")) * 1000).alias("durationMicros"),
        tags.alias("tags"),
        F.array(F.struct(F.col("begin").alias("timestamp"), F.col("event").alias("event"))).alias("logs"),
    )
    host = F.struct(
        F.col("service").alias("serviceName"), F.col("ip").alias("address"),
        F.lit(8080).alias("port"),
    )
    run = F.expr(f"(idx - 1) div {SPANS_PER_MESSAGE}")
    return (
        spans.groupBy("traceid", run.alias("run"), "receive", "service", "ip")
        .agg(F.collect_list(span).alias("spans"))
        .select(host.alias("host"), "spans", "receive")
    )
