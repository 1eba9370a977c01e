"""Flat span rows: flattening of messages, tag-derived columns, stored spans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from spanloom.functions import has_text, hex_id, to_seconds
from spanloom.schemas import NO_EVENT, SPAN_COLUMNS, TagKeys


def error_flag(error: Column) -> Column:
    return F.when(has_text(error), 1).otherwise(0).cast("bigint")


def span_type(component: Column, http_url: Column, traceid: Column, spanid: Column) -> Column:
    return (
        F.when(component == "redis", "REDIS")
        .when(component == "mysql", "MYSQL")
        .when(has_text(http_url), "RESTTEMPLATE")
        .when(traceid == spanid, "HTTP")
        .otherwise("OTHER")
    )


def first_event(logs: Column) -> Column:
    return F.coalesce(F.try_element_at(logs, F.lit(1))["event"], F.lit(NO_EVENT))


def explode_spans(messages: DataFrame) -> DataFrame:
    """One row per span with the message's host and receive time; absent fields take defaults."""
    s = F.col("s")
    zero = F.lit(0).cast("bigint")
    no_tags = F.create_map().cast("map<string,string>")
    return messages.select("host", "receive", F.explode("spans").alias("s")).select(
        F.col("host.serviceName").alias("service"),
        F.col("host.address").alias("ip"),
        F.col("host.port").alias("port"),
        "receive",
        s["begin"].alias("begin"),
        F.coalesce(s["end"], zero).alias("end"),
        F.coalesce(s["name"], F.lit("dummy")).alias("name"),
        F.coalesce(s["traceIdHigh"], zero).alias("trace_high"),
        F.coalesce(s["traceId"], zero).alias("trace_no"),
        F.coalesce(s["spanId"], zero).alias("span_no"),
        F.coalesce(s["parents"], F.array().cast("array<bigint>")).alias("parents"),
        F.coalesce(s["remote"], F.lit(False)).alias("remote"),
        s["processId"].alias("process_id"),
        s["durationMicros"].alias("duration_micros"),
        F.coalesce(s["tags"], no_tags).alias("tags"),
        F.coalesce(s["logs"], F.array().cast("array<struct<timestamp:bigint,event:string>>")).alias("logs"),
    )


def flat_spans(exploded: DataFrame, tags: TagKeys = TagKeys()) -> DataFrame:
    """Exploded spans to the flat analysis row."""
    tag = F.col("tags")
    traceid, spanid = hex_id(F.col("trace_no")), hex_id(F.col("span_no"))
    region = tag[tags.region]
    return exploded.select(
        "name",
        traceid.alias("traceid"),
        spanid.alias("spanid"),
        hex_id(F.try_element_at("parents", F.lit(-1))).alias("parent"),
        "begin",
        "end",
        (F.col("end") - F.col("begin")).alias("duration"),
        "receive",
        first_event(F.col("logs")).alias("event"),
        "service",
        "ip",
        tag[tags.http_host].alias("http_host"),
        error_flag(tag[tags.error]).alias("error_count"),
        span_type(tag[tags.component], tag[tags.http_url], traceid, spanid).alias("span_type"),
        F.when(has_text(region), region).alias("region"),
        tag[tags.from_page].alias("page_id"),
    )


def spans_of_tagged(rows: DataFrame) -> DataFrame:
    """Flat analysis rows of a table that already has one column per tag."""
    region = F.col("tag_region")
    return rows.select(
        "name", "traceid", "spanid", "parent", "begin", "end",
        (F.col("end") - F.col("begin")).alias("duration"),
        "receive", "event", "service", "ip",
        F.col("tag_http_host").alias("http_host"),
        error_flag(F.col("tag_error")).alias("error_count"),
        span_type(
            F.col("tag_lc"), F.col("tag_http_url"), F.col("traceid"), F.col("spanid")
        ).alias("span_type"),
        F.when(has_text(region), region).alias("region"),
        F.col("tag_from_page").alias("page_id"),
    ).select(*SPAN_COLUMNS)


def span_type_counts(spans: DataFrame) -> DataFrame:
    return spans.groupBy("span_type").agg(
        F.count("*").alias("spans"), F.sum("error_count").alias("errors")
    )


def span_identities(exploded: DataFrame) -> DataFrame:
    """Distinct spans by (high trace id, trace id, span id) and their number of records.

    Client and server records of a call share an identity, so this is no key of the store.
    """
    return exploded.groupBy("trace_high", "trace_no", "span_no").agg(
        F.count("*").alias("records")
    )


# ---- the span store -----------------------------------------------------------------------

# The row key is traceid:begin_sec:spanid:event.
STORE_COLUMNS = (
    "rowkey", "traceid", "begin_sec", "spanid", "event", "service", "ip", "name", "begin", "end",
    "parent", "logs", "tags", "receive",
)
# What the daily job reads of them; the event is part of the row key.
ANALYSIS_COLUMNS = (
    "rowkey", "traceid", "spanid", "service", "ip", "name", "begin", "end", "parent", "tags",
    "receive",
)


def store_rows(exploded: DataFrame) -> DataFrame:
    """Exploded spans as rows of the span store."""
    begin_sec = to_seconds(F.col("begin"))
    traceid, spanid = hex_id(F.col("trace_no")), hex_id(F.col("span_no"))
    event = first_event(F.col("logs"))
    return exploded.select(
        F.concat_ws(":", traceid, begin_sec, spanid, event).alias("rowkey"),
        traceid.alias("traceid"),
        begin_sec.alias("begin_sec"),
        spanid.alias("spanid"),
        event.alias("event"),
        "service", "ip", "name", "begin", "end",
        hex_id(F.try_element_at("parents", F.lit(-1))).alias("parent"),
        F.to_json("logs").alias("logs"),
        F.to_json("tags").alias("tags"),
        "receive",
    ).select(*STORE_COLUMNS)


def trace_days(exploded: DataFrame) -> DataFrame:
    """(traceid, begin_sec, has_root) per trace and UTC day: the day of begin_sec, and whether a span with the
    trace's own id began on it.

    Both follow from the store's key alone, so spans sent again change nothing.
    """
    begin_day = F.expr("floor(begin div 1000 / 86400) * 86400")
    return exploded.groupBy("trace_no", begin_day.alias("begin_sec")).agg(
        F.bool_or(F.col("span_no") == F.col("trace_no")).alias("has_root")
    ).select(hex_id(F.col("trace_no")).alias("traceid"), "begin_sec", "has_root")


def latest_per_key(rows: DataFrame, key: tuple[str, ...], version: str) -> DataFrame:
    """Last write wins per key, in one pass and one shuffle.

    The newest row of a key is a maximum, which combines copies before the shuffle: a key with
    very many copies costs each task one row.
    """
    rest = [c for c in rows.columns if c not in key and c != version]
    newest = F.max(F.struct(version, *rest)).alias("_row")
    return rows.groupBy(*key).agg(newest).select(*key, "_row.*")


def resolve_resent(spans: DataFrame) -> DataFrame:
    """Flat span rows with one row per store key: of spans sent again, the last received."""
    keyed = spans.withColumn("begin_sec", F.expr("begin div 1000"))
    key = ("traceid", "begin_sec", "spanid", "event")
    return latest_per_key(keyed, key, "receive").select(*spans.columns)


def parse_stored(store: DataFrame) -> DataFrame:
    """Stored rows back to analysis columns; the event is the fourth part of the row key."""
    return store.select(
        "name", "traceid", "spanid", "parent", "begin", "end",
        F.get(F.split("rowkey", ":"), F.lit(3)).alias("event"),
        "service", "ip",
    )


def day_scan(store: DataFrame, as_of_ms: int, offset_hours: int = 8) -> DataFrame:
    """Rows begun between midnight UTC less ``offset_hours`` and ``as_of_ms``."""
    day = as_of_ms // 86_400_000 * 86_400_000
    low = day - offset_hours * 3_600_000
    return store.where(F.col("begin").between(low, as_of_ms))


def spans_of_store(store: DataFrame, tags: TagKeys = TagKeys()) -> DataFrame:
    """Stored rows as full analysis rows, with the tag columns read from the stored JSON."""
    tag = F.from_json("tags", "map<string,string>")
    region = F.col("tag")[tags.region]
    return store.withColumn("tag", tag).select(
        "name", "traceid", "spanid", "parent", "begin", "end",
        (F.col("end") - F.col("begin")).alias("duration"),
        "receive",
        F.get(F.split("rowkey", ":"), F.lit(3)).alias("event"),
        "service", "ip",
        F.col("tag")[tags.http_host].alias("http_host"),
        error_flag(F.col("tag")[tags.error]).alias("error_count"),
        span_type(
            F.col("tag")[tags.component], F.col("tag")[tags.http_url],
            F.col("traceid"), F.col("spanid"),
        ).alias("span_type"),
        F.when(has_text(region), region).alias("region"),
        F.col("tag")[tags.from_page].alias("page_id"),
    )
