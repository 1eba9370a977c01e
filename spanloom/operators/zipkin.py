"""Conversion of spans to the Zipkin v1 model, as three tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from spanloom.functions import has_text, hex_id, ipv4_to_int, trace_id_string
from spanloom.schemas import (
    CLIENT_RECV, CLIENT_SEND, COLLECTOR_SPAN, LOCAL_COMPONENT, PEER_SERVICE, SERVER_ADDR,
    SERVER_RECV,
)

KEYS = ("trace_id", "id", "event_key")


def _first_log_ms(event: str) -> Column:
    return F.get(F.filter("logs", lambda e: e["event"] == event), F.lit(0))["timestamp"]


def _has_log(*events: str) -> Column:
    return F.exists("logs", lambda e: e["event"].isin(*events))


def convertible(exploded: DataFrame) -> DataFrame:
    """Exploded spans but for those the collector itself caused, with the endpoint columns."""
    return exploded.where(F.col("name") != COLLECTOR_SPAN).select(
        "*",
        trace_id_string(F.col("trace_high"), F.col("trace_no")).alias("trace_id"),
        hex_id(F.col("span_no")).alias("id"),
        F.coalesce(F.get("logs", F.lit(0))["event"], F.lit("none")).alias("event_key"),
        F.lower("service").alias("service_name"),
        ipv4_to_int(F.col("ip")).alias("ipv4"),
        F.coalesce("port", F.lit(0)).cast("bigint").alias("endpoint_port"),
    )


def zipkin_spans(exploded: DataFrame) -> DataFrame:
    """One row per span. Only spans of local origin report their time, and only stopped ones
    their duration: client receive minus client send when both are logged."""
    sent, received = _first_log_ms(CLIENT_SEND), _first_log_ms(CLIENT_RECV)
    running = (F.col("begin") != 0) & F.col("duration_micros").isNull()
    measured = F.when(
        sent.isNotNull() & received.isNotNull(), (received - sent) * 1000
    ).otherwise(F.coalesce("duration_micros", F.lit(0)))
    local = ~F.col("remote")
    return convertible(exploded).select(
        *KEYS,
        hex_id(F.try_element_at("parents", F.lit(1))).alias("parent_id"),
        F.when(has_text(F.col("name")), F.lower("name")).otherwise("").alias("name"),
        F.when(local, F.col("begin") * 1000).alias("timestamp"),
        F.when(local & ~running, measured).alias("duration"),
    )


def zipkin_annotations(exploded: DataFrame) -> DataFrame:
    """One row per log of a span."""
    return convertible(exploded).select(
        *KEYS, "service_name", "ipv4", "endpoint_port", F.explode("logs").alias("e")
    ).select(
        *KEYS,
        (F.col("e.timestamp") * 1000).alias("timestamp"),
        F.col("e.event").alias("value"),
        F.col("service_name").alias("endpoint_service"),
        F.col("ipv4").alias("endpoint_ipv4"),
        "endpoint_port",
    )


def zipkin_binary_annotations(exploded: DataFrame) -> DataFrame:
    """One row per tag, plus the local component of spans that are neither client nor server
    and the server address of spans that called a named peer."""
    def entry(kind: str, key: Column, value: Column, service: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("type"), key.alias("key"), value.alias("value"),
            service.alias("endpoint_service"),
        )

    nothing = F.array().cast(
        "array<struct<type:string,key:string,value:string,endpoint_service:string>>"
    )
    own = F.col("service_name")
    tag = F.col("tags")
    tagged = F.transform(
        F.map_entries("tags"), lambda e: entry("STRING", e["key"], e["value"], own)
    )
    component = entry(
        "STRING", F.lit(LOCAL_COMPONENT),
        F.coalesce(F.lower("process_id"), F.lit("unknown")), own,
    )
    needs_component = ~_has_log(CLIENT_RECV, SERVER_RECV) & tag[LOCAL_COMPONENT].isNull()
    server = entry("BOOL", F.lit(SERVER_ADDR), F.lit("true"), F.lower(tag[PEER_SERVICE]))
    needs_server = _has_log(CLIENT_SEND) & tag[SERVER_ADDR].isNull() & tag[PEER_SERVICE].isNotNull()
    everything = F.concat(
        F.when(needs_component, F.array(component)).otherwise(nothing),
        tagged,
        F.when(needs_server, F.array(server)).otherwise(nothing),
    )
    return convertible(exploded).select(
        *KEYS, "ipv4", "endpoint_port", F.explode(everything).alias("b")
    ).select(
        *KEYS, "b.*", F.col("ipv4").alias("endpoint_ipv4"), "endpoint_port"
    )
