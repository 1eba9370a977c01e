"""Schemas of the message, the flat span row and the tag keys the analysis reads."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

HOST = T.StructType([
    T.StructField("serviceName", T.StringType()),
    T.StructField("address", T.StringType()),
    T.StructField("port", T.IntegerType()),
])

LOG = T.StructType([
    T.StructField("timestamp", T.LongType()),
    T.StructField("event", T.StringType()),
])

SPAN = T.StructType([
    T.StructField("begin", T.LongType()),
    T.StructField("end", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("traceIdHigh", T.LongType()),
    T.StructField("traceId", T.LongType()),
    T.StructField("spanId", T.LongType()),
    T.StructField("parents", T.ArrayType(T.LongType())),
    T.StructField("remote", T.BooleanType()),
    T.StructField("exportable", T.BooleanType()),
    T.StructField("processId", T.StringType()),
    T.StructField("durationMicros", T.LongType()),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
    T.StructField("logs", T.ArrayType(LOG)),
])

MESSAGE = T.StructType([
    T.StructField("host", HOST),
    T.StructField("spans", T.ArrayType(SPAN)),
    T.StructField("receive", T.LongType()),
])

# Flat span rows: one row per span, ids as 16 hex characters, times in epoch milliseconds.
SPAN_COLUMNS = (
    "name", "traceid", "spanid", "parent", "begin", "end", "duration", "receive", "event",
    "service", "ip", "http_host", "error_count", "span_type", "region", "page_id",
)
LONG_COLUMNS = ("begin", "end", "duration", "receive", "error_count")


@dataclass(frozen=True)
class TagKeys:
    """Keys of the span tags read by the jobs.

    Deployments that prefix the two tags of their own (region and source page) pass the
    prefixed keys here.
    """

    error: str = "error"
    component: str = "lc"
    http_url: str = "http.url"
    http_host: str = "http.host"
    region: str = "region"
    from_page: str = "fromPage"


# Fixed values of the span model.
CLIENT_SEND = "cs"
CLIENT_RECV = "cr"
SERVER_RECV = "sr"
SERVER_ADDR = "sa"
LOCAL_COMPONENT = "lc"
PEER_SERVICE = "peer.service"
NO_EVENT = "none"
UNNAMED_API = "http:/"
COLLECTOR_SPAN = "message:sleuth"
