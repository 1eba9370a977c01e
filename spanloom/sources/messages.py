"""Span messages: the stream source, the two-byte wire header and the JSON payload."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from spanloom.schemas import MESSAGE

HEADER_BYTES = 2
FETCH_BYTES = 5_242_880

PAYLOAD = T.StructType([
    T.StructField("value", T.BinaryType()),
    T.StructField("timestamp", T.TimestampType()),
])


def kafka_payloads(
    spark: SparkSession,
    servers: str,
    topic: str,
    group: str,
    max_messages: int | None = None,
    min_partitions: int | None = None,
    starting: str = "latest",
) -> DataFrame:
    """Streaming (value, timestamp) rows of a Kafka topic.

    After an outage the backlog comes in batches of ``max_messages`` at most, spread evenly over
    the topic's partitions; ``min_partitions`` tasks share a batch even if the topic has fewer
    partitions. ``starting`` (latest, earliest or JSON offsets) counts for a stream without a checkpoint.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "kafka.group.id": group,
        "kafka.max.partition.fetch.bytes": FETCH_BYTES,
        "startingOffsets": starting,
        "maxOffsetsPerTrigger": max_messages,
        "minPartitions": min_partitions,
    }
    given = {k: v for k, v in options.items() if v is not None}
    return spark.readStream.format("kafka").options(**given).load().select("value", "timestamp")


def file_payloads(
    spark: SparkSession, path: str, max_files: int | None = None, max_bytes: int | None = None
) -> DataFrame:
    """Streaming (value, timestamp) rows of a folder of Parquet files, oldest first.

    A batch takes at most ``max_files`` files, or files of about ``max_bytes``; not both.
    """
    limits = {"maxFilesPerTrigger": max_files, "maxBytesPerTrigger": max_bytes}
    given = {k: v for k, v in limits.items() if v is not None}
    return spark.readStream.schema(PAYLOAD).options(**given).parquet(path)


def encode(messages: DataFrame) -> DataFrame:
    """Messages as wire payloads: header bytes, then JSON; ``receive`` becomes the timestamp."""
    text = F.to_json(F.struct("host", "spans"))
    return messages.select(
        F.concat(F.lit(bytes(HEADER_BYTES)), F.encode(text, "UTF-8")).alias("value"),
        F.timestamp_millis("receive").alias("timestamp"),
    )


def decode(payloads: DataFrame) -> DataFrame:
    """Parse every payload and say why it cannot be used, if it cannot.

    Adds ``message`` and ``reason``; ``reason`` is null for good messages. The receive time
    is the broker's timestamp.
    """
    parse_schema = T.StructType([*MESSAGE.fields, T.StructField("_corrupt", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    body = F.substring("value", HEADER_BYTES + 1, 2**31 - 1)
    length = F.octet_length("value")
    # Bytes that are not UTF-8 make a payload malformed; they must not end the batch.
    message = F.from_json(F.make_valid_utf8(body.cast("string")), parse_schema, options)
    # Out of an array, so that filters on the reason do not parse the payload once more for every use.
    parsed = payloads.select("*", F.explode(F.array(message)).alias("message"))
    reason = (
        F.when(F.col("value").isNull() | (length < HEADER_BYTES), "truncated")
        .when(length == HEADER_BYTES, "empty")
        .when(F.col("message").isNull() | F.col("message._corrupt").isNotNull(), "malformed")
        .when(F.col("message.spans").isNull(), "no spans")
    )
    return parsed.withColumn("reason", reason)


def good_messages(decoded: DataFrame) -> DataFrame:
    """(host, spans, receive) of the usable messages; spans without a begin time are left out."""
    return decoded.where(F.col("reason").isNull()).select(
        F.col("message.host").alias("host"),
        F.filter("message.spans", lambda s: s["begin"].isNotNull()).alias("spans"),
        F.unix_millis("timestamp").alias("receive"),
    )


def dead_letters(decoded: DataFrame) -> DataFrame:
    """Unusable payloads, and the spans without a begin time of otherwise good messages."""
    bad = decoded.where(F.col("reason").isNotNull()).select("reason", "value", "timestamp")
    unbegun = F.filter("message.spans", lambda s: s["begin"].isNull())
    partial = (
        decoded.where(F.col("reason").isNull())
        .select(unbegun.alias("left_out"), "timestamp")
        .where(F.size("left_out") > 0)
        .select(
            F.lit("span without begin").alias("reason"),
            F.encode(F.to_json("left_out"), "UTF-8").alias("value"),
            "timestamp",
        )
    )
    return bad.unionByName(partial)
