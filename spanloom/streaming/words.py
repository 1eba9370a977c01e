"""Running word counts: the total per word after every batch in which it occurs."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from spanloom.functions import split_on_spaces
from spanloom.operators.words import word_count


def kafka_texts(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Streaming ``text`` rows of a Kafka topic of strings."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .load()
        .selectExpr("cast(value as string) as text")
    )


def file_texts(spark: SparkSession, path: str, schema: str = "text string") -> DataFrame:
    """Streaming ``text`` rows of a folder of Parquet files."""
    return spark.readStream.schema(schema).parquet(path)


def counted_words(texts: DataFrame, column: str, at: str) -> DataFrame:
    """(word, at, n): the words of some texts of a task together, so that copies of a word do not move.

    A row with the newest time and neither word nor count stands for texts without words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, times = batch.columns
            rows = pa.table({"word": texts.flatten(), at: times.take(pc.list_parent_indices(texts))})
            counts = rows.group_by(["word", at]).aggregate([([], "count_all")]).combine_chunks()
            last = pa.array([pc.max(times).as_py()], times.type)
            columns = [
                pa.chunked_array([*counts["word"].chunks, pa.nulls(1, texts.type.value_type)]),
                pa.chunked_array([*counts[at].chunks, last]),
                pa.chunked_array([*counts["count_all"].chunks, pa.nulls(1, pa.int64())]),
            ]
            yield from pa.table(columns, names=["word", at, "n"]).combine_chunks().to_batches()

    return texts.select(split_on_spaces(F.col(column)), at).mapInArrow(run, f"word string, {at} timestamp, n bigint")


def expiring_word_count(
    texts: DataFrame, timeout: str, delay: str = "0 seconds", column: str = "text", at: str = "ts"
) -> DataFrame:
    """Streaming (word, first, last, n): the totals of words, each from its first text to its last before
    ``timeout`` passed without the word.

    A word that comes again after it starts at its own count. Totals are given out, and leave the
    state, when the watermark says that nothing can be added: the state holds the words of one
    timeout and delay, however long the stream runs.
    """
    seen = counted_words(texts, column, at).withWatermark(at, delay)
    # With the time in it the condition stays above the watermark, which all rows move.
    seen = seen.where(F.when(F.col(at).isNotNull(), F.col("word").isNotNull()))
    return (
        seen.groupBy("word", F.session_window(at, timeout))
        .agg(F.min(at).alias("first"), F.max(at).alias("last"), F.sum("n").alias("n"))
        .select("word", "first", "last", "n")
    )


def running_word_count(texts: DataFrame, column: str = "text") -> DataFrame:
    """Streaming (word, n); write with output mode ``update``."""
    return word_count(texts, column)
