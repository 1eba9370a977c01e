"""Word counts, per batch and running."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from spanloom.functions import split_on_spaces


def words(texts: DataFrame, column: str = "text", kept: tuple[str, ...] = ()) -> DataFrame:
    """One row per word, with the columns ``kept``."""
    return texts.select(F.explode(split_on_spaces(F.col(column))).alias("word"), *kept)


def word_count(texts: DataFrame, column: str = "text") -> DataFrame:
    return words(texts, column).groupBy("word").agg(F.count("*").alias("n"))
