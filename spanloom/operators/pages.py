"""Which pages call which APIs, and how long the calls take."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from spanloom.functions import is_empty
from spanloom.operators.stats import whole_mean
from spanloom.schemas import UNNAMED_API


def page_spans(spans: DataFrame) -> DataFrame:
    """Spans that come from a page, with the platform letter and the scheme removed.

    Client and server records of a call both count. Page and API stay separate columns, so
    neither may be cut at a separator.
    """
    return spans.where(
        ~is_empty(F.col("page_id")) & ~is_empty(F.col("name")) & (F.col("name") != UNNAMED_API)
    ).select(
        F.regexp_replace("page_id", "^[ia]FP", "FP").alias("page"),
        F.replace("name", F.lit(UNNAMED_API), F.lit("")).alias("api"),
        (F.col("end") - F.col("begin")).alias("duration"),
    )


def page_api_totals(spans: DataFrame) -> DataFrame:
    return (
        page_spans(spans).groupBy("page", "api")
        .agg(F.count("*").alias("times"), F.sum("duration").alias("total_duration"))
        .withColumn("duration", whole_mean(F.col("total_duration"), F.col("times")))
    )


def api_sources(totals: DataFrame) -> DataFrame:
    """The totals keyed by API: which pages call it how often."""
    return totals.select("api", "page", "times")


def hottest_api(totals: DataFrame) -> DataFrame:
    """Per page the calls of its most called API."""
    return totals.groupBy("page").agg(F.max("times").alias("times"))
