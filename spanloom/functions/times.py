"""Epoch-millisecond arithmetic; everything stays a bigint and truncates like integer division."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _div(value: Column, by: int) -> Column:
    return F.call_function("div", value, F.lit(by).cast("bigint"))


def to_seconds(ms: Column) -> Column:
    return _div(ms, 1000)


def minute_start(ms: Column) -> Column:
    """Start of the minute, in seconds."""
    return _div(ms, 60_000) * 60


def day_start(ms: Column) -> Column:
    """Start of the UTC day, in seconds."""
    return _div(ms, 86_400_000) * 86_400
