"""Text tests and the word split of the running-count job."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def is_empty(text: Column) -> Column:
    return text.isNull() | (text == "")


def has_text(text: Column) -> Column:
    """Not null and with at least one character that is not white space."""
    return text.isNotNull() & text.rlike(r"[^\s\x{1c}-\x{1f}]")


def split_on_spaces(text: Column) -> Column:
    """Split on single spaces, dropping empty strings at the end only.

    An empty text is one empty word, a text of spaces only has no words, and a null text
    is the word ``null``.
    """
    value = F.coalesce(text, F.lit("null"))
    kept = F.rtrim(value)
    only_spaces = (kept == "") & (value != "")
    return F.when(only_spaces, F.array().cast("array<string>")).otherwise(F.split(kept, " "))
