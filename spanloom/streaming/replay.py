"""Feeding a table to a stream slice by slice, one micro-batch each.

Every slice is written as ordinary files and consumed by a run of the query that ends when
it has read what there is; the next run recovers from the checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery


def replay(
    rows: DataFrame, slice_column: str, path: str, start: Callable[[], StreamingQuery]
) -> int:
    """Run ``start`` once per slice, in order; returns the number of slices.

    A slice is a coarse bucket, such as some days of time, so the list of slices is short.
    """
    slices = sorted(r[0] for r in rows.select(slice_column).distinct().collect())
    for one in slices:
        rows.where(F.col(slice_column) == one).drop(slice_column).write.mode("append").parquet(path)
        start().awaitTermination()
    return len(slices)
