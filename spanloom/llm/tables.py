"""Reading input tables and the strings of Arrow batches."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: What a Python worker keeps between tasks: the state of one operator at a time.
_WORKER_STATE: dict = {}


#: Functions whose results a worker keeps as parts of its state.
_CACHES: list = []


def worker_cache(function: Callable) -> Callable:
    """``lru_cache`` for what a state is made of: its results go with the state."""
    cached = functools.lru_cache(maxsize=4)(function)
    _CACHES.append(cached)
    return cached


def worker_state(key: tuple, make: Callable[[], object]):
    """The state of ``key`` in this worker, made at first use; the one before it is let go."""
    if key not in _WORKER_STATE:
        _WORKER_STATE.clear()
        for cached in _CACHES:
            cached.cache_clear()
        pa.default_memory_pool().release_unused()  # what Arrow keeps of batches that are gone
        _WORKER_STATE[key] = make()
    return _WORKER_STATE[key]


def values(column: pa.Array) -> Iterator:
    """The Python values of an Arrow column, one at a time: no second copy of a whole batch."""
    for item in column:
        yield item.as_py()


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in short runs of rows, so that what is made of them stays small."""
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            yield batch.slice(begin, rows)


def rows_beside(docs: DataFrame, name: str = "text") -> tuple[Column, Callable[[Column], list[Column]]]:
    """A struct of all columns but ``name``, so that the text moves once, beside it; and what makes the
    columns of ``docs``, in their order, of the struct ``_row`` and a text.
    """
    names = docs.columns
    own = name if name in names else next(c for c in names if c.lower() == name)

    def columns(text: Column) -> list[Column]:
        return [text.alias(c) if c == own else F.col("_row").getField(c).alias(c) for c in names]

    return F.struct(*[F.col(f"`{c}`") for c in names if c != own]).alias("_row"), columns


def text_of(value) -> str:
    return "" if value is None else value
