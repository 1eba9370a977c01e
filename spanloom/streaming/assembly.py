"""Trace assembly in Spark's own keyed state: a list of waiting spans per trace, and a timer for its release.

The rules are those of ``operators.holding.assemble``, applied whenever spans of a trace come in. What
waits is appended to the state store and not touched again until the trace is ready: a batch writes
the spans that it brings and no others. The state of a trace is read and written in runs of
``RUN_ROWS`` rows, so a large trace passes its task without being held there.

Time is the stream's clock, a column of the rows (by default the time of receipt). Its watermark
runs the timers, so traces are released by the clock alone, when others keep the stream going.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from spanloom.operators.holding import DROPPED, READY, HoldRules
from spanloom.schemas import LONG_COLUMNS, SPAN_COLUMNS

SPAN_SCHEMA = ", ".join(
    f"{c} {'bigint' if c in LONG_COLUMNS else 'string'}" for c in SPAN_COLUMNS
)
#: Spans of a trace that a task holds; more of them wait in the state store meanwhile.
RUN_ROWS = 2_048

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state where lists, timers and lifetimes are possible."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


class TraceAssembler(StatefulProcessor):
    """Holds the spans of a trace until it is complete."""

    def __init__(self, rules: HoldRules, delay_ms: int, run_rows: int):
        self.rules, self.delay_ms, self.run_rows = rules, delay_ms, run_rows

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", SPAN_SCHEMA)
        # The new spans of a trace, where there are more of them than a task should hold.
        self.arriving = handle.getListState("arriving", SPAN_SCHEMA)

    @staticmethod
    def _emit(spans, state: str) -> Iterator[Row]:
        for span in spans:
            yield Row(**dict(zip(SPAN_COLUMNS, span)), state=state)

    def _stop_timers(self) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        run, spilled = [], False
        clock = newest_end = None
        recent = False
        for row in rows:
            if len(run) == self.run_rows:
                self.arriving.appendList(run)
                run, spilled = [], True
            run.append(tuple(row[c] for c in SPAN_COLUMNS))
            clock = row["clock_ms"] if clock is None else max(clock, row["clock_ms"])
            newest_end = row["end"] if newest_end is None else max(newest_end, row["end"])
            recent = recent or row["receive"] - row["end"] < self.rules.hold_ms
        fresh = itertools.chain(self.arriving.get() if spilled else (), run)
        if clock - newest_end >= self.rules.late_ms:
            yield from self._emit(fresh, DROPPED)
        elif recent:
            while some := list(itertools.islice(fresh, self.run_rows)):
                self.waiting.appendList(some)
            self._stop_timers()
            due = clock + self.rules.release_from_ms - self.delay_ms
            self.handle.registerTimer(max(due, timerValues.getCurrentWatermarkInMs() + 1))
        else:
            if self.waiting.exists():
                yield from self._emit(self.waiting.get(), READY)
                self.waiting.clear()
                self._stop_timers()
            yield from self._emit(fresh, READY)
        if spilled:
            self.arriving.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._emit(self.waiting.get(), READY)
        self.waiting.clear()

    def close(self) -> None:
        pass


def once_each(spans: DataFrame) -> DataFrame:
    """Streaming flat spans, of each store key the first that the watermark still remembers."""
    keyed = spans.withColumn("begin_sec", F.expr("begin div 1000"))
    return keyed.dropDuplicatesWithinWatermark(["traceid", "begin_sec", "spanid", "event"]).drop(
        "begin_sec"
    )


def assembled_spans(
    spans: DataFrame,
    rules: HoldRules = HoldRules(),
    clock_ms: Column | None = None,
    delay_ms: int = 0,
    once: bool = False,
    run_rows: int = RUN_ROWS,
) -> DataFrame:
    """Streaming flat spans with ``state``: those of traces now ready, and those that came too late.

    Rows more than ``delay_ms`` behind the newest clock of the batches before may be left out by Spark.
    Timers allow for the delay, so it holds no trace back. With ``once`` a span that is sent again
    within the delay is taken once. Start the stream inside ``keyed_state``.
    """
    clock = F.col("receive") if clock_ms is None else clock_ms
    clocked = spans.select(*SPAN_COLUMNS, clock.cast("bigint").alias("clock_ms"))
    clocked = clocked.withColumn("clock_ts", F.timestamp_millis("clock_ms")).withWatermark(
        "clock_ts", f"{delay_ms} milliseconds"
    )
    if once:
        clocked = once_each(clocked)
    return clocked.groupBy("traceid").transformWithState(
        TraceAssembler(rules, delay_ms, run_rows), SPAN_SCHEMA + ", state string", "append", "EventTime"
    )
