"""The trace stream: decode, then a list of handlers per micro-batch.

Spans that wait for the next batch live in a small table between batches, not in operator
state: traces are then matched by distributed joins, and a trace with very many spans is
never held by one task. The table alternates between two folders; batch *n* reads the one
and writes the other, so a batch that is run again finds what it found the first time.

A batch's clock is the wall clock when it first ran. It is stored with the batch, so a batch that
is run again decides the same; no message's own time moves it. Between messages ticks keep
batches coming, so that waiting traces are released without new input.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from spanloom.operators.holding import DROPPED, READY, WAITING, HoldRules, assemble
from spanloom.operators.spans import explode_spans, flat_spans, resolve_resent
from spanloom.plans import jobs
from spanloom.schemas import LONG_COLUMNS, SPAN_COLUMNS, TagKeys
from spanloom.sinks import tables as t
from spanloom.sources.messages import dead_letters, decode, good_messages
from spanloom.staging import staged_job


@dataclass(frozen=True)
class MicroBatch:
    """What a handler sees: the batch's exploded spans, the flat rows and where to write."""

    spark: SparkSession
    batch_id: int
    root: str
    exploded: DataFrame
    spans: DataFrame
    as_of_ms: int | None
    rules: HoldRules


Handler = Callable[[MicroBatch], None]


def store_spans(batch: MicroBatch) -> None:
    jobs.write_raw_spans(batch.exploded, batch.root, batch.batch_id)


def analyze_pages(batch: MicroBatch) -> None:
    if batch.as_of_ms is not None:
        jobs.write_page_tables(batch.spans, batch.root, batch.batch_id, batch.as_of_ms)


def analyze_traces(batch: MicroBatch) -> None:
    ready = assemble_batch(batch)
    if ready is not None:
        forest = jobs.forest_of(resolve_resent(ready), extra=("ip", "http_host"))
        jobs.write_trace_tables(forest, batch.root, batch.batch_id, batch.as_of_ms // 1000)


HANDLERS: Sequence[Handler] = (store_spans, analyze_traces, analyze_pages)


#: Marks the rows that only keep batches coming.
TICK = "_tick"

# Column types of the flat span rows, plus the verdict the folder is partitioned by.
SLOT_SCHEMA = ", ".join(
    [f"{c} {'bigint' if c in LONG_COLUMNS else 'string'}" for c in SPAN_COLUMNS] + ["state string"]
)


def _slot(root: str, batch_id: int) -> str:
    return f"{root}/_assembly/slot={batch_id % 2}"


def _in_state(spark: SparkSession, root: str, batch_id: int, state: str) -> DataFrame:
    rows = spark.read.schema(SLOT_SCHEMA).parquet(_slot(root, batch_id))
    return rows.where(F.col("state") == state).drop("state")


def waiting_spans(spark: SparkSession, root: str, batch_id: int) -> DataFrame:
    """The spans that wait after a batch."""
    return _in_state(spark, root, batch_id, WAITING)


def assemble_batch(batch: MicroBatch) -> DataFrame | None:
    """Decide over the batch's and the waiting spans; returns those of the traces now ready.

    All groups are written in one pass, as partitions of the batch's folder. The spans of late
    traces go on to a table of their own.
    """
    spark, spans = batch.spark, batch.spans
    if batch.batch_id == 0:
        pending = spans.limit(0)
    else:
        pending = _in_state(spark, batch.root, batch.batch_id - 1, WAITING)
    target = _slot(batch.root, batch.batch_id)
    if batch.as_of_ms is None:
        decided = pending.withColumn("state", F.lit(WAITING))
    else:
        decided = assemble(spans, pending, batch.as_of_ms, batch.rules)
    decided.write.mode("overwrite").partitionBy("state").parquet(target)
    if batch.as_of_ms is None:
        return None
    late = _in_state(spark, batch.root, batch.batch_id, DROPPED).withColumn(
        "as_of", F.lit(batch.as_of_ms)
    )
    day = t.day_of_seconds(F.col("receive") / 1000)
    t.write_batch(late, batch.root, t.LATE_SPANS, batch.batch_id, day)
    return _in_state(spark, batch.root, batch.batch_id, READY)


LATE_SCHEMA = SLOT_SCHEMA.removesuffix(", state string") + ", as_of bigint, day date, batch_id bigint"


def late_spans(spark: SparkSession, root: str) -> DataFrame:
    """The spans that came too late, with the clock of the batch that said so."""
    return t.read_table(spark, root, t.LATE_SPANS, LATE_SCHEMA)


Clock = Callable[[DataFrame], int | None]


def wall_clock(spans: DataFrame) -> int:
    return int(time.time() * 1000)


def newest_receive(spans: DataFrame) -> int | None:
    """The clock of a replay of history: the newest receive time of the batch."""
    return spans.agg(F.max("receive")).first()[0]


ADAPTIVE = "spark.sql.adaptive.enabled"


@contextmanager
def adaptive(spark: SparkSession) -> Iterator[None]:
    """Jobs inside have adaptive execution, which Spark turns off in the session of a stream.

    The stream itself keeps no state in operators, so its batches need no fixed number of partitions.
    """
    before = spark.conf.get(ADAPTIVE)
    spark.conf.set(ADAPTIVE, "true")
    try:
        yield
    finally:
        spark.conf.set(ADAPTIVE, before)


@dataclass(frozen=True)
class TraceStream:
    """Settings of the stream; ``start`` runs it."""

    root: str
    handlers: Sequence[Handler] = HANDLERS
    rules: HoldRules = field(default_factory=HoldRules)
    tags: TagKeys = field(default_factory=TagKeys)
    trigger_seconds: int = 60
    clock: Clock = wall_clock

    def _as_of(self, spans: DataFrame, batch_id: int) -> int | None:
        """The batch's clock: read if the batch ran before, else taken and written."""
        spark, path = spans.sparkSession, f"{self.root}/_assembly/clock/batch={batch_id}"
        if not t.exists(spark, f"{path}/_SUCCESS"):
            spark.createDataFrame([(self.clock(spans),)], "as_of bigint").coalesce(1).write.mode(
                "overwrite"
            ).parquet(path)
        return spark.read.schema("as_of bigint").parquet(path).first().as_of

    def process(self, payloads: DataFrame, batch_id: int) -> None:
        with adaptive(payloads.sparkSession):
            self._process(payloads, batch_id)

    def _process(self, payloads: DataFrame, batch_id: int) -> None:
        if TICK in payloads.columns:
            payloads = payloads.where(~F.col(TICK)).drop(TICK)
        decoded = decode(payloads).withColumn(
            "value", F.when(F.col("reason").isNotNull(), F.col("value"))
        ).persist()
        try:
            t.write_batch(dead_letters(decoded), self.root, t.DEAD_LETTERS, batch_id)
            exploded = explode_spans(good_messages(decoded))
            spans = flat_spans(exploded, self.tags)
            as_of = self._as_of(spans, batch_id)
            batch = MicroBatch(
                payloads.sparkSession, batch_id, self.root, exploded, spans, as_of, self.rules
            )
            with staged_job(batch.spark):
                for handler in self.handlers:
                    handler(batch)
        finally:
            decoded.unpersist()

    def flush(self, spark: SparkSession, last_batch_id: int, as_of_ms: int) -> None:
        """After the stream has stopped for good: analyze what still waits."""
        with staged_job(spark):
            pending = waiting_spans(spark, self.root, last_batch_id)
            forest = jobs.forest_of(resolve_resent(pending), extra=("ip", "http_host"))
            jobs.write_trace_tables(forest, self.root, last_batch_id + 1, as_of_ms // 1000)

    def start(self, payloads: DataFrame, available_now: bool = False) -> StreamingQuery:
        writer = payloads.writeStream.foreachBatch(self.process).option(
            "checkpointLocation", f"{self.root}/_checkpoint"
        )
        if available_now:
            return writer.trigger(availableNow=True).start()
        return writer.trigger(processingTime=f"{self.trigger_seconds} seconds").start()

    def start_ticking(self, payloads: DataFrame) -> StreamingQuery:
        """``start`` with ticks: every interval has a batch, with messages or without."""
        spark = payloads.sparkSession
        ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load().select(
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in payloads.schema], F.lit(True).alias(TICK)
        )
        return self.start(payloads.withColumn(TICK, F.lit(False)).unionByName(ticks))
