"""The batch jobs behind the result tables; the stream runs the same code per micro-batch."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from spanloom.operators import indexes, pages, spans as span_ops, stats
from spanloom.operators.skew import heavy_keys
from spanloom.operators.tree import Forest, build_forest
from spanloom.schemas import TagKeys
from spanloom.sinks import tables as t
from spanloom.sources.events import INLINE_SPANS
from spanloom.staging import stage, staged_job

BatchHandler = Callable[[DataFrame, int, int], DataFrame]


def forest_of(spans: DataFrame, extra: tuple[str, ...] = ()) -> Forest:
    """Call trees of a written span table."""
    return build_forest(spans, heavy_keys(spans, "traceid", INLINE_SPANS), extra)


def write_trace_tables(forest: Forest, root: str, batch_id: int, now_sec: int) -> None:
    """Chain statistics, failed traces, all traces and address latency of one batch."""
    forest = forest.staged()
    start = t.day_of_seconds(F.col("starttime"))
    minute = t.day_of_seconds(F.col("minute_start"))
    chains = stats.chain_table(forest, "minute_start").withColumn("now", F.lit(now_sec))
    # A chain's older minutes in a batch, and later segments, have keys of their own.
    newest = F.max("minute_start").over(Window.partitionBy("api", "trace_md5"))
    older = F.when(F.col("minute_start") < newest, F.concat(F.lit("m"), "minute_start"))
    key = F.concat_ws(":", "api", "now", "trace_md5", older, indexes.later_segment())
    chains = chains.withColumn("rowkey", key)
    t.write_batch(chains, root, t.CHAIN_MINUTES, batch_id, minute)
    t.write_batch(indexes.failed_by_time(forest), root, t.FAILED_BY_TIME, batch_id, start)
    t.write_batch(indexes.failed_by_api(forest), root, t.FAILED_BY_API, batch_id, start)
    t.write_batch(indexes.all_by_key(forest), root, t.ALL_TRACES, batch_id, start, ("index",))
    addresses = stats.address_totals(forest).withColumn(
        "rowkey", F.concat_ws(":", "trace_md5", "span_name", "minute_start", "ip")
    )
    t.write_batch(addresses, root, t.ADDRESSES, batch_id, minute)


def write_page_tables(spans: DataFrame, root: str, batch_id: int, now_ms: int) -> None:
    """Page and API usage of one batch."""
    totals = pages.page_api_totals(spans).persist()
    now = F.lit(now_ms)

    def keyed(df: DataFrame, *parts) -> DataFrame:
        return df.withColumn("now", now).withColumn("rowkey", F.concat_ws("-", *parts))

    t.write_batch(keyed(totals, "page", "now", "api"), root, t.PAGE_APIS, batch_id)
    t.write_batch(
        keyed(pages.api_sources(totals), "api", "now", "page"), root, t.API_PAGES, batch_id
    )
    t.write_batch(
        keyed(pages.hottest_api(totals), "now", "page"), root, t.PAGE_CALLS, batch_id
    )
    totals.unpersist()


def write_raw_spans(exploded: DataFrame, root: str, batch_id: int) -> None:
    """The spans of a batch, and the days on which its traces have spans.

    The days go first: a day that is told of spans which are not there yet does no harm.
    """
    days = span_ops.trace_days(exploded)
    t.write_batch(days, root, t.TRACE_DAYS, batch_id, t.day_of_seconds(F.col("begin_sec")))
    rows = span_ops.latest_per_key(span_ops.store_rows(exploded), ("rowkey",), "receive")
    t.write_batch(rows, root, t.RAW_SPANS, batch_id, t.day_of_seconds(F.col("begin_sec")))


def read_raw_spans(
    spark: SparkSession, root: str, as_of_ms: int | None = None,
    columns: tuple[str, ...] = span_ops.STORE_COLUMNS,
) -> DataFrame:
    """The span store, last write per key; with ``as_of_ms`` the day scan.

    The range is a part of the row key, so it goes before the choice of the last write.
    """
    wanted = list(dict.fromkeys(("rowkey", "receive", *columns)))
    if as_of_ms is None:
        store = t.read_table(spark, root, t.RAW_SPANS, STORE_SCHEMA).select(*wanted)
    else:
        low = as_of_ms // 86_400_000 * 86_400_000 - 8 * 3_600_000
        store = stored_between(spark, root, low, as_of_ms, wanted)
    return span_ops.latest_per_key(store, ("rowkey",), "receive")


STORE_SCHEMA = ", ".join(
    f"{c} {'bigint' if c in ('begin_sec', 'begin', 'end', 'receive') else 'string'}"
    for c in span_ops.STORE_COLUMNS
) + ", day date, batch_id bigint"


def stored_between(
    spark: SparkSession, root: str, low_ms: int, high_ms: int,
    columns: Sequence[str] = ("rowkey", "receive", *span_ops.ANALYSIS_COLUMNS),
) -> DataFrame:
    """Stored rows begun in a range of time, all writes of each key.

    The range reaches the files as a partition filter on the day and a pushed filter on the begin
    time; only the named columns are read.
    """
    store = t.read_table(spark, root, t.RAW_SPANS, STORE_SCHEMA)
    days = F.col("day").between(
        t.day_of_seconds(F.lit(low_ms // 1000)), t.day_of_seconds(F.lit(high_ms // 1000))
    )
    rows = store.where(days & F.col("begin").between(low_ms, high_ms))
    return rows.select(*dict.fromkeys(columns))


def address_totals(spark: SparkSession, root: str) -> DataFrame:
    """Address latency with one row per key: a minute that fell into several batches is added up."""
    rows = t.read_table(spark, root, t.ADDRESSES)
    keys = ("rowkey", "trace_md5", "span_name", "minute_start", "ip")
    return rows.groupBy(*keys).agg(
        stats.whole_mean(F.sum("total_duration"), F.sum("times")).alias("avg_duration"),
        F.sum("times").alias("times"),
    )


def daily_table(forest: Forest) -> DataFrame:
    """Call-chain statistics per UTC day of the root's begin time, with steps and row key."""
    chains = stats.chain_table(forest, "start_day").withColumnRenamed("start_day", "day_start")
    bucket = F.concat_ws(".", "day_start", "trace_md5")
    return chains.withColumn("rowkey", F.concat_ws(":", "api", bucket, indexes.later_segment()))


TRACE_DAYS_SCHEMA = "traceid string, begin_sec bigint, has_root boolean, day date, batch_id bigint"


def crossing_traces(spark: SparkSession, root: str, first: int, last: int) -> DataFrame:
    """Traces with spans both on the days from ``first`` to ``last`` (s) and on others.

    One row per trace: ``owner``, the day of its first root span or, without one, of its last span,
    and ``others``, the days outside the range. Only the narrow table of trace days is read.
    """
    rows = t.read_table(spark, root, t.TRACE_DAYS, TRACE_DAYS_SCHEMA).select(
        "traceid", "has_root", "day"
    )
    low, high = t.day_of_seconds(F.lit(first)), t.day_of_seconds(F.lit(last))
    inside = F.col("day").between(low, high)
    here = rows.where(inside)
    there = rows.where(~inside).join(here.select("traceid").distinct(), "traceid", "left_semi")
    there = stage(there.distinct(), "crossing-days")
    both = there.unionByName(here.join(there.select("traceid").distinct(), "traceid", "left_semi"))
    return both.groupBy("traceid").agg(
        F.coalesce(F.min(F.when(F.col("has_root"), F.col("day"))), F.max("day")).alias("owner"),
        # At most the days that the store has.
        F.collect_set(F.when(~inside, F.col("day"))).alias("others"),
    ).withColumn("owned", F.col("owner").between(low, high))


def spans_of_days(
    spark: SparkSession, root: str, first: int, last: int,
    columns: Sequence[str] = ("rowkey", "receive", *span_ops.ANALYSIS_COLUMNS),
) -> DataFrame:
    """Stored rows of the traces whose root began on the days from ``first`` to ``last`` (s), all
    writes of each key and on whatever day a span lies.

    Traces that lie inside the range are read without a join. Of the others those owned by another day
    are left out, and the spans that owned ones have elsewhere are looked up in those days alone.
    """
    store = t.read_table(spark, root, t.RAW_SPANS, STORE_SCHEMA)
    wanted = list(dict.fromkeys(columns))
    low, high = t.day_of_seconds(F.lit(first)), t.day_of_seconds(F.lit(last))
    here = store.where(F.col("day").between(low, high)).select(*wanted)
    crossing = stage(crossing_traces(spark, root, first, last), "crossing-traces")
    if crossing.isEmpty():
        return here
    kept = here.join(crossing.where("not owned").select("traceid"), "traceid", "left_anti")
    owned = crossing.where("owned")
    days = [r.day for r in owned.select(F.explode("others").alias("day")).distinct().collect()]
    if not days:
        return kept.select(*wanted)
    there = store.where(F.col("day").isin(days)).join(owned.select("traceid"), "traceid", "left_semi")
    return kept.select(*wanted).unionByName(there.select(*wanted))


def owner_days(spark: SparkSession, root: str, first: int, last: int) -> list[int]:
    """The other days (s) that own a trace with spans in the range: run again, their tables change."""
    rows = crossing_traces(spark, root, first, last).where("not owned").select("owner").distinct()
    return sorted(
        r.owner for r in rows.select((F.unix_date("owner") * 86_400).alias("owner")).collect()
    )


def daily_chains(spans: DataFrame, first: int, last: int) -> DataFrame:
    """The chains of the traces whose root began on the days that start at ``first`` to ``last`` (s)."""
    return daily_table(forest_of(spans)).where(F.col("day_start").between(first, last))


DAILY_HANDLERS: Sequence[tuple[str, BatchHandler]] = ((t.CHAIN_DAYS, daily_chains),)


def daily_job(
    spark: SparkSession,
    root: str,
    as_of_ms: int,
    handlers: Sequence[tuple[str, BatchHandler]] = DAILY_HANDLERS,
    tags: TagKeys = TagKeys(),
    days: int = 1,
) -> None:
    """Run the handlers over the traces of the UTC day that ``as_of_ms`` lies in, or of more days.

    A trace belongs to the day on which its root began, whatever days its spans lie on, so no
    trace is cut and none is counted on two days: one run of several days writes what a run of each
    writes. Handlers give ``day_start``, the partition that a row belongs to; a rerun
    replaces the partitions of its days. Where spans came after a day's run, ``owner_days`` names it.
    """
    first = as_of_ms // 86_400_000 * 86_400
    last = first + (days - 1) * 86_400
    with staged_job(spark):
        stored = span_ops.latest_per_key(
            spans_of_days(spark, root, first, last), ("rowkey",), "receive"
        )
        spans = stage(span_ops.spans_of_store(stored, tags), "day-spans")
        for table, handler in handlers:
            rows = handler(spans, first, last)
            t.write_batch(rows, root, table, 0, t.day_of_seconds(F.col("day_start")))
