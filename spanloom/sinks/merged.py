"""Days of a result table merged by key: one row per key, in key order, for lookups by prefix.

Batches go on being written to the table itself. ``merge_days`` writes a generation of a day beside it,
from the generation before and the batches since, and then commits it by a row that names the
last batch it covers. A reader takes the newest committed generation and the later batches, so it
finds every row once at any moment: a generation without its commit is not read and is written again,
an older one stays for those who read it, until ``retire``. Batches must come in the order of their
numbers, covered ones must not be run again, and a day has one merge at a time. All rows of a key
lie on one day, as the time of the day is a part of the keys.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession, functions as F
from pyspark.sql.types import StructType

from spanloom.operators import spans as span_ops
from spanloom.sinks import tables as t
from spanloom.staging import remove

#: Rows of one file, which one task sorts: spans with their tags take about 1 KB each while it does. A
#: file has a row group or a few, so that statistics and bloom filters leave most of them out.
FILE_ROWS = 500_000
ROW_GROUP_BYTES = 16 * 1024 * 1024

COMMIT = "day date, generation bigint, upto bigint"
Commits = dict[datetime.date, tuple[int, int]]


@dataclass(frozen=True)
class MergedTable:
    """How the rows of a table are merged: ``merge`` leaves one row of each ``key``.

    Files are sorted by ``order`` (the key by default) after the columns of ``derived`` were added.
    Columns of ``blooms`` get bloom filters.
    """

    name: str
    key: tuple[str, ...]
    merge: Callable[[DataFrame], DataFrame]
    order: tuple[str, ...] = ()
    derived: tuple[tuple[str, str], ...] = ()  # (name, SQL expression)
    blooms: tuple[str, ...] = ()
    above: tuple[str, ...] = ()  # partition columns above the day

    def with_derived(self, rows: DataFrame) -> DataFrame:
        return rows.withColumns({name: F.expr(sql) for name, sql in self.derived})


def _merged(root: str, table: str) -> str:
    return f"{root}/{table}_merged"


def _commits(root: str, table: str) -> str:
    return f"{root}/{table}_merges"


def newest_commits(spark: SparkSession, root: str, table: str) -> Commits:
    """day -> (generation, last batch covered) of the newest committed generation of each day."""
    path = _commits(root, table)
    if not t.exists(spark, path):
        return {}
    newest = (
        spark.read.schema(COMMIT).parquet(path).groupBy("day")
        .agg(F.max(F.struct("generation", "upto")).alias("c")).collect()
    )
    return {r.day: (r.c.generation, r.c.upto) for r in newest}


def _covered(commits: Commits) -> Column:
    """Rows of batches that the generations cover; a filter on partitions alone."""
    covered = F.lit(False)
    for day, (_, upto) in commits.items():
        covered = covered | ((F.col("day") == F.lit(day)) & (F.col("batch_id") <= upto))
    return covered


def _between(first: datetime.date | None, last: datetime.date | None) -> Column:
    low = F.lit(True) if first is None else F.col("day") >= F.lit(first)
    return low if last is None else low & (F.col("day") <= F.lit(last))


def _generations(
    spark: SparkSession, root: str, table: str, schema: StructType, commits: Commits
) -> DataFrame:
    """Rows of the named generations; no folder of another one is listed."""
    path = _merged(root, table)
    folders = [f"{path}/day={day}/generation={g}" for day, (g, _) in sorted(commits.items())]
    return spark.read.schema(schema).option("basePath", path).parquet(*folders).drop("generation")


def read_merged(
    spark: SparkSession, root: str, table: MergedTable, schema: str,
    first: datetime.date | None = None, last: datetime.date | None = None,
) -> DataFrame:
    """One row per key of the days from ``first`` to ``last``, all of them by default.

    Days whose batches are all covered are read as they lie, without a shuffle. Filters on the
    columns of ``order`` reach the files, where row groups out of their range are skipped. ``schema``
    is that of the table, with ``day`` and ``batch_id``.
    """
    commits = {
        day: c for day, c in newest_commits(spark, root, table.name).items()
        if (first is None or day >= first) and (last is None or day <= last)
    }
    rest = t.read_table(spark, root, table.name, schema).where(_between(first, last))
    fresh = rest.where(~_covered(commits))
    open_days = [r.day for r in fresh.select("day").distinct().collect()]
    merging = {day: c for day, c in commits.items() if day in open_days}
    closed = {day: c for day, c in commits.items() if day not in open_days}
    plain = table.with_derived(rest).schema
    parts = []
    if closed:
        parts.append(_generations(spark, root, table.name, plain, closed))
    if open_days or not closed:
        rows = fresh
        if merging:
            before = _generations(spark, root, table.name, plain, merging)
            rows = rows.unionByName(before.select(*rows.columns))
        parts.append(table.with_derived(table.merge(rows)))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.select(*plain.names)


def merge_days(
    spark: SparkSession, root: str, table: MergedTable, schema: str,
    days: Sequence[datetime.date] | None = None, upto: int | None = None, file_rows: int = FILE_ROWS,
) -> dict[datetime.date, int]:
    """Write and commit the next generation of the days (all by default) that have new batches, of those
    up to ``upto`` (by default all that are there); returns the numbers of the generations.

    All days go in one job. Rows are range-partitioned by day and the order of the table, so files and row
    groups have ranges of their own, and a large day has many.
    """
    commits = newest_commits(spark, root, table.name)
    rows = t.read_table(spark, root, table.name, schema).where(~_covered(commits))
    if days is not None:
        rows = rows.where(F.col("day").isin(list(days)))
    if upto is not None:
        rows = rows.where(F.col("batch_id") <= upto)
    found = rows.groupBy("day").agg(F.count("*").alias("rows"), F.max("batch_id").alias("last")).collect()
    if not found:
        return {}
    following = {r.day: (commits.get(r.day, (-1, -1))[0] + 1, r.last) for r in found}
    rows = rows.where(_covered(following))  # not the batches that come meanwhile
    count = sum(r.rows for r in found)
    replaced = {day: c for day, c in commits.items() if day in following}
    if replaced:
        plain = table.with_derived(rows).schema
        before = _generations(spark, root, table.name, plain, replaced)
        count += before.count()
        rows = rows.unionByName(before.select(*rows.columns))
    order = ("day", *(table.order or table.key))
    out = table.with_derived(table.merge(rows))
    out = out.repartitionByRange(-(-count // file_rows), *order).sortWithinPartitions(*order)
    commit = spark.createDataFrame([(d, g, last) for d, (g, last) in following.items()], COMMIT)
    numbers = F.broadcast(commit.select("day", "generation"))  # a row a day
    write = _by_generation(out.join(numbers, "day")).option("parquet.block.size", ROW_GROUP_BYTES)
    for name in table.blooms:
        write = write.option(f"parquet.bloom.filter.enabled#{name}", "true")
    write.parquet(_merged(root, table.name))
    _by_generation(commit.coalesce(1)).parquet(_commits(root, table.name))
    return {day: generation for day, (generation, _) in following.items()}


def _by_generation(rows: DataFrame) -> DataFrameWriter:
    """A generation that failed is replaced as a whole, those of other days and numbers stay."""
    return (
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("day", "generation")
    )


def retire(spark: SparkSession, root: str, table: MergedTable, schema: str, day: datetime.date) -> None:
    """Remove what the newest generation of a day has replaced: covered batches, older generations.

    Run it when nobody reads from before the last commit. Commits stay, so that no batch counts again.
    """
    commit = newest_commits(spark, root, table.name).get(day)
    if commit is None:
        return
    generation, upto = commit
    rows = t.read_table(spark, root, table.name, schema).where(
        (F.col("day") == F.lit(day)) & (F.col("batch_id") <= upto)
    )
    parts = rows.select(*table.above, "batch_id").distinct().collect()
    for r in parts:
        top = "".join(f"/{c}={r[c]}" for c in table.above)
        remove(spark, f"{root}/{table.name}{top}/day={day}/batch_id={r.batch_id}")
    for old in range(generation):
        remove(spark, f"{_merged(root, table.name)}/day={day}/generation={old}")


# ---- the tables that are merged --------------------------------------------------------------


def _last_write(rows: DataFrame) -> DataFrame:
    return span_ops.latest_per_key(rows, ("rowkey",), "receive")


def _address_sums(rows: DataFrame) -> DataFrame:
    keys = ("rowkey", "trace_md5", "span_name", "minute_start", "ip", "day")
    return rows.groupBy(*keys).agg(
        F.sum("total_duration").alias("total_duration"), F.sum("times").alias("times"),
        F.max("batch_id").alias("batch_id"),
    )


def _last_batch(rows: DataFrame) -> DataFrame:
    return span_ops.latest_per_key(rows, ("index", "rowkey"), "batch_id")


# The key of a lookup row without the start, the trace and the segment at its end.
LOOKUP_KEY = (
    "left(rowkey, length(rowkey) - 1"
    " - length(concat_ws(':', starttime, traceid, if(segment > 0, segment, null))))"
)

SPANS = MergedTable(t.RAW_SPANS, ("rowkey",), _last_write)
ADDRESSES = MergedTable(t.ADDRESSES, ("rowkey",), _address_sums)
TRACES = MergedTable(
    t.ALL_TRACES, ("index", "rowkey"), _last_batch, ("index", "key", "starttime", "rowkey"),
    (("key", LOOKUP_KEY),), ("traceid",), ("index",),
)

ADDRESSES_SCHEMA = (
    "trace_md5 string, span_name string, minute_start bigint, ip string, total_duration bigint, "
    "times bigint, rowkey string, day date, batch_id bigint"
)
TRACES_SCHEMA = (
    "index string, rowkey string, segment bigint, spans string, traceid string, starttime bigint, "
    "bucket_md5 string, duration bigint, region string, day date, batch_id bigint"
)


def find_traces(
    spark: SparkSession, root: str, key: str, first_sec: int, last_sec: int, index: str = "api"
) -> DataFrame:
    """The rows of one API (or, by ``index`` ``md5``, of one chain) started in a range of seconds.

    The range chooses the days; key and start reach the files, which are sorted by them.
    """
    first, last = (
        datetime.date(1970, 1, 1) + datetime.timedelta(days=s // 86_400) for s in (first_sec, last_sec)
    )
    return read_merged(spark, root, TRACES, TRACES_SCHEMA, first, last).where(
        (F.col("index") == index) & (F.col("key") == key) & F.col("starttime").between(first_sec, last_sec)
    )


def find_trace(spark: SparkSession, root: str, traceid: str, index: str = "api") -> DataFrame:
    """The rows of one trace on any day; bloom filters leave out the row groups without it."""
    rows = read_merged(spark, root, TRACES, TRACES_SCHEMA)
    return rows.where((F.col("index") == index) & (F.col("traceid") == traceid))
