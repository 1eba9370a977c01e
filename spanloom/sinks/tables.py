"""Parquet result tables, partitioned by day (where they have one) and then by batch.

A batch that is run again replaces the partitions that it wrote, so a replay never adds rows twice.
A reader that asks for a day lists the folders of that day only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The names of the result tables.
RAW_SPANS = "trace"
CHAIN_MINUTES = "trace_api_analyze_minutes"
CHAIN_DAYS = "trace_api_analyze"
FAILED_BY_TIME = "exception_trace_by_time"
FAILED_BY_API = "exception_trace_by_api"
ALL_TRACES = "all_trace"
ADDRESSES = "span_ip"
PAGE_APIS = "trace_page_analyze_minutes"
API_PAGES = "trace_api_source_analyze_minutes"
PAGE_CALLS = "page_call_time_minutes"
DEAD_LETTERS = "dead_letters"
LATE_SPANS = "late_spans"
TRACE_DAYS = "trace_days"


def day_of_seconds(seconds: Column) -> Column:
    """UTC day, whatever the session's time zone."""
    return F.date_from_unix_date(F.floor(seconds / 86_400).cast("int"))


def write_batch(
    df: DataFrame, root: str, table: str, batch_id: int, day: Column | None = None,
    by: tuple[str, ...] = (),
) -> None:
    """Write a batch's rows, by ``day`` if given: a day's rows meet before they are written.

    Otherwise every task would open a file for each day. Adaptive execution splits a large day and puts
    small ones together, so the number of files follows the bytes and not tasks times days.
    """
    if day is not None:
        df, by = df.withColumn("day", day), (*by, "day")
        df = df.hint("rebalance", *(F.col(c) for c in by))
    (
        df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by, "batch_id").parquet(f"{root}/{table}")
    )


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in any file system that Spark reaches."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def read_table(
    spark: SparkSession, root: str, table: str, schema: str | None = None
) -> DataFrame:
    """A result table; with ``schema`` nothing is inferred, and a table without files is empty."""
    if schema is None:
        return spark.read.parquet(f"{root}/{table}")
    if not exists(spark, f"{root}/{table}"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{root}/{table}")


def compact(spark: SparkSession, root: str, table: str, day: str, files: int = 1) -> None:
    """Rewrite the files of each batch of a day as ``files`` files, batch by batch in one job.

    Rows and partitions stay as they are. Run it when no stream writes to that day any more.
    """
    one = f"{root}/{table}/day={day}"
    rows = spark.read.option("basePath", f"{root}/{table}").parquet(one)
    kept = f"{root}/{table}/_compacting"
    rows.repartition(files, "batch_id").write.mode("overwrite").partitionBy("day", "batch_id").parquet(kept)
    (
        spark.read.schema(rows.schema).parquet(kept).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch_id")
        .parquet(f"{root}/{table}")
    )
