"""Writes by day, and the jobs of a stream's batches: work follows the bytes, not tasks times days."""

import json

from pyspark.sql import functions as F

from model import frame, span
from spanloom.plans import jobs
from spanloom.sinks import tables as t
from spanloom.streaming.job import ADAPTIVE, TraceStream, newest_receive


def test_a_day_of_a_batch_is_not_a_file_per_task(spark, tmp_path):
    rows = spark.range(4_000).repartition(16).select(
        "id", (F.col("id") % 10 * 86_400).alias("s"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("k")
    )
    root = str(tmp_path)
    t.write_batch(rows, root, "x", 0, t.day_of_seconds(F.col("s")))
    t.write_batch(rows, root, "y", 0, t.day_of_seconds(F.col("s")), ("k",))
    assert len(list((tmp_path / "x").rglob("*.parquet"))) == 10
    assert len(list((tmp_path / "y").rglob("*.parquet"))) == 10  # a day has one k here
    for name in "xy":
        back = t.read_table(spark, root, name).agg(F.count("*"), F.sum("id"), F.count_distinct("day")).first()
        assert tuple(back) == (4_000, 4_000 * 3_999 // 2, 10)


def test_batches_run_adaptively_and_the_session_is_left_as_it_was(spark, tmp_path):
    seen = []
    handler = lambda batch: seen.append(batch.spark.conf.get(ADAPTIVE))
    stream = TraceStream(str(tmp_path), (handler,), clock=newest_receive)
    body = b"\0\0" + json.dumps({"spans": [{"begin": 1, "end": 2, "traceId": 1, "spanId": 1}]}).encode()
    payloads = spark.createDataFrame([(bytearray(body), 5)], "value binary, ms bigint").select(
        "value", F.timestamp_millis("ms").alias("timestamp")
    )
    spark.conf.set(ADAPTIVE, "false")  # as in the session of a stream
    try:
        stream.process(payloads, 0)
        assert spark.conf.get(ADAPTIVE) == "false"
    finally:
        spark.conf.set(ADAPTIVE, "true")
    assert seen == ["true"]


def test_trees_for_several_tables_are_written_once(spark, tmp_path):
    spans = frame(spark, [span("a", "a", None, "api", begin=0, end=5, event="sr", receive=10_000)])
    forest = jobs.forest_of(spans, extra=("ip", "http_host")).staged()
    plan = forest.inline._jdf.queryExecution().executedPlan().toString()
    assert "parquet" in plan and "Exchange" not in plan and "InMemoryTableScan" not in plan
    assert [r.steps_total for r in forest.summary().collect()] == [1]
