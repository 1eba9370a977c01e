"""Merging a day by key, and lookups in what is merged."""

import datetime

import pytest
from pyspark.sql import functions as F

from spanloom.plans import jobs
from spanloom.sinks import merged as m, tables as t

DAY = datetime.date(1970, 1, 2)
SPANS = [f for f in jobs.STORE_SCHEMA.split(", ")]


def _spans(spark, rows):
    """(key, name, receive) as rows of the span store."""
    known = {"rowkey": 0, "name": 1, "receive": 2}
    out = spark.createDataFrame(rows, "a string, b string, c bigint")
    columns = []
    for field in SPANS[:-2]:
        name, kind = field.split()
        source = F.col("abc"[known[name]]) if name in known else F.lit(None)
        columns.append(source.cast(kind).alias(name))
    return out.select(*columns)


def _write_spans(spark, root, batch, rows):
    t.write_batch(_spans(spark, rows), root, t.RAW_SPANS, batch, F.lit(DAY))


def _names(spark, root):
    rows = m.read_merged(spark, root, m.SPANS, jobs.STORE_SCHEMA)
    return sorted((r.rowkey, r.name) for r in rows.collect())


def test_last_write_of_each_key_over_generations(spark, tmp_path):
    root = str(tmp_path)
    assert _names(spark, root) == []
    assert m.merge_days(spark, root, m.SPANS, jobs.STORE_SCHEMA) == {}
    _write_spans(spark, root, 0, [("a", "old", 1), ("b", "b", 1)])
    _write_spans(spark, root, 1, [("a", "new", 2), ("c", None, 1)])
    want = [("a", "new"), ("b", "b"), ("c", None)]
    assert sorted(_names(spark, root), key=str) == sorted(want, key=str)
    assert m.merge_days(spark, root, m.SPANS, jobs.STORE_SCHEMA) == {DAY: 0}
    assert m.merge_days(spark, root, m.SPANS, jobs.STORE_SCHEMA) == {}
    rows = m.read_merged(spark, root, m.SPANS, jobs.STORE_SCHEMA)
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
    assert _names(spark, root) == want
    # A batch that comes later is merged while reading, and then at rest; an older write loses.
    _write_spans(spark, root, 2, [("b", "newer", 5), ("a", "stale", 0)])
    want[1] = ("b", "newer")
    assert _names(spark, root) == want
    assert m.merge_days(spark, root, m.SPANS, jobs.STORE_SCHEMA) == {DAY: 1}
    assert _names(spark, root) == want
    m.retire(spark, root, m.SPANS, jobs.STORE_SCHEMA, DAY)
    assert _names(spark, root) == want
    assert [p.name for p in (tmp_path / "trace_merged" / f"day={DAY}").iterdir() if p.is_dir()] == ["generation=1"]
    assert not list((tmp_path / "trace" / f"day={DAY}").glob("batch_id=*"))


def test_a_merge_that_ends_before_its_commit_changes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    _write_spans(spark, root, 0, [("a", "one", 1)])
    m.merge_days(spark, root, m.SPANS, jobs.STORE_SCHEMA, [DAY])
    _write_spans(spark, root, 1, [("a", "two", 2), ("b", "b", 1)])
    with monkeypatch.context() as patch:
        patch.setattr(m, "_commits", lambda root, table: "file:/proc/no/such/folder" if _written(tmp_path) else f"{root}/{table}_merges")
        with pytest.raises(Exception):
            m.merge_days(spark, root, m.SPANS, jobs.STORE_SCHEMA, [DAY])
    assert _written(tmp_path)
    assert _names(spark, root) == [("a", "two"), ("b", "b")]
    # Files of the failed generation are replaced by the next run, which finds more.
    _write_spans(spark, root, 2, [("c", "c", 1)])
    assert m.merge_days(spark, root, m.SPANS, jobs.STORE_SCHEMA) == {DAY: 1}
    assert _names(spark, root) == [("a", "two"), ("b", "b"), ("c", "c")]


def _written(folder):
    return (folder / "trace_merged" / f"day={DAY}" / "generation=1").exists()


def test_a_reader_from_before_the_commit_goes_on(spark, tmp_path):
    root = str(tmp_path)
    _write_spans(spark, root, 0, [("a", "one", 1)])
    m.merge_days(spark, root, m.SPANS, jobs.STORE_SCHEMA, [DAY])
    before = m.read_merged(spark, root, m.SPANS, jobs.STORE_SCHEMA)
    _write_spans(spark, root, 1, [("a", "two", 2)])
    m.merge_days(spark, root, m.SPANS, jobs.STORE_SCHEMA, [DAY])
    assert [r.name for r in before.collect()] == ["one"]
    assert _names(spark, root) == [("a", "two")]


def test_only_finished_batches_are_covered(spark, tmp_path):
    root = str(tmp_path)
    _write_spans(spark, root, 0, [("a", "one", 1)])
    _write_spans(spark, root, 1, [("a", "running", 2)])
    m.merge_days(spark, root, m.SPANS, jobs.STORE_SCHEMA, [DAY], upto=0)
    _write_spans(spark, root, 1, [("a", "run again", 3)])
    assert _names(spark, root) == [("a", "run again")]


@pytest.fixture(scope="module")
def traces(spark, tmp_path_factory):
    """One row a second for a day and two APIs, keys with colons, and one trace in two segments."""
    root = str(tmp_path_factory.mktemp("traces"))
    n = F.col("id")
    rows = spark.range(0, 86_400, numPartitions=4).select(
        F.lit("api").alias("index"),
        F.when(n % 3 == 0, "GET:/a").otherwise("GET:/a:b").alias("api"),
        (n + 86_400).alias("starttime"), F.format_string("%016x", n * 7919 % 86_400).alias("traceid"),
        F.explode(F.expr("if(id = 300, array(0L, 1L), array(0L))")).alias("segment"),
    )
    ending = F.concat_ws(":", "starttime", "traceid", F.when(F.col("segment") > 0, F.col("segment")))
    rows = rows.select(
        "index", F.concat_ws(":", "api", ending).alias("rowkey"), "segment",
        F.repeat(F.md5("traceid"), 8).alias("spans"), "traceid", "starttime", F.lit("m").alias("bucket_md5"),
        F.lit(1).cast("bigint").alias("duration"), F.lit(None).cast("string").alias("region"),
    )
    day = t.day_of_seconds(F.col("starttime"))
    for batch in (0, 1):
        t.write_batch(rows.where(F.col("starttime") % 2 == batch), root, t.ALL_TRACES, batch, day, ("index",))
    return root


def _scanned(df):
    """Rows that left the scans of a DataFrame's plan, once it ran."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    scans, todo = [], [plan]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("Scan parquet"):
            scans.append(node.metrics().apply("numOutputRows").value())
        todo.extend(node.children().apply(i) for i in range(node.children().size()))
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
    assert scans
    return sum(scans)


def test_a_lookup_reads_its_own_row_groups(spark, traces, monkeypatch):
    want = [(s, 0) for s in range(86_500, 86_900) if (s - 86_400) % 3 == 0]
    want = sorted([*want, (86_700, 1)])

    def found():
        rows = m.find_traces(spark, traces, "GET:/a", 86_500, 86_899)
        return rows, sorted((r.starttime, r.segment) for r in rows.collect())

    assert found()[1] == want
    monkeypatch.setattr(m, "ROW_GROUP_BYTES", 64 * 1024)
    assert m.merge_days(spark, traces, m.TRACES, m.TRACES_SCHEMA, [DAY], file_rows=20_000) == {DAY: 0}
    rows, got = found()
    assert got == want
    assert _scanned(rows) < 10_000  # of 86,401
    one = m.find_trace(spark, traces, f"{7919 * 300 % 86_400:016x}")
    assert sorted((r.key, r.segment) for r in one.collect()) == [("GET:/a", 0), ("GET:/a", 1)]
    assert _scanned(one) < 60_000
    assert m.find_traces(spark, traces, "GET:/a", 0, 86_399).count() == 0
    assert m.find_traces(spark, traces, "GET:/a", 86_400, 172_799, "md5").count() == 0


def test_sums_of_a_key(spark, tmp_path):
    root = str(tmp_path)
    ddl = m.ADDRESSES_SCHEMA.split(", day")[0]
    for batch, (total, times) in enumerate([(10, 1), (5, 2), (1, 1)]):
        rows = [("m", "s", 86_400, "ip", total, times, "k"), ("m", "s", 86_400, f"ip{batch}", 1, 1, f"k{batch}")]
        t.write_batch(spark.createDataFrame(rows, ddl), root, t.ADDRESSES, batch, F.lit(DAY))
        if batch < 2:
            m.merge_days(spark, root, m.ADDRESSES, m.ADDRESSES_SCHEMA, [DAY])
    got = m.read_merged(spark, root, m.ADDRESSES, m.ADDRESSES_SCHEMA).collect()
    assert sorted((r.rowkey, r.total_duration, r.times) for r in got) == [
        ("k", 16, 4), ("k0", 1, 1), ("k1", 1, 1), ("k2", 1, 1)]


def test_days_go_their_own_ways(spark, tmp_path):
    root = str(tmp_path)
    other = DAY + datetime.timedelta(days=1)
    _write_spans(spark, root, 0, [("a", "one", 1)])
    t.write_batch(_spans(spark, [("z", "one", 1)]), root, t.RAW_SPANS, 0, F.lit(other))
    assert m.merge_days(spark, root, m.SPANS, jobs.STORE_SCHEMA) == {DAY: 0, other: 0}
    _write_spans(spark, root, 1, [("a", "two", 2)])
    assert m.merge_days(spark, root, m.SPANS, jobs.STORE_SCHEMA) == {DAY: 1}
    assert _names(spark, root) == [("a", "two"), ("z", "one")]
    days = m.read_merged(spark, root, m.SPANS, jobs.STORE_SCHEMA, other, other)
    assert [(r.rowkey, r.day) for r in days.collect()] == [("z", other)]


def test_a_task_sorts_a_bounded_share_of_a_day(spark, tmp_path):
    root = str(tmp_path)
    ddl = m.ADDRESSES_SCHEMA.split(", day")[0]
    n = F.col("id")
    known = {"minute_start": n, "total_duration": n, "times": F.lit(1), "rowkey": n, "trace_md5": F.lit("m")}
    rows = spark.range(1_100_000).select(*[
        known.get(name, F.lit("x")).cast(kind).alias(name) for name, kind in (c.split() for c in ddl.split(", "))
    ])
    t.write_batch(rows, root, t.ADDRESSES, 0, F.lit(DAY))
    m.merge_days(spark, root, m.ADDRESSES, m.ADDRESSES_SCHEMA, [DAY])
    files = list((tmp_path / "span_ip_merged" / f"day={DAY}").rglob("*.parquet"))
    assert len(files) == 3
    got = m.read_merged(spark, root, m.ADDRESSES, m.ADDRESSES_SCHEMA).agg(F.count("*"), F.sum("times")).first()
    assert tuple(got) == (1_100_000, 1_100_000)
