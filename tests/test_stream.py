import json

from pyspark.sql import functions as F

from spanloom.operators.holding import HoldRules
from spanloom.operators import spans as span_ops
from spanloom.plans import jobs
from spanloom.sinks import tables as t
from spanloom.sources.messages import PAYLOAD, file_payloads
from spanloom.streaming.job import (
    HANDLERS, TraceStream, late_spans, newest_receive, store_spans, waiting_spans,
)
from spanloom.streaming.replay import replay
from spanloom.streaming.sessions import closed_sessions, spans_of_sessions
from spanloom.streaming.words import file_texts, running_word_count

BASE = 1_700_000_000_000
HOST = {"serviceName": "shop", "address": "10.0.0.1", "port": 80}


def payload(receive, *spans, raw=None):
    body = raw if raw is not None else json.dumps({"host": HOST, "spans": list(spans)}).encode()
    return (bytearray(b"\0\0" + body), receive)


def one(trace, number, begin, length=10, **more):
    root = number == trace
    span = dict(begin=BASE + begin, end=BASE + begin + length, name="http:/buy" if root else "sql",
                traceId=trace, spanId=number, parents=[] if root else [trace], tags={"lc": "mysql"},
                logs=[{"timestamp": BASE + begin, "event": "sr" if root else "cs"}])
    span.update(more)
    return span


def batches(spark, slices):
    rows = [(value, BASE + receive, n) for n, part in enumerate(slices) for value, receive in part]
    frame = spark.createDataFrame(rows, "value binary, ms bigint, slice int")
    return frame.select("value", F.timestamp_millis("ms").alias("timestamp"), "slice")


SLICES = [
    # trace 1 is complete; trace 2 ends too close to the receive time and waits
    [payload(60_000, one(1, 1, 10_000, tags={"fromPage": "iFP1"}), one(1, 11, 10_002, 4)),
     payload(60_000, one(2, 2, 58_000)), payload(60_000, raw=b"junk")],
    # the rest of trace 2, and trace 3 that waits until nothing comes any more
    [payload(120_000, one(2, 21, 70_000, 6)), payload(120_000, one(3, 3, 119_500, tags={"error": "e"}))],
    [payload(180_000, one(4, 4, 130_000))],
    # spans three minutes late
    [payload(240_000, one(5, 5, 20_000)), payload(240_000, one(6, 6, 239_999))],
]


def start_stream(spark, root, slices, handlers=HANDLERS, clock=newest_receive):
    stream = TraceStream(f"{root}/out", handlers, clock=clock)
    source = f"{root}/in"
    count = replay(
        batches(spark, slices), "slice", source,
        lambda: stream.start(file_payloads(spark, source), available_now=True),
    )
    return stream, count


def test_traces_across_batches(spark, tmp_path):
    stream, count = start_stream(spark, str(tmp_path), SLICES)
    assert count == 4
    chains = t.read_table(spark, stream.root, t.ALL_TRACES).where("index = 'api'")
    got = {int(r.traceid, 16): (r.batch_id, len(json.loads(r.spans))) for r in chains.collect()}
    assert got == {1: (0, 2), 2: (1, 2), 3: (2, 1), 4: (2, 1)}
    assert {int(r.traceid, 16) for r in waiting_spans(spark, stream.root, 3).collect()} == {6}

    dead = t.read_table(spark, stream.root, t.DEAD_LETTERS).collect()
    assert [(r.reason, bytes(r.value)) for r in dead] == [("malformed", b"\0\0junk")]
    assert t.read_table(spark, stream.root, t.RAW_SPANS).count() == 8
    failed = t.read_table(spark, stream.root, t.FAILED_BY_TIME).collect()
    assert [int(r.traceid, 16) for r in failed] == [3]
    pages = t.read_table(spark, stream.root, t.PAGE_APIS).collect()
    assert [(r.page, r.api, r.times, r.now) for r in pages] == [("FP1", "buy", 1, BASE + 60_000)]
    assert t.read_table(spark, stream.root, t.PAGE_CALLS).first().rowkey == f"{BASE + 60_000}-FP1"
    minutes = t.read_table(spark, stream.root, t.CHAIN_MINUTES)
    assert minutes.where("batch_id = 0").first().times == 1

    stream.flush(spark, 3, BASE + 300_000)
    chains = t.read_table(spark, stream.root, t.ALL_TRACES).where("index = 'md5' and batch_id = 4")
    assert [int(r.traceid, 16) for r in chains.collect()] == [6]


def test_a_batch_run_again_changes_nothing(spark, tmp_path):
    stream, _ = start_stream(spark, str(tmp_path), SLICES[:2])
    tables = (t.RAW_SPANS, t.ALL_TRACES, t.CHAIN_MINUTES, t.ADDRESSES)

    def content():
        return {n: sorted(map(str, t.read_table(spark, stream.root, n).collect())) for n in tables}

    before = content()
    again = batches(spark, SLICES[:2]).where("slice = 1").drop("slice")
    stream.process(again, 1)
    assert content() == before


def test_a_trace_held_twice_keeps_all_its_spans(spark, tmp_path):
    slices = [
        [payload(60_000, one(1, 1, 59_000))],
        [payload(120_000, one(1, 11, 119_000))],
        [payload(180_000, one(1, 12, 121_000))],
    ]
    stream, _ = start_stream(spark, str(tmp_path), slices)
    rows = t.read_table(spark, stream.root, t.ALL_TRACES).where("index = 'api'").collect()
    assert [(r.batch_id, len(json.loads(r.spans))) for r in rows] == [(2, 3)]


def test_an_empty_batch_keeps_what_waits(spark, tmp_path):
    slices = [
        [payload(60_000, one(1, 1, 59_000))], [payload(120_000, raw=b"junk")],
        [payload(180_000, one(2, 2, 121_000))],
    ]
    stream, _ = start_stream(spark, str(tmp_path), slices)
    rows = t.read_table(spark, stream.root, t.ALL_TRACES).where("index = 'api'").collect()
    assert sorted((int(r.traceid, 16), r.batch_id) for r in rows) == [(1, 2), (2, 2)]


def test_one_wrong_broker_time_costs_no_other_trace(spark, tmp_path):
    """A payload stamped ten minutes ahead; the batch's clock is the wall clock."""
    slices = [[payload(60_000, one(1, 1, 10_000)), payload(60_000, one(2, 2, 12_000)),
               payload(660_000, one(3, 3, 600_000))]]
    stream, _ = start_stream(spark, str(tmp_path), slices, clock=lambda spans: BASE + 61_000)
    rows = t.read_table(spark, stream.root, t.ALL_TRACES).where("index = 'api'").collect()
    assert {int(r.traceid, 16) for r in rows} == {1, 2, 3}
    assert late_spans(spark, stream.root).count() == 0


def test_late_spans_are_kept_aside_and_a_retry_decides_the_same(spark, tmp_path):
    clocks = iter([BASE + 61_000, BASE + 600_000])
    slices = [[payload(60_000, one(1, 1, 10_000)), payload(60_000, one(2, 2, -200_000))]]
    stream, _ = start_stream(spark, str(tmp_path), slices, clock=lambda spans: next(clocks))

    def found():
        done = t.read_table(spark, stream.root, t.ALL_TRACES).where("index = 'api'").collect()
        late = late_spans(spark, stream.root).collect()
        return [int(r.traceid, 16) for r in done], [(int(r.traceid, 16), r.as_of - BASE) for r in late]

    assert found() == ([1], [(2, 61_000)])
    stream.process(batches(spark, slices).drop("slice"), 0)
    assert found() == ([1], [(2, 61_000)])


def test_ticks_release_what_waits_without_new_input(spark, tmp_path):
    import time

    root = str(tmp_path)
    rules = HoldRules(late_ms=10**15, release_from_ms=60_000)
    start = time.time()
    # The held trace was received just now; later batches see a clock one minute ahead.
    stream = TraceStream(f"{root}/out", rules=rules, trigger_seconds=2,
                         clock=lambda spans: BASE + 60_000 + int((time.time() - start) * 20_000))
    batches(spark, [[payload(60_000, one(7, 7, 59_000))]]).drop("slice").write.parquet(f"{root}/in")
    query = stream.start_ticking(file_payloads(spark, f"{root}/in"))
    try:
        for _ in range(90):
            time.sleep(1)
            if t.exists(spark, f"{root}/out/{t.ALL_TRACES}/index=api"):
                break
    finally:
        query.stop()
    rows = t.read_table(spark, stream.root, t.ALL_TRACES).where("index = 'api'").collect()
    assert [int(r.traceid, 16) for r in rows] == [7]


def test_a_day_lists_its_own_folders_and_compaction_keeps_rows(spark, tmp_path):
    root = str(tmp_path)
    for batch in range(4):
        rows = spark.createDataFrame([(batch, 86_400 * d) for d in range(2)], "n int, s bigint").repartition(2)
        t.write_batch(rows, root, "x", batch, t.day_of_seconds(F.col("s")))
    assert sorted(p.name for p in (tmp_path / "x").iterdir() if p.is_dir()) == ["day=1970-01-01", "day=1970-01-02"]
    before = sorted(map(str, t.read_table(spark, root, "x").select("n", "s", "batch_id").collect()))
    t.compact(spark, root, "x", "1970-01-01")
    assert sorted(map(str, t.read_table(spark, root, "x").select("n", "s", "batch_id").collect())) == before
    assert t.read_table(spark, root, "none", "a int").count() == 0


def test_batches_leave_no_staged_folder(spark, tmp_path):
    import os

    from spanloom.staging import staging_root

    before = set(os.listdir(staging_root(spark)))
    start_stream(spark, str(tmp_path), SLICES)
    assert set(os.listdir(staging_root(spark))) == before


def test_bytes_that_are_not_text_are_a_dead_letter(spark, tmp_path):
    slices = [[payload(60_000, raw=b"\xff\xfe{"), payload(60_000, one(1, 1, 10_000))]]
    stream, _ = start_stream(spark, str(tmp_path), slices)
    assert [r.reason for r in t.read_table(spark, stream.root, t.DEAD_LETTERS).collect()] == ["malformed"]
    assert t.read_table(spark, stream.root, t.RAW_SPANS).count() == 1


def test_own_handlers(spark, tmp_path):
    seen = []
    start_stream(spark, str(tmp_path), SLICES, (lambda b: seen.append((b.batch_id, b.spans.count())),))
    assert seen == [(0, 3), (1, 2), (2, 1), (3, 2)]


def test_daily_job_reads_the_store(spark, tmp_path):
    stream, _ = start_stream(spark, str(tmp_path), SLICES, (store_spans,))
    as_of = BASE + 300_000
    jobs.daily_job(spark, stream.root, as_of)
    jobs.daily_job(spark, stream.root, as_of)
    rows = t.read_table(spark, stream.root, t.CHAIN_DAYS).collect()
    assert sum(r.times for r in rows) == 6
    assert {r.day_start for r in rows} == {BASE // 86_400_000 * 86_400}
    assert sum(r.mysql_times for r in rows) == 6
    assert sum(len(json.loads(r.spans)) * r.times for r in rows) == 8
    assert all(r.rowkey == f"{r.api}:{r.day_start}.{r.trace_md5}" for r in rows)
    scan = jobs.read_raw_spans(spark, stream.root, as_of, span_ops.ANALYSIS_COLUMNS)
    plan = scan._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "GreaterThanOrEqual(begin" in plan
    assert "logs" not in plan.split("ReadSchema")[1]


def test_sessions_fetch_their_spans_from_the_store(spark, tmp_path):
    spans = [(f"t{i}", BASE + i * 1000 + j, BASE + i * 1000 + j + 5) for i in range(3) for j in (0, 20_000)]
    spans += [("end", BASE + 10**9, BASE + 10**9)]
    schema = "traceid string, begin bigint, end bigint"
    rows = spark.createDataFrame([(*s, int(s[0] == "end")) for s in spans], schema + ", slice int")
    root, found = str(tmp_path), []

    def write(sessions, _):
        store = spark.read.schema(schema).parquet(f"{root}/in")
        closed = spark.createDataFrame(sessions.collect(), sessions.schema)
        found.extend(spans_of_sessions(closed, store).collect())

    def start():
        source = spark.readStream.schema(schema).parquet(f"{root}/in")
        return (closed_sessions(source).writeStream.outputMode("append").foreachBatch(write)
                .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start())

    replay(rows, "slice", f"{root}/in", start)
    assert sorted(map(tuple, found)) == sorted(s for s in spans if s[0] != "end")


def test_running_word_count(spark, tmp_path):
    root, seen = str(tmp_path), []
    rows = spark.createDataFrame([("aa bb ", 0), ("aa cc", 1), ("aa aa", 2)], "text string, slice int")

    def start():
        return (running_word_count(file_texts(spark, f"{root}/in")).writeStream.outputMode("update")
                .foreachBatch(lambda b, i: seen.append((i, sorted(map(tuple, b.collect())))))
                .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start())

    replay(rows, "slice", f"{root}/in", start)
    assert seen == [(0, [("aa", 1), ("bb", 1)]), (1, [("aa", 2), ("cc", 1)]), (2, [("aa", 4)])]


def test_rules_have_the_usual_defaults():
    rules = HoldRules()
    assert (rules.late_ms, rules.hold_ms) == (120_000, 3_000)
    assert (rules.release_from_ms, rules.release_until_ms) == (60_000, 120_000)
    assert PAYLOAD.names == ["value", "timestamp"]
