import json

from pyspark.sql import functions as F

from spanloom.functions import has_text, hex_id, ipv4_to_int, split_on_spaces, parse_hex_id
from spanloom.operators import spans as span_ops, zipkin
from spanloom.schemas import MESSAGE, TagKeys
from spanloom.sources import events
from spanloom.sources.messages import PAYLOAD, dead_letters, decode, good_messages

HOST = {"serviceName": "Shop", "address": "10.1.2.3", "port": 8080}


def message(*spans, receive=50_000, host=HOST):
    return {"host": host, "spans": list(spans), "receive": receive}


def one_span(**more):
    base = dict(begin=1500, end=2500, name="get", traceId=7, spanId=9, parents=[3, 4],
                tags={}, logs=[{"timestamp": 1500, "event": "cs"}], durationMicros=1_000_000)
    base.update(more)
    return base


def exploded(spark, *spans, **more):
    return span_ops.explode_spans(spark.createDataFrame([message(*spans, **more)], MESSAGE))


def flat(spark, *spans, tags=TagKeys()):
    return span_ops.flat_spans(exploded(spark, *spans), tags).orderBy("begin").collect()


def column(spark, expression, *values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("v"))).collect()]


def test_ids(spark):
    values = [0, 1, -1, 2**63 - 1, -(2**63)]
    texts = [f"{v % 2**64:016x}" for v in values]
    assert column(spark, hex_id, *values, kind="bigint") == texts
    assert column(spark, parse_hex_id, *texts) == values
    odd = ["f" * 16 + "0" * 15 + "a", "a", "A", "", "0" * 33, "12g"]
    assert column(spark, parse_hex_id, *odd) == [10, 10, None, None, None, None]


def test_addresses(spark):
    values = ["10.1.0.5", "255.255.255.255", "256.1.1.1", "db-host", None, "", "1.2.3"]
    wanted = [167837701, -1, None, None, 2130706433, 2130706433, None]
    assert column(spark, ipv4_to_int, *values) == wanted


def test_blank_text(spark):
    values = [None, "", "  ", "\t\n", " x "]
    assert column(spark, has_text, *values) == [False, False, False, False, True]


def test_word_split_drops_empty_words_at_the_end_only(spark):
    values = ["which means that the aa ", "a  b", " a", "", "   ", None]
    wanted = [["which", "means", "that", "the", "aa"], ["a", "", "b"], ["", "a"], [""], [], ["null"]]
    assert column(spark, split_on_spaces, *values) == wanted


def test_flat_row(spark):
    row = flat(spark, one_span(tags={"http.host": "h", "region": "r", "fromPage": "p"}))[0]
    assert (row.traceid, row.spanid, row.parent) == ("0" * 15 + "7", "0" * 15 + "9", "0" * 15 + "4")
    assert (row.duration, row.receive, row.event) == (1000, 50_000, "cs")
    assert (row.service, row.ip, row.http_host) == ("Shop", "10.1.2.3", "h")
    assert (row.region, row.page_id, row.error_count) == ("r", "p", 0)


def test_defaults_of_absent_fields(spark):
    row = flat(spark, {"begin": 5})[0]
    assert (row.name, row.end, row.event, row.parent) == ("dummy", 0, "none", None)
    assert row.traceid == row.spanid == "0" * 16
    assert row.span_type == "HTTP"


def test_span_types_and_errors(spark):
    rows = flat(
        spark,
        one_span(begin=1, tags={"lc": "redis", "http.url": "u", "error": " "}),
        one_span(begin=2, tags={"lc": "mysql", "error": "x"}),
        one_span(begin=3, tags={"lc": "other", "http.url": "u"}),
        one_span(begin=4, spanId=7),
        one_span(begin=5, tags={"http.url": "  ", "region": " "}),
    )
    assert [r.span_type for r in rows] == ["REDIS", "MYSQL", "RESTTEMPLATE", "HTTP", "OTHER"]
    assert [r.error_count for r in rows] == [0, 1, 0, 0, 0]
    assert rows[4].region is None


def test_tag_keys_are_settings(spark):
    keys = TagKeys(region="shop.region", from_page="shop.page")
    row = flat(spark, one_span(tags={"shop.region": "r", "shop.page": "p", "region": "no"}), tags=keys)[0]
    assert (row.region, row.page_id) == ("r", "p")


def payload_rows(spark, *values):
    rows = [(None if v is None else bytearray(v),) for v in values]
    return spark.createDataFrame(rows, "value binary").withColumn(
        "timestamp", F.timestamp_millis(F.lit(1234))
    ).select(*PAYLOAD.names)


def test_decode(spark):
    good = json.dumps({"host": HOST, "spans": [one_span(), {"end": 4}]}).encode()
    values = [b"\0\0" + good, None, b"\0", b"\0\0", b"\0\0not json", b'\0\0{"spans": 3}',
              b'\0\0{"host": null, "spans": null}', b"\0\0" + good[:-9]]
    decoded = decode(payload_rows(spark, *values))
    message = good_messages(decoded).collect()
    assert len(message) == 1
    assert message[0].receive == 1234 and message[0].host.serviceName == "Shop"
    assert [s.begin for s in message[0].spans] == [1500]
    reasons = sorted(r.reason for r in dead_letters(decoded).collect())
    assert reasons == sorted([
        "truncated", "truncated", "empty", "malformed", "malformed", "malformed", "no spans",
        "span without begin",
    ])


def test_store_keeps_the_last_write(spark):
    rows = exploded(spark, one_span(), receive=1).unionByName(
        exploded(spark, one_span(name="later"), one_span(logs=[]), receive=2)
    )
    stored = span_ops.latest_per_key(span_ops.store_rows(rows), ("rowkey",), "receive")
    got = {r.event: r for r in stored.collect()}
    assert set(got) == {"cs", "none"}
    assert got["cs"].name == "later" and got["cs"].begin_sec == 1
    assert got["cs"].rowkey == f"{7:016x}:1:{9:016x}:cs"
    assert json.loads(got["cs"].logs) == [{"timestamp": 1500, "event": "cs"}]
    back = span_ops.spans_of_store(stored).where("event = 'cs'").first()
    assert (back.event, back.parent, back.duration) == ("cs", f"{4:016x}", 1000)


def test_day_scan_bounds(spark):
    day = 19_000 * 86_400_000
    low = day - 8 * 3_600_000
    rows = spark.createDataFrame([(low - 1,), (low,), (day,), (day + 5,), (day + 6,)], "begin bigint")
    got = [r.begin for r in span_ops.day_scan(rows, day + 5).collect()]
    assert sorted(got) == [low, day, day + 5]


def test_identity_ignores_the_event(spark):
    rows = exploded(spark, one_span(), one_span(logs=[{"timestamp": 1, "event": "sr"}]), one_span(spanId=1))
    got = {(r.trace_no, r.span_no): r.records for r in span_ops.span_identities(rows).collect()}
    assert got == {(7, 9): 2, (7, 1): 1}


def test_conversion_of_times(spark):
    logs = [{"timestamp": 100, "event": "cs"}, {"timestamp": 130, "event": "cr"}]
    rows = exploded(
        spark,
        one_span(spanId=1, logs=logs),
        one_span(spanId=2, remote=True),
        one_span(spanId=3, durationMicros=None),
        one_span(spanId=4, parents=[], traceIdHigh=5),
        one_span(spanId=5, name="message:sleuth"),
    )
    got = {int(r.id, 16): r for r in zipkin.zipkin_spans(rows).collect()}
    assert set(got) == {1, 2, 3, 4}
    assert (got[1].timestamp, got[1].duration, got[1].parent_id) == (1_500_000, 30_000, f"{3:016x}")
    assert (got[2].timestamp, got[2].duration) == (None, None)
    assert (got[3].timestamp, got[3].duration) == (1_500_000, None)
    assert got[4].parent_id is None and got[4].trace_id == f"{5:016x}{7:016x}"
    assert got[4].duration == 1_000_000


def test_conversion_of_tags(spark):
    rows = exploded(
        spark,
        one_span(spanId=1, processId="ProcA"),
        one_span(spanId=2, logs=[{"timestamp": 1, "event": "sr"}], tags={"k": "v"}),
        one_span(spanId=3, tags={"peer.service": "Db", "lc": "x"}),
        one_span(spanId=4, tags={"peer.service": "Db", "sa": "y", "lc": "x"}),
        one_span(spanId=5, logs=[]),
    )
    got = {}
    for r in zipkin.zipkin_binary_annotations(rows).collect():
        got.setdefault(int(r.id, 16), set()).add((r.type, r.key, r.value, r.endpoint_service))
    assert got[1] == {("STRING", "lc", "proca", "shop")}
    assert got[2] == {("STRING", "k", "v", "shop")}
    assert ("BOOL", "sa", "true", "db") in got[3] and len(got[3]) == 3
    assert all(kind == "STRING" for kind, *_ in got[4])
    assert got[5] == {("STRING", "lc", "unknown", "shop")}
    notes = zipkin.zipkin_annotations(rows).where("id = '0000000000000002'").first()
    assert (notes.timestamp, notes.value, notes.endpoint_ipv4) == (1000, "sr", 167838211)


def test_tasks_that_derive_spans_are_bounded_by_rows(spark, monkeypatch):
    monkeypatch.setattr(events, "TASK_ROWS", 500, raising=False)
    rows = events.event_spans(spark, "/root/testdata/sf0.01").rows
    sizes = rows.groupBy(F.spark_partition_id()).count().agg(F.sum("count"), F.max("count")).first()
    assert sizes[0] == 10_000 and sizes[1] < 1_500


def test_a_payload_is_parsed_once(spark):
    stored = spark.range(3).selectExpr("cast(string(id) as binary) as value", "timestamp_millis(id) as timestamp")
    plan = good_messages(decode(stored))._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("from_json") == 1
