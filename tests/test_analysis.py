import json

from model import frame, span
from spanloom.operators import holding, indexes, pages, stats, words
from spanloom.operators.holding import HoldRules, assemble
from spanloom.operators.tree import build_forest


def forest(spark, rows, extra=()):
    return build_forest(frame(spark, rows), None, extra)


def two_calls():
    """The same chain twice in one minute, with durations 10 and 15 and steps of 4 and 7."""
    rows = []
    for tid, length, step, error in (("a", 10, 4, 0), ("b", 15, 7, 1)):
        rows += [
            span(tid, tid, None, "http:/buy", begin=0, end=length, event="sr", receive=70_000,
                 span_type="HTTP", region="r1"),
            span(tid, tid + "1", tid, "sql", begin=1, end=1 + step, span_type="MYSQL",
                 error_count=error, http_host="db"),
        ]
    return rows


def test_chain_statistics(spark):
    row = stats.chain_stats(forest(spark, two_calls()).summary(), "minute_start").first()
    assert (row.minute_start, row.api, row.times, row.duration) == (60, "http:/buy", 2, 12)
    assert (row.max_latency, row.max_latency_trace) == (15, "b")
    assert (row.min_latency, row.min_latency_trace) == (10, "a")
    assert (row.mysql_times, row.redis_times, row.rest_times, row.region) == (2, 0, 0, None)


def test_region_is_known_for_single_calls_only(spark):
    rows = [r for r in two_calls() if r["traceid"] == "a"]
    assert stats.chain_stats(forest(spark, rows).summary(), "minute_start").first().region == "r1"


def test_ties_go_to_the_largest_and_smallest_trace(spark):
    rows = [span(t, t, None, "x", event="sr", receive=1) for t in ("m", "z", "a")]
    row = stats.chain_stats(forest(spark, rows).summary(), "minute_start").first()
    assert (row.max_latency_trace, row.min_latency_trace) == ("z", "a")


def test_steps_and_table(spark):
    f = forest(spark, two_calls())
    steps = {r.pos: r for r in stats.chain_steps(f, "minute_start").collect()}
    assert (steps[1].span_name, steps[1].duration, steps[1].error_count) == ("sql", 5, 1)
    assert (steps[1].level, steps[1].parent, steps[1].span_id) == (1, "a", "a1")
    table = stats.chain_table(f, "minute_start").first()
    assert (table.times, table.duration, table.segment) == (2, 12, 0)
    assert json.loads(table.spans)[1] == {
        "spanName": "sql", "spanId": "a1", "duration": 5, "level": 1, "parent": "a",
        "errorCount": 1, "spanType": "MYSQL",
    }


def test_step_profile_divides_by_calls(spark):
    rows = two_calls() + [span("a", "a2", "a", "sql", begin=9, end=10), span("b", "b2", "b", "sql", begin=9, end=10)]
    got = {r.span_name: r for r in stats.step_profile(forest(spark, rows)).collect()}
    assert (got["sql"].times, got["sql"].steps, got["sql"].duration) == (2, 4, 6)


def test_chain_profile_bounds(spark):
    rows = [span("q", "q", None, "x", begin=5, end=6, event="sr", receive=1)]
    row = stats.chain_profile(forest(spark, rows).summary()).first()
    assert (row.max_latency, row.max_latency_trace) == (1, "")
    assert (row.min_latency, row.min_latency_trace) == (1, "q")


def test_addresses_of_root_and_called_hosts(spark):
    rows = two_calls() + [span("a", "a3", "a", "cache", begin=20, http_host=" ")]
    got = stats.address_latency(forest(spark, rows, ("ip", "http_host"))).collect()
    assert sorted((r.span_name, r.ip, r.times) for r in got) == [
        ("http:/buy", "10.0.0.1", 1), ("http:/buy", "10.0.0.1", 1), ("sql", "db", 1), ("sql", "db", 1),
    ]


def test_failed_traces(spark):
    rows = two_calls() + [
        span("u", "u", None, "http:/", begin=3000, event="sr", error_count=1),
        span("w", "w", None, " ", begin=3000, event="sr", error_count=1),
    ]
    f = forest(spark, rows)
    assert [r.rowkey for r in indexes.failed_by_time(f).collect()] == ["0:b"]
    row = indexes.failed_by_api(f).first()
    assert row.rowkey == "http:/buy:0:b"
    assert [s["spanName"] for s in json.loads(row.spans)] == ["http:/buy", "sql"]


def test_every_trace_is_found_by_chain_and_api(spark):
    f = forest(spark, two_calls())
    md5 = f.summary().first().trace_md5
    keys = sorted((r["index"], r.rowkey) for r in indexes.all_by_key(f).collect())
    assert keys == [
        ("api", "http:/buy:0:a"), ("api", "http:/buy:0:b"),
        ("md5", f"{md5}:0:a"), ("md5", f"{md5}:0:b"),
    ]


def test_pages(spark):
    rows = [
        span("a", "1", None, "http:/cart-x", page_id="iFP-1", end=10),
        span("a", "2", None, "http:/cart-x", page_id="aFP-1", end=21),
        span("a", "3", None, "list", page_id="FP-1"),
        span("a", "4", None, "http:/", page_id="FP-1"), span("a", "5", None, "", page_id="FP-1"),
        span("a", "6", None, "list", page_id=""), span("a", "7", None, "list", page_id=None),
        span("a", "8", None, "list", page_id="xFP2"),
    ]
    totals = pages.page_api_totals(frame(spark, rows))
    got = {(r.page, r.api): (r.times, r.total_duration, r.duration) for r in totals.collect()}
    assert got == {
        ("FP-1", "cart-x"): (2, 31, 15), ("FP-1", "list"): (1, 5, 5),
        ("xFP2", "list"): (1, 5, 5),
    }
    hot = {r.page: r.times for r in pages.hottest_api(totals).collect()}
    assert hot == {"FP-1": 2, "xFP2": 1}
    assert pages.api_sources(totals).columns == ["api", "page", "times"]


def test_word_count(spark):
    texts = spark.createDataFrame([("aa bb ",), ("aa cc ee",), (None,)], "text string")
    got = {r.word: r.n for r in words.word_count(texts).collect()}
    assert got == {"aa": 2, "bb": 1, "cc": 1, "ee": 1, "null": 1}


# ---- completeness of traces ------------------------------------------------------------------

NOW = 1_000_000


def at(traceid, spanid, end_ago, receive_ago):
    end = NOW - end_ago
    return span(traceid, spanid, begin=end - 5, end=end, receive=NOW - receive_ago)


def states(spark, fresh, pending, now=NOW):
    out = assemble(frame(spark, fresh), frame(spark, pending), now, HoldRules())
    return sorted((r.traceid, r.spanid, r.state) for r in out.collect())


def test_recent_spans_hold_their_trace(spark):
    fresh = [
        at("done", "1", 9_000, 0), at("done", "2", 5_000, 0),
        at("held", "1", 9_000, 0), at("held", "2", 2_999, 0),
        at("edge", "1", 3_000, 0),
        at("skew", "1", -50, 0),
        at("late", "1", 120_000, 0), at("late", "2", 130_000, 0),
        at("mixed", "1", 200_000, 0), at("mixed", "2", 119_999, 0),
    ]
    assert states(spark, fresh, []) == [
        ("done", "1", "ready"), ("done", "2", "ready"), ("edge", "1", "ready"),
        ("held", "1", "waiting"), ("held", "2", "waiting"), ("late", "1", "dropped"), ("late", "2", "dropped"),
        ("mixed", "1", "ready"), ("mixed", "2", "ready"), ("skew", "1", "waiting"),
    ]


def test_waiting_traces_merge_release_or_wait_on(spark):
    fresh = [at("merge", "2", 9_000, 0), at("again", "2", 1_000, 0)]
    pending = [
        at("merge", "1", 62_000, 60_000), at("again", "1", 62_000, 60_000),
        at("idle", "1", 62_000, 60_000), at("young", "1", 60_000, 59_999),
        at("stale", "1", 400_000, 300_000),
    ]
    assert states(spark, fresh, pending) == [
        ("again", "1", "waiting"), ("again", "2", "waiting"), ("idle", "1", "ready"),
        ("merge", "1", "ready"), ("merge", "2", "ready"), ("stale", "1", "ready"),
        ("young", "1", "waiting"),
    ]


def test_release_window(spark):
    rows = [
        at("in", "1", 62_000, 60_000), at("young", "1", 60_000, 59_999),
        at("old", "1", 121_000, 120_000), at("split", "1", 62_000, 60_000),
        at("split", "2", 121_000, 120_000), at("never", "1", 90_000, 80_000),
    ]
    spans = frame(spark, rows)
    rules = HoldRules()
    assert {r.traceid for r in holding.held_traces(spans, rules).collect()} == {
        "in", "young", "old", "split",
    }
    assert [r.traceid for r in holding.released_traces(spans, NOW, rules).collect()] == ["in"]
    ready = holding.ready_traces(spans, NOW, rules)
    assert {r.traceid for r in ready.collect()} == {"in", "never"}


def test_late_traces_are_judged_by_their_last_span(spark):
    rows = [at("late", "1", 120_000, 0), at("late", "2", 500_000, 0), at("ok", "1", 500_000, 0),
            at("ok", "2", 119_999, 0)]
    kept = holding.on_time(frame(spark, rows), NOW)
    assert {r.traceid for r in kept.collect()} == {"ok"}
