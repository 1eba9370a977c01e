"""The daily job: every trace on the day of its root, whatever days its spans lie on."""

import json
import random

import pytest

from spanloom.operators import spans as span_ops
from spanloom.plans import jobs
from spanloom.schemas import MESSAGE
from spanloom.sinks import tables as t

DAY, HOUR = 86_400_000, 3_600_000
BASE = 19_700 * DAY
HOST = {"serviceName": "shop", "address": "10.0.0.1", "port": 80}


def sent(trace, number, begin, parent=None, name=None):
    return {
        "begin": BASE + begin, "end": BASE + begin + 7, "name": name or f"n{number}",
        "traceId": trace, "spanId": number, "parents": [parent] if parent else [],
        "tags": {}, "logs": [{"timestamp": BASE + begin, "event": "sr" if number == trace else "cs"}],
    }


def write(spark, root, batch, spans, receive=0):
    messages = spark.createDataFrame([{"host": HOST, "spans": spans, "receive": BASE + receive}], MESSAGE)
    jobs.write_raw_spans(span_ops.explode_spans(messages), root, batch)


def chains(spark, root):
    rows = t.read_table(spark, root, t.CHAIN_DAYS).collect()
    return sorted(
        ((r.day_start - BASE // 1000) // 86_400, r.api, r.times, len(json.loads(r.spans)), str(r.day))
        for r in rows
    )


def run(spark, root, days, at_once):
    for day in range(0, days, at_once):
        jobs.daily_job(spark, root, BASE + day * DAY + 5 * HOUR, days=at_once)


@pytest.mark.parametrize("at_once", [1, 2])
def test_a_trace_over_midnight_is_one_chain(spark, tmp_path, at_once):
    root = str(tmp_path)
    write(spark, root, 0, [sent(1, 1, 10 * HOUR), sent(1, 11, 11 * HOUR, 1)])
    write(spark, root, 1, [sent(1, 12, DAY + 9 * HOUR, 1, "late")])
    write(spark, root, 2, [sent(2, 2, DAY + 3 * HOUR)])
    run(spark, root, 2, at_once)
    assert [c[:4] for c in chains(spark, root)] == [(0, "n1", 1, 3), (1, "n2", 1, 1)]
    second = BASE // 1000 + 86_400
    assert jobs.owner_days(spark, root, second, second) == [BASE // 1000]
    assert jobs.owner_days(spark, root, BASE // 1000, second) == []


def test_spans_that_come_after_the_run_change_the_owner_day_only(spark, tmp_path):
    root = str(tmp_path)
    write(spark, root, 0, [sent(1, 1, 10 * HOUR)])
    run(spark, root, 1, 1)
    # More of the trace a month later, and a second root span, which owns nothing.
    write(spark, root, 1, [sent(1, 12, 30 * DAY, 1, "late"), sent(1, 1, 31 * DAY, None, "again")])
    jobs.daily_job(spark, root, BASE + 30 * DAY)
    jobs.daily_job(spark, root, BASE + 31 * DAY)
    assert [c[:4] for c in chains(spark, root)] == [(0, "n1", 1, 1)]
    month = BASE // 1000 + 30 * 86_400
    (owner,) = jobs.owner_days(spark, root, month, month + 86_400)
    jobs.daily_job(spark, root, owner * 1000)
    assert [c[:4] for c in chains(spark, root)] == [(0, "n1", 1, 2)]


def random_spans(days):
    rng, batches = random.Random(11), [[], [], []]
    for trace in range(1, 40):
        ids = [trace if rng.random() < 0.7 else 1000 + trace]
        ids += [10_000 + trace * 100 + i for i in range(rng.randint(0, 8))]
        start, length = rng.randrange(days * DAY), rng.choice([HOUR, DAY, days * DAY])
        for i, number in enumerate(ids):
            begin = min(days * DAY - 1, start + (rng.randrange(length) if i else 0))
            one = sent(trace, number, begin, rng.choice(ids[:i]) if i else None, f"t{trace}")
            batches[rng.randrange(3)].append(one)
            if rng.random() < 0.2:
                batches[rng.randrange(3)].append(dict(one, end=one["end"] + 1))
    return batches


def test_days_one_by_one_or_all_at_once_give_the_same(spark, tmp_path):
    days = 6
    found = []
    for at_once in (1, 4, days):
        root = str(tmp_path / str(at_once))
        for n, batch in enumerate(random_spans(days)):
            write(spark, root, n, batch, days * DAY + n)
        run(spark, root, days, at_once)
        found.append(chains(spark, root))
    assert found[0] == found[1] == found[2]
    # The plain rule: the first root span's day, else the last span's.
    owner = {}
    for trace in range(1, 40):
        own = [s for b in random_spans(days) for s in b if s["traceId"] == trace]
        roots = [s["begin"] for s in own if s["spanId"] == trace]
        begin = min(roots) if roots else max(s["begin"] for s in own)
        owner[f"t{trace}"] = (begin - BASE) // DAY
    assert {(c[1], c[0]) for c in found[0]} == set(owner.items())
    assert all(c[2] == 1 for c in found[0])


def test_a_day_inside_its_traces_needs_no_join(spark, tmp_path):
    root = str(tmp_path)
    write(spark, root, 0, [sent(1, 1, HOUR), sent(2, 2, DAY + HOUR)])
    rows = jobs.spans_of_days(spark, root, BASE // 1000, BASE // 1000)
    assert [r.spanid[-1] for r in rows.collect()] == ["1"]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "PartitionFilters: [isnotnull(day" in plan
