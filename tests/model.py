"""Plain statements of the trace rules, to compare the jobs with on small inputs."""

from __future__ import annotations

import hashlib

SPAN_DDL = (
    "name string, traceid string, spanid string, parent string, begin bigint, end bigint, "
    "duration bigint, receive bigint, event string, service string, ip string, "
    "http_host string, error_count bigint, span_type string, region string, page_id string"
)


def span(traceid, spanid, parent=None, name="op", begin=0, end=None, event="cs", **more):
    end = begin + 5 if end is None else end
    row = dict(
        name=name, traceid=traceid, spanid=spanid, parent=parent, begin=begin, end=end,
        duration=end - begin, receive=begin + 10_000, event=event, service="svc", ip="10.0.0.1",
        http_host=None, error_count=0, span_type="OTHER", region=None, page_id=None,
    )
    row.update(more)
    return row


def frame(spark, rows):
    order = [part.split()[0] for part in SPAN_DDL.split(", ")]
    return spark.createDataFrame([tuple(r[c] for c in order) for r in rows], SPAN_DDL)


def _key(s):
    rest = [s[c] for c in ("name", "end", "receive", "error_count", "span_type", "region")]
    fields = [s["begin"], s["name"].lower(), s["spanid"], s["event"], s["parent"], *rest]
    return [(v is not None, v) for v in fields]


def preorder(spans):
    """Steps (level, span) of one trace: root first, children in order below their parent."""
    ordered = sorted(spans, key=_key)
    roots = [i for i, s in enumerate(ordered) if s["spanid"] == s["traceid"]]
    root = roots[0] if roots else len(ordered) - 1
    steps = []
    stack = [(0, root)]
    while stack:
        level, at = stack.pop()
        steps.append((level, ordered[at]))
        own = ordered[at]["spanid"]
        same = [i for i, s in enumerate(ordered) if s["spanid"] == own]
        if at == (root if root in same else same[0]):
            below = [
                i for i, s in enumerate(ordered)
                if i != root and s["parent"] == own and s["event"] == "cs"
                and s["spanid"] != s["parent"]
            ]
            stack.extend((level + 1, i) for i in reversed(below))
    return steps


def summary(spans):
    steps = preorder(spans)
    root = steps[0][1]
    names = "".join(s["name"] + "|" for _, s in steps)
    kinds = [s["span_type"] for _, s in steps]
    return dict(
        traceid=root["traceid"], api=root["name"],
        trace_md5=hashlib.md5(names.encode()).hexdigest(),
        duration=root["end"] - root["begin"], start_ms=root["begin"],
        start_day=root["begin"] // 86_400_000 * 86_400,
        minute_start=root["receive"] // 60_000 * 60,
        day_start=root["receive"] // 86_400_000 * 86_400,
        error_status=any(s["error_count"] > 0 for _, s in steps),
        rest_times=kinds.count("RESTTEMPLATE"), mysql_times=kinds.count("MYSQL"),
        redis_times=kinds.count("REDIS"), region=root["region"], steps_total=len(steps),
    )
