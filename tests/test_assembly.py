"""Traces held in keyed state against the rules of the batch step, slice by slice."""

import glob
import random

import pytest
from pyspark.sql import functions as F

from model import SPAN_DDL, frame, span
from spanloom.operators.holding import HoldRules, assemble
from spanloom.schemas import SPAN_COLUMNS
from spanloom.sinks import tables as t
from spanloom.streaming.assembly import assembled_spans, keyed_state
from spanloom.streaming.replay import replay

MINUTE = 60_000
END = 10_000 * MINUTE


def at(traceid, number, minute, ago, **more):
    """A span received at a full minute that ended ``ago`` before."""
    end = minute * MINUTE - ago
    return span(traceid, f"{traceid}{number}", begin=end - 5, end=end, receive=minute * MINUTE, **more)


def run(spark, folder, slices, **options):
    """(state, trace, span, slice) of everything that comes out; an end marker releases the last."""
    root = str(folder)
    marked = [*slices, [at("end", 0, END // MINUTE, 0)]]
    frames = [frame(spark, rows).withColumn("slice", F.lit(n)) for n, rows in enumerate(marked)]
    rows = frames[0]
    for more in frames[1:]:
        rows = rows.unionByName(more)
    rows = rows.cache()

    def start():
        source = spark.readStream.schema(SPAN_DDL).parquet(f"{root}/in")
        with keyed_state(spark):
            return (
                assembled_spans(source, **options).writeStream.outputMode("append")
                .foreachBatch(lambda batch, n: t.write_batch(batch, root, "out", n))
                .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
            )

    replay(rows, "slice", f"{root}/in", start)
    rows.unpersist()
    out = t.read_table(spark, root, "out")
    assert set(out.columns) == {*SPAN_COLUMNS, "state", "batch_id"}
    return sorted((r.state, r.traceid, r.spanid, r.batch_id // 2) for r in out.collect())


def plain(spark, slices):
    """The batch step over the slices and what waits; the clock is the slice's newest receipt."""
    pending, out = [], []
    for n, rows in enumerate([*slices, [at("end", 0, END // MINUTE, 0)]]):
        clock = max(r["receive"] for r in rows)
        empty = frame(spark, pending) if pending else frame(spark, rows).limit(0)
        decided = [r.asDict() for r in assemble(frame(spark, rows), empty, clock).collect()]
        out += [(r["state"], r["traceid"], r["spanid"], n) for r in decided if r["state"] != "waiting"]
        pending = [r for r in decided if r["state"] == "waiting"]
    return sorted(out)


SLICES = [
    [at("done", 1, 1, 9_000), at("merge", 1, 1, 2_000), at("merge", 2, 1, 30_000),
     at("again", 1, 1, 500), at("idle", 1, 1, -20), at("edge", 1, 1, 3_000)],
    [at("merge", 3, 2, 5_000), at("again", 2, 2, 2_999), at("late", 1, 2, 120_000),
     at("mixed", 1, 2, 200_000), at("mixed", 2, 2, 119_999), at("again", 3, 2, 10_000)],
    [at("again", 4, 3, 3_001), at("other", 1, 3, 0), at("late", 2, 3, 500_000)],
]


def test_hold_merge_release_and_drop(spark, tmp_path):
    got = run(spark, tmp_path, SLICES)
    assert got == plain(spark, SLICES)
    assert ("dropped", "late", "late1", 1) in got and ("ready", "idle", "idle1", 1) in got
    assert [g[3] for g in got if g[1] == "again"] == [2] * 4


@pytest.mark.parametrize("run_rows", [3, 2_048])
def test_large_traces_pass_in_runs(spark, tmp_path, run_rows):
    rng = random.Random(4)
    slices = [
        [at(f"t{rng.randrange(9)}", 100 * m + i, m, rng.choice([0, 2_000, 4_000, 40_000, 130_000]))
         for i in range(40)]
        for m in range(1, 6)
    ]
    slices = [rows + [at("big", 100 * m + i, m, 10 + i) for i in range(20)] for m, rows in enumerate(slices, 1)]
    assert run(spark, tmp_path, slices, run_rows=run_rows) == plain(spark, slices)


def test_a_batch_writes_its_own_spans_only(spark, tmp_path):
    """What waits is not written again: later deltas of the state do not grow with it."""
    big = [at("big", i, 1, 0) for i in range(4_000)]
    rest = [[at("big", 10_000 + n, n, 0)] for n in range(2, 6)]
    changes = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
    spark.conf.set(changes, "true")
    try:
        run(spark, tmp_path, [big, *rest])
    finally:
        spark.conf.unset(changes)
    by_version = {}
    for path in glob.glob(f"{tmp_path}/checkpoint/state/0/*/**/*.changelog", recursive=True):
        version = int(path.rsplit("/", 1)[1].split(".")[0].split("_")[0])
        by_version[version] = by_version.get(version, 0) + len(open(path, "rb").read())
    later = [n for version, n in by_version.items() if version > 1]
    assert by_version[1] > 10 * max(later)


def test_spans_sent_again_in_another_batch_count_once(spark, tmp_path):
    slices = [
        [at("a", 1, 1, 1_000), at("a", 2, 1, 5_000), at("b", 1, 1, 0)],
        [dict(at("a", 1, 1, 1_000), receive=2 * MINUTE), at("a", 3, 2, 4_000),
         dict(at("b", 1, 1, 0), receive=2 * MINUTE)],
    ]
    got = run(spark, tmp_path, slices, delay_ms=10 * MINUTE, once=True)
    spans = [g[2] for g in got if g[0] == "ready"]
    assert sorted(spans) == ["a1", "a2", "a3", "b1"]
    again = run(spark, tmp_path / "all", slices, delay_ms=10 * MINUTE)
    assert sorted(g[2] for g in again) == ["a1", "a1", "a2", "a3", "b1", "b1"]
