"""Every registered query against its SQL, on the smallest tables and on skewed ones."""

import glob
import os
import shutil

import pytest

import __spark_entry__ as entry
from check import compare, connect
from spanloom.plans import oracle, queries as registry
from spanloom.sources import events as events_source

SF = "/root/testdata/sf0.001"
NAMES = sorted(registry.queries())
# Queries whose large-trace path is exercised with the skewed tables.
SKEWED = (
    "span_flatten_messages", "span_order", "trace_tree", "trace_summary", "api_minutes_table",
    "span_ip", "all_trace_by_md5", "late_trace_filter",
)


@pytest.fixture(scope="module")
def plain():
    return connect(SF)


def test_every_query_has_sql():
    assert set(oracle.oracle_sql()) == set(NAMES)
    assert set(NAMES) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, plain, name):
    ok, note = compare(spark, plain, SF, name)
    assert ok, note


def test_the_time_zone_of_the_session_does_not_matter(spark, plain):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for name in ("span_flatten", "decode_messages"):
            ok, note = compare(spark, plain, SF, name)
            assert ok, note
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    """The events with a third of all rows moved to one user and day."""
    folder = str(tmp_path_factory.mktemp("skewed"))
    for path in glob.glob(f"{SF}/*.parquet"):
        if not path.endswith("events.parquet"):
            os.symlink(path, os.path.join(folder, os.path.basename(path)))
    con = connect(SF)
    con.execute(f"""
        copy (select event_id,
                case when event_id % 3 = 0 then date_trunc('day', min(ts) over ())
                       + (event_id * interval 20 second) else ts end as ts,
                case when event_id % 3 = 0 then 4 else user_id end as user_id,
                event_type, value, props
              from events)
        to '{folder}/events.parquet' (format parquet)""")
    yield folder, connect(folder)
    shutil.rmtree(folder, ignore_errors=True)


@pytest.mark.parametrize("name", SKEWED)
def test_query_with_a_third_of_all_rows_in_one_trace(spark, skewed, monkeypatch, name):
    folder, con = skewed
    defaults = (64, events_source.DAY_TRACES, events_source.BINARY)
    monkeypatch.setattr(events_source.event_spans, "__defaults__", defaults)
    assert events_source.event_spans(spark, folder).heavy.count == 1
    ok, note = compare(spark, con, folder, name)
    assert ok, note
