"""Streams over several files, one micro-batch each, give the same tables as one batch over everything."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pulsetrail.operators import state as st
from pulsetrail.sources.testdata import EVENTS_SCHEMA, TestData, samples_from_events
from pulsetrail.streaming import samples as sm


@pytest.fixture(scope="module")
def drop(spark, folder, tmp_path_factory):
    """The events as four files in time order."""
    path = str(tmp_path_factory.mktemp("drop"))
    events = TestData(spark, folder).events
    for low, high in ((1, 8), (8, 16), (16, 24), (24, 32)):
        part = events.filter((F.dayofmonth("ts") >= low) & (F.dayofmonth("ts") < high))
        part.coalesce(1).write.mode("append").parquet(path)
    return path


def _stream(spark, path, max_files=1):
    return samples_from_events(sm.read_stream(spark, path, EVENTS_SCHEMA, max_files))


def _rows(df):
    return sorted(map(str, df.collect()))


def test_incremental_load_equals_batch(spark, folder, drop, tmp_path):
    t = TestData(spark, folder)
    handle = sm.load_new_samples(t.samples.schema)
    tables = sm.run_batches(_stream(spark, drop), handle, str(tmp_path))
    whole = st.load_samples(t.samples.limit(0), t.exported_samples)
    assert tables.latest("sample_log") == 3 and all(tables.done(f"batch {k}") for k in range(4))
    assert _rows(tables.read_all("sample_log", whole.schema)) == _rows(whole)
    # the last batch again, outside of its commit: its rows are known
    last = t.exported_samples.filter(F.dayofmonth("sample_time") >= 24)
    handle(tables, last, 3)
    assert _rows(tables.read_all("sample_log", whole.schema)) == _rows(whole)


def test_spans_and_lifetimes_equal_batch(spark, folder, drop, tmp_path):
    once = f"{folder}/ev*"
    spans = sm.read_spans(sm.run_batches(_stream(spark, drop), sm.add_spans, str(tmp_path / "a")))
    assert _rows(spans) == _rows(sm.read_spans(sm.run_batches(_stream(spark, once), sm.add_spans, str(tmp_path / "b"))))
    for name, read in (("c", lambda t: sm.read_lifetimes(t, 6 * 3600)), ("d", lambda t: sm.read_bursts(t, 6 * 3600))):
        parts = read(sm.run_batches(_stream(spark, drop), sm.add_pieces, str(tmp_path / f"{name}1")))
        whole = read(sm.run_batches(_stream(spark, once), sm.add_pieces, str(tmp_path / f"{name}2")))
        assert _rows(parts) == _rows(whole)


def test_first_seen_events_once(spark, drop, tmp_path):
    tables = sm.run_batches(_stream(spark, drop), sm.add_first_seen, str(tmp_path))
    found = tables.read_all("event_mst", sm.EVENT_SCHEMA)
    assert found.count() == found.select("wait_event_component", "wait_event").distinct().count() == 5


def test_late_rows_are_set_aside(spark, tmp_path):
    """A late file: rows older than the newest seen minus the horizon."""
    schema = TestData(spark, "/root/testdata/sf0.001").samples.schema
    base = TestData(spark, "/root/testdata/sf0.001").samples
    tables_handle = sm.split_late(dt.timedelta(days=10), schema)
    from pulsetrail.sources.tables import VersionedTables
    tables = VersionedTables(spark, str(tmp_path))
    recent = base.filter(F.dayofmonth("sample_time") >= 25)
    old = base.filter(F.dayofmonth("sample_time") < 5)
    tables_handle(tables, recent, 0)
    tables_handle(tables, old, 1)
    assert tables.read_all("late", schema).count() == old.count()
    assert tables.read_all("on_time", schema).count() == recent.count()


@pytest.fixture(scope="module")
def shuffled(spark, folder, tmp_path_factory):
    """The events as files in no order of time, with copies of a third of them in a last file."""
    path = str(tmp_path_factory.mktemp("shuffled"))
    events = TestData(spark, folder).events
    for k in (3, 0, 2, 1):
        events.filter(F.pmod(F.hash("event_id"), F.lit(4)) == k).coalesce(1).write.mode("append").parquet(path)
    return path, events


def _batch(df):
    return df.groupBy(F.date_trunc("minute", "sample_time").alias("dt"), "host").agg(F.count(F.lit(1)).alias("cnt"))


def test_minutes_are_whole_whatever_the_order(spark, folder, shuffled, tmp_path):
    path, _ = shuffled
    samples = TestData(spark, folder).samples
    got = sm.read_minute_hosts(sm.run_batches(_stream(spark, path), sm.add_minute_hosts, str(tmp_path / "a")))
    assert _rows(got) == _rows(_batch(samples))
    waits = sm.read_minute_waits(sm.run_batches(_stream(spark, path), sm.add_minute_waits, str(tmp_path / "b")))
    whole = sm.read_minute_waits(sm.run_batches(_stream(spark, f"{folder}/ev*"), sm.add_minute_waits, str(tmp_path / "c")))
    assert _rows(waits) == _rows(whole)


def test_lifetimes_do_not_depend_on_the_order(spark, folder, shuffled, tmp_path):
    path, _ = shuffled
    for name, read in (("l", lambda t: sm.read_lifetimes(t, 6 * 3600)), ("b", lambda t: sm.read_bursts(t, 6 * 3600))):
        parts = read(sm.run_batches(_stream(spark, path), sm.add_pieces, str(tmp_path / f"{name}1")))
        whole = read(sm.run_batches(_stream(spark, f"{folder}/ev*"), sm.add_pieces, str(tmp_path / f"{name}2")))
        assert _rows(parts) == _rows(whole)


def test_a_late_sample_bridges_lifetimes(spark, tmp_path):
    from pulsetrail.sources.tables import VersionedTables
    tables = VersionedTables(spark, str(tmp_path))
    day = "2024-01-05 "
    for batch, time in enumerate(("00:00:00", "20:00:00", "03:00:00")):
        rows = spark.sql(f"SELECT 'n' AS top_level_node_id, 1L AS pid, TIMESTAMP_NTZ '{day}{time}' AS sample_time")
        sm.add_pieces(tables, rows, batch)
    got = sm.read_lifetimes(tables, 6 * 3600).orderBy("opened").collect()
    assert [(r["opened"].hour, r["last_seen"].hour) for r in got] == [(0, 3), (20, 20)]
    assert got[0]["gone_dt"] == got[0]["last_seen"] and got[1]["gone_dt"] is None


def test_copies_are_dropped_however_late(spark, folder, shuffled, tmp_path):
    path, events = shuffled
    copies = str(tmp_path / "in")
    events.write.parquet(copies)
    events.filter("event_id % 3 = 0").coalesce(1).write.mode("append").parquet(copies)
    schema = TestData(spark, folder).samples.schema
    tables = sm.run_batches(_stream(spark, copies), sm.load_distinct(schema), str(tmp_path / "out"))
    loaded = st.load_samples(TestData(spark, folder).samples.limit(0), TestData(spark, folder).exported_samples)
    got = tables.read_all("sample_once", schema)
    assert got.count() == loaded.select(*st.SAMPLE_KEY).distinct().count()
    # whole rows: each is one of those that were sent
    assert _rows(got) == _rows(got.distinct()) and got.select(*loaded.columns).exceptAll(loaded).count() == 0
    assert got.filter("query_id IS NOT NULL").count() > 0


def test_small_filters_lose_nothing(spark, folder, shuffled, tmp_path):
    """A filter with a single bitmap says "maybe" for nearly all rows: the look-up decides."""
    path, _ = shuffled
    schema = TestData(spark, folder).samples.schema
    tables = sm.VersionedTables(spark, str(tmp_path))
    rows = samples_from_events(spark.read.schema(EVENTS_SCHEMA).parquet(path))
    handle = sm.load_distinct(schema, n_slots=1)
    for k, part in enumerate((rows.filter("pid % 2 = 0"), rows, rows.filter("pid % 3 = 0"))):
        handle(tables, part, k)
    want = st.load_samples(rows.limit(0), rows).select(*st.SAMPLE_KEY).distinct()
    assert tables.read_all("sample_once", schema).count() == want.count()


def test_tiers_stay_few_and_equal_batch(spark, tmp_path):
    """Thirty batches in no order, some of them twice: few folders are read, and the counts are those of all rows."""
    tables = sm.VersionedTables(spark, str(tmp_path))
    rows = spark.range(300).selectExpr("id", "'h' || id % 3 AS host",
                                       "TIMESTAMP_NTZ '2024-01-05 00:00:00' + make_interval(0,0,0,0,0,id % 7) AS sample_time")
    most = 0
    for k in [*range(20, 30), *range(20), 3, 25]:
        if not tables.done(f"batch {k}"):
            with tables.transaction(f"batch {k}") as tx:
                sm.add_minute_hosts(tx, rows.filter(f"id % 30 = {k}"), k)
        most = max(most, len(tables.live("minute_host")))
    assert most <= 2 * (sm.FANOUT - 1) and len(tables.live("minute_host")) <= 9
    assert _rows(sm.read_minute_hosts(tables)) == _rows(_batch(rows))
