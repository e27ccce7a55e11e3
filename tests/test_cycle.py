"""Whole collection cycles into tables, and whole reports out of them."""

import pytest
from pyspark.sql import functions as F

from pulsetrail.plans import catalog
from pulsetrail.plans.cycle import SAMPLE_LOG, Exports, run_cycle, validity_table
from pulsetrail.plans.reports import History, interval_report, query_report, rr_report, session_report
from pulsetrail.schemas import TABLES
from pulsetrail.sources.tables import VersionedTables
from pulsetrail.sources.testdata import AS_OF, CUT, LOOKBACK_SECONDS, TestData


def _exports(t, samples):
    lines = t.kv_lines.filter("snap_id = 1").select("host", "line")
    return Exports(t.databases, t.local_tablets, t.activity, t.statements, samples, lines)


@pytest.fixture(scope="module")
def cycles(spark, folder, tmp_path_factory):
    t = TestData(spark, folder)
    store = VersionedTables(spark, str(tmp_path_factory.mktemp("history")))
    old = t.exported_samples.filter(F.col("sample_time") < F.lit(CUT).cast("timestamp_ntz"))
    return t, store, [run_cycle(store, _exports(t, part), "node2", stamp) for part, stamp in (
        (old, CUT), (t.exported_samples, AS_OF), (t.exported_samples, "2024-01-31 00:05:00"))]


def test_samples_arrive_once(cycles):
    t, store, (first, second, third) = cycles
    total = t.samples.filter("NOT (wait_event = 'Extension' AND query_id IN (5, 7))").count()
    assert first["samples"]["sample_log"] + second["samples"]["sample_log"] == total
    assert third["samples"]["sample_log"] == 0
    log = store.read_all("sample_log", SAMPLE_LOG)
    assert log.count() == total and log.filter("rpc_request_id IS NULL OR day IS NULL").count() == 0


def test_a_repeated_cycle_only_adds_snapshots(cycles):
    _, store, (_, second, third) = cycles
    for job in ("databases", "tablets", "sessions", "queries", "events"):
        for table, rows in third[job].items():
            if table.endswith(("_mst", "_rep")):
                assert rows == second[job][table]
            if table.endswith("_closed"):
                assert rows == 0
    assert third["queries"]["query_log"] == 0
    assert third["databases"]["database_log"] == second["databases"]["database_log"] > 0


def test_seeds_and_filled_texts(cycles):
    t, store, _ = cycles
    queries = store.read("query_mst", TABLES["query_mst"])
    assert queries.filter("queryid <= 7 AND query LIKE concat(queryid, ' %')").count() == 8
    assert queries.count() == queries.select("queryid").distinct().count()


def test_open_sessions_are_those_of_the_export(cycles):
    t, store, _ = cycles
    whole, alive = validity_table(store, "session_mst"), store.read("session_mst", TABLES["session_mst"])
    assert alive.filter("usesysid IS NOT NULL").count() == t.activity.count()
    assert whole.filter("gone_dt IS NULL").count() == alive.count() < whole.count()
    assert whole.count() == whole.select("tsrv_uuid", "pid", "backend_start").distinct().count()
    assert store.read_all("session_log", TABLES["session_log"]).select("sess_id").distinct().count() == t.activity.count()


def test_every_job_is_in_the_run_log(cycles):
    _, store, runs = cycles
    log = store.read_all("run_log", TABLES["run_log"])
    assert log.count() == sum(len(r) for r in runs)
    assert {r.component for r in log.select("component").distinct().collect()} == set(runs[0])


def test_reports(spark, folder):
    t = TestData(spark, folder)
    h = History(t.samples, t.queries, t.sessions, t.tablets, t.replicas, t.servers)
    for name, df in interval_report(h, AS_OF, LOOKBACK_SECONDS, LOOKBACK_SECONDS).items():
        assert df.columns and (df.count() or name == "slowest_queries")
    rr, links = catalog._rr(t), catalog._links(t)
    one = rr.orderBy("rr_uuid").first()
    pid = t.sessions.filter(f"id = {one.sess_id}").first().pid
    parts = session_report(h, pid, AS_OF, LOOKBACK_SECONDS)
    assert parts["session_rr"].count() == rr.filter(f"sess_id = {one.sess_id}").count()
    whole = catalog.QUERIES["event_tree"](spark, folder).filter(f"pid = {pid}")
    assert [r.output.replace(" ", "") for r in parts["event_tree"].collect()] == [
        r.output.replace(" ", "") for r in whole.collect()]
    assert all(df.count() for df in rr_report(h, rr, links, one.rr_uuid[:8]).values())
    some = links.first().queryid
    assert all(df.count() for df in query_report(h, rr, links, some, AS_OF, LOOKBACK_SECONDS).values())
