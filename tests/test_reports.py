"""Selectors of the drill-downs, the order and text of the event tree, and options of the reports."""

import datetime as dt

import pytest

from pulsetrail.plans import catalog, collect, dashboards, derive, drilldown, interval, tree
from pulsetrail.schemas import TABLES
from pulsetrail.sources.tables import VersionedTables, write_report
from pulsetrail.sources.testdata import AS_OF, LOOKBACK_SECONDS, TestData


@pytest.fixture(scope="module")
def data(spark, folder):
    t = TestData(spark, folder)
    rr = catalog._rr(t)
    return t, rr, catalog._links(t), rr.orderBy("rr_uuid").first()


def _pid(data):
    t, rr, _, first = data
    return t.sessions.filter(f"id = {first.sess_id}").first().pid


def test_selectors_give_the_part_of_the_whole(data):
    t, rr, links, first = data
    pid, prefix = _pid(data), first.rr_uuid[:6]
    for whole, part in (
            (drilldown.session_rr(rr, t.sessions), drilldown.session_rr(rr, t.sessions, pid)),
            (drilldown.session_queries(rr, links, t.queries, t.sessions),
             drilldown.session_queries(rr, links, t.queries, t.sessions, pid)),
            (drilldown.session_rr_queries(rr, links, t.queries, t.sessions),
             drilldown.session_rr_queries(rr, links, t.queries, t.sessions, pid)),
            (drilldown.session_events(rr, t.samples, t.tablets, t.queries, t.sessions),
             drilldown.session_events(rr, t.samples, t.tablets, t.queries, t.sessions, pid))):
        rows = part.collect()
        assert rows and rows == whole.filter(f"pid = {pid}").collect()
    for whole, part in ((drilldown.rr_timing(rr, t.sessions), drilldown.rr_timing(rr, t.sessions, prefix)),
                        (drilldown.rr_events(rr, t.samples), drilldown.rr_events(rr, t.samples, prefix))):
        assert part.count() and sorted(part.collect()) == sorted(whole.filter(f"rr_uuid LIKE '{prefix}%'").collect())


def test_statement_selector(data):
    t, rr, links, _ = data
    qid = links.first().queryid
    some = drilldown.query_rrs(t.queries, links, rr, t.samples, AS_OF, LOOKBACK_SECONDS, qid)
    assert {r.queryid for r in some.collect()} == {qid}
    assert drilldown.query_text(t.queries, qid).count() == 1


def test_switched_off_events_read_nothing(data):
    t, rr, _, _ = data
    off = drilldown.session_events(rr, t.samples, t.tablets, t.queries, t.sessions, enabled=False)
    assert off.count() == 0
    assert "FileScan" not in off._jdf.queryExecution().optimizedPlan().toString()


def test_tree_of_one_process_reads_in_order(data, tmp_path):
    t, rr, links, _ = data
    pid = _pid(data)
    lines = tree.event_tree(rr, links, t.queries, t.samples, t.tablets, t.sessions, pid)
    rows = tree.ordered(lines).collect()
    text = [r.output for r in rows]
    assert text[-1] == " -- the end -- " and text.count(" -- the end -- ") == 1
    assert f" from pid: {pid} clnt: " in text[0]
    state = None
    for line in text[:-1]:  # header, then statements, then the closing pair, then the next header
        if " from pid: " in line:
            assert state in (None, "dot")
            state = "header"
        elif " end RR " in line:
            assert state == "statement end"
            state = "closing"
        elif line == " .":
            assert state == "closing"
            state = "dot"
        elif "-- end qry --" in line:
            assert state == "sample"
            state = "statement end"
        elif "qry_id:" in line:
            state = "statement"
        elif " aux: " in line or " tbl: " in line or len(line) > 40:
            assert state in ("statement", "sample")
            state = "sample"
    numbers = [line.split("( ")[1].rstrip(")").split() for line in text if "-- end qry --" in line]
    assert sum(int(n[2][3:]) for n in numbers) == len([r for r in rows if r.part == 3 and r.section == 1])
    assert [int(n[0][3:]) for n in numbers] == sorted(int(n[0][3:]) for n in numbers)

    write_report(lines, str(tmp_path / "tree"), tree.ORDER)
    files = sorted(p for p in (tmp_path / "tree").iterdir() if p.name.startswith("part-"))
    assert "".join(p.read_text() for p in files).splitlines() == text


def test_request_without_statements_closes_with_its_own_time(data, spark):
    t, rr, links, first = data
    one = rr.filter(f"rr_uuid = '{first.rr_uuid}'")
    rows = tree.ordered(tree.event_tree(one, links.limit(0), t.queries, t.samples, t.tablets, t.sessions, _pid(data)))
    text = [r.output for r in rows.collect()]
    stamp = first.rr_min_dt.strftime("%H:%M:%S.%f")[:-3]
    assert text[1].startswith(f"{stamp}  {first.rr_uuid[:2]} -- -- -- end RR")


def test_known_requests_are_left_out_and_extended(data):
    t, rr, links, _ = data
    known = rr.filter("sess_id % 2 = 0")
    fresh = derive.build_root_requests(t.samples, t.sessions, AS_OF, LOOKBACK_SECONDS, known=known)
    assert fresh.count() == rr.filter("sess_id % 2 = 1").count()
    assert sorted(derive.extend_root_requests(known, fresh).collect()) == sorted(
        rr.select("sess_id", "rr_uuid", "rr_min_dt", "rr_max_dt").collect())
    assert derive.build_rr_query_links(rr, t.samples, known=links).count() == 0


def test_crosstab_with_and_without_listed_hosts(data):
    t, *_ = data
    listed = interval.minute_host_crosstab(t.samples, catalog.START, catalog.END, ["node2", "node3", "node4", "node5"])
    found = interval.minute_host_crosstab(t.samples, catalog.START, catalog.END)
    assert listed.drop("other").collect() == found.select(listed.drop("other").columns).collect()
    assert listed.filter("other IS NOT NULL").count() == 0


def test_empty_interval(data):
    t, *_ = data
    assert interval.interval_summary(t.samples, "2030-01-01 00:00:00", "2030-01-02 00:00:00").count() == 0


def test_freshness_without_a_snapshot(data):
    t, *_ = data
    row = dashboards.snapshot_freshness(t.snapshots.limit(0), AS_OF).first()
    assert (row.ela_sec, row.nogo) == (3601, False)
    assert dashboards.snapshot_freshness(t.snapshots, "2024-01-30 00:02:59").first().nogo is True


def test_few_requests_give_the_same_links(data):
    t, rr, links, first = data
    one = rr.filter(f"sess_id = {first.sess_id}")
    few = derive.build_rr_query_links(one, t.samples, few=True)
    assert few.count() and sorted(few.collect()) == sorted(derive.build_rr_query_links(one, t.samples).collect())


def test_snapshot_header_waits_for_its_age(data):
    t, *_ = data
    last = t.snapshots.orderBy("id", ascending=False).first()       # one snapshot per minute
    soon, then = (str(last.log_dt + dt.timedelta(seconds=s)) for s in (179, 180))
    assert collect.snapshot_header(t.snapshots, "node2", soon).count() == 0
    assert collect.snapshot_header(t.snapshots, "node2", then).first().id == last.id + 1
    assert collect.snapshot_header(t.snapshots.limit(0), "node2", AS_OF).first().id == 1


def test_collectors_write_what_they_count(data, spark, tmp_path):
    t, *_ = data
    store = VersionedTables(spark, str(tmp_path))
    result = collect.collect_samples(t.samples.limit(0), t.exported_samples)
    written = collect.commit(result, store, "node2", AS_OF)
    assert written == {"sample_log": result.counts().first().n_rows}
    again = collect.collect_samples(store.read_all("sample_log", t.samples.schema), t.exported_samples)
    assert collect.commit(again, store, "node2", AS_OF) == {"sample_log": 0}
    log = store.read_all("run_log", TABLES["run_log"])
    assert [r.info_txt for r in log.orderBy("info_txt").collect()] == ["sample_log: 0.", f"sample_log: {written['sample_log']}."]
    sessions = collect.collect_sessions(t.known_sessions, t.activity, t.exported_samples, AS_OF)
    assert set(collect.commit(sessions, store, "node2", AS_OF)) == {"session_mst", "session_log"}


def test_label_of_a_fixed_moment_does_not_depend_on_the_zone(spark):
    from pyspark.sql import functions as F
    from pulsetrail.functions import clock, moment
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert spark.range(1).select(clock(moment(dt.datetime(2024, 1, 2, 3, 4, 5))).alias("c")).first().c == "03:04:05"
            assert F is not None
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
