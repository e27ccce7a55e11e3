"""State operators on hand-made frames, one branch each, and properties of repeated and split loads."""

import datetime as dt
import random

import pytest

from pulsetrail.operators import state as st
from pulsetrail.operators.aggregates import merge_spans
from pulsetrail.operators.quality import check_orphans, check_unique

T0 = dt.datetime(2024, 1, 1)
NOW = "2024-01-02 00:00:00"
NOW_DT = dt.datetime(2024, 1, 2)
SESSION = ("id long, tsrv_uuid string, host string, pid int, backend_start timestamp_ntz, gone_dt timestamp_ntz, "
           "client_addr string, client_port int, client_hostname string, datid long, usesysid long, leader_pid int, "
           "app_name string, backend_type string")
ACTIVITY = ("host string, tsrv_uuid string, pid int, backend_start timestamp_ntz, client_addr string, client_port int, "
            "client_hostname string, datid long, usesysid long, leader_pid int, application_name string, "
            "backend_type string")
SAMPLE = ("host string, sample_time timestamp_ntz, root_request_id string, rpc_request_id long, wait_event string, "
          "query_id long")


def _session(i, pid, start, gone=None, host="h1"):
    return (i, "t-" + host, host, pid, start, gone, None, None, None, 1, 10, None, "app", "client backend")


def _active(pid, start, host="h1"):
    return (host, "t-" + host, pid, start, "10.0.0.1/32", 5433, None, 1, 10, None, "app", "client backend")


def test_sessions_open_close_and_reopen(spark):
    t1 = T0 + dt.timedelta(hours=1)
    known = spark.createDataFrame([
        _session(1, 11, T0), _session(2, 12, T0), _session(3, 13, T0, t1), _session(4, 11, T0, host="h2")], SESSION)
    active = spark.createDataFrame([_active(11, T0), _active(13, T0), _active(14, t1)], ACTIVITY)
    opened = st.open_sessions(known, active)
    assert {(r.pid, r.client_addr) for r in opened.collect()} == {(13, "10.0.0.1"), (14, "10.0.0.1")}
    closed = {(r.id, r.gone_dt) for r in st.close_sessions(known, active, NOW).collect()}
    assert closed == {(1, None), (2, NOW_DT), (3, t1), (4, None)}  # h2 has not reported
    both = {r.id: r.gone_dt for r in st.close_sessions(known, active, NOW, ["h1", "h2"]).collect()}
    assert both[4] == NOW_DT
    state = st.extended(known, opened)
    assert st.open_sessions(state, active).count() == 0


def test_ghosts_only_for_unknown_processes(spark):
    known = spark.createDataFrame([_session(1, 11, T0)], SESSION)
    rows = [("t-h1", "h1", 11, "10.0.0.1:1", 1, T0), ("t-h1", "h2", 12, "10.0.0.2:2", 1, T0 + dt.timedelta(hours=2)),
            ("t-h1", "h1", 12, "10.0.0.2:2", 1, T0 + dt.timedelta(hours=1))]
    samples = spark.createDataFrame(rows, "top_level_node_id string, host string, pid long, client_node_ip string, "
                                          "dbid long, sample_time timestamp_ntz")
    got = st.ghost_sessions(known, samples).collect()
    assert [(r.pid, r.host, r.backend_start, r.client_addr, r.client_port) for r in got] == [
        (12, "h1", T0 + dt.timedelta(hours=1), "10.0.0.2", 2)]
    assert {r.usesysid for r in st.extended(known, st.ghost_sessions(known, samples)).collect()} == {10, None}


def test_replicas_move_and_return_without_overlap(spark):
    rep = "tblt_uuid string, tsrv_uuid string, log_dt timestamp_ntz, gone_dt timestamp_ntz, role string, state string"
    held = "tablet_id string, tsrv_uuid string, host string"
    state = spark.createDataFrame([], rep)
    moves = [[("a", "s1"), ("a", "s2")], [("a", "s1"), ("b", "s2")], [("a", "s2"), ("b", "s1")], [("a", "s1"), ("a", "s2")]]
    for n, where in enumerate(moves):
        local = spark.createDataFrame([(t, s, "h") for t, s in where], held)
        stamp = (T0 + dt.timedelta(days=n)).isoformat(sep=" ")
        state = spark.createDataFrame(
            st.track_replicas(state, local, stamp, ["s1", "s2"]).collect(), rep)
    spans = {}
    for r in state.collect():
        spans.setdefault((r.tblt_uuid, r.tsrv_uuid), []).append((r.log_dt, r.gone_dt))
    assert {k for k, v in spans.items() if v[-1][1] is None or any(g is None for _, g in v)} == {("a", "s1"), ("a", "s2")}
    for pieces in spans.values():
        pieces.sort()
        for (_, gone), (start, _) in zip(pieces, pieces[1:]):
            assert gone is not None and gone <= start
    assert len(spans[("a", "s1")]) == 2 and len(spans[("a", "s2")]) == 2


def test_tablets_close_with_their_last_replica(spark):
    tablets = spark.createDataFrame([("a", T0, None), ("b", T0, None), ("c", T0, T0)],
                                    "tblt_uuid string, log_dt timestamp_ntz, gone_dt timestamp_ntz")
    reps = spark.createDataFrame([("a", None), ("a", T0), ("b", T0)], "tblt_uuid string, gone_dt timestamp_ntz")
    got = {r.tblt_uuid: r.gone_dt for r in st.close_tablets(tablets, reps, NOW).collect()}
    assert got == {"a": None, "b": NOW_DT, "c": T0}
    local = spark.createDataFrame([("c", "h", "t"), ("a", "h", "t"), ("d", "h", "t")],
                                  "tablet_id string, host string, tsrv_uuid string")
    assert {r.tblt_uuid for r in st.open_tablets(tablets, local, NOW).collect()} == {"c", "d"}


def test_statement_text_sources_and_fill(spark):
    known = spark.createDataFrame([(1, NOW_DT, " "), (2, T0, None), (3, NOW_DT, "old"), (4, NOW_DT, None)],
                                  "queryid long, log_dt timestamp_ntz, query string")
    stmts = spark.createDataFrame([(1, "b"), (1, "a"), (2, "x"), (3, "y"), (4, None)], "queryid long, query string")
    got = {r.queryid: r.query for r in st.fill_query_text(known, stmts, NOW).collect()}
    assert got == {1: "a", 2: None, 3: "old", 4: None}


def test_counters_are_logged_when_they_change(spark):
    from pulsetrail.schemas import INPUTS, STATEMENT_COUNTERS
    schema = "host string, tsrv_uuid string, " + ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in INPUTS["statements"])

    def row(qid, calls, text, toplevel=True):
        values = {"queryid": qid, "userid": 1, "dbid": 1, "toplevel": toplevel, "calls": calls, "rows": 5, "query": text}
        return ("h", "t", *[values.get(f.name) for f in INPUTS["statements"]])

    first = spark.createDataFrame([row(1, 1, "select"), row(2, 1, "select", None), row(3, 1, "EXPLAIN x"),
                                   row(4, 1, None)], schema)
    log = st.log_statements(spark.createDataFrame([], "tsrv_uuid string, queryid long, log_dt timestamp_ntz, userid long, "
                            "dbid long, toplevel boolean, " + ", ".join(
                                f"{c} {INPUTS['statements'][c].dataType.simpleString()}" for c in STATEMENT_COUNTERS)),
                            first, NOW)
    assert {r.queryid for r in log.collect()} == {1, 2}
    assert st.log_statements(log, first, NOW).count() == 0  # the NULL flag does not log again
    second = spark.createDataFrame([row(1, 2, "select"), row(2, 1, "select", None)], schema)
    assert {r.queryid for r in st.log_statements(log, second, NOW).collect()} == {1}


def _samples(seed, n=200):
    rnd = random.Random(seed)
    return [(rnd.choice(["h1", "h2"]), T0 + dt.timedelta(seconds=i), rnd.choice(["r1", "r2", None]),
             rnd.choice([None, 0, 1]), rnd.choice(["Extension", "OnCpu", None]), rnd.choice([5, 7, 9, None]))
            for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_loading_twice_or_in_parts_gives_the_same_log(spark, seed):
    rows = _samples(seed)
    empty = spark.createDataFrame([], SAMPLE)
    whole = st.load_samples(empty, spark.createDataFrame(rows, SAMPLE))
    assert st.load_samples(whole, spark.createDataFrame(rows, SAMPLE)).count() == 0
    log = empty
    for part in (rows[:70], rows[50:140], rows[120:]):  # parts overlap
        log = spark.createDataFrame(
            log.unionByName(st.load_samples(log, spark.createDataFrame(part, SAMPLE))).collect(), SAMPLE)
    assert sorted(map(str, log.collect())) == sorted(map(str, whole.collect()))
    assert whole.filter("rpc_request_id IS NULL").count() == 0


def test_equal_rows_of_one_export_are_kept(spark):
    row = ("h", T0, "r", 1, "e", 9)
    assert st.load_samples(spark.createDataFrame([], SAMPLE), spark.createDataFrame([row, row], SAMPLE)).count() == 2


def test_only_days_of_the_batch_are_read(spark):
    days = [T0.date() + dt.timedelta(days=d) for d in range(5)]
    log = spark.createDataFrame([(d,) for d in days], "day date")
    batch = spark.createDataFrame([("h", T0 + dt.timedelta(days=d), "r", 1, "e", 9) for d in (1, 2)], SAMPLE)
    assert {r.day for r in st.log_of_days(log, batch).collect()} == set(days[1:3])
    assert st.log_of_days(log, batch.limit(0)).count() == 0


def test_spans_extend_and_equal_one_shot(spark):
    rnd = random.Random(3)
    rows = [(rnd.randrange(5), T0 + dt.timedelta(seconds=rnd.randrange(1000))) for _ in range(100)]
    piece = lambda part: spark.createDataFrame([(k, t, t) for k, t in part], "k int, a timestamp_ntz, b timestamp_ntz")
    empty = piece([])
    once = merge_spans(empty, piece(rows), ["k"], "a", "b")
    parts = merge_spans(merge_spans(empty, piece(rows[:40]), ["k"], "a", "b"), piece(rows[40:]), ["k"], "a", "b")
    assert sorted(once.collect()) == sorted(parts.collect())


def test_surrogate_keys_are_stable(spark):
    df = spark.createDataFrame([(i, str(i)) for i in range(50)], "a int, b string")
    one = {(r.a, r.id) for r in st.with_key(df, ["a", "b"]).collect()}
    assert one == {(r.a, r.id) for r in st.with_key(df.repartition(7), ["a", "b"]).collect()}
    assert len({i for _, i in one}) == 50


def test_key_reports(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    assert [(r.a, r.n_rows) for r in check_unique(df, ["a", "b"]).collect()] == [(1, 2)]
    parent = spark.createDataFrame([(1,)], "id int")
    assert [(r.orphan, r.n_rows) for r in check_orphans(df, parent, "a", "id").collect()] == [(2, 1)]
