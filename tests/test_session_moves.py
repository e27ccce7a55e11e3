"""Session states in one pass: equal to the operators one after the other, each export read once."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pulsetrail.operators import state as st
from pulsetrail.plans import collect
from pulsetrail.sources.store import SCRATCH, VersionedTables
from pulsetrail.sources.testdata import AS_OF, TestData

STATE = ["tsrv_uuid", "host", "pid", "backend_start", "gone_dt", "client_addr", "client_port", "datid", "usesysid", "id"]


def _rows(df, columns=None):
    return sorted(map(str, (df.select(*columns) if columns else df).collect()))


def _step_by_step(sessions, activity, samples, gone=None, hosts=None):
    whole = lambda part: part if gone is None else part.unionByName(gone)
    opened = st.extended(sessions, st.open_sessions(sessions, activity))
    known = st.extended(opened, st.ghost_sessions(whole(opened), samples))
    state = st.close_sessions(known, activity, AS_OF, hosts)
    return state, st.log_sessions(activity, whole(state), AS_OF)


@pytest.fixture(scope="module")
def data(spark, folder):
    return TestData(spark, folder)


@pytest.mark.parametrize("apart", [False, True])
@pytest.mark.parametrize("reported", [None, ["node2", "node3"]])
def test_equal_to_the_operators_in_order(spark, data, apart, reported):
    known = data.known_sessions.filter("datid <> 13517")
    gone = known.filter("gone_dt IS NOT NULL") if apart else None
    sessions = known.filter("gone_dt IS NULL") if apart else known
    hosts = None if reported is None else spark.createDataFrame([(h,) for h in reported], "host string")
    want_state, want_log = _step_by_step(sessions, data.activity, data.exported_samples, gone, hosts)
    got = collect.collect_sessions(sessions, data.activity, data.exported_samples, AS_OF, gone, hosts)
    assert _rows(got.replace["session_mst"], STATE) == _rows(want_state, STATE)
    log = got.append["session_log"]
    assert _rows(log, sorted(log.columns)) == _rows(want_log, sorted(log.columns)) != []


def test_every_branch(spark, data):
    """Stays, closes, opens, re-opens, guessed, known by a closed row, another host, NULL keys, exported twice, no rows."""
    t0, now = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 31)
    some, exported = data.known_sessions.schema.toNullable(), data.activity.schema.toNullable()
    session = lambda i, pid, gone=None, host="h1", start=t0: tuple(
        {"id": i, "tsrv_uuid": "t-" + host, "host": host, "pid": pid, "backend_start": start, "gone_dt": gone}.get(f.name)
        for f in some)
    shown = lambda pid, host="h1", start=t0: tuple(
        {"tsrv_uuid": "t-" + host, "host": host, "pid": pid, "backend_start": start, "client_addr": "10.0.0.1/32"}.get(f.name)
        for f in exported)
    open_rows = spark.createDataFrame([session(1, 11), session(2, 12), session(3, 11, host="h2"), session(8, 16, start=None)], some)
    gone = spark.createDataFrame([session(4, 13, now), session(5, 14, now), session(6, 99, now)], some)
    export = spark.createDataFrame([shown(11), shown(13), shown(15), shown(15), shown(16, start=None)], exported)
    taken = [("t-h1", 14, "h1"), ("t-h1", 20, "h1"), ("t-h2", 21, "h2"), ("t-h1", 15, "h2"), ("t-h1", 20, "h2")]
    samples = spark.createDataFrame([(n, p, h, "10.0.0.9:9", 1, t0 + dt.timedelta(hours=i)) for i, (n, p, h) in enumerate(taken)],
                                    "top_level_node_id string, pid long, host string, client_node_ip string, dbid long, "
                                    "sample_time timestamp_ntz")
    got = st.session_moves(open_rows, export, samples, AS_OF, gone)
    moves = sorted((r.pid, r.tsrv_uuid, r.move, r.gone_dt is not None, r.logged is not None) for r in got.collect())
    assert moves == [(11, "t-h1", "kept", False, True), (11, "t-h2", "kept", False, False), (12, "t-h1", "closed", True, False),
                     (13, "t-h1", "apart", False, True), (13, "t-h1", "opened", False, True), (15, "t-h1", "opened", False, True),
                     (16, "t-h1", "kept", False, False), (20, "t-h1", "guessed", True, False), (21, "t-h2", "guessed", False, False)]
    none = st.session_moves(open_rows.limit(0), export.limit(0), samples.limit(0), AS_OF, gone.limit(0))
    assert none.count() == 0 and none.columns[-2:] == ["move", "logged"]


def test_each_export_is_read_once(spark, data, tmp_path):
    paths = {}
    for name, rows in (("open", data.known_sessions.filter("gone_dt IS NULL")), ("gone", data.known_sessions.filter("gone_dt IS NOT NULL")),
                       ("activity", data.activity), ("samples", data.exported_samples)):
        paths[name] = str(tmp_path / f"export_{name}")
        rows.write.parquet(paths[name])
    read = {name: spark.read.parquet(path) for name, path in paths.items()}
    store, plans = VersionedTables(spark, str(tmp_path / "store")), []

    def plan(df):
        files = " ".join(df.inputFiles())
        return {name for name in paths if f"export_{name}/" in files}, df._jdf.queryExecution().executedPlan().toString()

    with store.transaction("one") as tx:
        def scratch(df):
            plans.append(plan(df))
            return tx.scratch(df)

        result = collect.collect_sessions(read["open"], read["activity"], read["samples"], AS_OF, read["gone"], None, scratch)
        plans += [plan(df) for df in (*result.replace.values(), *result.append.values())]
        collect.stage(result, tx, "node2", AS_OF)
    assert [reads for reads, _ in plans] == [{"activity", "samples"}, {"open", "gone"}, set(), set()]
    assert plans[0][1].count("FileScan parquet") == 2
    assert "ReadSchema: struct<id:bigint,tsrv_uuid:string,pid:int,backend_start:timestamp_ntz>" in plans[1][1]
    assert all("Exchange" not in text for _, text in plans[2:])
    assert not (tmp_path / "store" / SCRATCH / tx.work).exists()
    assert store.live("session_mst") and store.live("session_log")
