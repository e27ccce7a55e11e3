import datetime as dt

from pulsetrail.operators import joins as jn

T0 = dt.datetime(2024, 1, 1)


def _h(hours):
    return T0 + dt.timedelta(hours=hours)


def test_anti_join_treats_nulls_as_equal(spark):
    old = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    new = spark.createDataFrame([(1, None), (2, "y"), (None, None)], "a int, b string")
    assert {tuple(r) for r in jn.only_new(new, old, ["a", "b"]).collect()} == {(2, "y"), (None, None)}
    assert jn.only_new(old, old, ["a", "b"]).count() == 0


def test_vanished(spark):
    mst = spark.createDataFrame([(1,), (2,), (3,)], "a int")
    assert {r.a for r in jn.vanished(mst, mst.filter("a <> 2"), ["a"]).collect()} == {2}


def test_update_join_takes_nulls_and_keeps_unmatched(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    source = spark.createDataFrame([(1, None, 5)], "k int, v string, w int")
    got = {r.k: (r.v, r.w) for r in jn.merge_columns(target, source, ["k"], ["v", "w"]).collect()}
    assert got == {1: (None, 5), 2: ("b", None)}


def test_kv_needs_every_key_but_not_every_value(spark):
    rows = [("h1", "a", "1"), ("h1", "b", None), ("h2", "a", "2"), ("h3", "a", "x"), ("h3", "b", "y")]
    kv = spark.createDataFrame(rows, "host string, key string, value string")
    got = {r.host: (r.a, r.b) for r in jn.kv_to_row(kv, {"a": "int", "b": "string"}).collect()}
    assert got == {"h1": (1, None), "h3": (None, "y")}


def test_snapshot_without_a_host_is_dropped(spark):
    log = spark.createDataFrame([(1, "node2", 1.0), (1, "node3", 2.0), (2, "node2", 3.0), (3, "node2", None),
                                 (3, "node3", 4.0)], "snap_id long, host string, rd_psec double")
    snaps = spark.createDataFrame([(i, _h(i)) for i in (1, 2, 3)], "id long, log_dt timestamp_ntz")
    got = jn.snapshot_wide(snaps, log, ["node2", "node3"], {"rd_psec": "rds"}).collect()
    assert [(r.n2_rds, r.n3_rds) for r in got] == [(1.0, 2.0), (None, 4.0)]


def test_reused_process_ids_meet_their_own_session(spark):
    sessions = spark.createDataFrame(
        [(1, "n", 7, _h(0), _h(30)), (2, "n", 7, _h(40), None), (3, "m", 7, _h(0), None)],
        "id long, tsrv_uuid string, pid int, backend_start timestamp_ntz, gone_dt timestamp_ntz")
    rows = spark.createDataFrame([("n", 7, _h(h)) for h in (0, 29, 30, 35, 40, 99)],
                                 "top_level_node_id string, pid long, t timestamp_ntz")
    as_written = jn.attach_session(rows, sessions).collect()
    assert len(as_written) == 12  # every session of the process, whenever it lived
    timed = jn.attach_session(rows, sessions, "t", "2024-01-31 00:00:00").collect()
    assert sorted((r.sess_id, r.t) for r in timed) == [(1, _h(0)), (1, _h(29)), (1, _h(30)), (2, _h(40)), (2, _h(99))]


def test_tablet_names_stay_single_for_returning_tablets(spark):
    uuid = "0f3a1b2c-1111-2222-3333-444455556666"
    tablets = spark.createDataFrame([(uuid, "t1"), (uuid, "t1")], "tblt_uuid string, table_name string")
    rows = spark.createDataFrame([(_h(0), 1, "h", "0f3a1b2c1111222"), (_h(0), 1, "h", None), (_h(0), 1, "h", "ffff")],
                                 "sample_time timestamp_ntz, pid long, host string, wait_event_aux string")
    got = {(r.wait_event_aux, r.table_name) for r in jn.attach_tablet(rows, tablets).collect()}
    assert got == {("0f3a1b2c1111222", "t1"), (None, None), ("ffff", None)}
    assert jn.attach_tablet(rows, tablets, "inner").count() == 1


def test_server_lookup_prefers_the_live_list(spark):
    hosts = spark.createDataFrame([("a",), ("b",), ("c",)], "host string")
    live = spark.createDataFrame([("live-a", "a")], "uuid string, host string")
    master = spark.createDataFrame([("old-a", "a"), ("old-b", "b")], "tsrv_uuid string, host string")
    got = {r.host: r.tsrv_uuid for r in jn.resolve_server(hosts, live, master).collect()}
    assert got == {"a": "live-a", "b": "old-b", "c": None}


def test_substring_matches_count_every_triple(spark):
    texts = ["abcabcabc", "xbcabcxxx", "abcxxxabc", "q", None]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    cuts = [(1, 3), (4, 3), (7, 3)]
    sub = lambda t, c: t[c[0] - 1:c[0] - 1 + c[1]]
    known = [t for t in texts if t is not None]
    brute = {}
    for a in known:
        for b in known:
            for c in known:
                if sub(a, cuts[0]) == sub(b, cuts[1]) == sub(c, cuts[2]):
                    brute[sub(a, cuts[0])] = brute.get(sub(a, cuts[0]), 0) + 1
    assert {r["sub"]: r.triples for r in jn.substring_matches(df, "text", cuts).collect()} == brute
