"""Nothing is lost or multiplied: unlisted hosts, NULL times, drained servers, repeated keys, re-used process ids."""

import datetime as dt

from pyspark.sql import functions as F

from pulsetrail.operators import aggregates as ag
from pulsetrail.operators import filters as fl
from pulsetrail.operators import joins as jn
from pulsetrail.operators import state as st
from pulsetrail.plans import derive, drilldown, interval, tree
from pulsetrail.sources.testdata import AS_OF, LOOKBACK_SECONDS, TestData


def test_crosstab_keeps_hosts_that_are_not_listed(spark):
    df = spark.createDataFrame([("m", "a", 2), ("m", "z", 3), ("m", None, 4)], "minute string, host string, cnt long")
    row = ag.crosstab(df, "minute", "host", "cnt", ["a", "b"]).first()
    assert (row["a"], row["b"], row["other"]) == (2, None, 7)


def test_a_batch_with_a_null_time_loads_once(spark, folder):
    batch = TestData(spark, folder).samples.limit(3)
    batch = batch.union(batch.limit(1).withColumn("sample_time", F.lit(None).cast("timestamp_ntz")))
    log = batch.withColumn("day", F.to_date("sample_time"))
    assert st.load_samples(st.log_of_days(log, batch), batch).count() == 0
    far = log.withColumn("day", F.lit(dt.date(1999, 1, 1)))
    assert st.log_of_days(far, batch).count() == 0


def test_a_server_without_tablets_closes_its_replicas(spark):
    replicas = spark.createDataFrame([("t1", "s1", None), ("t2", "s2", None), ("t3", "s3", None)],
                                     "tblt_uuid string, tsrv_uuid string, gone_dt timestamp_ntz")
    replicas = replicas.withColumns({"log_dt": F.lit(None).cast("timestamp_ntz"), "role": F.lit("x"), "state": F.lit("x")})
    local = spark.createDataFrame([("t2", "s2")], "tablet_id string, tsrv_uuid string")
    reporting = spark.createDataFrame([("s1",), ("s2",)], "tsrv_uuid string")
    got = {r["tblt_uuid"]: r["gone_dt"] for r in st.track_replicas(replicas, local, "2024-01-31 00:00:00", reporting).collect()}
    assert got["t1"] is not None and got["t2"] is None and got["t3"] is None


def test_an_update_adds_no_rows(spark):
    target = spark.createDataFrame([(1, 0)], "k int, v int")
    source = spark.createDataFrame([(1, 5), (1, 7)], "k int, v int")
    assert [tuple(r) for r in jn.merge_columns(target, source, ["k"], ["v"]).collect()] == [(1, 7)]


def test_repeated_keys_are_listed(spark):
    kv = spark.createDataFrame([("h", "a", "1"), ("h", "a", "2"), ("h", "b", "1")], "host string, key string, value string")
    assert [tuple(r) for r in jn.repeated_keys(kv).collect()] == [("h", "a", 2)]


def _reused(spark):
    """Twenty sessions of one process id, one after the other, with a request in each."""
    day = [f"2024-01-{k:02d}" for k in range(1, 21)]
    sessions = spark.createDataFrame([(k, "n", 7, f"{d} 08:00:00", f"{d} 18:00:00", 1) for k, d in enumerate(day)],
                                     "id long, tsrv_uuid string, pid int, a string, b string, usesysid long")
    sessions = sessions.withColumns({"backend_start": F.col("a").cast("timestamp_ntz"), "gone_dt": F.col("b").cast("timestamp_ntz")})
    samples = spark.createDataFrame([("n", 7, f"r{k}", f"{d} 12:00:0{j}", 1) for k, d in enumerate(day) for j in range(3)],
                                    "top_level_node_id string, pid long, root_request_id string, t string, query_id long")
    return sessions, samples.withColumn("sample_time", F.col("t").cast("timestamp_ntz"))


def test_a_request_belongs_to_the_session_that_was_alive(spark):
    sessions, samples = _reused(spark)
    got = derive.build_root_requests(samples, sessions, "2024-01-31 00:00:00", 30 * 86400).collect()
    assert sorted((r["sess_id"], r["rr_uuid"]) for r in got) == sorted((k, f"r{k}") for k in range(20))
    assert derive.build_root_requests(samples, sessions, "2024-01-20 12:00:01", 60).count() == 1


def test_statements_of_a_session_stand_in_order_of_time(spark):
    """The first occurrence is a clock without a day: it must not decide the order."""
    moment = lambda text: dt.datetime.fromisoformat(text)
    sessions = spark.createDataFrame([(1, 7, moment("2024-01-01 00:00:00"))], "id long, pid int, backend_start timestamp_ntz")
    rr = spark.createDataFrame([(1, "r")], "sess_id long, rr_uuid string")
    links = spark.createDataFrame([("r", 1, moment("2024-01-01 23:00:00"), 5), ("r", 2, moment("2024-01-02 01:00:00"), 5)],
                                  "rr_uuid string, queryid long, qurr_start_dt timestamp_ntz, dur_ms long")
    queries = spark.createDataFrame([(1, "a"), (2, "b")], "queryid long, query string")
    assert [r["queryid"] for r in drilldown.session_queries(rr, links, queries, sessions).collect()] == [1, 2]


def _logged(spark, folder, tmp_path):
    path = str(tmp_path / "log")
    TestData(spark, folder).samples.withColumn("day", F.to_date("sample_time")).write.partitionBy("day").parquet(path)
    return spark.read.parquet(path)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_reports_read_the_days_they_need(spark, folder, tmp_path):
    log, t = _logged(spark, folder, tmp_path), TestData(spark, folder)
    start, end = fl.parse_moment("2024-01-10 00:00:00"), fl.parse_moment("2024-01-10 01:00:00")
    plan = interval.busiest_events(log, start, end)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert interval.busiest_events(log, start, end).collect() == interval.busiest_events(t.samples, start, end).collect()
    rr = derive.build_root_requests(log, t.sessions, AS_OF, LOOKBACK_SECONDS)
    links = derive.build_rr_query_links(rr, t.samples)
    for df in (derive.build_rr_query_links(rr, log), drilldown.session_rr_events(rr, log, t.sessions),
               drilldown.session_events(rr, log, t.tablets, t.queries, t.sessions), drilldown.rr_events(rr, log),
               drilldown.query_rrs(t.queries, links, rr, log, AS_OF, LOOKBACK_SECONDS),
               tree.event_tree(rr, links, t.queries, log, t.tablets, t.sessions),
               tree.events_per_pid_list(rr, links, log, t.sessions)):
        assert "dynamicpruning" in _plan(df)


def test_derivation_in_parts_equals_one_pass(spark, folder, tmp_path):
    from pulsetrail.plans import cycle
    from pulsetrail.sources.tables import VersionedTables
    sessions, samples = _reused(spark)
    samples = samples.withColumns({"host": F.lit("h"), "rpc_request_id": F.lit(0), "wait_event": F.lit("w"), "day": F.to_date("sample_time")})
    results = []
    for name, moments in (("one", ["2024-01-21 00:00:00"]), ("parts", [f"2024-01-{k:02d} 12:00:01" for k in range(2, 22)])):
        tables = VersionedTables(spark, str(tmp_path / name))
        tables.replace("session_mst", cycle.conform(sessions, "session_mst"))
        tables.add("sample_log", cycle.conform(samples, "sample_log"), 0, ["day"])
        for k, moment in enumerate(moments[::5] + moments[-1:] if name == "parts" else moments):
            cycle.run_derive(tables, "h", moment, 21 * 86400, batch=k)
            cycle.run_derive(tables, "h", moment, 21 * 86400, batch=k)       # a repeated run changes nothing
        results.append((sorted(map(tuple, cycle.requests(tables).collect())), sorted(map(tuple, cycle.links(tables).collect()))))
    assert results[0] == results[1] and len(results[0][0]) == 20 and len(results[0][1]) == 20
    assert {r[3] for r in results[0][1]} == {2000}
