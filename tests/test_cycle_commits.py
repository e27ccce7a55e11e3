"""A collection cycle is published once and at once; snapshots and lines that do not fit are part of it."""

import pytest
from pyspark.sql import functions as F

from pulsetrail.plans import collect
from pulsetrail.plans.cycle import SAMPLE_LOG, Exports, Listings, run_cycle
from pulsetrail.schemas import TABLES
from pulsetrail.sources.store import VersionedTables
from pulsetrail.sources.testdata import TestData

UUID = "0f3a1b2c-1111-2222-3333-444455556666"


def _listings(spark, **more):
    lines = lambda *rows: spark.createDataFrame([("node2", r) for r in rows], "host string, line string")
    given = {
        "masters": lines("Master UUID   RPC Host/Port   State Role", f"{UUID} \tnode2:7100   ALIVE   LEADER"),
        "servers": lines("Tablet Server UUID  RPC Host/Port", f"{UUID}  node2:9100 0.5s ALIVE 3 4 86400 10 MB",
                         "Timed out", ""),
        "universe": spark.createDataFrame([("node2", '{"universeUuid": "u", "clusterUuid": "c", "version": 7}')],
                                          "host string, slurp string"),
        "metrics": spark.createDataFrame([(UUID, '{"memory_free": 3145728, "cpu_usage_user": 0.5}', "OK", "")],
                                         "uuid string, metrics string, status string, error string")}
    return Listings(**{**given, **more})


@pytest.fixture(scope="module")
def data(spark, folder):
    t = TestData(spark, folder)
    lines = spark.createDataFrame([("node2", x) for x in (
        "nr_processes=3", "master_mem=1", "master_mem=2", "tserver_mem=5", "disk_usage_mb=6", "top_info=x", "no pair", "")],
        "host string, line string")
    return t, Exports(t.databases, t.local_tablets, t.activity, t.statements, t.exported_samples, lines,
                      listings=_listings(spark))


def _state(store):
    return {n: store.read_all(n, TABLES.get(n, SAMPLE_LOG)).count()
            for n in ("sample_log", "database_log", "session_log", "host_log", "query_log", "run_log", "snapshot_log",
                      "tserver_log", "master_log", "universe_log")}


def test_a_broken_cycle_changes_nothing_and_a_repeated_one_neither(spark, data, tmp_path, monkeypatch):
    t, exports = data
    store = VersionedTables(spark, str(tmp_path))
    real, seen = collect.stage, []

    def breaking(result, *args):
        seen.append(result.component)
        if result.component == "samples":
            raise RuntimeError("between two tables")
        return real(result, *args)

    monkeypatch.setattr(collect, "stage", breaking)
    with pytest.raises(RuntimeError):
        run_cycle(store, exports, "node2", "2024-01-31 00:00:00")
    assert "databases" in seen and not any(_state(VersionedTables(spark, str(tmp_path))).values())
    monkeypatch.setattr(collect, "stage", real)
    first = run_cycle(store, exports, "node2", "2024-01-31 00:00:00")
    once = _state(store)
    assert all(once.values())
    assert run_cycle(VersionedTables(spark, str(tmp_path)), exports, "node2", "2024-01-31 00:00:00") == first
    assert _state(VersionedTables(spark, str(tmp_path))) == once

    # what the cycle says about lines
    notes = {r.component: r.info_txt for r in store.read_all("run_log", TABLES["run_log"]).collect()}
    assert "servers lines: 4" in notes["snapshot"] and "servers rejected: 1" in notes["snapshot"]
    assert "masters rejected: 0" in notes["snapshot"]
    assert "host rejected: 1" in notes["hosts"] and "keys repeated: 1" in notes["hosts"]
    assert store.read_all("host_log", TABLES["host_log"]).first().master_mem == 2
    server = store.read_all("tserver_log", TABLES["tserver_log"]).first()
    assert (server.snap_id, server.port, server.mem_free_mb, server.ts_status) == (1, 9100, 3, "OK")
    assert store.read("tserver_mst", TABLES["tserver_mst"]).count() == store.read("master_mst", TABLES["master_mst"]).count() == 1

    # the gate: too young, then old enough
    soon = run_cycle(store, exports, "node2", "2024-01-31 00:02:00")
    assert "snapshot" not in soon and _state(store)["snapshot_log"] == 1
    later = run_cycle(store, exports, "node2", "2024-01-31 00:05:00")
    assert later["snapshot"]["snapshot_log"] == 1 and later["snapshot"]["tserver_mst"] == 1
    assert sorted(r.id for r in store.read_all("snapshot_log", TABLES["snapshot_log"]).collect()) == [1, 2]
    assert later["samples"]["sample_log"] == 0 and later["queries"]["query_log"] == 0
    day = store.read_all("sample_log", SAMPLE_LOG, days=["2024-01-05"])
    assert day.count() == t.samples.filter("NOT (wait_event = 'Extension' AND query_id IN (5, 7))").filter(
        F.to_date("sample_time") == "2024-01-05").count() and all("day=2024-01-05" in f for f in day.inputFiles())
