import os

import pytest

from pulsetrail.schemas import FOREIGN_KEYS, TABLES, UNIQUE_KEYS
from pulsetrail.sources import tables as tb
from pulsetrail.sources import text as tx

UUID = "0f3a1b2c-1111-2222-3333-444455556666"


def test_key_value_file(spark, tmp_path):
    path = tmp_path / "abc.out"
    path.write_text("nr_processes=12\ntop_info=load=0.5 a=b\ndisk_usage_mb=\nno pair\n")
    got = {r.key: r.value for r in tx.read_kv(spark, str(path), "node2").collect()}
    assert got == {"nr_processes": "12", "top_info": "load=0.5 a=b", "disk_usage_mb": None}


def test_lines_and_whole_files(spark, tmp_path):
    path = tmp_path / "u.json"
    path.write_text('{"universeUuid": "u",\n\n "clusterUuid": "c", "version": 7}')
    lines = tx.read_lines(spark, str(path), "node2")
    assert [r.slurp for r in lines.collect()].count(None) == 1
    row = tx.parse_universe(tx.read_lines(spark, str(path), "node2", whole_file=True)).first()
    assert (row.host, row.univ_uuid, row.clst_uuid, row.version) == ("node2", "u", "c", 7)


def test_listings(spark, tmp_path):
    path = tmp_path / "m.out"
    path.write_text(f"Master UUID   RPC Host/Port   State Role\n{UUID} \tnode2:7100   ALIVE   LEADER  x\n")
    lines = spark.read.text(str(path)).withColumnRenamed("value", "line")
    row = tx.parse_masters(tx.normalise_listing(lines)).collect()
    assert [(r.mast_uuid, r.host, r.port, r.state, r.role) for r in row] == [(UUID, "node2", 7100, "ALIVE", "LEADER")]
    path = tmp_path / "t.out"
    path.write_text(f"Tablet Server UUID Host\n{UUID}   node3:9100 0.42s ALIVE 1.50 x 99 rest\n")
    lines = spark.read.text(str(path)).withColumnRenamed("value", "line")
    row = tx.parse_tservers(tx.normalise_listing(lines)).first()
    assert (row.port, row.status, row.rd_psec, row.wr_psec, row.uptime_s) == (9100, "ALIVE", 1.5, None, 99)


def test_metrics_accept_numbers_and_quoted_numbers(spark):
    rows = [("u1", '{"memory_free": 3145728, "cpu_usage_user": 0.5}', "OK", None),
            ("u2", '{"memory_free": "3145727", "cpu_usage_user": "0.5"}', "OK", None), ("u3", "broken", "ERR", "x")]
    got = {r.tsrv_uuid: (r.mem_free_mb, r.cpu_user, r.ts_status) for r in tx.parse_server_metrics(
        spark.createDataFrame(rows, "uuid string, metrics string, status string, error string")).collect()}
    assert got == {"u1": (3, 0.5, "OK"), "u2": (2, 0.5, "OK"), "u3": (None, None, "ERR")}


def test_append_overwrite_and_partition_overwrite(spark, tmp_path):
    path = str(tmp_path / "t")
    tb.append(spark.createDataFrame([("a", 1), ("b", 1)], "host string, n int"), path, ["host"])
    assert tb.append(spark.createDataFrame([("a", 2)], "host string, n int"), path, ["host"]).count() == 1
    assert spark.read.parquet(path).count() == 3
    tb.overwrite(spark.createDataFrame([("a", 9)], "host string, n int"), path, ["host"])
    assert {tuple(r) for r in spark.read.parquet(path).select("host", "n").collect()} == {("a", 9), ("b", 1)}
    tb.overwrite(spark.createDataFrame([("c", 1)], "host string, n int"), str(tmp_path / "u"))
    assert spark.read.parquet(str(tmp_path / "u")).count() == 1


def test_versions(spark, tmp_path):
    store = tb.VersionedTables(spark, str(tmp_path))
    schema = TABLES["database_mst"]
    assert store.read("database_mst", schema).count() == 0
    one = spark.createDataFrame([(1, "db", "h", None)], schema)
    assert store.replace("database_mst", one) == 0
    assert store.replace("database_mst", one.union(one)) == 1
    assert store.read("database_mst", schema).count() == 2
    assert store.read("database_mst", schema, before=1).count() == 1
    store.add("log", one, 0)
    store.add("log", one, 1)
    store.add("log", one, 1)  # the same batch again
    assert store.read_all("log", schema).count() == 2
    assert store.read_all("log", schema, before=1).count() == 1


def test_inventory_sizes(spark, folder):
    names = ["events", "documents", "part"]
    got = {r.relname: r for r in tb.table_inventory(
        spark, {n: f"{folder}/{n}.parquet" for n in names}, ["event", "doc"]).collect()}
    assert set(got) == {"events", "documents"}
    for name, row in got.items():
        assert row.size_mb == os.path.getsize(f"{folder}/{name}.parquet") // 1024 // 1024
        assert row.num_tablets == 1 and row.rows == spark.read.parquet(f"{folder}/{name}.parquet").count()


def test_scan_uses_declared_schemas(spark, tmp_path):
    spark.createDataFrame([(3, "x")], "queryid long, extra string").write.parquet(str(tmp_path / "q"))
    df = tb.scan(spark, "query_mst", str(tmp_path / "q"))
    assert df.columns == TABLES["query_mst"].fieldNames() and df.first().queryid == 3


@pytest.mark.parametrize("table", sorted(UNIQUE_KEYS))
def test_declared_keys_exist(table):
    assert set(UNIQUE_KEYS[table]) <= set(TABLES[table].fieldNames())


def test_declared_parents_exist():
    for child, column, parent, key in FOREIGN_KEYS:
        assert column in TABLES[child].fieldNames() and key in TABLES[parent].fieldNames()
