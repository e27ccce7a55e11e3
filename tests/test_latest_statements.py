"""The table of the newest counters: same rows as the log, no shuffle of the stored side."""

from pyspark.sql import functions as F

from pulsetrail.operators import state as st
from pulsetrail.plans.cycle import LATEST_SCHEMA
from pulsetrail.sources.store import VersionedTables
from pulsetrail.sources.testdata import TestData

LATER = "2024-02-01 00:00:00"


def _rows(df):
    return sorted(map(str, df.collect()))


def _kept(store, df):
    with store.transaction() as tx:
        tx.replace_bucketed("statement_latest", df, st.LATEST_KEY, 8)
    return VersionedTables(store.spark, store.root).read_bucketed("statement_latest", LATEST_SCHEMA, st.LATEST_KEY, 8)


def test_stored_counters_are_not_shuffled(spark, folder, tmp_path):
    t = TestData(spark, folder)
    latest = _kept(VersionedTables(spark, str(tmp_path)), st.latest_statements(t.known_statements))
    assert latest.count() == t.known_statements.count()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (st.changed_statements(latest, t.statements, LATER), st.merge_latest(latest, t.statements)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            lines = plan.splitlines()
            scan = next(i for i, x in enumerate(lines) if "SelectedBucketsCount: 8 out of 8" in x)
            depth = len(lines[scan]) - len(lines[scan].lstrip(" :+-"))
            above = []
            for x in reversed(lines[:scan]):
                d = len(x) - len(x.lstrip(" :+-"))
                if d < depth:
                    above.append(x)
                    depth = d
            assert any("Join" in x for x in above)
            assert not any("Exchange" in x for x in above[:next(i for i, x in enumerate(above) if "Join" in x)])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_changes_of_three_exports(spark, tmp_path):
    schema = "tsrv_uuid string, queryid long, userid long, dbid long, toplevel boolean, calls long, rows long, query string"

    def export(*rows):
        df = spark.createDataFrame([("t", q, 10, None, top, n, 10 * n, text) for q, top, n, text in rows], schema)
        return df.withColumns({c: F.lit(None).cast("long") for c in st.STATEMENT_COUNTERS if c not in df.columns})

    store, latest = VersionedTables(spark, str(tmp_path)), spark.createDataFrame([], LATEST_SCHEMA)
    steps = [
        (export((1, True, 5, "a"), (2, None, 1, "b"), (3, True, 1, "explain c"), (4, True, 1, None)), {1, 2}),
        (export((1, True, 5, "a"), (2, None, 1, "b")), set()),
        (export((1, True, 7, "a")), {1}),
        (export((1, True, 5, "a"), (2, None, 2, "b")), {1, 2}),     # 1 was reset: its earlier counters come back
        (export((2, None, 2, "b")), set()),
    ]
    for rows, want in steps:
        assert {r.queryid for r in st.changed_statements(latest, rows, LATER).collect()} == want
        latest = _kept(store, st.merge_latest(latest, rows))
    assert {(r.statement_key, r.calls) for r in latest.collect()} == {("1|t|~|10|true", 5), ("2|t|~|10|~", 2)}
