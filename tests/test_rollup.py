"""The roll-up of requests per minute against exact counts."""

from pyspark.sql import functions as F

from pulsetrail.plans import interval, rollup
from pulsetrail.plans.catalog import END, START
from pulsetrail.sources.testdata import TestData


def test_merged_parts_estimate_like_the_whole(spark):
    rows = spark.range(200_000).selectExpr(
        "id % 3 AS query_id", "'r' || (id % 60000) AS root_request_id",
        "TIMESTAMP_NTZ '2024-01-05 00:00:00' + make_interval(0,0,0,0,0,0,id % 7200) AS sample_time")
    whole = rollup.minute_requests(rows)
    parts = rollup.minute_requests(rows.filter("id % 2 = 0")).unionByName(rollup.minute_requests(rows.filter("id % 2 = 1")))
    for table in (whole, parts, rollup.merged(parts)):
        for start, end, n in (("2024-01-05 00:00:00", "2024-01-05 02:00:00", 20_000), ("2024-01-05 00:10:00", "2024-01-05 00:10:00", None)):
            exact = rollup.sketch_error(rows.filter(F.col("sample_time") < F.lit(end).cast("timestamp_ntz") + F.expr("INTERVAL 1 MINUTE")),
                                        table, start, "2024-01-05 00:10:59.999999" if n is None else end)
            got = exact.collect()
            assert len(got) == 3 and all(r.close for r in got)
            assert n is None or {r.nr_rreq for r in got} == {n}
    assert rollup.merged(parts).count() == whole.count()


def test_same_top_statements(spark, folder):
    t = TestData(spark, folder)
    exact = interval.top_queries(t.samples, t.queries, START, END).collect()
    rolled = rollup.top_rolled_queries(rollup.minute_requests(t.samples), t.queries, START, END).collect()
    assert [(r.cnt_ashev, r.top_qry, r.query) for r in rolled] == [(r.cnt_ashev, r.top_qry, r.query) for r in exact]
    assert all(abs(a.nr_rreq - b.nr_rreq) <= b.nr_rreq * rollup.MOST_ERROR for a, b in zip(rolled, exact))
