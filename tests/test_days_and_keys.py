"""Reports do not depend on the layout of the sample log; the key report against plain loops."""

import random

from pyspark.sql import functions as F

from pulsetrail.operators import quality as q
from pulsetrail.operators.joins import of_days
from pulsetrail.plans import catalog, drilldown
from pulsetrail.sources import text as tx
from pulsetrail.sources.testdata import TestData


def _rows(df):
    return sorted(map(str, df.collect()))


def test_same_rows_with_and_without_days(spark, folder, tmp_path):
    t = TestData(spark, folder)
    rr = catalog._rr(t).filter("rr_min_dt < TIMESTAMP_NTZ '2024-01-12 00:00:00'")
    timeless = t.samples.filter("sample_id % 50 = 0").withColumn("sample_time", F.lit(None).cast("timestamp_ntz"))
    # a request with samples on a day outside its derived span
    stray = t.samples.filter("sample_id % 60 = 0").withColumn("sample_time", F.lit("2023-12-01 00:00:00").cast("timestamp_ntz"))
    samples = t.samples.unionByName(timeless).unionByName(stray)
    samples.withColumn("day", F.to_date("sample_time")).write.partitionBy("day").parquet(f"{tmp_path}/log")
    by_day = spark.read.parquet(f"{tmp_path}/log")
    flat, split = of_days(samples, rr), of_days(by_day, rr)
    assert _rows(flat.select("sample_id", "sample_time")) == _rows(split.select("sample_id", "sample_time"))
    assert flat.filter("sample_time IS NULL").count() == timeless.count() > 0
    assert flat.filter("sample_time < '2024-01-01'").count() == 0
    for report in (lambda s: drilldown.rr_events(rr, s), lambda s: drilldown.session_rr_events(rr, s, t.sessions),
                   lambda s: drilldown.query_rrs(t.queries, catalog._links(t), rr, s, "2024-01-31 00:00:00", 30 * 86400)):
        assert _rows(report(samples)) == _rows(report(by_day)) != []


def test_overlaps_by_hand(spark):
    rng = random.Random(4)
    rows = []
    for key in range(60):
        for _ in range(rng.randint(1, 7)):
            start = rng.randint(0, 200)
            rows.append((None if key == 0 else key, start, None if rng.random() < 0.1 else start + rng.randint(0, 60)))
    rows += [(99, 5, 9)] * 3 + [(98, None, 4)]
    df = spark.createDataFrame(rows, "key long, a long, b long").selectExpr(
        "key", "TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_interval(0,0,0,0,a) AS a",
        "TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_interval(0,0,0,0,b) AS b")
    want = {}
    for key in {r[0] for r in rows}:
        own = sorted(((a, float("inf") if b is None else b) for k, a, b in rows if k == key and a is not None
                      and (b is None or b > a)), key=lambda x: x[0])
        n = sum(any(e > own[i][0] for _, e in own[:i]) for i in range(len(own)))
        if n:
            want[key] = n
    for unit in ("day", "hour"):
        assert {r.key: r.n_rows for r in q.check_overlaps(df, ["key"], "a", "b", unit).collect()} == want


def test_lines_are_judged(spark):
    uuid = "0f3a1b2c-1111-2222-3333-444455556666"
    lines = [(uuid + "  node2:7100", "good"), (uuid[:-1], "rejected"), ("Tablet Server UUID  RPC", "skipped"), (" ", "skipped"),
             (None, "skipped"), ("Master UUIDs are gone", "rejected"), (uuid + "x node2", "rejected")]
    df = spark.createDataFrame(lines, "line string, want string")
    assert tx.judge_lines(df, "listing").filter("verdict <> want").count() == 0
    good = [(r.line, r.verdict == "good") for r in tx.judge_lines(df, "listing").collect()]
    assert tx.normalise_listing(df).count() == sum(g for _, g in good)
    kv = spark.createDataFrame([("a=1", "good"), ("a", "rejected"), ("", "skipped"), ("=", "good")], "line string, want string")
    assert tx.judge_lines(kv, "kv").filter("verdict <> want").count() == 0
