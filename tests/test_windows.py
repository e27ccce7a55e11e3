"""Sliced windows against the plain window over the whole key."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pulsetrail.operators.windows import counter_delta, neighbours, ordinal

START = dt.datetime(2024, 1, 1)


def _rows(seed, n=400):
    """One key holds most rows; times repeat, values may be NULL, one key is NULL."""
    rnd = random.Random(seed)
    keys = ["hot"] * 12 + ["a", "b", None]
    return [(rnd.choice(keys), START + dt.timedelta(seconds=rnd.randrange(0, 5 * 3600, 97)), i,
             rnd.choice([None, 1, 2, 3])) for i in range(n)]


@pytest.fixture(scope="module", params=[1, 2])
def frame(spark, request):
    return spark.createDataFrame(_rows(request.param), "k string, t timestamp_ntz, i int, v int").repartition(5)


@pytest.mark.parametrize("unit", ["minute", "hour", "day"])
def test_neighbours_equal_plain_window(frame, unit):
    whole = Window.partitionBy("k").orderBy("t", "i")
    want = frame.select("k", "t", "i", "v", F.lag("v").over(whole).alias("p"), F.lag("t").over(whole).alias("pt"),
                        F.lead("v").over(whole).alias("n"))
    got = neighbours(frame, ["k"], "t", ["i"], before={"v": "p", "t": "pt"}, after={"v": "n"}, unit=unit)
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("unit", ["minute", "hour"])
def test_ordinal_equals_row_number(frame, unit):
    want = frame.withColumn("no", F.row_number().over(Window.partitionBy("k").orderBy("t", "i")))
    got = ordinal(frame, ["k"], "t", ["i"], "no", unit)
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("unit", ["minute", "hour"])
def test_ordinal_needs_no_join(spark, unit):
    """Moments, keys and both at once may be NULL, and rows may be equal; the rows meet their slice's offset unjoined."""
    rows = [*_rows(3, 60), *[(k, None, i, 1) for k in ("hot", None) for i in (1, 1, 2)], *_rows(3, 60)]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, i int, v int").repartition(5)
    whole = Window.partitionBy("k")
    want = df.withColumn("no", F.row_number().over(whole.orderBy("t", "i"))).withColumn("of", F.count("*").over(whole))
    got = ordinal(df, ["k"], "t", ["i"], "no", unit, total="of")
    assert got.columns == want.columns
    places = ["k", "t", "i", "no", "of"]
    assert sorted(map(str, got.select(places).collect())) == sorted(map(str, want.select(places).collect()))
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_counter_delta_starts_empty(spark):
    df = spark.createDataFrame([("h", START + dt.timedelta(hours=i), 10 * i * i) for i in range(4)],
                               "h string, t timestamp_ntz, c long")
    got = [r.d for r in counter_delta(df, ["h"], "t", {"c": "d"}).orderBy("t").collect()]
    assert got == [None, 10, 30, 50]


def test_rows_are_shuffled_once_for_both_halves(spark, frame):
    out = neighbours(frame, ["k"], "t", ["i"], before={"v": "p"})
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan or plan.count("ReusedQueryStage") or "Reused" in plan
