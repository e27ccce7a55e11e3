import datetime as dt

from pyspark.sql import functions as F

from pulsetrail import functions as fn
from pulsetrail.operators import filters as fl


def _one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def _ts(text):
    return F.lit(text).cast("timestamp_ntz")


def test_query_label_replaces_newlines_and_cuts(spark):
    assert _one(spark, fn.query_label(F.lit("a\nb" + "c" * 100))) == "a b" + "c" * 57


def test_pads_truncate(spark):
    assert _one(spark, fn.right_pad(F.lit("abcdef"), 3)) == "abc"
    assert _one(spark, fn.left_pad(F.lit("7"), 3)) == "  7"


def test_identifiers(spark):
    uuid = "0f3a1b2c-1111-2222-3333-444455556666"
    assert _one(spark, fn.hex_prefix(F.lit(uuid))) == "0f3a1b2c1111222"
    assert _one(spark, fn.rr_key(F.lit(uuid))) == int("0f3a1b2c1111222", 16)
    assert _one(spark, fn.bare_address(F.lit("10.0.0.1/32"))) == "10.0.0.1"
    assert _one(spark, fn.port_part(F.lit("10.0.0.1:5433"))) == 5433
    assert _one(spark, fn.port_part(F.lit("10.0.0.1"))) is None


def test_integer_megabytes_truncate_towards_zero(spark):
    assert _one(spark, fn.mega(F.lit(3 * 1024 * 1024 - 1))) == 2
    assert _one(spark, fn.mega(F.lit(-3 * 1024 * 1024 + 1))) == -2


def test_time_labels(spark):
    t = _ts("2024-01-02 03:04:05.678912")
    assert _one(spark, fn.clock_ms(t)) == "03:04:05.678"
    assert _one(spark, fn.clock_ms_colon(t)) == "03:04:05:678"
    assert _one(spark, fn.clock_ms_dashed(t)) == " - 03:04:05.678"
    assert _one(spark, fn.minute_label(t)) == "002 TUE 03:04:00"
    assert _one(spark, fn.stamp_day_first(t)) == "2024-02-01 03:04:05"
    assert _one(spark, fn.day_clock(t)) == "02 03:04:05"


def test_durations(spark):
    a, b = _ts("2024-01-01 00:00:00"), _ts("2024-01-02 00:00:01.234567")
    assert _one(spark, fn.seconds3(a, b)) == 86401.234
    assert _one(spark, fn.seconds3(b, a)) == -86401.234
    assert _one(spark, fn.whole_seconds(a, b)) == 86401
    assert _one(spark, fn.seconds_of_day_wrap(a, b)) == 1
    assert _one(spark, fn.millis_rounded(a, b)) == 86401235
    assert _one(spark, fn.millis_truncated(a, b)) == 86401234


def test_truncation_keeps_the_timestamp_type(spark):
    df = spark.range(1).select(_ts("2024-01-02 03:04:05").alias("t"))
    out = df.select(fn.truncated(df, "t", "minute").alias("m"))
    assert out.dtypes == [("m", "timestamp_ntz")]
    assert out.first()[0] == dt.datetime(2024, 1, 2, 3, 4)


def test_interval_is_closed_and_lookback_is_open(spark):
    df = spark.createDataFrame([(i,) for i in range(4)], "i int").select(
        "i", F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_interval(0,0,0,0,0,0,i)").alias("sample_time"))
    start, end = fl.interval_from_offsets("2024-01-01 00:00:03", 2, 1)
    assert [r.i for r in fl.in_interval(df, start, end).collect()] == [1, 2]
    assert [r.i for r in fl.lookback(df, "sample_time", "2024-01-01 00:00:03", 2).collect()] == [2, 3]


def test_noise_rule_keeps_three_valued_logic(spark):
    rows = [("Extension", 5), ("Extension", 7), ("Extension", 9), ("Other", 5), (None, 5), (None, 9), ("Extension", None)]
    df = spark.createDataFrame(rows, "wait_event string, query_id long")
    assert {tuple(r) for r in fl.drop_noise(df).collect()} == {("Extension", 9), ("Other", 5), (None, 9)}


def test_foreground_prefixes(spark):
    df = spark.createDataFrame([("00001",), ("0001",), ("1",), (None,)], "root_request_id string")
    assert {r[0] for r in fl.foreground(df).collect()} == {"0001", "1"}
    assert {r[0] for r in fl.foreground(df, "000").collect()} == {"1"}


def test_explain_and_blank_text(spark):
    df = spark.createDataFrame([("Explain x",), ("select" + " " * 20 + "explain",), (None,), (" ",)], "query string")
    assert len(fl.not_explain(df).collect()) == 2
    assert len(fl.blank(df, "query").collect()) == 2


def test_prefix_disjunction(spark):
    df = spark.createDataFrame([("session_log",), ("samples",), ("query_mst",)], "t string")
    assert df.filter(fl.starts_with_any(F.col("t"), ["session", "query"])).count() == 2
