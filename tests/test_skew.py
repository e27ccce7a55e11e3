"""A key with a third of all rows: joins split it at run time, windows spread it, folds shrink it first."""

import pytest
from pyspark.sql import functions as F

from pulsetrail.operators.joins import attach_tablet, only_new, samples_of
from pulsetrail.operators.windows import neighbours
from pulsetrail.plans.drilldown import session_rr_events
from pulsetrail.sources.testdata import samples_from_events

SETTINGS = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.shuffle.partitions": "16"}


@pytest.fixture
def tight(spark):
    """Thresholds small enough for test data, and no broadcasts."""
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def skewed(tight):
    """60,000 samples, a third of them of one user on one node and one statement."""
    hot = F.col("id") % 3 == 0
    events = tight.range(0, 60000, 1, 8).select(
        F.when(hot, F.col("id") * 4 + 1).otherwise(F.col("id")).alias("event_id"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 86400).cast("timestamp_ntz").alias("ts"),
        F.when(hot, 1).otherwise(F.col("id") % 997).cast("long").alias("user_id"),
        F.lit("click").alias("event_type"), F.lit(1.0).alias("value"),
        F.concat(F.lit('{"k": '), F.when(hot, 42).otherwise(F.col("id") % 100).cast("string"), F.lit("}")).alias("props"))
    return samples_from_events(events)


def _final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_hot_request_is_split(tight, skewed):
    requests = skewed.select(F.col("root_request_id").alias("rr_uuid"))
    some = samples_of(skewed, requests)
    assert "skew=true" in _final_plan(some.select("sample_id", "host"))
    assert some.count() == 60000


def test_hot_session_events_are_split(tight, skewed):
    sessions = skewed.groupBy("pid").count().select(
        "pid", F.col("pid").alias("id"), F.lit(None).cast("timestamp_ntz").alias("backend_start"))
    requests = skewed.groupBy("root_request_id", "pid").count().select(
        F.col("root_request_id").alias("rr_uuid"), F.col("pid").alias("sess_id"))
    assert "skew=true" in _final_plan(session_rr_events(requests, skewed, sessions))


def test_hot_tablet_is_split(tight, skewed):
    uuid = "0f3a1b2c-1111-2222-3333-444455556666"
    tablets = tight.range(100).select(F.uuid().alias("tblt_uuid"), F.lit("t").alias("table_name")).unionByName(
        tight.range(1).select(F.lit(uuid).alias("tblt_uuid"), F.lit("hot").alias("table_name")))
    rows = skewed.withColumn("wait_event_aux", F.when(F.col("pid") == 1001, F.lit("0f3a1b2c1111222")).otherwise(
        F.col("wait_event_aux")))
    named = attach_tablet(rows, tablets)
    assert "skew=true" in _final_plan(named.select("sample_id", "host", "table_name"))
    assert named.filter("table_name = 'hot'").count() == rows.filter("pid = 1001").count()


def test_anti_join_splits_copies(tight, skewed):
    """A third of the batch are copies of one sample."""
    copies = skewed.select("host", F.when(F.col("pid") == 1001, F.lit("x")).otherwise(
        F.col("sample_id").cast("string")).alias("key"), "client_node_ip", "top_level_node_id")
    known = copies.filter("key <> 'x'").select("key")
    fresh = only_new(copies, known, ["key"])
    assert "skew=true" in _final_plan(fresh)
    assert fresh.count() == copies.filter("key = 'x'").count()


def test_rows_without_tablet_do_not_pile_up(tight, skewed):
    tablets = tight.range(100).select(F.uuid().alias("tblt_uuid"), F.lit("t").alias("table_name"))
    plan = attach_tablet(skewed.withColumn("wait_event_aux", F.lit(None).cast("string")), tablets)
    assert plan.count() == 60000
    assert "hashpartitioning(coalesce(__aux_key" in _final_plan(plan.select("sample_id", "table_name"))


def test_hot_session_window_is_spread(tight, skewed):
    """No task of the sliced window sees more than a slice of the hot session."""
    out = neighbours(skewed.select("pid", "sample_time", "sample_id"), ["pid"], "sample_time", ["sample_id"],
                     before={"sample_id": "p"}, unit="minute")
    sizes = (skewed.groupBy("pid", F.date_trunc("minute", "sample_time").alias("m")).count()
             .agg(F.max("count")).first()[0])
    assert skewed.filter("pid = 1001").count() >= 20000 and sizes < 100
    assert out.filter("p IS NULL").count() == skewed.select("pid").distinct().count()
