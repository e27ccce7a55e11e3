"""Shape of the physical plans: what must hold for the jobs to run on large data."""

import pytest

from pulsetrail.plans import catalog
from pulsetrail.session import shared_folder
from pulsetrail.sources.testdata import TestData

BATCH = {**catalog.REPORTS, **catalog.DRILLDOWNS, **catalog.OPERATORS, **catalog.STATE}
# queries that fold the raw samples must do it in hash tables, not by sorting them
FOLDS = ["interval_summary", "minute_host_crosstab", "busiest_events", "busiest_tablets", "top_queries",
         "build_root_requests", "build_rr_query_links", "wait_type_per_minute", "slowest_queries", "rr_cardinalities"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(BATCH))
def test_no_cartesian_product_and_no_python(spark, folder, name):
    plan = _plan(BATCH[name](spark, folder))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert operator not in plan


@pytest.mark.parametrize("name", FOLDS)
def test_samples_are_folded_by_hash(spark, folder, name):
    assert "SortAggregate" not in _plan(BATCH[name](spark, folder))


def test_interval_and_columns_reach_the_scan(spark, folder):
    plan = _plan(BATCH["busiest_components"](spark, folder))
    assert "GreaterThanOrEqual(ts" in plan and "LessThanOrEqual(ts" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string>" in plan


def test_windows_are_keyed(spark, folder):
    t = TestData(spark, folder)
    for name in ("session_rr_queries", "session_events", "counter_delta", "event_tree", "database_counter_delta"):
        for line in _plan(BATCH[name](spark, folder)).splitlines():
            assert "SinglePartition" not in line or "Window" not in line
    assert t.events is not None


class _Session:
    """Only what `shared_folder` asks of a session."""

    def __init__(self, master, named=None, app="test-app"):
        self.conf, self.sparkContext = self, self
        self.master, self.applicationId, self._named = master, app, named

    def get(self, key, default=None):
        return self._named or default

    def getConf(self):
        return self


def test_shared_folder_is_the_one_the_cluster_names():
    assert shared_folder(_Session("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    own = shared_folder(_Session("local[2]"))
    assert own.startswith("/tmp/pulsetrail-") and shared_folder(_Session("local[2]")) == own
    with pytest.raises(RuntimeError):
        shared_folder(_Session("yarn"))
