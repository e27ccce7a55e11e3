"""The event tree's plan and its counts, with and without those of the derivation."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from pulsetrail.functions import dashed_uuid
from pulsetrail.plans import catalog, derive, tree
from pulsetrail.sources.testdata import AS_OF, EVENTS_SCHEMA, LOOKBACK_SECONDS, SCHEMAS, TestData, samples_from_events


@pytest.fixture(scope="module")
def stored(spark, folder, tmp_path_factory):
    """The tables as files of their own, as they lie in a history."""
    t, base = TestData(spark, folder), str(tmp_path_factory.mktemp("history"))
    tables = {"rr": catalog._rr(t), "links": catalog._counted_links(t), "queries": t.queries, "samples": t.samples,
              "tablets": t.tablets, "sessions": t.sessions}
    for name, rows in tables.items():
        rows.write.parquet(f"{base}/{name}")
    return {name: spark.read.parquet(f"{base}/{name}") for name in tables}


def _tree(s, links):
    return tree.event_tree(s["rr"], links, s["queries"], s["samples"], s["tablets"], s["sessions"])


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_counts_of_the_derivation_are_those_of_the_samples(stored):
    plain = stored["links"].drop("n_samples")
    with_counts, without = (sorted(map(str, _tree(stored, links).collect())) for links in (stored["links"], plain))
    assert with_counts == without != []
    again = derive.build_rr_query_links(stored["rr"], stored["samples"], counted=True)
    assert sorted(again.collect()) == sorted(stored["links"].select(*again.columns).collect())


def test_samples_are_read_once(stored):
    one, two = _plan(_tree(stored, stored["links"])), _plan(_tree(stored, stored["links"].drop("n_samples")))
    scans = [re.findall(r"FileScan parquet \[[^\]]*root_request_id#", plan) for plan in (one, two)]
    assert [len(s) for s in scans] == [1, 2]
    assert len(re.findall(r"FileScan parquet \[[^\]]*rr_min_dt#", one)) <= 4      # days, numbers (twice), places of samples
    for line in one.splitlines():
        assert "SinglePartition" not in line or "Window" not in line


@pytest.fixture(scope="module")
def few(spark, tmp_path_factory):
    """Tables of a few rows: two users, one of them twice at the same time, requests without a known statement."""
    base, start = str(tmp_path_factory.mktemp("few")), dt.datetime(2024, 1, 10, 8)
    events = [(i, start + dt.timedelta(minutes=40 * (i - i % 2)), i % 2 + 1, "click", 1.0, f'{{"k": {10 + i % 3}}}')
              for i in range(12)] + [(12, start, 3, "view", 1.0, '{"k": 99}'), (13, None, 1, "view", 1.0, '{"k": 10}')]
    spark.createDataFrame(events, EVENTS_SCHEMA).write.parquet(f"{base}/events.parquet")
    spark.createDataFrame([(i, f"select {i}", "en", "s", 9) for i in (10, 11, 12)],
                          SCHEMAS["documents"]).write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame([(1, "t1", "b", "t", 1, 1.0)], SCHEMAS["part"]).write.parquet(f"{base}/part.parquet")
    return base


def test_session_tree_reads_its_own_tables(spark, few):
    """What the report derives is stored: only the sample lines still read the statement of a sample."""
    got = catalog.QUERIES["event_tree_tmp"](spark, few)
    assert len(re.findall(r"FileScan parquet \[[^\]]*props#", _plan(got))) == 1
    t = TestData(spark, few)
    requests = derive.build_root_requests(t.samples, t.sessions, AS_OF, LOOKBACK_SECONDS)
    links = derive.build_rr_query_links(requests, t.samples, counted=True)
    want = tree.ordered(tree.event_tree(requests, links, t.queries, t.samples, t.tablets, t.sessions))
    assert got.schema == want.schema and got.count() > 12
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_start_of_a_statement_is_formatted_once(stored):
    """Of the lines of a statement, the first three and the end begin with it."""
    frame = _tree(stored, stored["links"])._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"date_format\((?:cast\()?qurr_start_dt#", frame)) == 1


def test_node_ids_are_those_of_any_number(spark):
    rows = [(i, None, i, "click", 1.0, None) for i in (-5, -2, -1, 0, 1, 2, 3, 4, 7)] + [(9, None, None, None, None, None)]
    seen = spark.createDataFrame(rows, EVENTS_SCHEMA)
    for number, column in (("event_id", "tsrv_uuid"), ("user_id", "top_level_node_id")):
        node = dashed_uuid(F.concat(F.lit("tsrv|"), (F.col(number) % 4 + 2).cast("string")))
        assert (sorted(map(str, samples_from_events(seen).select(column).collect()))
                == sorted(map(str, seen.select(node.alias(column)).collect())))
