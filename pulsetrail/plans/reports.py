"""Whole reports: the queries a user runs together, by name, in reading order.

Everything is lazy but the crosstab of `interval_report`: a pivot without a list of hosts runs a job to find them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators.filters import interval_from_offsets, rr_like
from . import derive, drilldown, interval, tree


@dataclass
class History:
    """The history tables reports read."""

    samples: DataFrame
    queries: DataFrame
    sessions: DataFrame
    tablets: DataFrame
    replicas: DataFrame
    servers: DataFrame


def interval_report(h: History, as_of, seconds_ago: int = 900, length: int = 900) -> dict[str, DataFrame]:
    """What was busy in the interval starting `seconds_ago` before `as_of`."""
    start, end = interval_from_offsets(as_of, seconds_ago, length)
    return {
        "interval_summary": interval.interval_summary(h.samples, start, end),
        "minute_host_crosstab": interval.minute_host_crosstab(h.samples, start, end),
        "busiest_nodes": interval.busiest_nodes(h.samples, start, end, as_of),
        "busiest_components": interval.busiest_components(h.samples, start, end),
        "busiest_events": interval.busiest_events(h.samples, start, end),
        "busiest_tablets": interval.busiest_tablets(h.samples, h.tablets, h.replicas, h.servers, start, end),
        "top_queries": interval.top_queries(h.samples, h.queries, start, end, background="000"),
        "top_query_per_rr": interval.top_query_per_rr(h.samples, h.queries, start, end, background="000"),
        "top_query_per_pid": interval.top_query_per_pid(h.samples, h.queries, start, end, background="000"),
        "slowest_queries": interval.slowest_queries(h.samples, h.queries, start, end),
    }


def session_report(h: History, pid: int, as_of, seconds: int = 3600, temporal: bool = True) -> dict[str, DataFrame]:
    """One process: its session, requests, statements, samples and the event tree. Requests are derived for this
    process only; they and their links are persisted while the parts are read. Unpersist `root_requests` and `links`
    when done."""
    rr = derive.build_root_requests(h.samples, h.sessions, as_of, seconds, pid=pid, temporal=temporal).persist()
    links = derive.build_rr_query_links(rr, h.samples, few=True).persist()
    return {
        "root_requests": rr,
        "links": links,
        "session_info": drilldown.session_info(h.sessions, pid),
        "session_rr": drilldown.session_rr(rr, h.sessions, pid),
        "session_queries": drilldown.session_queries(rr, links, h.queries, h.sessions, pid),
        "session_rr_queries": drilldown.session_rr_queries(rr, links, h.queries, h.sessions, pid),
        "session_rr_events": drilldown.session_rr_events(rr, h.samples, h.sessions, pid),
        "session_events": drilldown.session_events(rr, h.samples, h.tablets, h.queries, h.sessions, pid),
        "event_tree": tree.ordered(tree.event_tree(rr, links, h.queries, h.samples, h.tablets, h.sessions, pid)),
    }


def rr_report(h: History, root_requests: DataFrame, links: DataFrame, prefix: str) -> dict[str, DataFrame]:
    """Requests whose id starts with `prefix`."""
    rr = rr_like(root_requests, prefix)
    return {
        "rr_session": drilldown.rr_session(rr, h.sessions),
        "rr_timing": drilldown.rr_timing(rr, h.sessions),
        "rr_queries": drilldown.rr_queries(rr, links, h.queries),
        "rr_events": drilldown.rr_events(rr, h.samples),
    }


def query_report(h: History, root_requests: DataFrame, links: DataFrame, queryid: int, as_of,
                 seconds: int = 3600) -> dict[str, DataFrame]:
    """One statement: its text and the requests that ran it."""
    return {
        "query_text": drilldown.query_text(h.queries, queryid),
        "query_rrs": drilldown.query_rrs(h.queries, links, root_requests, h.samples, as_of, seconds, queryid),
    }
