"""Drill-downs: one session (by process id), one request (by id prefix) or one statement.

Leaving the selector out reports on all of them at once, with the selector as an extra column; ordering columns
inside a session never cross into another one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (clock, clock_ms, clock_ms_dashed, day_clock, millis_truncated, rr_key, seconds3)
from ..operators.filters import lookback, only_pid, rr_like
from ..operators.joins import attach_tablet, join_query, of_days, samples_of, splittable
from ..operators.windows import blank_repeat, neighbours
from .derive import rr_view


def _client():
    return F.substring(F.concat(F.col("client_addr"), F.lit(":"), F.col("client_port").cast("string")), 1, 25)


def _requests_of(root_requests: DataFrame, sessions: DataFrame, pid: int | None) -> DataFrame:
    """Requests with pid and start of their session."""
    owner = only_pid(sessions, pid).select(F.col("id").alias("__sess"), "pid", "backend_start")
    return root_requests.join(owner, root_requests["sess_id"] == owner["__sess"], "inner").drop("__sess")


# ---- by session -------------------------------------------------------------------------------------------

def session_info(sessions: DataFrame, pid: int | None = None) -> DataFrame:
    return only_pid(sessions, pid).select(
        F.col("id").alias("sess_id"), "host", "pid", "app_name", _client().alias("client_info"),
        clock(F.col("backend_start")).alias("sess_start"),
        seconds3(F.col("backend_start"), F.col("gone_dt")).alias("dur_secs"))


def session_rr(root_requests: DataFrame, sessions: DataFrame, pid: int | None = None) -> DataFrame:
    """Requests of a session: seconds into the session and duration."""
    return (_requests_of(root_requests, sessions, pid)
            .orderBy("pid", "rr_min_dt", "rr_uuid")
            .select("pid", F.substring("rr_uuid", 1, 8).alias("rr_short"), "rr_uuid",
                    clock(F.col("rr_min_dt")).alias("rr_start"),
                    seconds3(F.col("backend_start"), F.col("rr_min_dt")).alias("secs_in"),
                    seconds3(F.col("rr_min_dt"), F.col("rr_max_dt")).alias("rr_duration_s")))


def session_queries(root_requests: DataFrame, links: DataFrame, queries: DataFrame, sessions: DataFrame,
                    pid: int | None = None) -> DataFrame:
    """Statements of a session, in order of first occurrence."""
    requests = _requests_of(root_requests, sessions, pid).select(F.col("rr_uuid").alias("__rr"), "pid")
    per_query = (links.join(requests, links["rr_uuid"] == requests["__rr"], "inner")
                 .groupBy("pid", "queryid")
                 .agg(F.count(F.lit(1)).alias("nr_of_rr"), F.min("qurr_start_dt").alias("first"),
                      F.sum("dur_ms").alias("total_ms")))
    return (join_query(per_query, queries, "queryid")
            .orderBy("pid", "first", "queryid")
            .select("pid", "queryid", "query", "nr_of_rr", clock_ms(F.col("first")).alias("first_occ"), "total_ms"))


def session_rr_queries(root_requests: DataFrame, links: DataFrame, queries: DataFrame, sessions: DataFrame,
                       pid: int | None = None) -> DataFrame:
    """Time line of statements: a repeated request id is blanked, `lag_ms` is the gap to the next statement."""
    requests = _requests_of(root_requests, sessions, pid).select(F.col("rr_uuid").alias("__rr"), "sess_id", "pid")
    line = (links.join(requests, links["rr_uuid"] == requests["__rr"], "inner").drop("__rr"))
    line = join_query(line, queries, "queryid")
    ties = ["rr_uuid", "queryid"]
    line = neighbours(line, ["sess_id"], "qurr_start_dt", ties, before={"rr_uuid": "rr_before"},
                      after={"qurr_start_dt": "next_start"})
    shown = blank_repeat("rr_uuid", "rr_before", F.substring("rr_uuid", 1, 4))
    return (line.orderBy("pid", "sess_id", "qurr_start_dt", *ties)
            .select("pid", shown.alias("rr_uuid"), clock_ms(F.col("qurr_start_dt")).alias("qury_started"),
                    "queryid", millis_truncated(F.col("qurr_start_dt"), F.col("next_start")).alias("lag_ms"),
                    "dur_ms", "query"))


def session_rr_events(root_requests: DataFrame, samples: DataFrame, sessions: DataFrame,
                      pid: int | None = None) -> DataFrame:
    """All samples of a session's requests, whichever node took them."""
    samples = of_days(samples, root_requests)
    requests = _requests_of(root_requests, sessions, pid).select("rr_uuid", F.col("pid").alias("session_pid"))
    return (samples.join(requests, samples["root_request_id"] == requests["rr_uuid"], "inner")
            .orderBy("session_pid", "sample_time", "sample_id")
            .select(F.col("session_pid").alias("pid"), F.substring("rr_uuid", 1, 8).alias("rr_uuid"),
                    clock_ms_dashed(F.col("sample_time")).alias("sample_tim"), "host", "wait_event", "query_id"))


def session_events(root_requests: DataFrame, samples: DataFrame, tablets: DataFrame, queries: DataFrame,
                   sessions: DataFrame, pid: int | None = None, enabled: bool = True) -> DataFrame:
    """Samples of a session with table name; samples from a remote call carry a ` L ` mark. Switched off, the
    filter folds to nothing before any scan."""
    samples = of_days(samples, root_requests)
    requests = _requests_of(root_requests, sessions, pid).select(
        "sess_id", F.col("pid").alias("session_pid"), "rr_uuid")
    known = queries.select(F.col("queryid").alias("__q"))
    rows = samples.filter(F.lit(enabled))
    rows = (rows.join(requests, rows["root_request_id"] == requests["rr_uuid"], "inner"))
    rows = rows.join(known, rows["query_id"] == known["__q"], "left_semi")
    rows = attach_tablet(rows, tablets, "left")
    rows = neighbours(rows, ["sess_id"], "sample_time", ["sample_id"], before={"rr_uuid": "rr_before"}, unit="minute")
    shown = blank_repeat("rr_uuid", "rr_before", F.substring("rr_uuid", 1, 8))
    mark = F.when(F.col("rpc_request_id") == 0, F.col("host")).otherwise(F.concat(F.lit(" L "), F.col("host")))
    return (rows.orderBy("session_pid", "sess_id", "sample_time", "sample_id")
            .select(F.col("session_pid").alias("pid"), shown.alias("rr_uuid"),
                    clock_ms(F.col("sample_time")).alias("time_ms"),
                    F.concat(mark, F.lit("     "), F.substring("wait_event", 1, 15)).alias("event"),
                    "table_name", F.substring("wait_event_aux", 1, 12).alias("ev_aux"),
                    F.col("rpc_request_id").alias("rpc_r_id")))


# ---- by request -------------------------------------------------------------------------------------------

def rr_session(root_requests: DataFrame, sessions: DataFrame, prefix: str | None = None) -> DataFrame:
    view = rr_like(rr_view(root_requests, sessions), prefix)
    return view.select("rr_uuid", "sess_id", "host", "app_name", _client().alias("client_info"),
                       day_clock(F.col("backend_start")).alias("sess_start"),
                       day_clock(F.col("gone_dt")).alias("backend_end"),
                       seconds3(F.col("backend_start"), F.col("gone_dt")).alias("dur_secs"))


def rr_timing(root_requests: DataFrame, sessions: DataFrame, prefix: str | None = None) -> DataFrame:
    view = rr_like(rr_view(root_requests, sessions), prefix)
    return view.select(F.col("id").alias("rr_id"), "host", "rr_uuid", clock(F.col("rr_min_dt")).alias("rr_start"),
                       seconds3(F.col("backend_start"), F.col("rr_min_dt")).alias("secs_into_sess"),
                       F.col("dur_ms").alias("rr_duration_ms"))


def rr_queries(root_requests: DataFrame, links: DataFrame, queries: DataFrame, prefix: str | None = None) -> DataFrame:
    requests = rr_like(root_requests, prefix).select(F.col("rr_uuid").alias("__rr"))
    found = links.join(requests, links["rr_uuid"] == requests["__rr"], "inner")
    return join_query(found, queries, "queryid").select("rr_uuid", "queryid", "query")


def rr_events(root_requests: DataFrame, samples: DataFrame, prefix: str | None = None) -> DataFrame:
    samples = of_days(samples, root_requests)
    requests = rr_like(root_requests, prefix).select("rr_uuid")
    return (samples.join(requests, samples["root_request_id"] == requests["rr_uuid"], "inner")
            .orderBy("rr_uuid", "sample_time", "sample_id")
            .select("rr_uuid", clock_ms_dashed(F.col("sample_time")).alias("sample_tim"), "host", "wait_event",
                    "query_id"))


# ---- by statement -----------------------------------------------------------------------------------------

def query_rrs(queries: DataFrame, links: DataFrame, root_requests: DataFrame, samples: DataFrame, as_of,
              seconds: int = 3600, queryid: int | None = None) -> DataFrame:
    """Requests of a statement. `cnt_ash` counts all samples of the request, whatever statement they belong to."""
    samples = of_days(samples, root_requests)
    if queryid is not None:
        queries, links = queries.filter(F.col("queryid") == queryid), links.filter(F.col("queryid") == queryid)
        samples = samples_of(samples, links)
    recent = lookback(root_requests, "rr_min_dt", as_of, seconds).select("rr_uuid", "rr_min_dt", "rr_max_dt")
    sizes = samples.groupBy("root_request_id").agg(F.count(F.lit(1)).alias("cnt_ash"))
    found = recent.join(sizes, recent["rr_uuid"] == sizes["root_request_id"], "inner").drop("root_request_id")
    known = queries.select(F.col("queryid").alias("__q"))
    used = (links.join(known, links["queryid"] == known["__q"], "left_semi")
            .select("queryid", F.col("rr_uuid").alias("__rr")))
    return (used.join(found, splittable(used, found, {"__rr": "rr_uuid"}), "inner")
            .orderBy("queryid", "rr_min_dt", "rr_uuid")
            .select("queryid", F.substring("rr_uuid", 1, 8).alias("root_req"), rr_key(F.col("rr_uuid")).alias("rr_id"),
                    clock_ms(F.col("rr_min_dt")).alias("st_time"),
                    seconds3(F.col("rr_min_dt"), F.col("rr_max_dt")).alias("nr_seconds"), "cnt_ash"))


def query_text(queries: DataFrame, queryid: int | None = None) -> DataFrame:
    if queryid is None:
        return queries.select("queryid", "query")
    return queries.filter(F.col("queryid") == queryid).select("query")
