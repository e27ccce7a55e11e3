"""Root requests and the statements inside them, derived from samples.

Samples are folded to one row per (node, process, request) or (request, statement) before they meet sessions
or requests; the request id is the join key, a number derived from it is for display only.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import millis_rounded, rr_key
from ..operators.aggregates import merge_spans, span
from ..operators.filters import BACKGROUND_PREFIX, foreground, lookback, no_ghosts, only_pid, parse_moment
from ..operators.joins import attach_session, of_days, only_new, samples_of


def build_root_requests(samples: DataFrame, sessions: DataFrame, as_of, seconds: int = 3600,
                        known: DataFrame | None = None, prefix: str = BACKGROUND_PREFIX, pid: int | None = None,
                        temporal: bool = True) -> DataFrame:
    """First and last sample of every foreground request, per session: sess_id, rr_uuid, rr_min_dt, rr_max_dt.

    Samples match the session of their node and process id that was alive then. Without `temporal` they match every
    session that ever had this process id: one row per session, for single processes that are not re-used. Requests in
    `known` are left out.
    """
    rows = only_pid(foreground(lookback(samples, "sample_time", as_of, seconds), prefix), pid)
    owners = only_pid(no_ghosts(sessions), pid)
    if temporal:
        since = parse_moment(as_of) - dt.timedelta(seconds=seconds)
        matched = attach_session(rows, owners, time="sample_time", as_of=as_of, since=since)
        spans = span(matched, ["sess_id", "root_request_id"], "sample_time", "lo", "hi")
    else:
        keys = ["top_level_node_id", "pid", "root_request_id"]
        spans = attach_session(span(rows, keys, "sample_time", "lo", "hi"), owners)
    out = spans.select("sess_id", F.col("root_request_id").alias("rr_uuid"),
                       F.col("lo").alias("rr_min_dt"), F.col("hi").alias("rr_max_dt"))
    return out if known is None else only_new(out, known, ["sess_id", "rr_uuid"])


def build_rr_query_links(root_requests: DataFrame, samples: DataFrame, known: DataFrame | None = None,
                         few: bool = False, counted: bool = False) -> DataFrame:
    """Statements seen in each request, with first sample and duration in ms: rr_uuid, queryid, qurr_start_dt, dur_ms;
    with `counted`, also the number of samples, n_samples.

    By default all samples are folded before the requests select among the folds. With `few` requests (one
    process, say) they select the samples first.
    """
    samples = of_days(samples, root_requests)
    if few:
        samples = samples_of(samples, root_requests)
    spans = span(samples.filter(F.col("query_id").isNotNull()), ["root_request_id", "query_id"],
                 "sample_time", "lo", "hi", "n_samples" if counted else None)
    out = (samples_of(spans, root_requests)
           .select(F.col("root_request_id").alias("rr_uuid"), F.col("query_id").alias("queryid"),
                   F.col("lo").alias("qurr_start_dt"), millis_rounded(F.col("lo"), F.col("hi")).alias("dur_ms"),
                   *(["n_samples"] if counted else [])))
    return out if known is None else only_new(out, known, ["rr_uuid", "queryid"])


def link_spans(root_requests: DataFrame, samples: DataFrame) -> DataFrame:
    """First and last sample of each statement in each request: rr_uuid, queryid, qurr_start_dt, qurr_end_dt. Spans of
    parts of the samples can be merged, durations cannot."""
    seen = of_days(samples, root_requests).filter(F.col("query_id").isNotNull())
    spans = span(seen, ["root_request_id", "query_id"], "sample_time", "qurr_start_dt", "qurr_end_dt")
    return samples_of(spans, root_requests).select(F.col("root_request_id").alias("rr_uuid"),
                                                   F.col("query_id").alias("queryid"), "qurr_start_dt", "qurr_end_dt")


def merge_links(known: DataFrame, batch: DataFrame) -> DataFrame:
    """Link spans widened by those of a later batch, plus the new ones."""
    return merge_spans(known, batch, ["rr_uuid", "queryid"], "qurr_start_dt", "qurr_end_dt")


def link_durations(spans: DataFrame) -> DataFrame:
    """Links as reports read them: the duration in ms follows from the span."""
    return spans.select("rr_uuid", "queryid", "qurr_start_dt",
                        millis_rounded(F.col("qurr_start_dt"), F.col("qurr_end_dt")).alias("dur_ms"))


def extend_root_requests(known: DataFrame, batch: DataFrame) -> DataFrame:
    """Known requests widened by the spans of a later batch, plus the new ones."""
    return merge_spans(known, batch, ["sess_id", "rr_uuid"], "rr_min_dt", "rr_max_dt")


def rr_view(root_requests: DataFrame, sessions: DataFrame) -> DataFrame:
    """Requests with their session and duration in ms."""
    owner = sessions.select(F.col("id").alias("__sess"), "tsrv_uuid", "pid", "backend_start", "host", "app_name",
                            "client_addr", "client_port", "gone_dt")
    micros = F.timestamp_diff("MICROSECOND", F.col("rr_min_dt"), F.col("rr_max_dt"))
    return (root_requests.join(owner, root_requests["sess_id"] == owner["__sess"], "inner")
            .withColumn("id", rr_key(F.col("rr_uuid")))
            .withColumn("dur_ms", micros / F.lit(1000.0))
            .select("sess_id", "tsrv_uuid", "pid", "backend_start", "host", "id", "rr_uuid", "rr_min_dt",
                    "rr_max_dt", "dur_ms", "app_name", "client_addr", "client_port", "gone_dt"))
