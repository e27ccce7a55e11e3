"""Interval reports: what was busy between two moments. Facts are filtered and counted first; statement texts,
tablets and servers only meet the counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (hex_prefix, minute_label, moment, seconds_of_day_wrap, stamp, stamp_day_first, truncated,
                         whole_seconds)
from ..operators.aggregates import crosstab, sample_counts, span, top_k
from ..operators.filters import (BACKGROUND_PREFIX, alive, foreground, in_interval, outside_background_ids,
                                 parse_moment)
from ..operators.joins import join_query


def interval_summary(samples: DataFrame, start, end) -> DataFrame:
    """One row: the interval and its number of samples; no row when it holds none."""
    return (in_interval(samples, start, end).agg(F.count(F.lit(1)).alias("cnt_samples"))
            .filter(F.col("cnt_samples") > 0)
            .select(F.lit("report on interval :").alias("titl"),
                    stamp_day_first(moment(parse_moment(start))).alias("from_dt"),
                    stamp_day_first(moment(parse_moment(end))).alias("to_dt"), "cnt_samples"))


def minute_host_crosstab(samples: DataFrame, start, end, hosts: Sequence[str] | None = None) -> DataFrame:
    """Samples per minute label and host. Counting by minute first leaves one label to format per minute."""
    rows = in_interval(samples, start, end)
    counts = sample_counts(rows.withColumn("minute", truncated(rows, "sample_time", "minute")), ["minute", "host"])
    labelled = counts.withColumn("dt_hr", minute_label(F.col("minute")))
    return crosstab(labelled, "dt_hr", "host", "cnt", hosts).orderBy("dt_hr")


def busiest_nodes(samples: DataFrame, start, end, as_of, wrap_at_midnight: bool = False) -> DataFrame:
    rows = in_interval(samples, start, end)
    age = seconds_of_day_wrap if wrap_at_midnight else whole_seconds
    return (rows.groupBy("host")
            .agg(F.count(F.lit(1)).alias("recs_in_intrv"), F.min("sample_time").alias("first"),
                 F.max("sample_time").alias("last"))
            .select("recs_in_intrv", stamp(F.col("first")).alias("oldest_stored"),
                    stamp(F.col("last")).alias("latest_stored"),
                    age(F.col("last"), moment(parse_moment(as_of))).alias("secs_ago"), "host")
            .orderBy("host"))


def busiest_components(samples: DataFrame, start, end) -> DataFrame:
    keys = ["host", "wait_event_component", "wait_event_class"]
    return (sample_counts(in_interval(samples, start, end), keys)
            .select("cnt", "host", F.col("wait_event_component").alias("busiest_comp"), "wait_event_class")
            .orderBy(F.desc("cnt"), "host", "busiest_comp", "wait_event_class"))


def busiest_events(samples: DataFrame, start, end, k: int = 40) -> DataFrame:
    keys = ["wait_event_class", "wait_event_type", "wait_event", "host"]
    counts = sample_counts(in_interval(samples, start, end), keys)
    return (top_k(counts, [F.desc("cnt"), *map(F.col, keys)], k)
            .select("cnt", "wait_event_class", "wait_event_type", F.col("wait_event").alias("busiest_event"),
                    F.col("host").alias("per_host")))


def busiest_tablets(samples: DataFrame, tablets: DataFrame, replicas: DataFrame, servers: DataFrame, start, end,
                    k: int = 20, as_written: bool = False) -> DataFrame:
    """Tablets with the most samples, by server and table, counting open replicas on the sampled server only.

    `as_written` reproduces the historical query, which forgot to tie the replica to the tablet: each count is
    multiplied by the number of open replicas of that server. The multiplication is done as one.
    """
    hits = sample_counts(in_interval(samples, start, end).filter(F.col("wait_event_aux").isNotNull()),
                         ["tsrv_uuid", "wait_event_aux"])
    names = (tablets.select("tblt_uuid", "schema_name", "table_name").distinct()
             .withColumn("prefix", hex_prefix(F.col("tblt_uuid"))))
    found = hits.join(names, hits["wait_event_aux"] == names["prefix"], "inner").drop("prefix")
    open_replicas = alive(replicas).select("tblt_uuid", "tsrv_uuid")
    if as_written:
        per_server = open_replicas.groupBy("tsrv_uuid").agg(F.count(F.lit(1)).alias("times"))
        found = found.join(per_server, "tsrv_uuid", "inner").withColumn("cnt", F.col("cnt") * F.col("times"))
    else:
        found = found.join(open_replicas.distinct(), ["tblt_uuid", "tsrv_uuid"], "inner")
    hosts = servers.select("tsrv_uuid", F.col("host").alias("server_host"))
    keys = ["host", "wait_event_aux", "schema_name", "table_name"]
    totals = (found.join(hosts, "tsrv_uuid", "inner").withColumn("host", F.col("server_host"))
              .groupBy(*keys).agg(F.sum("cnt").alias("cnt")))
    return top_k(totals, [F.desc("cnt"), *map(F.col, keys)], k).select("cnt", *keys)


def top_queries(samples: DataFrame, queries: DataFrame, start, end, k: int = 20,
                background: str = BACKGROUND_PREFIX, approximate: bool = False) -> DataFrame:
    """Statements with the most samples and how many root requests they ran in."""
    rr = F.col("root_request_id")
    distinct = F.approx_count_distinct(rr) if approximate else F.count_distinct(rr)
    counts = (foreground(in_interval(samples, start, end), background).groupBy("query_id")
              .agg(F.count(F.lit(1)).alias("cnt_ashev"), distinct.alias("nr_rreq")))
    ranked = join_query(counts, queries)
    return (top_k(ranked, [F.desc("cnt_ashev"), F.col("query_id")], k)
            .select("cnt_ashev", "nr_rreq", F.col("query_id").alias("top_qry"), "query"))


def _top_query_per(samples, queries, start, end, k, background, key):
    counts = sample_counts(foreground(in_interval(samples, start, end), background), [key, "query_id"])
    return top_k(join_query(counts, queries), [F.desc("cnt"), F.col(key), F.col("query_id")], k)


def top_query_per_rr(samples: DataFrame, queries: DataFrame, start, end, k: int = 20,
                     background: str = BACKGROUND_PREFIX) -> DataFrame:
    top = _top_query_per(samples, queries, start, end, k, background, "root_request_id")
    return top.select("cnt", F.substring("root_request_id", 1, 9).alias("top_root_req"),
                      F.col("query_id").alias("top_qry"), "query")


def top_query_per_pid(samples: DataFrame, queries: DataFrame, start, end, k: int = 20,
                      background: str = BACKGROUND_PREFIX) -> DataFrame:
    top = _top_query_per(samples, queries, start, end, k, background, "pid")
    return top.select("cnt", F.col("pid").alias("top_pid"), F.col("query_id").alias("top_qry"), "query")


def slowest_queries(samples: DataFrame, queries: DataFrame, start, end, background: str = BACKGROUND_PREFIX,
                    id_bound: int = 100) -> DataFrame:
    """Statements seen over more than one second, longest first. Ids within +-`id_bound` are background work."""
    rows = outside_background_ids(foreground(in_interval(samples, start, end), background), bound=id_bound)
    spans = (rows.groupBy("query_id")
             .agg(F.min("sample_time").alias("first"), F.max("sample_time").alias("last"),
                  F.count(F.lit(1)).alias("nr_occ"))
             .filter(F.timestamp_diff("MICROSECOND", F.col("first"), F.col("last")) > 1_000_000)
             .withColumn("max_sec", whole_seconds(F.col("first"), F.col("last"))))
    return (join_query(spans, queries).select(F.col("query_id").alias("queryid"), "max_sec", "nr_occ", "query")
            .orderBy(F.desc("max_sec"), "queryid"))


def longest_rr_query(samples: DataFrame, background: str = BACKGROUND_PREFIX, id_bound: int = 100) -> DataFrame:
    """Time span of each (root request, statement), longest first."""
    keys = ["root_request_id", "query_id"]
    rows = outside_background_ids(foreground(samples, background), bound=id_bound)
    spans = span(rows, keys, "sample_time", "min_time", "max_time")
    micros = F.timestamp_diff("MICROSECOND", F.col("min_time"), F.col("max_time"))
    return spans.withColumn("sec", micros / F.lit(1_000_000.0)).orderBy(F.desc("sec"), *keys)


def sample_coverage(samples: DataFrame) -> DataFrame:
    """Per host the earliest and latest sample, most recent host first."""
    return (span(samples, ["host"], "sample_time", "earliest_sample", "latest_sample")
            .orderBy(F.desc("latest_sample"), "host"))
