"""Dashboard queries: wait types per minute, server load side by side, counter deltas, freshness."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import mega, moment, truncated, whole_seconds
from ..operators.aggregates import scalar_or_default, top_k
from ..operators.filters import parse_moment
from ..operators.joins import snapshot_wide
from ..operators.windows import counter_delta

WAIT_TYPES = {"timeout": "Timeout", "network": "Network", "disk_io": "DiskIO",
              "wait_on_condition": "WaitOnCondition", "io": "IO", "client": "Client"}
CPU_EVENTS = {"cpu_active": "OnCpu_Active", "cpu_passive": "OnCpu_Passive"}


def wait_type_columns() -> list:
    """Conditional counts per wait type; also used on streams, where a pivot is not allowed."""
    plain = [F.count_if(F.col("wait_event_type") == kind).alias(name) for name, kind in WAIT_TYPES.items()]
    cpu = [F.count_if((F.col("wait_event_type") == "Cpu") & (F.col("wait_event") == event)).alias(name)
           for name, event in CPU_EVENTS.items()]
    return plain + cpu


def wait_type_per_minute(samples: DataFrame) -> DataFrame:
    return (samples.groupBy(truncated(samples, "sample_time", "minute").alias("dt"))
            .agg(*wait_type_columns()).orderBy("dt"))


def tserver_rw_wide(snapshots: DataFrame, log: DataFrame, hosts: Sequence[str]) -> DataFrame:
    return snapshot_wide(snapshots, log, hosts, {"rd_psec": "rds", "wr_psec": "wrs"})


def tserver_cpu_wide(snapshots: DataFrame, log: DataFrame, hosts: Sequence[str]) -> DataFrame:
    return snapshot_wide(snapshots, log, hosts, {"cpu_user": "usr", "cpu_syst": "sys"})


def snapshot_freshness(snapshots: DataFrame, as_of, minimum_age: int = 180) -> DataFrame:
    """Seconds since the last snapshot and whether that is too recent for another one. No snapshot yet
    counts as one 3601 seconds ago."""
    now = parse_moment(as_of)
    last = scalar_or_default(snapshots, "log_dt", moment(now - dt.timedelta(seconds=3601)), "last_snap")
    return (last.select(whole_seconds(F.col("last_snap"), moment(now)).alias("ela_sec"))
            .withColumn("nogo", F.col("ela_sec") < minimum_age))


def database_counter_delta(log: DataFrame, host: str | None = None, datid: int | None = None,
                           k: int = 100) -> DataFrame:
    """Growth of the database counters from one collection to the next, latest `k` rows."""
    if host is not None:
        log = log.filter(F.col("log_host") == host)
    if datid is not None:
        log = log.filter(F.col("datid") == datid)
    moved = counter_delta(log, ["log_host", "datid"], "log_dt",
                          {"sessions": "delta_sess", "tup_returned": "delta_tup_ret", "temp_bytes": "delta_temp"},
                          unit="day")
    out = moved.select("datid", "log_host", "log_dt", "sessions", "delta_sess", "delta_tup_ret",
                       mega(F.col("delta_temp")).alias("delta_temp_mb"), "tup_returned", "temp_bytes")
    return top_k(out, [F.desc("log_dt"), F.col("log_host"), F.col("datid")], k)
