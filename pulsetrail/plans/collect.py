"""Collection jobs: compositions of the state operators, each giving its tables and its counts.

A job is lazy. `Collected.counts` reports rows per step as a DataFrame; `stage` writes the tables inside a transaction and
counts what was written from the file footers, `commit` does so for a single job. `observed` holds counts for the run log
that fall out of these writes, such as lines that did not fit.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import moment, whole_seconds
from ..operators import state as st
from ..operators.joins import kv_rows, merge_columns, only_new
from ..sources.store import Transaction, VersionedTables
from ..sources.text import (counted_lines, normalise_listing, parse_kv, parse_masters, parse_server_metrics, parse_tservers,
                            parse_universe)

HOST_KEYS = {"nr_processes": "int", "master_mem": "long", "tserver_mem": "long", "disk_usage_mb": "long",
             "top_info": "string"}
METRIC_COLUMNS = ["mem_free_mb", "mem_total_mb", "mem_avail_mb", "ts_root_mem_limit_mb", "ts_root_mem_slimit_mb",
                  "ts_root_mem_cons_mb", "cpu_user", "cpu_syst", "ts_status", "ts_error"]


@dataclass
class Collected:
    """Result of one job: whole new states, rows to append, and the changed rows of each step."""

    component: str
    replace: dict[str, DataFrame] = field(default_factory=dict)
    append: dict[str, DataFrame] = field(default_factory=dict)
    steps: dict[str, DataFrame] = field(default_factory=dict)
    partitions: dict[str, list[str]] = field(default_factory=dict)
    observed: dict[str, Observation] = field(default_factory=dict)
    bucketed: dict[str, tuple[DataFrame, str, int]] = field(default_factory=dict)

    def counts(self) -> DataFrame:
        """component, step, n_rows."""
        out = None
        for name, rows in self.steps.items():
            one = rows.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(self.component).alias("component"), F.lit(name).alias("step"), "n_rows")
            out = one if out is None else out.unionByName(one)
        return out


def run_log_row(spark: SparkSession, component: str, host: str, logged_dt, ela_ms: float,
                counts: dict[str, int]) -> DataFrame:
    """One run-log row; the text lists each step with its number of rows."""
    info = ", ".join(f"{step}: {n}" for step, n in counts.items()) + "."
    return spark.range(1).select(moment(logged_dt).alias("logged_dt"), F.lit(host).alias("log_host"),
                                 F.lit(component).alias("component"), F.lit(round(ela_ms, 3)).alias("ela_ms"),
                                 F.lit(info).alias("info_txt"))


def stage(result: Collected, tx: Transaction, host: str, as_of, batch: int | None = None) -> tuple[dict[str, int], DataFrame]:
    """Write a job's tables inside a transaction. Returns the rows written per table and the job's run-log row."""
    started, written = time.monotonic(), {}
    for name, df in [*result.append.items(), *result.replace.items()]:
        if name in result.replace:
            rows = tx.replace(name, df, batch, component=result.component)
        else:
            rows = tx.add(name, df, batch, result.partitions.get(name, ()), component=result.component)
        written[name] = rows.count()
    for name, (df, key, buckets) in result.bucketed.items():
        tx.replace_bucketed(name, df, key, buckets)
    notes = {f"{name} {what}": n for name, seen in result.observed.items() for what, n in seen.get.items()}
    elapsed = (time.monotonic() - started) * 1000
    return written, run_log_row(tx.spark, result.component, host, as_of, elapsed, {**written, **notes})


def commit(result: Collected, tables: VersionedTables, host: str, as_of, batch: int | None = None) -> dict[str, int]:
    """Write a job's tables and its run-log row, published together; returns the rows written per table. A batch that was
    written before is left as it is."""
    cycle = None if batch is None else f"{result.component}/{batch}"
    tables.refresh()
    if cycle is not None and tables.done(cycle):
        return tables.counts(cycle).get(result.component, {})
    with tables.transaction(cycle) as tx:
        written, row = stage(result, tx, host, as_of, batch)
        tx.add("run_log", row)
    return written


def collect_databases(databases: DataFrame, batch: DataFrame, as_of) -> Collected:
    rows = batch.withColumn("log_host", F.col("host")).withColumn("log_dt", moment(as_of))
    state = st.upsert_new(databases, rows, ["datid"])
    log = st.log_databases(batch, as_of)
    return Collected("databases", {"database_mst": state}, {"database_log": log},
                     {"new": only_new(state, databases, ["datid"]), "log": log})


def collect_queries(queries: DataFrame, log: DataFrame, samples: DataFrame, activity: DataFrame,
                    statements: DataFrame, as_of, seconds: int = 900, latest: DataFrame | None = None) -> Collected:
    """Statements, their texts and the counters that changed. With `latest`, the table of the newest counters, the log
    itself is not read."""
    fresh = st.new_queries(queries, samples, activity, statements, as_of, seconds)
    state = st.extended(queries, fresh)
    changed = st.log_statements(log, statements, as_of) if latest is None else \
        st.changed_statements(latest, statements, as_of)
    kept = {} if latest is None else {
        "statement_latest": (st.merge_latest(latest, statements), st.LATEST_KEY, st.LATEST_BUCKETS)}
    return Collected("queries", {"query_mst": st.fill_query_text(state, statements, as_of)}, {"query_log": changed},
                     {**{source: fresh.filter(F.col("source") == source) for source in st.SOURCES},
                      "filled": state.filter(st.blank_recent(state, as_of, 3600)), "log": changed}, bucketed=kept)


def collect_sessions(sessions: DataFrame, activity: DataFrame, samples: DataFrame, as_of,
                     gone: DataFrame | None = None, reporting: DataFrame | None = None,
                     written: Callable[[DataFrame], DataFrame] = lambda df: df) -> Collected:
    """Open, guess from samples, close, log: in this order. Guessed sessions are not in the export, so they are
    closed in the same run and only re-open once an export confirms them.

    With closed sessions kept apart in `gone`, `sessions` holds the open ones only: they alone are rewritten. One pass
    decides all four (`session_moves`); `written` stores it, so that its tables are split from it without another pass.
    """
    moves = written(st.session_moves(sessions, activity, samples, as_of, gone, reporting, written))
    state = moves.filter(F.col("move") != st.APART).select(*sessions.columns)
    log = moves.filter(F.col("logged").isNotNull()).select(F.col("id").alias("sess_id"), "logged.*")
    return Collected("sessions", {"session_mst": state}, {"session_log": log},
                     {"activity": moves.filter(F.col("move") == st.OPENED),
                      "samples": moves.filter(F.col("move") == st.GUESSED),
                      "closed": state.filter(F.col("gone_dt") == moment(as_of)), "log": log})


def host_metrics(kv: DataFrame, local_tablets: DataFrame, by=("host",), repeats: Observation | None = None) -> DataFrame:
    """One row per host (and export, with more columns in `by`) with the number of tablets the host holds. `repeats` takes
    the number of keys that were given more than once."""
    tablets = local_tablets.groupBy(F.col("host").alias("__host")).agg(F.count(F.lit(1)).alias("nr_local_tablets"))
    rows = kv_rows(kv, HOST_KEYS, by)
    if repeats is not None:
        rows = rows.observe(repeats, F.coalesce(F.sum("n_repeated"), F.lit(0)).alias("repeated"))
    rows = rows.drop("n_repeated")
    joined = rows.join(tablets, rows["host"] == tablets["__host"], "left").drop("__host")
    return joined.withColumn("nr_local_tablets", F.coalesce("nr_local_tablets", F.lit(0)))


def collect_hosts(lines: DataFrame, local_tablets: DataFrame, by=("host",)) -> Collected:
    """Host rows. Lines that do not fit and keys given more than once are counted as the rows are written."""
    seen, repeats = Observation(), Observation()
    kv = parse_kv(counted_lines(lines, "kv", seen))
    rows = host_metrics(kv, local_tablets, by, repeats)
    return Collected("hosts", append={"host_log": rows}, steps={"log": rows},
                     observed={"host": seen, "keys": repeats})


def collect_tablets(tablets: DataFrame, replicas: DataFrame, local: DataFrame, as_of,
                    reporting: DataFrame | None = None) -> Collected:
    opened = st.open_tablets(tablets, local, as_of)
    tracked = st.track_replicas(replicas, local, as_of, reporting)
    state = st.close_tablets(st.extended(tablets, opened), tracked, as_of)
    now = moment(as_of)
    return Collected("tablets", {"tablet_mst": state, "tablet_rep": tracked}, {}, {
        "m_created": opened, "r_created": tracked.filter(F.col("log_dt") == now),
        "r_gone": tracked.filter(F.col("gone_dt") == now), "m_gone": state.filter(F.col("gone_dt") == now)})


def collect_samples(log: DataFrame, batch: DataFrame) -> Collected:
    rows = st.load_samples(log, batch)
    return Collected("samples", append={"sample_log": rows}, steps={"log": rows})


def collect_events(events: DataFrame, samples: DataFrame, as_of) -> Collected:
    found = st.upsert_events(events, samples, as_of)
    return Collected("events", {"event_mst": st.extended(events, found)}, {}, {"new": found})


def snapshot_header(snapshots: DataFrame, host: str, as_of, minimum_age: int = 180) -> DataFrame:
    """Header row of the next snapshot; none while the last one is younger than `minimum_age` seconds."""
    last = snapshots.agg(F.max("id").alias("last_id"), F.max("log_dt").alias("last_dt"))
    age = whole_seconds(F.col("last_dt"), moment(as_of))
    return (last.filter(F.coalesce(age >= minimum_age, F.lit(True)))
            .select((F.coalesce("last_id", F.lit(0)) + 1).alias("id"), moment(as_of).alias("log_dt"),
                    F.lit(host).alias("log_host")))


def first_seen(master: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """One row per unknown server: the listing of the earliest snapshot that shows it."""
    others = [c for c in ("snap_id", "host", "port") if c != key]
    first = (rows.groupBy(key).agg(F.min(F.struct(*others)).alias("__f"))
             .select(key, *[F.col(f"__f.{c}").alias(c) for c in others]))
    return only_new(first, master, [key])


def collect_snapshot(masters: DataFrame, servers: DataFrame, master_lines: DataFrame, server_lines: DataFrame,
                     universe_lines: DataFrame, metrics: DataFrame) -> Collected:
    """Listings of one or more snapshots (lines carry `snap_id`): first-seen servers, a log row per server and
    snapshot with its metrics merged in, and the universe document."""
    seen = {"masters": Observation(), "servers": Observation()}
    master_log = parse_masters(normalise_listing(counted_lines(master_lines, "listing", seen["masters"])))
    server_rows = parse_tservers(normalise_listing(counted_lines(server_lines, "listing", seen["servers"])))
    server_log = merge_metrics(server_rows, metrics)
    universe_log = parse_universe(universe_lines)
    new_masters = first_seen(masters, master_log, "mast_uuid")
    new_servers = first_seen(servers, server_rows, "tsrv_uuid")
    return Collected("snapshot", {"master_mst": st.extended(masters, new_masters),
                                  "tserver_mst": st.extended(servers, new_servers)},
                     {"master_log": master_log, "tserver_log": server_log, "universe_log": universe_log},
                     {"universe": universe_log, "new_masters": new_masters, "masters": master_log,
                      "new_servers": new_servers, "servers": server_log}, observed=seen)


def merge_metrics(log: DataFrame, metrics: DataFrame) -> DataFrame:
    """Server metrics merged into the rows of the same snapshot and server."""
    return merge_columns(log, parse_server_metrics(metrics), ["tsrv_uuid", "snap_id"], METRIC_COLUMNS)
