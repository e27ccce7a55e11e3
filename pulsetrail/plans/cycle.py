"""One collection cycle: every export into its history tables, in the order the tables depend on each other.

Rows of validity tables never change once closed. They are kept in two parts: the open rows, rewritten by each
cycle, and the closed ones, to which each cycle appends what it closed. A cycle writes what is alive or new, not
the history; `validity_table` reads both parts as one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import moment
from ..operators import state as st
from ..operators.filters import lookback
from ..schemas import TABLES
from ..sources.seeds import seed_queries
from ..sources.store import VersionedTables
from . import collect, derive

# natural keys behind the display numbers of append-only tables
_NUMBERED = {"database_log": ["datid", "log_host", "log_dt"], "query_log": [*st.STATEMENT_KEY, "log_dt"],
             "event_mst": ["wait_event_component", "wait_event"], "run_log": ["logged_dt", "log_host", "component"]}
SAMPLE_LOG = T.StructType([*TABLES["sample_log"].fields, T.StructField("day", T.DateType())])


VALIDITY = ["session_mst", "tablet_mst", "tablet_rep"]


def _closed(tables: VersionedTables, name: str) -> DataFrame:
    return tables.read_all(f"{name}_closed", TABLES[name])


def validity_table(tables: VersionedTables, name: str) -> DataFrame:
    """Open and closed rows of a session, tablet or replica table."""
    return tables.read(name, TABLES[name]).unionByName(_closed(tables, name))


def split_closed(result: collect.Collected) -> None:
    """Let closed rows be appended instead of rewritten. The job saw open rows only, so these are new."""
    for name in VALIDITY:
        if name in result.replace:
            state = result.replace[name]
            result.replace[name] = state.filter(F.col("gone_dt").isNull())
            result.append[f"{name}_closed"] = state.filter(F.col("gone_dt").isNotNull())


@dataclass
class Exports:
    """The exported statistics of one collection. Each frame carries `host` and `tsrv_uuid`; `reporting` lists the
    nodes that took part, also those with nothing to show."""

    databases: DataFrame
    local_tablets: DataFrame
    activity: DataFrame
    statements: DataFrame
    samples: DataFrame
    host_lines: DataFrame | None = None
    reporting: DataFrame | None = None
    listings: Listings | None = None


@dataclass
class Listings:
    """What the admin tool says of one moment: lines (`host`, `line`) of the master and server listings, universe
    documents (`slurp`) and server metrics."""

    masters: DataFrame
    servers: DataFrame
    universe: DataFrame
    metrics: DataFrame


def conform(df: DataFrame, name: str) -> DataFrame:
    """Columns and types as declared for the table, NULL where the job has no value."""
    schema = SAMPLE_LOG if name == "sample_log" else TABLES[name.removesuffix("_closed")]
    if name in _NUMBERED:
        df = st.with_key(df, _NUMBERED[name])
    if name == "sample_log":
        df = df if "sample_id" in df.columns else st.with_key(df, st.SAMPLE_KEY, "sample_id")
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema])


def _queries(tables: VersionedTables, as_of) -> DataFrame:
    """The statement dimension; a new one starts with the background statements."""
    known = tables.read("query_mst", TABLES["query_mst"])
    if tables.latest("query_mst") is None:
        known = st.extended(known, seed_queries(tables.spark).withColumn("log_dt", moment(as_of)))
    return known


LATEST_SCHEMA = T.StructType([T.StructField(st.LATEST_KEY, T.StringType()), T.StructField("calls", T.LongType()),
                              T.StructField("rows", T.LongType())])


def _latest_statements(tables: VersionedTables) -> DataFrame:
    """The newest counters of each statement; of a log that has no such table, its newest rows."""
    if tables.latest("statement_latest") is None:
        return st.latest_statements(tables.read_all("query_log", TABLES["query_log"]))
    return tables.read_bucketed("statement_latest", LATEST_SCHEMA, st.LATEST_KEY, st.LATEST_BUCKETS)


def run_cycle(tables: VersionedTables, exports: Exports, host: str, as_of,
              cycle: str | None = None) -> dict[str, dict[str, int]]:
    """Run all collectors and publish their tables in one commit; returns the rows written per job and table.

    `cycle` names the collection, by default with host and moment. A cycle that was published is not run again, and one
    that failed has changed nothing, so it can be repeated as it is.
    """
    cycle = cycle or f"{host} at {as_of}"
    tables.refresh()
    if tables.done(cycle):
        return tables.counts(cycle)
    read = lambda name: tables.read(name, TABLES[name])

    def samples() -> collect.Collected:
        log = tables.read_all("sample_log", SAMPLE_LOG, days=st.days_of(exports.samples))
        result = collect.collect_samples(log, exports.samples)
        result.append["sample_log"] = result.append["sample_log"].withColumn("day", F.to_date("sample_time"))
        result.partitions["sample_log"] = ["day"]
        return result

    jobs = [
        lambda: collect.collect_databases(read("database_mst"), exports.databases, as_of),
        lambda: collect.collect_tablets(read("tablet_mst"), read("tablet_rep"), exports.local_tablets, as_of,
                                        exports.reporting),
        lambda: collect.collect_sessions(read("session_mst"), exports.activity, exports.samples, as_of,
                                         _closed(tables, "session_mst"), exports.reporting, tx.scratch),
        lambda: collect.collect_queries(_queries(tables, as_of), tables.read_all("query_log", TABLES["query_log"]),
                                        exports.samples, exports.activity, exports.statements, as_of,
                                        latest=_latest_statements(tables)),
        samples,
        lambda: collect.collect_events(read("event_mst"), exports.samples, as_of),
    ]
    if exports.host_lines is not None:
        jobs.append(lambda: _hosts(exports, as_of))
    if exports.listings is not None:
        jobs.append(lambda: _snapshot(tables, exports.listings, host, as_of))
    written, log = {}, None
    with tables.transaction(cycle) as tx:
        for job in jobs:
            result = job()
            if result is None:
                continue
            split_closed(result)
            result.replace = {name: conform(df, name) for name, df in result.replace.items()}
            result.append = {name: conform(df, name) for name, df in result.append.items()}
            written[result.component], row = collect.stage(result, tx, host, as_of)
            log = row if log is None else log.unionByName(row)
        tx.add("run_log", conform(log, "run_log"))
    return written


REQUEST_SCHEMA = "sess_id long, rr_uuid string, rr_min_dt timestamp_ntz, rr_max_dt timestamp_ntz"
LINK_SCHEMA = "rr_uuid string, queryid long, qurr_start_dt timestamp_ntz, qurr_end_dt timestamp_ntz"


def run_derive(tables: VersionedTables, host: str, as_of, seconds: int = 3600, batch: int | None = None) -> dict[str, int]:
    """Derive requests and links from the samples of the look-back and the stored sessions. A run appends the spans it
    saw, in its own batch; `requests` and `links` fold them, so later runs widen what earlier ones found. Running a batch
    again replaces it. Returns the rows appended."""
    samples = tables.read_all("sample_log", SAMPLE_LOG)
    found = derive.build_root_requests(samples, validity_table(tables, "session_mst"), as_of, seconds).persist()
    recent = lookback(samples, "sample_time", as_of, seconds)
    result = collect.Collected("derive", append={"root_request_mst": found,
                                                 "root_request_query_lnk": derive.link_spans(found, recent)})
    try:
        return collect.commit(result, tables, host, as_of, batch)
    finally:
        found.unpersist()


def requests(tables: VersionedTables) -> DataFrame:
    """Root requests as of the last derivation."""
    spans = tables.read_all("root_request_mst", _parsed(REQUEST_SCHEMA))
    return derive.extend_root_requests(spans, spans.limit(0))


def links(tables: VersionedTables) -> DataFrame:
    """Statements in requests as of the last derivation."""
    spans = tables.read_all("root_request_query_lnk", _parsed(LINK_SCHEMA))
    return derive.link_durations(derive.merge_links(spans, spans.limit(0)))


def _parsed(columns: str) -> T.StructType:
    kinds = {"long": T.LongType(), "string": T.StringType(), "timestamp_ntz": T.TimestampNTZType()}
    return T.StructType([T.StructField(n, kinds[k]) for n, k in (c.split(" ") for c in columns.split(", "))])


def _snapshot(tables: VersionedTables, listings: Listings, host: str, as_of) -> collect.Collected | None:
    """The snapshot job behind its gate: nothing while the last snapshot is too young."""
    header = collect.snapshot_header(tables.read_all("snapshot_log", TABLES["snapshot_log"]), host, as_of).first()
    if header is None:
        return None
    told = {"snap_id": F.lit(header.id).cast("long"), "log_dt": moment(as_of), "log_host": F.lit(host)}
    of_now = lambda df: df.withColumns(told)
    result = collect.collect_snapshot(
        tables.read("master_mst", TABLES["master_mst"]), tables.read("tserver_mst", TABLES["tserver_mst"]),
        of_now(listings.masters.drop("host")), of_now(listings.servers.drop("host")), of_now(listings.universe),
        of_now(listings.metrics).drop("log_dt", "log_host"))
    result.append["snapshot_log"] = tables.spark.range(1).select(
        told["snap_id"].alias("id"), *[c.alias(n) for n, c in told.items() if n != "snap_id"])
    return result


def _hosts(exports: Exports, as_of) -> collect.Collected:
    result = collect.collect_hosts(exports.host_lines, exports.local_tablets)
    result.append["host_log"] = st.with_key(result.append["host_log"].withColumn("log_dt", moment(as_of)),
                                            ["host", "log_dt"])
    return result
