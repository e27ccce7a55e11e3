"""Incremental table operators of the collection jobs.

Each is a pure function of the stored state and a new export; it returns the new rows (for append-only tables)
or the new state (for tables whose rows are closed or filled later). Nothing is updated in place, so the same
code serves a batch run and a stream's `foreachBatch`. Exports carry `host` and `tsrv_uuid`, so one run can
cover many nodes.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import address_part, bare_address, is_blank, moment, port_part
from ..schemas import ACTIVITY_STATE, DATABASE_COUNTERS, STATEMENT_COUNTERS
from .filters import alive, drop_noise, lookback, not_explain, parse_moment
from .joins import null_safe, only_new, renamed_keys, with_mark

SAMPLE_KEY = ["host", "sample_time", "root_request_id", "rpc_request_id", "wait_event"]
STATEMENT_KEY = ["queryid", "tsrv_uuid", "dbid", "userid", "toplevel", "rows", "calls"]
UNDETECTED = "-undetected-"


def with_defaults(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Fill missing or NULL columns, as the column defaults of a table would."""
    for name, value in defaults.items():
        df = df.withColumn(name, F.coalesce(F.col(name), value) if name in df.columns else value)
    return df


def with_key(df: DataFrame, keys: Sequence[str], name: str = "id") -> DataFrame:
    """Surrogate number from the natural key: the same on every run and every partitioning. For display and
    lookups; joins use the natural key."""
    return df.withColumn(name, F.xxhash64(*keys))


def _fill(df: DataFrame, names: Sequence[str], like: DataFrame) -> DataFrame:
    """`df` with exactly the columns of `like`, NULL where it has none."""
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(like.schema[c].dataType).alias(c)
                       for c in names])


def extended(state: DataFrame, new: DataFrame) -> DataFrame:
    return state.unionByName(_fill(new, state.columns, state))


# ---- databases --------------------------------------------------------------------------------------------

def upsert_new(master: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Master rows plus first-seen ones; one row per new key even when several nodes report it."""
    picked = [c for c in master.columns if c in batch.columns and c not in keys]
    first = batch.groupBy(*keys).agg(*[F.min(c).alias(c) for c in picked]) if picked else batch.select(*keys).distinct()
    return extended(master, only_new(first, master, keys))


def log_databases(batch: DataFrame, as_of) -> DataFrame:
    """One log row per database and node, with collection time."""
    return batch.select("datid", "tsrv_uuid", moment(as_of).alias("log_dt"), F.col("host").alias("log_host"),
                        *DATABASE_COUNTERS)


# ---- sessions ---------------------------------------------------------------------------------------------

SESSION_KEY = ["host", "pid", "backend_start"]
PROCESS_KEY = ["tsrv_uuid", "pid"]


def _exported_sessions(activity: DataFrame) -> list[Column]:
    """Columns of an exported session as an open row."""
    return [F.xxhash64(*SESSION_KEY).alias("id"), F.col("tsrv_uuid"), *[F.col(c) for c in SESSION_KEY],
            F.lit(None).cast("timestamp_ntz").alias("gone_dt"), bare_address(F.col("client_addr")).alias("client_addr"),
            *[F.col(c) for c in ("client_port", "client_hostname", "datid", "usesysid", "leader_pid")],
            F.col("application_name").alias("app_name"), F.col("backend_type")]


def open_sessions(sessions: DataFrame, activity: DataFrame) -> DataFrame:
    """New rows: exported sessions without an open row for the same host, pid and start. A closed one re-opens."""
    return only_new(activity, alive(sessions), SESSION_KEY).select(*_exported_sessions(activity))


def _guessed(samples: DataFrame) -> DataFrame:
    """Processes that samples show: the earliest sample stands in for the start, the node that took it is the host."""
    keys = ["top_level_node_id", "pid", "client_node_ip", "dbid"]
    per_host = samples.groupBy(*keys, "host").agg(F.min("sample_time").alias("first"))  # folds the samples
    return (per_host.groupBy(*keys)
            .agg(F.min("first").alias("backend_start"), F.min_by("host", F.struct("first", "host")).alias("host"))
            .withColumnRenamed("top_level_node_id", "tsrv_uuid"))


def _guessed_sessions(processes: DataFrame) -> DataFrame:
    return with_key(processes, ["tsrv_uuid", "host", "pid", "client_node_ip", "backend_start"]).select(
        "id", "tsrv_uuid", "host", F.col("pid").cast("int").alias("pid"), "backend_start",
        address_part(F.col("client_node_ip")).alias("client_addr"),
        port_part(F.col("client_node_ip")).alias("client_port"), F.col("dbid").alias("datid"))


def ghost_sessions(sessions: DataFrame, samples: DataFrame) -> DataFrame:
    """New rows guessed from samples of processes no session is known for; the user id stays unknown."""
    known = sessions.withColumn("pid", F.col("pid").cast("long"))
    return _guessed_sessions(only_new(_guessed(samples), known, PROCESS_KEY))


def close_sessions(sessions: DataFrame, activity: DataFrame, as_of,
                   hosts: DataFrame | Sequence[str] | None = None) -> DataFrame:
    """New state: open sessions of the reporting hosts that the export no longer shows get `gone_dt`. `hosts` (a frame
    with the column `host`, or names) are the reporting ones; without it, those in the export are."""
    keys = ["host", "pid", "backend_start"]
    marked = with_mark(sessions, activity, keys, "__here")
    if hosts is None:
        marked = with_mark(marked, activity, ["host"], "__reported")
    elif isinstance(hosts, DataFrame):
        marked = with_mark(marked, hosts, ["host"], "__reported")
    else:
        marked = marked.withColumn("__reported", F.col("host").isin(*hosts))
    gone = F.col("gone_dt").isNull() & F.col("__reported") & ~F.col("__here")
    return (marked.withColumn("gone_dt", F.when(gone, moment(as_of)).otherwise(F.col("gone_dt")))
            .drop("__here", "__reported"))


def _logged_state(as_of) -> list[Column]:
    """Columns of the session log that an exported row gives."""
    return [F.col("tsrv_uuid"), moment(as_of).alias("log_dt"),
            *[F.col(c) for c in ("host", "datid", "datname", "pid", "leader_pid", "usesysid", "usename", *ACTIVITY_STATE)]]


def log_sessions(activity: DataFrame, sessions: DataFrame, as_of) -> DataFrame:
    """Exported state of each session with its session id."""
    owner = sessions.select(F.col("id").alias("sess_id"), F.col("tsrv_uuid").alias("__t"), F.col("pid").alias("__p"),
                            F.col("backend_start").alias("__b"))
    joined = activity.join(owner, (activity["tsrv_uuid"] == owner["__t"]) & (activity["pid"] == owner["__p"])
                           & (activity["backend_start"] == owner["__b"]), "inner")
    return joined.select("sess_id", *_logged_state(as_of))


KEPT, CLOSED, OPENED, GUESSED, APART = "kept", "closed", "opened", "guessed", "apart"
_STORED, _EXPORTED, _SAMPLED, _HISTORY = 0, 1, 2, 3


def session_moves(sessions: DataFrame, activity: DataFrame, samples: DataFrame, as_of, gone: DataFrame | None = None,
                  hosts: DataFrame | None = None, written: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """What one export does to every session, in one pass: the columns of `sessions`, `move`, and `logged`, the exported
    state where the export shows the session.

    Stored rows, exported rows, processes guessed from samples and closed rows kept apart in `gone` become one tagged
    stream. It moves twice: by process, which tells what is guessed and what is logged, and by (host, pid, start), which
    tells what opens, stays and closes. The moves are

    * kept, closed: stored rows, the latter with `gone_dt` set by this export,
    * opened: exported rows without an open row of the same host, pid and start; a session exported twice opens once,
    * guessed: processes nobody knows, closed at once where their host reports (it does not show them),
    * apart: closed rows of `gone` that the export shows again. They are only logged.

    The results are those of `open_sessions`, `ghost_sessions`, `close_sessions` and `log_sessions` in this order. NULL keys
    compare equal, but are not logged. `written` stores rows that are read more than once and hands back a reader: with
    it, each export is read once. Of `gone`, four columns are read, and only rows of exported or sampled processes move.
    `hosts` (column `host`) are the reporting ones; default: those of the export.
    """
    state = F.struct(*_logged_state(as_of))
    nothing = F.lit(None).cast(activity.select(state.alias("s")).schema["s"].dataType).alias("logged")

    def tagged(rows: DataFrame, tag: int, logged: Column = nothing) -> DataFrame:
        own = [F.col(c) if c in rows.columns else F.lit(None) for c in sessions.columns]
        typed = [c.cast(sessions.schema[n].dataType).alias(n) for c, n in zip(own, sessions.columns)]
        return rows.select(*typed, F.lit(tag).alias("__tag"), logged)

    exported = activity.select(*_exported_sessions(activity), state.alias("logged"))
    fresh = written(tagged(exported, _EXPORTED, F.col("logged")).unionByName(
        tagged(_guessed_sessions(_guessed(samples)), _SAMPLED)))
    rows = tagged(sessions, _STORED).unionByName(fresh)
    if gone is not None:
        wanted = renamed_keys(fresh, PROCESS_KEY).distinct()
        history = gone.select("id", *PROCESS_KEY, "backend_start")
        rows = rows.unionByName(tagged(history.join(wanted, null_safe(history, wanted, PROCESS_KEY), "left_semi"), _HISTORY))

    tag = F.col("__tag")
    process, start = Window.partitionBy(*PROCESS_KEY), Window.partitionBy(*PROCESS_KEY, "backend_start")
    whole_key = F.col("tsrv_uuid").isNotNull() & F.col("pid").isNotNull() & F.col("backend_start").isNotNull()
    rows = (rows.withColumn("__known", F.max(tag != _SAMPLED).over(process))
            .withColumn("logged", F.when(whole_key, F.max("logged").over(start)))
            .filter((tag != _SAMPLED) | ~F.col("__known")).drop("__known"))

    same = Window.partitionBy(*SESSION_KEY)
    rows = (rows.withColumn("__open", F.max((tag == _STORED) & F.col("gone_dt").isNull()).over(same))
            .withColumn("__shown", F.max(tag == _EXPORTED).over(same))
            .withColumn("__nth", F.row_number().over(Window.partitionBy(*SESSION_KEY, "__tag").orderBy(
                "tsrv_uuid", "client_addr", "client_port", "datid")))
            .filter((tag != _EXPORTED) | (~F.col("__open") & (F.col("__nth") == 1)))
            .filter((tag != _HISTORY) | F.col("logged").isNotNull()))

    rows = with_mark(rows, fresh.filter(tag == _EXPORTED) if hosts is None else hosts, ["host"], "__reported")
    closes = tag.isin(_STORED, _SAMPLED) & F.col("gone_dt").isNull() & F.col("__reported") & ~F.col("__shown")
    move = (F.when(tag == _EXPORTED, OPENED).when(tag == _SAMPLED, GUESSED).when(tag == _HISTORY, APART)
            .when(closes, CLOSED).otherwise(KEPT))
    return rows.select(*[F.when(closes, moment(as_of)).otherwise(F.col(c)).alias(c) if c == "gone_dt" else F.col(c)
                         for c in sessions.columns], move.alias("move"), "logged")


# ---- statements -------------------------------------------------------------------------------------------

SOURCES = ["samples", "activity", "statements"]


def new_queries(queries: DataFrame, samples: DataFrame, activity: DataFrame, statements: DataFrame, as_of,
                seconds: int = 900) -> DataFrame:
    """Statements not yet known, each from the first source that shows it: recent samples (id only), activity,
    statement statistics. Several texts can share an id; the smallest is taken.

    Ids come first: every source is folded to one row per id without its text and tagged, the smallest tag wins, and the
    known statements are taken off. Texts are then read for what is left only. The extra column `source` says where a row
    came from.
    """
    columns = ["log_dt", "log_tsrv", "log_host"]

    def folded(rows: DataFrame, key: str, when: Column) -> DataFrame:
        rows = rows.filter(F.col(key).isNotNull()).withColumn("__seen", when)
        first = F.min(F.struct("__seen", "host", "tsrv_uuid"))
        return rows.groupBy(F.col(key).alias("queryid")).agg(first.alias("f")).select(
            "queryid", F.col("f.__seen").alias("log_dt"), F.col("f.tsrv_uuid").alias("log_tsrv"),
            F.col("f.host").alias("log_host"))

    recent = (lookback(samples, "sample_time", as_of, seconds).groupBy("query_id", "host", "tsrv_uuid")
              .agg(F.min("sample_time").alias("sample_time")))
    parts = [
        folded(recent, "query_id", F.col("sample_time")),
        folded(activity, "query_id", F.coalesce("query_start", moment(as_of))),
        folded(statements, "queryid", moment(as_of)),
    ]
    tagged = None
    for rank, part in enumerate(parts):
        one = part.select("queryid", F.struct(F.lit(rank).alias("rank"), *columns).alias("r"))
        tagged = one if tagged is None else tagged.unionByName(one)
    best = tagged.groupBy("queryid").agg(F.min_by("r", F.col("r.rank")).alias("r"))
    fresh = only_new(best.select("queryid", "r.rank", *[F.col(f"r.{c}").alias(c) for c in columns]), queries, ["queryid"])

    # samples carry no text
    texts = None
    for rank, rows, key in ((1, activity, "query_id"), (2, statements, "queryid")):
        wanted = fresh.filter(F.col("rank") == rank).select(F.col("queryid").alias("__id"))
        one = (rows.select(F.col(key).alias("__q"), F.col("query").alias("__text"))
               .join(wanted, F.col("__q") == F.col("__id"), "left_semi").groupBy("__q").agg(F.min("__text").alias("query")))
        texts = one if texts is None else texts.unionByName(one)      # an id has one rank, so no id is in both
    names = F.array(*[F.lit(n) for n in SOURCES])
    return fresh.join(texts, fresh["queryid"] == texts["__q"], "left").select(
        "queryid", *columns, "query", F.element_at(names, F.col("rank") + 1).alias("source"))


def upsert_queries(queries: DataFrame, samples: DataFrame, activity: DataFrame, statements: DataFrame, as_of,
                   seconds: int = 900) -> DataFrame:
    return extended(queries, new_queries(queries, samples, activity, statements, as_of, seconds))


def blank_recent(queries: DataFrame, as_of, seconds: int) -> Column:
    return is_blank(F.col("query")) & (F.col("log_dt") > moment(parse_moment(as_of) - dt.timedelta(seconds=seconds)))


def fill_query_text(queries: DataFrame, statements: DataFrame, as_of, seconds: int = 3600) -> DataFrame:
    """Recent rows with a blank text take the smallest text exported for their id (NULL if there is none)."""
    blank_ones = queries.filter(blank_recent(queries, as_of, seconds)).select(F.col("queryid").alias("__id"))
    texts = (statements.filter(F.col("query").isNotNull()).select(F.col("queryid").alias("__q"), "query")
             .join(blank_ones, F.col("__q") == F.col("__id"), "left_semi")
             .groupBy("__q").agg(F.min("query").alias("__text")))
    joined = queries.join(texts, queries["queryid"] == texts["__q"], "left")
    filled = F.when(F.coalesce(blank_recent(queries, as_of, seconds), F.lit(False)), F.col("__text"))
    return joined.withColumn("query", filled.otherwise(F.col("query"))).select(*queries.columns)


def log_statements(log: DataFrame, statements: DataFrame, as_of) -> DataFrame:
    """New log rows: counters that changed since any earlier export. EXPLAIN shares ids and is left out, as are
    rows without a text."""
    fresh = only_new(not_explain(statements), log, STATEMENT_KEY)
    return fresh.select("tsrv_uuid", "queryid", moment(as_of).alias("log_dt"), "userid", "dbid", "toplevel",
                        *STATEMENT_COUNTERS)


LATEST_KEY = "statement_key"
LATEST_BUCKETS = 32
_OWNER = ["queryid", "tsrv_uuid", "dbid", "userid", "toplevel"]


def _keyed(statements: DataFrame) -> DataFrame:
    """The statement's natural key as one text, NULL parts as `~`: a single join key without NULLs."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in _OWNER]
    return statements.withColumn(LATEST_KEY, F.concat_ws("|", *parts))


def latest_statements(log: DataFrame) -> DataFrame:
    """(statement_key, calls, rows): the newest counters of each statement in a log. Later ones come from
    `merge_latest`, so this is for a log that has no such table yet."""
    newest = F.max(F.struct("log_dt", "calls", "rows")).alias("n")
    return _keyed(log).groupBy(LATEST_KEY).agg(newest).select(LATEST_KEY, "n.calls", "n.rows")


def changed_statements(latest: DataFrame, statements: DataFrame, as_of) -> DataFrame:
    """New log rows: counters that differ from the newest known ones of their statement. Unlike `log_statements`, which
    looks for equal counters anywhere in the log, counters that come back to earlier values (after a reset) are logged.

    The work follows the export and the number of statements, not the age of the log. With `latest` bucketed by
    `statement_key`, only the export is shuffled."""
    known = latest.select(F.col(LATEST_KEY).alias("__key"), F.col("calls").alias("__calls"), F.col("rows").alias("__rows"))
    fresh = _keyed(not_explain(statements))
    fresh = fresh.join(known, fresh[LATEST_KEY] == known["__key"], "left")
    same = F.col("__key").isNotNull() & F.col("calls").eqNullSafe(F.col("__calls")) & F.col("rows").eqNullSafe(F.col("__rows"))
    return fresh.filter(~same).select("tsrv_uuid", "queryid", moment(as_of).alias("log_dt"), "userid", "dbid", "toplevel",
                                      *STATEMENT_COUNTERS)


def merge_latest(latest: DataFrame, statements: DataFrame) -> DataFrame:
    """The newest counters after an export: exported statements take its counters (of several rows the most calls), the
    others keep theirs. Buckets meet their own rows only."""
    fresh = _keyed(not_explain(statements)).groupBy(LATEST_KEY).agg(F.max(F.struct("calls", "rows")).alias("n"))
    known = latest.select(F.col(LATEST_KEY).alias("__key"), F.struct("calls", "rows").alias("__n"))
    both = fresh.join(known, fresh[LATEST_KEY] == known["__key"], "full_outer")
    return both.select(F.coalesce(LATEST_KEY, "__key").alias(LATEST_KEY), F.coalesce("n", "__n").alias("n")).select(
        LATEST_KEY, "n.calls", "n.rows")


# ---- tablets ----------------------------------------------------------------------------------------------

_TABLET_COLUMNS = {"table_id": "tabl_uuid", "table_type": "table_type", "namespace_name": "namespace_name",
                   "schema_name": "schema_name", "table_name": "table_name",
                   "partition_key_start": "partition_key_start", "partition_key_end": "partition_key_end"}


def open_tablets(tablets: DataFrame, local: DataFrame, as_of) -> DataFrame:
    """New rows: held tablets without an open row; one that left and came back gets another row."""
    carried = [F.min(c).alias(name) for c, name in _TABLET_COLUMNS.items() if c in local.columns]
    held = (local.groupBy(F.col("tablet_id").alias("tblt_uuid"))
            .agg(*carried, F.min(F.struct("host", "tsrv_uuid")).alias("__by"))
            .withColumn("log_host", F.col("__by.host")).withColumn("log_tsrv", F.col("__by.tsrv_uuid")).drop("__by"))
    return only_new(held, alive(tablets), ["tblt_uuid"]).withColumn("log_dt", moment(as_of))


def track_replicas(replicas: DataFrame, local: DataFrame, as_of,
                   servers: DataFrame | Sequence[str] | None = None) -> DataFrame:
    """New state: a replica opens when a server first holds a tablet, closes when it no longer does, and opens
    again as a new interval when the tablet returns. `servers` (a frame with the column `tsrv_uuid`, or ids) are the
    reporting ones, so that a server that holds nothing any more closes its replicas; default: those in the export."""
    held = local.select(F.col("tablet_id").alias("tblt_uuid"), "tsrv_uuid").distinct()
    marked = with_mark(replicas, held, ["tblt_uuid", "tsrv_uuid"], "__here")
    if servers is None:
        marked = with_mark(marked, held, ["tsrv_uuid"], "__reported")
    elif isinstance(servers, DataFrame):
        marked = with_mark(marked, servers, ["tsrv_uuid"], "__reported")
    else:
        marked = marked.withColumn("__reported", F.col("tsrv_uuid").isin(*servers))
    gone = F.col("gone_dt").isNull() & F.col("__reported") & ~F.col("__here")
    kept = (marked.withColumn("gone_dt", F.when(gone, moment(as_of)).otherwise(F.col("gone_dt")))
            .drop("__here", "__reported"))
    fresh = with_defaults(only_new(held, alive(replicas), ["tblt_uuid", "tsrv_uuid"]), {
        "log_dt": moment(as_of), "role": F.lit(UNDETECTED), "state": F.lit(UNDETECTED)})
    return extended(kept, fresh)


def close_tablets(tablets: DataFrame, replicas: DataFrame, as_of) -> DataFrame:
    """New state: an open tablet without any open replica is gone."""
    marked = with_mark(tablets, alive(replicas), ["tblt_uuid"], "__held")
    gone = F.col("gone_dt").isNull() & ~F.col("__held")
    return marked.withColumn("gone_dt", F.when(gone, moment(as_of)).otherwise(F.col("gone_dt"))).drop("__held")


# ---- samples and events -----------------------------------------------------------------------------------

def load_samples(log: DataFrame, batch: DataFrame) -> DataFrame:
    """New sample rows: not yet in the log by the natural key, background noise dropped, NULL call ids as 0.

    Only the log is consulted: equal rows inside one export are distinct observations and all kept. Of a log
    partitioned by day, hand in `log_of_days`: the key holds the sample time, so other days cannot match.
    """
    rows = drop_noise(batch).withColumn("rpc_request_id", F.coalesce("rpc_request_id", F.lit(0).cast("long")))
    return only_new(rows, log, SAMPLE_KEY)


def days_of(batch: DataFrame) -> list:
    """The days of a batch of samples, None for samples without a time; a handful, they come to the driver."""
    return [r[0] for r in batch.select(F.to_date("sample_time").alias("d")).distinct().collect()]


def on_days(day: str, days: Sequence) -> Column:
    """True for the given days, with literals that prune a scan; None stands for rows without a day."""
    wanted = F.lit(False)
    for d in days:
        wanted = wanted | (F.col(day).isNull() if d is None else F.coalesce(F.col(day) == F.lit(d), F.lit(False))
                           if None in days else F.col(day) == F.lit(d))
    return wanted


def log_of_days(log: DataFrame, batch: DataFrame, day: str = "day") -> DataFrame:
    """The partitions of the log that the batch can touch, that of samples without a time among them."""
    return log.filter(on_days(day, days_of(batch)))


def distinct_events(samples: DataFrame) -> DataFrame:
    """One row per (component, event) with the smallest type and class and the host that showed it first.

    The first step groups by all the text columns, so only times are aggregated and the rows are folded in hash
    tables before the shuffle; the second step works on what is left, a few rows per event and host.
    """
    keys = ["wait_event_component", "wait_event"]
    seen = (samples.filter(F.col("wait_event_component").isNotNull() & F.col("wait_event").isNotNull())
            .groupBy(*keys, "wait_event_type", "wait_event_class", "host").agg(F.min("sample_time").alias("first")))
    return seen.groupBy(*keys).agg(
        F.min("wait_event_type").alias("wait_event_type"), F.min("wait_event_class").alias("wait_event_class"),
        F.min_by("host", F.struct("first", "host")).alias("log_host"))


def upsert_events(events: DataFrame, samples: DataFrame, as_of) -> DataFrame:
    """New catalogue rows: (component, event) pairs not yet known, with a note on where they were first found."""
    found = distinct_events(samples).withColumn(
        "wait_event_notes", F.concat(F.lit("first found on: "), F.col("log_host"), F.lit(f", at: {as_of}")))
    return only_new(found, events, ["wait_event_component", "wait_event"])
