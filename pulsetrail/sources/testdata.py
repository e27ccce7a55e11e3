"""The supplied star-schema tables seen as session and wait-event history.

Every view is a lazy projection or aggregation of the given tables, so its work grows with them. `events`
becomes the sample stream, `documents` the statement texts, `part` the tablets. Collection jobs need a state
before and an export after, so the same rows are split by time or attribute into "known" and "current".
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dashed_uuid, moment
from ..schemas import DATABASE_COUNTERS, INPUTS, STATEMENT_COUNTERS
from .seeds import SEED_QUERIES, seed_queries

AS_OF = "2024-01-31 00:00:00"
REPORT_START = "2024-01-01 00:00:00"
LOOKBACK_SECONDS = 30 * 86400
CUT = "2024-01-16 00:00:00"          # history known before, export taken after
OVERLAP = "2024-01-17 00:00:00"      # samples up to here are already loaded
LAST_DAY = "2024-01-30 00:00:00"
LATE = "2024-01-29 00:00:00"
HOSTS = ["node2", "node3", "node4", "node5"]

EVENTS_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
SCHEMAS = {
    "events": EVENTS_SCHEMA,
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
}


def node_uuid(number: Column) -> Column:
    return dashed_uuid(F.concat(F.lit("tsrv|"), number.cast("string")))


def node_name(number: Column) -> Column:
    return F.concat(F.lit("node"), number.cast("string"))


def _snap_id(minute: Column) -> Column:
    """Number of a minute's snapshot, 1 for the first minute of the reports."""
    return F.timestamp_diff("MINUTE", moment(REPORT_START), minute) + 1


def _null(kind: T.DataType) -> Column:
    """Typed NULL; moments are zone-less here, like those of the supplied tables."""
    return F.lit(None).cast("timestamp_ntz" if isinstance(kind, T.TimestampType) else kind)


def _uuid_sql(seed: str) -> str:
    text = f"md5({seed})"
    for position in (21, 17, 13, 9):
        text = f"overlay({text} PLACING '-' FROM {position} FOR 0)"
    return text


def _node_sql(number: str) -> str:
    """`node_uuid` in SQL. The four nodes of the cluster are literals, folded once; any other number is hashed per row."""
    known = " ".join(f"WHEN {n} THEN {_uuid_sql(f"'tsrv|{n}'")}" for n in range(2, 6))
    return f"CASE {number} {known} ELSE {_uuid_sql(f"concat('tsrv|', CAST({number} AS STRING))")} END"


# One SQL projection: the view is rebuilt for every query, and this costs one call instead of a hundred.
_SAMPLE_COLUMNS = [
    "event_id AS sample_id",
    "ts AS sample_time",
    "concat('node', CAST(event_id % 4 + 2 AS STRING)) AS host",
    _node_sql("(event_id % 4 + 2)") + " AS tsrv_uuid",
    "CASE WHEN query_id <= 7 THEN '00000000-0000-0000-0000-000000000000' ELSE "
    + _uuid_sql("concat(CAST(user_id AS STRING), '|', CAST(to_date(ts) AS STRING))") + " END AS root_request_id",
    "CASE WHEN event_id % 3 <> 0 THEN event_id % 5 END AS rpc_request_id",
    "CASE WHEN event_type = 'signup' THEN 'SQL' ELSE 'TServer' END AS wait_event_component",
    "CASE WHEN event_type IN ('click', 'view') THEN 'Common' WHEN event_type IN ('purchase', 'error') THEN 'TabletWait'"
    " WHEN event_type = 'signup' THEN 'Client' END AS wait_event_class",
    "CASE event_type WHEN 'click' THEN 'Cpu' WHEN 'view' THEN 'Cpu' WHEN 'purchase' THEN 'DiskIO'"
    " WHEN 'signup' THEN 'Client' WHEN 'error' THEN 'Timeout' END AS wait_event_type",
    "CASE event_type WHEN 'click' THEN 'OnCpu_Active' WHEN 'view' THEN 'OnCpu_Passive' WHEN 'purchase' THEN 'WAL_Sync'"
    " WHEN 'signup' THEN 'ClientRead' WHEN 'error' THEN 'Extension' END AS wait_event",
    "CASE WHEN event_id % 4 <> 0 THEN left(md5(concat('tblt|', CAST(event_id % 50 + 1 AS STRING))), 15) END"
    " AS wait_event_aux",
    _node_sql("(user_id % 4 + 2)") + " AS top_level_node_id",
    "query_id",
    "user_id + 1000 AS pid",
    "concat('10.0.0.', CAST(user_id AS STRING), ':', CAST(user_id + 5000 AS STRING)) AS client_node_ip",
    "value AS sample_weight",
    "user_id % 3 + 13515 AS dbid",
]


def samples_from_events(events: DataFrame) -> DataFrame:
    """Sample rows as a sampler would export them (rpc id may be NULL). Works on a stream too."""
    keyed = events.selectExpr("*", "CAST(get_json_object(props, '$.k') AS BIGINT) AS query_id")
    return keyed.selectExpr(*_SAMPLE_COLUMNS)


class TestData:
    """Lazy views over one scale-factor folder."""

    __test__ = False

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")

    # ---- history as the reports see it -------------------------------------------------------------------

    @cached_property
    def exported_samples(self) -> DataFrame:
        return samples_from_events(self.events)

    @cached_property
    def samples(self) -> DataFrame:
        return self.exported_samples.withColumn("rpc_request_id", F.coalesce("rpc_request_id", F.lit(0).cast("long")))

    @cached_property
    def queries(self) -> DataFrame:
        return (self.table("documents")
                .filter(~F.col("doc_id").isin([i for i, _ in SEED_QUERIES]))
                .select(F.col("doc_id").alias("queryid"), F.col("text").alias("query"))
                .unionByName(seed_queries(self.spark)))

    @cached_property
    def tablets(self) -> DataFrame:
        return self.table("part").select(
            dashed_uuid(F.concat(F.lit("tblt|"), F.col("p_partkey").cast("string"))).alias("tblt_uuid"),
            F.col("p_name").alias("table_name"), F.col("p_brand").alias("schema_name"),
            F.lit(None).cast("timestamp_ntz").alias("gone_dt"))

    @cached_property
    def servers(self) -> DataFrame:
        numbers = self.spark.range(2, 6, 1, 1).withColumnRenamed("id", "n")
        return numbers.select(node_name(F.col("n")).alias("host"), node_uuid(F.col("n")).alias("tsrv_uuid"))

    def _placed(self, parts: DataFrame, even: Column) -> DataFrame:
        """Two replicas per tablet: nodes 3 and 5, or 2 and 4."""
        return parts.withColumn("n", F.explode(F.when(even, F.array(F.lit(3), F.lit(5)))
                                                .otherwise(F.array(F.lit(2), F.lit(4)))))

    @cached_property
    def replicas(self) -> DataFrame:
        even = F.col("p_partkey") % 2 == 0
        return self._placed(self.table("part").select("p_partkey"), even).select(
            dashed_uuid(F.concat(F.lit("tblt|"), F.col("p_partkey").cast("string"))).alias("tblt_uuid"),
            node_uuid(F.col("n")).alias("tsrv_uuid"),
            F.when(F.col("p_partkey") % 7 == 0, moment("2024-01-20 00:00:00")).alias("gone_dt"))

    def _session_rows(self, events: DataFrame, gone: Column, start: Column | None = None) -> DataFrame:
        user = F.col("user_id")
        text = user.cast("string")
        return (events.groupBy("user_id")
                .agg((F.min("ts") if start is None else start).alias("backend_start"), F.max("ts").alias("last_ts"))
                .select(
                    user.alias("id"), node_uuid(user % 4 + 2).alias("tsrv_uuid"),
                    node_name(user % 4 + 2).alias("host"), (user + 1000).cast("int").alias("pid"),
                    "backend_start", gone.alias("gone_dt"),
                    F.concat(F.lit("10.0.0."), text).alias("client_addr"),
                    (user + 5000).cast("int").alias("client_port"),
                    F.lit(None).cast("string").alias("client_hostname"),
                    (user % 3 + 13515).alias("datid"),
                    F.when(user % 10 != 9, F.lit(10)).cast("long").alias("usesysid"),
                    F.lit(None).cast("int").alias("leader_pid"),
                    F.concat(F.lit("app"), (user % 3).cast("string")).alias("app_name"),
                    F.lit("client backend").alias("backend_type")))

    @cached_property
    def sessions(self) -> DataFrame:
        return self._session_rows(self.events, F.when(F.col("user_id") % 5 != 0, F.col("last_ts")))

    @cached_property
    def tserver_log(self) -> DataFrame:
        """A snapshot per minute with events: a row per server; node5 does not answer on one day."""
        nodes = range(2, 6)
        hits = lambda kind, n: F.count_if((F.col("event_type") == kind) & (F.col("event_id") % 4 + 2 == n))
        kinds = {"views": "view", "buys": "purchase", "clicks": "click", "errors": "error"}
        minute = F.date_trunc("minute", F.col("ts"))
        wide = self.events.groupBy(minute.cast("timestamp_ntz").alias("log_dt")).agg(
            *[hits(kind, n).alias(f"{name}_{n}") for n in nodes for name, kind in kinds.items()])
        per_node = F.array(*[F.struct(F.lit(n).alias("n"), *[F.col(f"{name}_{n}").alias(name) for name in kinds])
                             for n in nodes])
        return (wide.select("log_dt", F.explode(per_node).alias("x")).select("log_dt", "x.*")
                .filter(~((F.col("n") == 5) & (F.to_date("log_dt") == "2024-01-10")))
                .select(_snap_id(F.col("log_dt")).alias("snap_id"), node_uuid(F.col("n")).alias("tsrv_uuid"),
                        node_name(F.col("n")).alias("host"),
                        F.col("views").cast("double").alias("rd_psec"), F.col("buys").cast("double").alias("wr_psec"),
                        (F.col("clicks") / 100.0).alias("cpu_user"), (F.col("errors") / 100.0).alias("cpu_syst")))

    @cached_property
    def snapshots(self) -> DataFrame:
        return (self.events.groupBy(F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("log_dt"))
                .agg(F.count("*").alias("n"))
                .select(_snap_id(F.col("log_dt")).alias("id"), "log_dt",
                        F.lit("node2").alias("log_host"), F.col("n").alias("duration_ms")))

    @cached_property
    def database_log(self) -> DataFrame:
        from pyspark.sql import Window
        running = (Window.partitionBy("log_host", "datid").orderBy("log_dt")
                   .rowsBetween(Window.unboundedPreceding, 0))
        each = (self.events
                .groupBy(F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("log_dt"),
                         node_name(F.col("event_id") % 4 + 2).alias("log_host"),
                         (F.col("user_id") % 3 + 13515).alias("datid"))
                .agg(F.count_if(F.col("event_type") == "signup").alias("s"), F.count("*").alias("n")))
        return each.select(
            "datid", "log_host", "log_dt", F.sum("s").over(running).alias("sessions"),
            F.sum("n").over(running).alias("tup_returned"),
            (F.sum("n").over(running) * F.lit(5_000_000)).alias("temp_bytes"))

    # ---- state before, export after: inputs of the collection jobs ---------------------------------------

    @cached_property
    def known_sessions(self) -> DataFrame:
        return self._session_rows(self.events.filter(F.col("ts") < moment(CUT)),
                                  F.when(F.col("user_id") % 5 == 4, moment(CUT)))

    @cached_property
    def activity(self) -> DataFrame:
        """Sessions active on the last day; some restarted their backend after the cut."""
        user = F.col("user_id")
        last = F.when(F.col("ts") >= moment(LAST_DAY), F.get_json_object("props", "$.k").cast("long"))
        fixed = {
            "host": node_name(user % 4 + 2), "tsrv_uuid": node_uuid(user % 4 + 2),
            "pid": (user + 1000).cast("int"), "datid": user % 3 + 13515,
            "datname": F.concat(F.lit("db"), (user % 3 + 13515).cast("string")),
            "usesysid": F.lit(10).cast("long"), "usename": F.lit("app"),
            "application_name": F.concat(F.lit("app"), (user % 3).cast("string")),
            "client_addr": F.concat(F.lit("10.0.0."), user.cast("string"), F.lit("/32")),
            "client_port": (user + 5000).cast("int"), "backend_start": F.col("backend_start"),
            "xact_start": F.col("last_ts"), "query_start": F.when(user % 4 != 0, F.col("last_ts")),
            "state_change": F.col("last_ts"), "state": F.lit("active"), "query_id": F.col("last_query"),
            "query": F.concat(F.lit("select "), F.col("last_query").cast("string")),
            "backend_type": F.lit("client backend"),
        }
        schema = INPUTS["activity"]
        names = ["host", "tsrv_uuid"] + schema.fieldNames()
        base = (self.events.groupBy("user_id")
                .agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
                     F.min(F.when(F.col("ts") >= moment(CUT), F.col("ts"))).alias("restart_ts"),
                     F.max(last).alias("last_query"))
                .filter(F.col("last_ts") >= moment(LAST_DAY))
                .withColumn("backend_start",
                            F.when(user % 7 == 0, F.col("restart_ts")).otherwise(F.col("first_ts"))))
        return base.select(*[(fixed[n] if n in fixed else _null(schema[n].dataType)).alias(n)
                             for n in names])

    def _statements(self, samples: DataFrame) -> DataFrame:
        qid = F.col("query_id")
        text = (F.when(qid % 10 == 0, F.concat(F.lit("explain select "), qid.cast("string")))
                 .when(qid % 10 != 1, F.concat(F.lit("select "), F.col("dbid").cast("string"),
                                               F.lit(" from t"), qid.cast("string"))))
        fixed = {"queryid": qid, "userid": F.lit(10).cast("long"), "dbid": F.col("dbid"),
                 "toplevel": F.lit(True), "calls": F.col("n"), "rows": F.col("n") * 10,
                 "plans": F.col("n"), "query": text}
        schema = INPUTS["statements"]
        return (samples.groupBy("host", "tsrv_uuid", "query_id", "dbid").agg(F.count("*").alias("n"))
                .select("host", "tsrv_uuid",
                        *[(fixed[f.name] if f.name in fixed else _null(f.dataType)).alias(f.name)
                          for f in schema]))

    @cached_property
    def statements(self) -> DataFrame:
        return self._statements(self.exported_samples)

    @cached_property
    def known_statements(self) -> DataFrame:
        past = self._statements(self.exported_samples.filter(F.col("sample_time") < moment(LATE)))
        return past.select("tsrv_uuid", "queryid", moment(LATE).alias("log_dt"), "userid", "dbid", "toplevel",
                           *STATEMENT_COUNTERS)

    @cached_property
    def known_queries(self) -> DataFrame:
        qid = F.col("query_id")
        seen = (self.exported_samples.filter(F.col("sample_time") < moment("2024-01-01 06:00:00"))
                .filter(~qid.isin([i for i, _ in SEED_QUERIES])).select("query_id").distinct())
        early = seen.select(
            qid.alias("queryid"),
            F.when(qid % 2 == 0, moment("2024-01-30 23:30:00")).otherwise(moment("2024-01-30 22:00:00")).alias("log_dt"),
            F.lit(None).cast("string").alias("log_tsrv"), F.lit("node2").alias("log_host"),
            F.when(qid % 3 == 1, F.lit("  ")).when(qid % 3 == 2, F.concat(F.lit("known "), qid.cast("string")))
             .alias("query"))
        seeds = seed_queries(self.spark).select(
            "queryid", moment(REPORT_START).alias("log_dt"), F.lit(None).cast("string").alias("log_tsrv"),
            F.lit("node2").alias("log_host"), "query")
        return early.unionByName(seeds)

    @cached_property
    def databases(self) -> DataFrame:
        """One statistics row per node and database; three counters vary, the rest follow from them."""
        n = F.col("n")
        fixed = {"datid": F.col("dbid"), "datname": F.concat(F.lit("db"), F.col("dbid").cast("string")),
                 "numbackends": F.col("backends").cast("int"), "xact_commit": n, "xact_rollback": F.col("errors"),
                 "tup_returned": n * 100, "temp_bytes": n * F.lit(5_000_000), "sessions": F.col("backends"),
                 "active_time": n.cast("double"), "stats_reset": moment(REPORT_START)}
        schema = INPUTS["databases"]
        return (self.exported_samples.groupBy("host", "tsrv_uuid", "dbid")
                .agg(F.count("*").alias("n"), F.countDistinct("pid").alias("backends"),
                     F.count_if(F.col("wait_event_type") == "Timeout").alias("errors"))
                .select("host", "tsrv_uuid",
                        *[(fixed[f.name] if f.name in fixed else F.lit(0).cast(f.dataType) if f.name in _ZERO
                           else _null(f.dataType)).alias(f.name) for f in schema]))

    @cached_property
    def known_databases(self) -> DataFrame:
        return (self.exported_samples.filter(F.col("sample_time") < moment("2024-01-01 00:05:00"))
                .select("dbid").distinct()
                .select(F.col("dbid").alias("datid"), F.concat(F.lit("db"), F.col("dbid").cast("string")).alias("datname"),
                        F.lit("node2").alias("log_host"), moment(REPORT_START).alias("log_dt")))

    @cached_property
    def _parts(self) -> DataFrame:
        return self.table("part").select(
            "p_partkey", "p_size", "p_name", "p_brand",
            dashed_uuid(F.concat(F.lit("tblt|"), F.col("p_partkey").cast("string"))).alias("tblt_uuid"))

    @cached_property
    def known_tablets(self) -> DataFrame:
        return self._parts.filter(F.col("p_size") <= 25).select(
            "tblt_uuid", F.lit("user").alias("table_type"), F.col("p_brand").alias("schema_name"),
            F.col("p_name").alias("table_name"), moment(REPORT_START).alias("log_dt"),
            F.when(F.col("p_size") % 5 == 0, moment(CUT)).alias("gone_dt"))

    @cached_property
    def known_replicas(self) -> DataFrame:
        return self._placed(self._parts.filter(F.col("p_size") <= 25), F.col("p_partkey") % 2 == 0).select(
            "tblt_uuid", node_uuid(F.col("n")).alias("tsrv_uuid"), moment(REPORT_START).alias("log_dt"),
            F.when(F.col("p_size") % 5 == 0, moment(CUT)).alias("gone_dt"),
            F.lit("-undetected-").alias("role"), F.lit("-undetected-").alias("state"))

    @cached_property
    def local_tablets(self) -> DataFrame:
        """What every node holds now: sizes 8 and 18 were dropped, size 7 moved to the other pair of nodes."""
        even = (F.col("p_partkey") % 2 == 0) != (F.col("p_size") == 7)
        return self._placed(self._parts.filter(~F.col("p_size").isin(8, 18)), even).select(
            F.col("tblt_uuid").alias("tablet_id"), F.lit("user").alias("table_type"),
            F.col("p_brand").alias("schema_name"), F.col("p_name").alias("table_name"),
            node_name(F.col("n")).alias("host"), node_uuid(F.col("n")).alias("tsrv_uuid"))

    @cached_property
    def known_events(self) -> DataFrame:
        early = self.exported_samples.filter(F.col("sample_time") < moment("2024-01-01 00:05:00"))
        return (early.groupBy("wait_event_component", "wait_event")
                .agg(F.min("wait_event_type").alias("wait_event_type"), F.min("wait_event_class").alias("wait_event_class"))
                .withColumn("wait_event_notes", F.lit("known")))

    # ---- text exports ------------------------------------------------------------------------------------

    @cached_property
    def tserver_listing(self) -> DataFrame:
        """Lines of the server listing, one header and one line per server and snapshot, now and then one that is broken."""
        row = F.concat(F.col("tsrv_uuid"), F.lit("  "), F.col("host"), F.lit(":9100   0.5s  ALIVE    "),
                       F.col("rd_psec").cast("int").cast("string"), F.lit("    "),
                       F.col("wr_psec").cast("int").cast("string"), F.lit("  "),
                       (F.col("snap_id") * 86400).cast("string"), F.lit("  10 MB"))
        lines = self._with_header(self.tserver_log.select("snap_id", F.col("host").alias("file_host"), row.alias("line")),
                                  "Tablet Server UUID  RPC Host/Port  Heartbeat delay  Status")
        broken = self.snapshots.filter(F.col("id") % 10 == 0).select(
            F.col("id").alias("snap_id"), F.lit("node2").alias("file_host"), F.lit("Timed out: no answer").alias("line"))
        return lines.unionByName(broken)

    @cached_property
    def master_listing(self) -> DataFrame:
        uuid = dashed_uuid(F.concat(F.lit("mast|"), F.col("host")))
        role = F.when(F.col("host") == "node2", "LEADER").otherwise("FOLLOWER")
        row = F.concat(uuid, F.lit("   "), F.col("host"), F.lit(":7100    ALIVE     "), role)
        return self._with_header(self.tserver_log.select("snap_id", F.col("host").alias("file_host"), row.alias("line")),
                                 "Master UUID  RPC Host/Port  State  Role")

    @staticmethod
    def _with_header(lines: DataFrame, header: str) -> DataFrame:
        """Each file (one per server and snapshot) starts with its header line."""
        return (lines.withColumn("line", F.explode(F.array(F.lit(header), F.col("line")))))

    @cached_property
    def universe_lines(self) -> DataFrame:
        return self.snapshots.select(
            F.col("id").alias("snap_id"), F.col("log_host"),
            F.to_json(F.struct(
                dashed_uuid(F.lit("universe")).alias("universeUuid"),
                dashed_uuid(F.concat(F.lit("cluster|"), F.col("id").cast("string"))).alias("clusterUuid"),
                F.col("id").cast("int").alias("version"))).alias("slurp"))

    @cached_property
    def server_metrics(self) -> DataFrame:
        size = lambda factor: (F.col("rd_psec").cast("long") * factor).alias
        return self.tserver_log.select(
            "snap_id", F.col("tsrv_uuid").alias("uuid"),
            F.to_json(F.struct(
                size(3_000_000)("memory_free"), size(90_000_000)("memory_total"),
                size(50_000_000)("memory_available"), size(20_000_000)("tserver_root_memory_limit"),
                size(17_000_000)("tserver_root_memory_soft_limit"),
                size(1_500_000)("tserver_root_memory_consumption"),
                F.col("cpu_user").alias("cpu_usage_user"), F.col("cpu_syst").alias("cpu_usage_system"))).alias("metrics"),
            F.lit("OK").alias("status"), F.lit("").alias("error"))

    @cached_property
    def kv_lines(self) -> DataFrame:
        """`key=value` lines per host and day. Every ninth day lacks one key, every fourth has an empty value."""
        n, day = F.col("wr_psec").cast("long"), F.col("snap_id")
        lines = F.array(
            F.concat(F.lit("nr_processes="), n.cast("string")),
            F.concat(F.lit("master_mem="), (n * 1000).cast("string")),
            F.concat(F.lit("tserver_mem="), (n * 3000).cast("string")),
            F.when(day % 9 != 0, F.concat(F.lit("disk_usage_mb="), (n + 7).cast("string"))),
            F.when(day % 4 == 0, F.lit("top_info=")).otherwise(
                F.concat(F.lit("top_info=load=0."), n.cast("string"))))
        return (self.tserver_log.select("host", "snap_id", F.explode(lines).alias("line"))
                .filter(F.col("line").isNotNull()))


# database counters the export reports as zero
_ZERO = [c for c in DATABASE_COUNTERS if c not in
         ("checksum_failures", "checksum_last_failure", "stats_reset")]
