"""The event tree: an indented text report request -> statement -> sample, as a DataFrame of lines.

Every kind of line is produced set-wise with an explicit sort key; the report is their union. Nothing numbers
lines globally and nothing loops: `ordered` sorts by the key, which Spark does by range partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clock_ms, clock_ms_colon, left_pad, right_pad
from ..operators.filters import only_pid
from ..operators.joins import attach_tablet, join_query, of_days, renamed_keys, samples_of
from ..operators.windows import ordinal

# Sort key of a line. `section` orders header / statements / closing inside a request, `part` inside a statement.
ORDER = ["pid", "rr_min_dt", "rr_uuid", "sess_id", "section", "qurr_start_dt", "queryid", "part", "sample_time",
         "sample_id"]
HEADER, BODY, CLOSING, REPORT_END = 0, 1, 2, 9


def ordered(lines: DataFrame) -> DataFrame:
    return lines.orderBy(*[F.col(c).asc_nulls_last() for c in ORDER])


def _lines(df: DataFrame, *parts: tuple[int, int, Column]) -> DataFrame:
    """One row per (section, part, text) that has a text, with the sort columns `df` has and NULL for the rest. Lines
    outside the body of a request belong to no statement."""
    rows = F.array(*[F.struct(F.lit(s).alias("section"), F.lit(p).alias("part"), text.alias("output"))
                     for s, p, text in parts])
    types = {"pid": "long", "rr_min_dt": "timestamp_ntz", "qurr_start_dt": "timestamp_ntz", "queryid": "long",
             "rr_uuid": "string", "sess_id": "long", "sample_time": "timestamp_ntz", "sample_id": "long"}
    own = df.select(*[F.col(c) for c in types if c in df.columns], F.explode(rows).alias("line"))

    def value(c: str) -> Column:
        if c in ("section", "part"):
            return F.col(f"line.{c}")
        if c not in own.columns:
            return F.lit(None)
        return F.when(F.col("line.section") == BODY, F.col(c)) if c in ("qurr_start_dt", "queryid") else F.col(c)

    return (own.filter(F.ltrim("line.output") != "")
            .select(*[value(c).cast(types.get(c, "int")).alias(c) for c in ORDER], F.col("line.output").alias("output")))


def _requests(root_requests: DataFrame, sessions: DataFrame, pid: int | None) -> DataFrame:
    owner = only_pid(sessions, pid).select(F.col("id").alias("__sess"), F.col("pid").cast("long").alias("pid"),
                                           "client_addr", "client_port", "app_name")
    return root_requests.join(owner, root_requests["sess_id"] == owner["__sess"], "inner").drop("__sess")


def _links_of(links: DataFrame, requests: DataFrame) -> DataFrame:
    wanted = renamed_keys(requests, ["rr_uuid"]).distinct()
    return links.join(wanted, links["rr_uuid"] == wanted["__k_rr_uuid"], "left_semi")


def _counted(links: DataFrame, samples: DataFrame) -> DataFrame:
    """Links with `n_samples`, counted where the derivation did not."""
    if "n_samples" in links.columns:
        return links
    sizes = (samples.filter(F.col("query_id").isNotNull())
             .groupBy(F.col("root_request_id").alias("__rr"), F.col("query_id").alias("__q"))
             .agg(F.count(F.lit(1)).alias("__n")))
    joined = links.join(sizes, (links["rr_uuid"] == sizes["__rr"]) & (links["queryid"] == sizes["__q"]), "left")
    return joined.withColumn("n_samples", F.coalesce("__n", F.lit(0))).drop("__rr", "__q", "__n")


def event_tree(root_requests: DataFrame, links: DataFrame, queries: DataFrame, samples: DataFrame,
               tablets: DataFrame, sessions: DataFrame, pid: int | None = None) -> DataFrame:
    """Lines of the tree for one process id, or for every one. Columns: the sort key and `output`.

    Requests meet their statements once: the first statement's row carries the request's header, the last one's its
    closing. Samples are read once where `links` carry their number (`n_samples`, see `derive.build_rr_query_links`);
    otherwise they are counted in a pass of their own.
    """
    samples = of_days(samples, root_requests)
    requests = _requests(root_requests, sessions, pid)
    numbered = ordinal(requests, ["pid"], "rr_min_dt", ["rr_uuid", "sess_id"], "rr_no")
    if pid is not None:
        samples, links = samples_of(samples, requests), _links_of(links, requests)
    # statements are numbered before they meet the requests: their order is the same in every session
    labelled = ordinal(join_query(_counted(links, samples), queries, "queryid"), ["rr_uuid"], "qurr_start_dt",
                       ["queryid"], "ql_no", total="n_ql").withColumnRenamed("rr_uuid", "__rr")

    # one row per statement of a request; a request without statements has one row without a statement. Four lines begin
    # with the start of the statement: as a column it is formatted once
    short = F.substring("rr_uuid", 1, 2)
    statements = (numbered.join(labelled, F.col("rr_uuid") == F.col("__rr"), "left").drop("__rr")
                  .withColumn("__start", F.when(F.col("queryid").isNotNull(),
                                                F.concat(clock_ms(F.col("qurr_start_dt")), F.lit("  "), short))))
    first, last = F.coalesce("ql_no", F.lit(1)) == 1, F.col("ql_no").eqNullSafe(F.col("n_ql"))

    title = F.concat(clock_ms(F.col("rr_min_dt")), F.lit("  "), F.col("rr_uuid"), F.lit(" from pid: "),
                     F.col("pid").cast("string"), F.lit(" clnt: "), F.col("client_addr"), F.lit(":"),
                     F.col("client_port").cast("string"), F.lit(" app: "), F.col("app_name"), F.lit("  "))
    # the closing line shows the start of the last statement
    closing = F.concat(clock_ms(F.coalesce("qurr_start_dt", "rr_min_dt")), F.lit("  "), short,
                       F.lit(" -- -- -- end RR -- -- -- / "))
    start = F.col("__start")
    query_line = F.concat(start, F.lit("  qry_id: "), left_pad(F.col("queryid").cast("string"), 20),
                          F.lit("  qry: "), F.col("query"))
    numbers = F.concat(F.lit("        ( rr:"), F.col("rr_no").cast("string"), F.lit(" ql:"),
                       F.col("ql_no").cast("string"), F.lit(" al:"), F.col("n_samples").cast("string"), F.lit(")"))
    frame_lines = _lines(
        statements, (HEADER, 0, F.when(first, title)), (BODY, 0, start), (BODY, 1, query_line), (BODY, 2, start),
        (BODY, 4, F.concat(start, F.lit("   -- -- -- end qry -- -- -- / "), numbers)),
        (CLOSING, 0, F.when(last, closing)), (CLOSING, 1, F.when(last, F.lit(" ."))))

    # samples of the reported requests and statements
    place = (join_query(links, queries, "queryid").select("rr_uuid", "queryid", "qurr_start_dt")
             .join(requests.select(F.col("rr_uuid").alias("__own"), F.col("pid").alias("report_pid"), "sess_id",
                                   "rr_min_dt"), F.col("rr_uuid") == F.col("__own"), "inner").drop("__own"))
    hits = samples.join(place, (samples["root_request_id"] == place["rr_uuid"])
                        & (samples["query_id"] == place["queryid"]), "inner")
    hits = attach_tablet(hits, tablets, "left").withColumn("pid", F.col("report_pid"))
    where = F.when(F.col("rpc_request_id") == 0,
                   F.concat(F.lit("  "), F.col("host"), F.lit("      "), F.col("wait_event"))).otherwise(
        F.concat(F.lit("    \\ "), F.col("host"), F.lit("    \\ "), F.col("wait_event")))
    what = F.when(F.coalesce("table_name", F.lit("-")) == "-",
                  F.concat(F.lit("    aux: "), F.coalesce("wait_event_aux", F.lit(" - ")))).otherwise(
        F.concat(F.lit("    tbl: "), F.col("table_name")))
    sample_text = F.concat(clock_ms_colon(F.col("sample_time")), F.lit("  "), short,
                           right_pad(where, 35), right_pad(what, 30))
    sample_lines = _lines(hits, (BODY, 3, F.replace(sample_text, F.lit(" aux:  -"), F.lit(" "))))

    pids = only_pid(sessions, pid).select(F.col("pid").cast("long").alias("pid")).distinct()
    end_lines = _lines(pids, (REPORT_END, 0, F.lit(" -- the end -- ")))

    return frame_lines.unionByName(sample_lines).unionByName(end_lines)


def events_per_pid_list(root_requests: DataFrame, links: DataFrame, samples: DataFrame, sessions: DataFrame,
                        pid: int | None = None) -> DataFrame:
    """Flat nested list request / statement / sample. Samples are those of the request itself; listing every
    sample of a statement under each request that ran it would pair all of them with all of them."""
    samples = of_days(samples, root_requests)
    requests = _requests(root_requests, sessions, pid)
    head = F.concat(F.lit("sess: "), F.col("sess_id").cast("string"), F.lit(" "), F.col("rr_uuid"), F.lit(" "),
                    F.date_format("rr_max_dt", "HH:mm.ss"))
    request_lines = _lines(requests, (HEADER, 0, head), (CLOSING, 0, F.lit("\\n")))

    owner = requests.select(F.col("rr_uuid").alias("__rr"), "pid", "sess_id", "rr_min_dt")
    statements = links.join(owner, F.col("rr_uuid") == F.col("__rr"), "inner").drop("__rr")
    stamp = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    text = F.format_string("  Query ID: %d, Qurr Start Date: %s, Duration (ms): %d", F.col("queryid"),
                           F.date_format("qurr_start_dt", stamp), F.col("dur_ms"))
    statement_lines = _lines(statements, (BODY, 1, text))

    place = statements.select(F.col("rr_uuid").alias("__rr"), F.col("queryid").alias("__q"), "rr_uuid", "queryid",
                              F.col("pid").alias("report_pid"), "sess_id", "rr_min_dt", "qurr_start_dt")
    hits = (samples.join(place, (samples["root_request_id"] == place["__rr"]) & (samples["query_id"] == place["__q"]),
                         "inner").drop("__rr", "__q").withColumn("pid", F.col("report_pid")))
    sample_text = F.format_string(
        "    Sample Time: %s, Host: %s, Wait Event: %s, Wait Event Aux: %s, RPC Request ID: %d",
        F.date_format("sample_time", stamp), F.col("host"), F.col("wait_event"),
        F.coalesce("wait_event_aux", F.lit("")), F.col("rpc_request_id"))
    sample_lines = _lines(hits, (BODY, 3, sample_text))
    return request_lines.unionByName(statement_lines).unionByName(sample_lines)
