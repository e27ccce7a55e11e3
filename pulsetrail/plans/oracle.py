"""The same queries in SQL, for an independent engine over the same tables.

`VIEWS` restates the history views; `QUERIES` the reports and operators. `oracle(key)` puts the views a query needs
in front of it.
"""

from __future__ import annotations

import re

from ..schemas import ACTIVITY_STATE, INPUTS, STATEMENT_COUNTERS


def _uuid(seed: str) -> str:
    d = f"md5({seed})"
    return "||'-'||".join(f"substr({d},{a},{n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))


def _node(n: str) -> str:
    return "(" + _uuid(f"'tsrv|'||({n})") + ")"


_SQL_TYPES = {"long": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "DOUBLE", "string": "VARCHAR",
              "timestamp": "TIMESTAMP", "boolean": "BOOLEAN", "decimal": "DOUBLE", "integer": "INTEGER",
              "bigint": "BIGINT"}


def _columns(schema, names, given: dict[str, str]) -> str:
    """`names` as a select list: the given expressions, typed NULLs for the rest."""
    out = []
    for name in names:
        kind = _SQL_TYPES[schema[name].dataType.typeName().split("(")[0]]
        out.append(f"{given[name]} AS {name}" if name in given else f"CAST(NULL AS {kind}) AS {name}")
    return ", ".join(out)


LABEL = "substr(replace(query, chr(10), ' '), 1, 60)"
AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
INTERVAL = "sample_time BETWEEN TIMESTAMP '2024-01-01 00:00:00' AND TIMESTAMP '2024-01-31 00:00:00'"
CUT = "TIMESTAMP '2024-01-16 00:00:00'"
MS = "'%H:%M:%S.%g'"


def _seconds3(a: str, b: str) -> str:
    return f"(datediff('microsecond', {a}, {b}) // 1000) / 1000.0"


_COUNTERS = ("numbackends xact_commit xact_rollback blks_read blks_hit tup_returned tup_fetched tup_inserted tup_updated "
             "tup_deleted conflicts temp_files temp_bytes deadlocks checksum_failures checksum_last_failure "
             "blk_read_time blk_write_time session_time active_time idle_in_transaction_time sessions "
             "sessions_abandoned sessions_fatal sessions_killed stats_reset").split()


def _database_columns() -> str:
    given = {c: "CAST(0 AS " + _SQL_TYPES[INPUTS["databases"][c].dataType.typeName()] + ")" for c in _COUNTERS}
    for c in ("checksum_failures", "checksum_last_failure"):
        del given[c]
    given.update(numbackends="CAST(backends AS INTEGER)", xact_commit="n", xact_rollback="errors",
                 tup_returned="n * 100", temp_bytes="n * 5000000", sessions="backends",
                 active_time="CAST(n AS DOUBLE)", stats_reset="TIMESTAMP '2024-01-01 00:00:00'")
    return _columns(INPUTS["databases"], _COUNTERS, given)


def _statement_counters() -> str:
    return _columns(INPUTS["statements"], STATEMENT_COUNTERS, {"calls": "n", "rows": "n * 10", "plans": "n"})


def _session_view(source: str, gone: str) -> str:
    return f"""
        SELECT user_id AS id, {_node('2 + user_id % 4')} AS tsrv_uuid, 'node'||(2 + user_id % 4) AS host,
               CAST(1000 + user_id AS INTEGER) AS pid, min(ts) AS backend_start, {gone} AS gone_dt,
               '10.0.0.'||user_id AS client_addr, CAST(5000 + user_id AS INTEGER) AS client_port,
               CAST(NULL AS VARCHAR) AS client_hostname, 13515 + user_id % 3 AS datid,
               CASE WHEN user_id % 10 <> 9 THEN CAST(10 AS BIGINT) END AS usesysid,
               CAST(NULL AS INTEGER) AS leader_pid, 'app'||(user_id % 3) AS app_name,
               'client backend' AS backend_type
        FROM {source} GROUP BY user_id"""


VIEWS = {
    "ev": "SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
    "exported": f"""
        SELECT event_id AS sample_id, ts AS sample_time, 'node'||(2 + event_id % 4) AS host,
               {_node('2 + event_id % 4')} AS tsrv_uuid,
               CASE WHEN k <= 7 THEN '00000000-0000-0000-0000-000000000000'
                    ELSE {_uuid("user_id||'|'||CAST(ts AS DATE)")} END AS root_request_id,
               CASE WHEN event_id % 3 <> 0 THEN event_id % 5 END AS rpc_request_id,
               CASE WHEN event_type = 'signup' THEN 'SQL' ELSE 'TServer' END AS wait_event_component,
               CASE WHEN event_type IN ('click', 'view') THEN 'Common' WHEN event_type = 'signup' THEN 'Client'
                    ELSE 'TabletWait' END AS wait_event_class,
               CASE event_type WHEN 'purchase' THEN 'DiskIO' WHEN 'signup' THEN 'Client' WHEN 'error' THEN 'Timeout'
                    ELSE 'Cpu' END AS wait_event_type,
               CASE event_type WHEN 'click' THEN 'OnCpu_Active' WHEN 'view' THEN 'OnCpu_Passive'
                    WHEN 'purchase' THEN 'WAL_Sync' WHEN 'signup' THEN 'ClientRead' ELSE 'Extension' END AS wait_event,
               CASE WHEN event_id % 4 <> 0 THEN substr(md5('tblt|'||(1 + event_id % 50)), 1, 15) END AS wait_event_aux,
               {_node('2 + user_id % 4')} AS top_level_node_id, k AS query_id, 1000 + user_id AS pid,
               '10.0.0.'||user_id||':'||(5000 + user_id) AS client_node_ip, value AS sample_weight,
               13515 + user_id % 3 AS dbid
        FROM ev""",
    "samples": "SELECT * REPLACE (coalesce(rpc_request_id, 0) AS rpc_request_id) FROM exported",
    "seeds": """
        SELECT CAST(column0 AS BIGINT) AS queryid, column1 AS query FROM (VALUES (0, '0 zero'), (1, '1 LogAppender'),
            (2, '2 Flush'), (3, '3 compaction'), (4, '4 RaftUpdateConsensus'), (5, '5 CatalogRequests'),
            (6, '6 LogBackgroundSync'), (7, '7 cron ?')) t(column0, column1)""",
    "queries": "SELECT doc_id AS queryid, text AS query FROM documents WHERE doc_id > 7 UNION ALL SELECT * FROM seeds",
    "labels_": f"SELECT queryid, {LABEL} AS query FROM queries",
    "parts": f"SELECT *, {_uuid("'tblt|'||p_partkey")} AS tblt_uuid FROM part",
    "tablets": """SELECT tblt_uuid, p_name AS table_name, p_brand AS schema_name,
                         substr(replace(tblt_uuid, '-', ''), 1, 15) AS prefix FROM parts""",
    "servers": f"""SELECT 'node'||n AS host, {_node('n')} AS tsrv_uuid FROM (VALUES (2), (3), (4), (5)) t(n)""",
    "replicas": f"""
        SELECT tblt_uuid, {_node('n')} AS tsrv_uuid,
               CASE WHEN p_partkey % 7 = 0 THEN TIMESTAMP '2024-01-20 00:00:00' END AS gone_dt
        FROM parts JOIN (VALUES (2), (3), (4), (5)) t(n) ON (p_partkey + n) % 2 = 1""",
    "sessions": _session_view("events", "CASE WHEN user_id % 5 <> 0 THEN max(ts) END"),
    "tserver_log": f"""
        SELECT datediff('minute', TIMESTAMP '2024-01-01 00:00:00', m) + 1 AS snap_id, {_node('n')} AS tsrv_uuid,
               'node'||n AS host, CAST(views AS DOUBLE) AS rd_psec, CAST(buys AS DOUBLE) AS wr_psec,
               clicks / 100.0 AS cpu_user, errors / 100.0 AS cpu_syst, views, buys
        FROM (SELECT date_trunc('minute', ts) AS m, n,
                     count(*) FILTER (event_type = 'view' AND 2 + event_id % 4 = n) AS views,
                     count(*) FILTER (event_type = 'purchase' AND 2 + event_id % 4 = n) AS buys,
                     count(*) FILTER (event_type = 'click' AND 2 + event_id % 4 = n) AS clicks,
                     count(*) FILTER (event_type = 'error' AND 2 + event_id % 4 = n) AS errors
              FROM events, (VALUES (2), (3), (4), (5)) t(n) GROUP BY 1, 2)
        WHERE NOT (n = 5 AND CAST(m AS DATE) = DATE '2024-01-10')""",
    "snapshots": """SELECT DISTINCT datediff('minute', TIMESTAMP '2024-01-01 00:00:00', date_trunc('minute', ts)) + 1 AS id,
                           CAST(date_trunc('minute', ts) AS TIMESTAMP) AS log_dt FROM events""",
    "database_log": """
        SELECT datid, log_host, log_dt, CAST(sum(s) OVER w AS BIGINT) AS sessions,
               CAST(sum(n) OVER w AS BIGINT) AS tup_returned, CAST(sum(n) OVER w AS BIGINT) * 5000000 AS temp_bytes
        FROM (SELECT CAST(date_trunc('minute', ts) AS TIMESTAMP) AS log_dt, 'node'||(2 + event_id % 4) AS log_host,
                     13515 + user_id % 3 AS datid, count(*) FILTER (event_type = 'signup') AS s, count(*) AS n
              FROM events GROUP BY 1, 2, 3)
        WINDOW w AS (PARTITION BY log_host, datid ORDER BY log_dt ROWS UNBOUNDED PRECEDING)""",
    "rr": f"""
        SELECT own.id AS sess_id, seen.root_request_id AS rr_uuid, min(seen.sample_time) AS rr_min_dt,
               max(seen.sample_time) AS rr_max_dt
        FROM sessions own JOIN samples seen ON seen.pid = own.pid AND seen.top_level_node_id = own.tsrv_uuid
        WHERE seen.sample_time >= own.backend_start AND seen.sample_time <= coalesce(own.gone_dt, {AS_OF})
          AND seen.sample_time > TIMESTAMP '2024-01-01 00:00:00' AND own.usesysid IS NOT NULL
          AND NOT starts_with(seen.root_request_id, '0000') GROUP BY ALL""",
    "links": """
        SELECT rm.rr_uuid, al.query_id AS queryid, min(sample_time) AS qurr_start_dt,
               CAST(round(datediff('microsecond', min(sample_time), max(sample_time)) / 1000.0) AS BIGINT) AS dur_ms
        FROM (SELECT DISTINCT rr_uuid FROM rr) rm JOIN samples al ON rm.rr_uuid = al.root_request_id
        GROUP BY 1, 2""",
    "prefix_names": "SELECT prefix, min(table_name) AS table_name FROM tablets GROUP BY 1",
    # exports and known state
    "known_sessions": _session_view(f"(SELECT * FROM events WHERE ts < {CUT})",
                                    f"CASE WHEN user_id % 5 = 4 THEN {CUT} END"),
    "activity": f"""
        SELECT 'node'||(2 + user_id % 4) AS host, {_node('2 + user_id % 4')} AS tsrv_uuid, user_id,
               CAST(1000 + user_id AS INTEGER) AS pid, 13515 + user_id % 3 AS datid,
               CASE WHEN user_id % 7 = 0 THEN min(ts) FILTER (ts >= {CUT}) ELSE min(ts) END AS backend_start,
               max(ts) AS last_ts, CASE WHEN user_id % 4 <> 0 THEN max(ts) END AS query_start,
               max(k) FILTER (ts >= TIMESTAMP '2024-01-30 00:00:00') AS query_id
        FROM ev GROUP BY user_id HAVING max(ts) >= TIMESTAMP '2024-01-30 00:00:00'""",
    "statements": """
        SELECT host, tsrv_uuid, query_id AS queryid, dbid, count(*) AS n,
               CASE WHEN query_id % 10 = 0 THEN 'explain select '||query_id
                    WHEN query_id % 10 <> 1 THEN 'select '||dbid||' from t'||query_id END AS query
        FROM exported GROUP BY host, tsrv_uuid, query_id, dbid""",
    "known_statements": """
        SELECT tsrv_uuid, query_id AS queryid, dbid, count(*) AS n FROM exported
        WHERE sample_time < TIMESTAMP '2024-01-29 00:00:00' GROUP BY host, tsrv_uuid, query_id, dbid""",
    "changed_statements": """
        SELECT * FROM statements s WHERE upper(left(query, 20)) NOT LIKE '%EXPLAIN%' AND NOT EXISTS (
            SELECT 1 FROM known_statements o WHERE o.tsrv_uuid = s.tsrv_uuid AND o.queryid = s.queryid
            AND o.dbid = s.dbid AND o.n = s.n)""",
    "known_queries": """
        SELECT queryid, CASE WHEN queryid % 2 = 0 THEN TIMESTAMP '2024-01-30 23:30:00'
                             ELSE TIMESTAMP '2024-01-30 22:00:00' END AS log_dt,
               CAST(NULL AS VARCHAR) AS log_tsrv, 'node2' AS log_host,
               CASE queryid % 3 WHEN 1 THEN '  ' WHEN 2 THEN 'known '||queryid END AS query
        FROM (SELECT DISTINCT query_id AS queryid FROM exported
              WHERE sample_time < TIMESTAMP '2024-01-01 06:00:00' AND query_id > 7)
        UNION ALL SELECT queryid, TIMESTAMP '2024-01-01 00:00:00', CAST(NULL AS VARCHAR), 'node2', query FROM seeds""",
    "from_samples": f"""
        SELECT query_id AS queryid, min(sample_time) AS log_dt, arg_min(tsrv_uuid, (sample_time, host)) AS log_tsrv,
               arg_min(host, (sample_time, host)) AS log_host, CAST(NULL AS VARCHAR) AS query
        FROM exported WHERE sample_time > {AS_OF} - INTERVAL 12 HOUR
          AND query_id NOT IN (SELECT queryid FROM known_queries) GROUP BY query_id""",
    "from_activity": f"""
        SELECT query_id AS queryid, min(coalesce(query_start, {AS_OF})) AS log_dt,
               arg_min(tsrv_uuid, (coalesce(query_start, {AS_OF}), host)) AS log_tsrv,
               arg_min(host, (coalesce(query_start, {AS_OF}), host)) AS log_host, 'select '||query_id AS query
        FROM activity WHERE query_id IS NOT NULL AND query_id NOT IN (SELECT queryid FROM known_queries)
          AND query_id NOT IN (SELECT queryid FROM from_samples) GROUP BY query_id""",
    "from_statements": f"""
        SELECT queryid, {AS_OF} AS log_dt, arg_min(tsrv_uuid, host) AS log_tsrv, min(host) AS log_host,
               min(query) AS query
        FROM statements WHERE queryid NOT IN (SELECT queryid FROM known_queries)
          AND queryid NOT IN (SELECT queryid FROM from_samples)
          AND queryid NOT IN (SELECT queryid FROM from_activity) GROUP BY queryid""",
    "all_queries": """SELECT * FROM known_queries UNION ALL SELECT * FROM from_samples
                      UNION ALL SELECT * FROM from_activity UNION ALL SELECT * FROM from_statements""",
    "databases": """
        SELECT host, tsrv_uuid, dbid AS datid, count(*) AS n, count(DISTINCT pid) AS backends,
               count(*) FILTER (wait_event_type = 'Timeout') AS errors
        FROM exported GROUP BY 1, 2, 3""",
    "known_databases": """
        SELECT DISTINCT dbid AS datid, 'db'||dbid AS datname, 'node2' AS log_host,
               TIMESTAMP '2024-01-01 00:00:00' AS log_dt
        FROM exported WHERE sample_time < TIMESTAMP '2024-01-01 00:05:00'""",
    "known_tablets": f"""
        SELECT tblt_uuid, 'user' AS table_type, p_brand AS schema_name, p_name AS table_name,
               TIMESTAMP '2024-01-01 00:00:00' AS log_dt, CASE WHEN p_size % 5 = 0 THEN {CUT} END AS gone_dt
        FROM parts WHERE p_size <= 25""",
    "known_replicas": f"""
        SELECT tblt_uuid, {_node('n')} AS tsrv_uuid, TIMESTAMP '2024-01-01 00:00:00' AS log_dt,
               CASE WHEN p_size % 5 = 0 THEN {CUT} END AS gone_dt
        FROM parts JOIN (VALUES (2), (3), (4), (5)) t(n) ON (p_partkey + n) % 2 = 1 WHERE p_size <= 25""",
    "local_tablets": f"""
        SELECT tblt_uuid, p_brand AS schema_name, p_name AS table_name, 'node'||n AS host, {_node('n')} AS tsrv_uuid
        FROM parts JOIN (VALUES (2), (3), (4), (5)) t(n)
          ON (p_partkey + n + CASE WHEN p_size = 7 THEN 1 ELSE 0 END) % 2 = 1
        WHERE p_size NOT IN (8, 18)""",
    "opened_tablets": """
        SELECT tblt_uuid, min(schema_name) AS schema_name, min(table_name) AS table_name, min(host) AS log_host,
               arg_min(tsrv_uuid, host) AS log_tsrv FROM local_tablets
        WHERE tblt_uuid NOT IN (SELECT tblt_uuid FROM known_tablets WHERE gone_dt IS NULL) GROUP BY tblt_uuid""",
    "tracked": f"""
        SELECT k.tblt_uuid, k.tsrv_uuid, k.log_dt,
               CASE WHEN k.gone_dt IS NULL AND l.tblt_uuid IS NULL THEN {AS_OF} ELSE k.gone_dt END AS gone_dt
        FROM known_replicas k LEFT JOIN local_tablets l ON k.tblt_uuid = l.tblt_uuid AND k.tsrv_uuid = l.tsrv_uuid
        UNION ALL
        SELECT l.tblt_uuid, l.tsrv_uuid, {AS_OF}, NULL FROM local_tablets l
        WHERE NOT EXISTS (SELECT 1 FROM known_replicas k WHERE k.gone_dt IS NULL AND k.tblt_uuid = l.tblt_uuid
                          AND k.tsrv_uuid = l.tsrv_uuid)""",
    "known_events": """SELECT DISTINCT wait_event_component, wait_event FROM exported
                       WHERE sample_time < TIMESTAMP '2024-01-01 00:05:00'""",
    "all_sessions": "SELECT * FROM known_sessions UNION ALL SELECT * FROM sessions",
    "quiet": "SELECT * FROM samples WHERE NOT (wait_event = 'Extension' AND query_id IN (5, 7))",
    "loaded": f"""
        SELECT n.* FROM quiet n WHERE n.sample_time >= {CUT} AND NOT EXISTS (
            SELECT 1 FROM quiet o WHERE o.sample_time < TIMESTAMP '2024-01-17 00:00:00' AND o.host = n.host
              AND o.sample_time = n.sample_time AND o.root_request_id = n.root_request_id
              AND o.rpc_request_id = n.rpc_request_id AND o.wait_event = n.wait_event)""",
    "opened_sessions": """
        SELECT a.* FROM activity a WHERE NOT EXISTS (
            SELECT 1 FROM known_sessions k WHERE k.host = a.host AND k.pid = a.pid
              AND k.backend_start = a.backend_start AND k.gone_dt IS NULL)""",
    "some_sessions": "SELECT * FROM known_sessions WHERE datid <> 13517",
    "ghosts": """
        SELECT top_level_node_id AS tsrv_uuid, arg_min(host, (sample_time, host)) AS host, pid,
               min(sample_time) AS backend_start, client_node_ip, dbid FROM exported e
        WHERE NOT EXISTS (SELECT 1 FROM some_sessions m WHERE m.tsrv_uuid = e.top_level_node_id AND m.pid = e.pid)
        GROUP BY top_level_node_id, pid, client_node_ip, dbid""",
    "kv": """
        SELECT host, snap_id, 'nr_processes' AS key, CAST(buys AS VARCHAR) AS value FROM tserver_log
        UNION ALL SELECT host, snap_id, 'master_mem', CAST(buys * 1000 AS VARCHAR) FROM tserver_log
        UNION ALL SELECT host, snap_id, 'tserver_mem', CAST(buys * 3000 AS VARCHAR) FROM tserver_log
        UNION ALL SELECT host, snap_id, 'disk_usage_mb', CAST(buys + 7 AS VARCHAR) FROM tserver_log WHERE snap_id % 9 <> 0
        UNION ALL SELECT host, snap_id, 'top_info', CASE WHEN snap_id % 4 <> 0 THEN 'load=0.'||buys END FROM tserver_log""",
    "kv_wide": """
        SELECT host, snap_id, CAST(buys AS INTEGER) AS nr_processes, buys * 1000 AS master_mem,
               buys * 3000 AS tserver_mem, buys + 7 AS disk_usage_mb,
               CASE WHEN snap_id % 4 <> 0 THEN 'load=0.'||buys END AS top_info
        FROM tserver_log WHERE snap_id % 9 <> 0""",
    "metrics": """
        SELECT snap_id, tsrv_uuid, views * 3000000 // 1048576 AS mem_free_mb, views * 90000000 // 1048576 AS mem_total_mb,
               views * 50000000 // 1048576 AS mem_avail_mb, views * 20000000 // 1048576 AS ts_root_mem_limit_mb,
               views * 17000000 // 1048576 AS ts_root_mem_slimit_mb, views * 1500000 // 1048576 AS ts_root_mem_cons_mb,
               cpu_user, cpu_syst, 'OK' AS ts_status, '' AS ts_error FROM tserver_log""",
    "bursts": """
        SELECT top_level_node_id, pid, sample_time, CAST(sum(fresh) OVER (PARTITION BY top_level_node_id, pid
                 ORDER BY sample_time, sample_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS burst
        FROM (SELECT *, CASE WHEN sample_time < lag(sample_time) OVER (PARTITION BY top_level_node_id, pid
                 ORDER BY sample_time, sample_id) + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM samples)""",
    # the event tree
    "tree_rr": """
        SELECT rr.*, CAST(sm.pid AS BIGINT) AS pid, client_addr, client_port, app_name,
               row_number() OVER (PARTITION BY sm.pid ORDER BY rr_min_dt, rr_uuid, sess_id) AS rr_no
        FROM rr JOIN sessions sm ON rr.sess_id = sm.id""",
    "tree_ql": """
        SELECT r.pid, r.rr_min_dt, r.rr_uuid, r.sess_id, l.qurr_start_dt, l.queryid, l.dur_ms, q.query, r.rr_no,
               row_number() OVER (PARTITION BY r.sess_id, r.rr_uuid ORDER BY l.qurr_start_dt, l.queryid) AS ql_no,
               (SELECT count(*) FROM samples s WHERE s.root_request_id = r.rr_uuid AND s.query_id = l.queryid) AS al_no,
               strftime(l.qurr_start_dt, '%H:%M:%S.%g')||'  '||substr(r.rr_uuid, 1, 2) AS start
        FROM tree_rr r JOIN links l ON l.rr_uuid = r.rr_uuid JOIN labels_ q ON q.queryid = l.queryid""",
    "tree_al": """
        SELECT t.pid, t.rr_min_dt, t.rr_uuid, t.sess_id, t.qurr_start_dt, t.queryid, s.sample_time, s.sample_id, s.host,
               s.wait_event, s.wait_event_aux, s.rpc_request_id, n.table_name
        FROM tree_ql t JOIN samples s ON s.root_request_id = t.rr_uuid AND s.query_id = t.queryid
        LEFT JOIN prefix_names n ON n.prefix = s.wait_event_aux""",
    "tree_last": "SELECT sess_id, rr_uuid, max(qurr_start_dt) AS last_start FROM tree_ql GROUP BY 1, 2",
}

_KEY_RR = "pid, rr_min_dt, rr_uuid, sess_id"
_NO_QL = "CAST(NULL AS TIMESTAMP) AS qurr_start_dt, CAST(NULL AS BIGINT) AS queryid"
_NO_AL = "CAST(NULL AS TIMESTAMP) AS sample_time, CAST(NULL AS BIGINT) AS sample_id"


def _line(keys: str, section: int, ql: str, part: int, al: str, text: str, source: str) -> str:
    return (f"SELECT {keys}, CAST({section} AS INTEGER) AS section, {ql}, CAST({part} AS INTEGER) AS part, {al}, "
            f"{text} AS output FROM {source}")


# Fixed format: the line texts of the tree.
_QL = "qurr_start_dt, queryid"
_EVENT_TREE = " UNION ALL ".join([
    _line(_KEY_RR, 0, _NO_QL, 0, _NO_AL,
          "strftime(rr_min_dt, '%H:%M:%S.%g')||'  '||rr_uuid||' from pid: '||pid||' clnt: '||client_addr||':'||client_port"
          "||' app: '||app_name||'  '", "tree_rr"),
    _line("r.pid, r.rr_min_dt, r.rr_uuid, r.sess_id", 2, _NO_QL, 0, _NO_AL,
          "strftime(coalesce(last_start, rr_min_dt), '%H:%M:%S.%g')||'  '||substr(r.rr_uuid, 1, 2)"
          "||' -- -- -- end RR -- -- -- / '",
          "tree_rr r LEFT JOIN tree_last z ON z.sess_id = r.sess_id AND z.rr_uuid = r.rr_uuid"),
    _line(_KEY_RR, 2, _NO_QL, 1, _NO_AL, "' .'", "tree_rr"),
    _line(_KEY_RR, 1, _QL, 0, _NO_AL, "start", "tree_ql"),
    _line(_KEY_RR, 1, _QL, 1, _NO_AL, "start||'  qry_id: '||lpad(CAST(queryid AS VARCHAR), 20, ' ')||'  qry: '||query",
          "tree_ql"),
    _line(_KEY_RR, 1, _QL, 2, _NO_AL, "start", "tree_ql"),
    _line(_KEY_RR, 1, _QL, 4, _NO_AL, "start||'   -- -- -- end qry -- -- -- / '||'        ( rr:'||rr_no||' ql:'||ql_no"
          "||' al:'||al_no||')'", "tree_ql"),
    _line(_KEY_RR, 1, _QL, 3, "sample_time, sample_id",
          "replace(strftime(sample_time, '%H:%M:%S:%g')||'  '||substr(rr_uuid, 1, 2)||rpad(CASE rpc_request_id WHEN 0 THEN "
          "'  '||host||'      '||wait_event ELSE '    \\ '||host||'    \\ '||wait_event END, 35, ' ')||rpad(CASE WHEN "
          "table_name IS NULL THEN '    aux: '||coalesce(wait_event_aux, ' - ') ELSE '    tbl: '||table_name END, 30, ' '),"
          " ' aux:  -', ' ')", "tree_al"),
    _line("pid, CAST(NULL AS TIMESTAMP) AS rr_min_dt, CAST(NULL AS VARCHAR) AS rr_uuid, CAST(NULL AS BIGINT) AS sess_id",
          9, _NO_QL, 0, _NO_AL, "' -- the end -- '", "(SELECT DISTINCT CAST(pid AS BIGINT) AS pid FROM sessions)"),
])
_STAMP = "'%Y-%m-%d %H:%M:%S.%f'"
_EVENTS_LIST = " UNION ALL ".join([
    _line(_KEY_RR, 0, _NO_QL, 0, _NO_AL, "'sess: '||sess_id||' '||rr_uuid||' '||strftime(rr_max_dt, '%H:%M.%S')", "tree_rr"),
    _line(_KEY_RR, 2, _NO_QL, 0, _NO_AL, "'\\n'", "tree_rr"),
    _line("r.pid, r.rr_min_dt, r.rr_uuid, r.sess_id", 1, _QL, 1, _NO_AL,
          f"'  Query ID: '||queryid||', Qurr Start Date: '||strftime(qurr_start_dt, {_STAMP})||', Duration (ms): '||dur_ms",
          "tree_rr r JOIN links l ON l.rr_uuid = r.rr_uuid"),
    _line("r.pid, r.rr_min_dt, r.rr_uuid, r.sess_id", 1, _QL, 3, "sample_time, sample_id",
          f"'    Sample Time: '||strftime(sample_time, {_STAMP})||', Host: '||s.host||', Wait Event: '||wait_event"
          "||', Wait Event Aux: '||coalesce(wait_event_aux, '')||', RPC Request ID: '||rpc_request_id",
          "tree_rr r JOIN links l ON l.rr_uuid = r.rr_uuid JOIN samples s ON s.root_request_id = l.rr_uuid "
          "AND s.query_id = l.queryid"),
])


def _wide(pairs: list[tuple[str, str]]) -> str:
    """Four self-joins of the server log, one per host, as the dashboard views are written."""
    cells = ", ".join(f"t{n}.{c} AS n{n}_{s}" for n in (2, 3, 4, 5) for c, s in pairs)
    joins = " ".join(f"JOIN tserver_log t{n} ON sl.id = t{n}.snap_id AND t{n}.host = 'node{n}'" for n in (2, 3, 4, 5))
    return f"SELECT sl.log_dt, {cells} FROM snapshots sl {joins}"


def _counts(component: str, steps: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{component}' AS component, '{s}' AS step, (SELECT count(*) FROM {source}) AS n_rows"
                              for s, source in steps.items())


_WAITS = ", ".join([*[f"count(*) FILTER (wait_event_type = '{k}') AS {n}" for n, k in (
    ("timeout", "Timeout"), ("network", "Network"), ("disk_io", "DiskIO"), ("wait_on_condition", "WaitOnCondition"),
    ("io", "IO"), ("client", "Client"))],
    "count(*) FILTER (wait_event_type||'_'||wait_event = 'Cpu_OnCpu_Active') AS cpu_active",
    "count(*) FILTER (wait_event_type||'_'||wait_event = 'Cpu_OnCpu_Passive') AS cpu_passive"])

_ACTIVITY = {"application_name": "'app'||(user_id % 3)", "client_addr": "'10.0.0.'||user_id||'/32'",
             "client_port": "CAST(5000 + user_id AS INTEGER)", "backend_start": "a.backend_start",
             "xact_start": "last_ts", "query_start": "query_start", "state_change": "last_ts", "state": "'active'",
             "query_id": "query_id", "query": "'select '||query_id", "backend_type": "'client backend'"}

# Samples are counted per server and tablet prefix before anything is joined.
_TABLET_TOP = """
    WITH counted AS (SELECT tsrv_uuid, wait_event_aux, count(*) AS n FROM samples WHERE {interval} GROUP BY ALL),
    held AS (SELECT tsrv_uuid, tblt_uuid FROM replicas WHERE gone_dt IS NULL)
    SELECT CAST(sum(n) AS BIGINT) AS cnt, servers.host, wait_event_aux, schema_name, table_name
    FROM counted JOIN held USING (tsrv_uuid) JOIN servers USING (tsrv_uuid)
    JOIN tablets ON tablets.prefix = wait_event_aux {tie}
    GROUP BY ALL ORDER BY cnt DESC, host, wait_event_aux, schema_name, table_name LIMIT 20"""

_INVENTORY = ["customer", "documents", "events", "labels", "lineitem", "orders", "pages", "part", "supplier"]

def _overlapping(table: str, keys: str, start: str) -> str:
    """Intervals that begin while an earlier one of their key lasts."""
    return f"""
        SELECT * FROM {table} WHERE {start} IS NOT NULL AND (gone_dt IS NULL OR gone_dt > {start})
        QUALIFY max(coalesce(gone_dt, TIMESTAMP 'infinity')) OVER (PARTITION BY {keys} ORDER BY {start}
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > {start}"""


def _key_report() -> str:
    def line(table: str, constraint: str, rows: str) -> str:
        return f"""SELECT '{table}' AS table_name, '{constraint}' AS "constraint", count(*) AS n_rows FROM ({rows})"""

    unique = {"session_mst": ("all_sessions", "id"), "query_mst": ("known_queries", "queryid"),
              "database_mst": ("known_databases", "datid"), "database_log": ("database_log", "datid, log_host, log_dt"),
              "tablet_rep": ("known_replicas", "tblt_uuid, tsrv_uuid, log_dt"),
              "tserver_log": ("tserver_log", "snap_id, tsrv_uuid"), "snapshot_log": ("snapshots", "id"),
              "root_request_query_lnk": ("(SELECT query_id AS queryid, root_request_id AS rr_uuid FROM samples)",
                                         "queryid, rr_uuid")}
    lines = [line(t, f"unique {keys}", f"SELECT * FROM {source} x QUALIFY count(*) OVER (PARTITION BY {keys}) > 1")
             for t, (source, keys) in unique.items()]
    parents = [("tserver_log", "snap_id", "snapshot_log", "snapshots", "id", "tserver_log"),
               ("root_request_query_lnk", "queryid", "query_mst", "known_queries", "queryid",
                "(SELECT query_id AS queryid FROM samples)"),
               ("database_log", "datid", "database_mst", "known_databases", "datid", "database_log")]
    lines += [line(child, f"{key} in {parent}", f"SELECT * FROM {source} c WHERE {key} IS NOT NULL AND NOT EXISTS ("
                   f"SELECT 1 FROM {view} p WHERE p.{parent_key} = c.{key})")
              for child, key, parent, view, parent_key, source in parents]
    lines += [line("session_mst", "no overlap of tsrv_uuid, pid",
                   _overlapping("all_sessions", "tsrv_uuid, pid", "backend_start")),
              line("tablet_rep", "no overlap of tblt_uuid, tsrv_uuid",
                   _overlapping("known_replicas", "tblt_uuid, tsrv_uuid", "log_dt"))]
    return " UNION ALL ".join(lines)


QUERIES = {
    "interval_summary": f"""
        SELECT 'report on interval :' AS titl, '2024-01-01 00:00:00' AS from_dt, '2024-31-01 00:00:00' AS to_dt,
               count(*) AS cnt_samples FROM samples WHERE {INTERVAL}""",
    "minute_host_crosstab": "SELECT upper(strftime(sample_time, '%j %a %H:%M:00')) AS dt_hr, " + ", ".join(
        f"nullif(count(*) FILTER (host = 'node{n}'), 0) AS node{n}" for n in (2, 3, 4, 5))
        + ", nullif(count(*) FILTER (coalesce(host NOT IN ('node2', 'node3', 'node4', 'node5'), true)), 0) AS other"
        + f" FROM samples WHERE {INTERVAL} GROUP BY 1",
    "busiest_nodes": f"""
        SELECT count(*) AS recs_in_intrv, strftime(min(sample_time), '%Y-%m-%d %H:%M:%S') AS oldest_stored,
               strftime(max(sample_time), '%Y-%m-%d %H:%M:%S') AS latest_stored,
               datediff('microsecond', max(sample_time), {AS_OF}) // 1000000 AS secs_ago, host
        FROM samples WHERE {INTERVAL} GROUP BY host""",
    "busiest_components": f"""
        SELECT count(*) AS cnt, host, wait_event_component AS busiest_comp, wait_event_class FROM samples
        WHERE {INTERVAL} GROUP BY 2, 3, 4""",
    "busiest_events": f"""
        SELECT count(*) AS cnt, wait_event_class, wait_event_type, wait_event AS busiest_event, host AS per_host
        FROM samples WHERE {INTERVAL} GROUP BY 2, 3, 4, 5 ORDER BY cnt DESC, 2, 3, 4, 5 LIMIT 40""",
    "busiest_tablets": _TABLET_TOP.format(tie="AND tablets.tblt_uuid = held.tblt_uuid", interval=INTERVAL),
    "busiest_tablets_as_written": _TABLET_TOP.format(tie="", interval=INTERVAL),
    "top_queries": f"""
        SELECT count(*) AS cnt_ashev, count(DISTINCT root_request_id) AS nr_rreq, query_id AS top_qry, q.query
        FROM samples JOIN labels_ q ON queryid = query_id WHERE {INTERVAL} AND root_request_id NOT LIKE '0000%'
        GROUP BY query_id, q.query ORDER BY cnt_ashev DESC, top_qry LIMIT 20""",
    "top_query_per_rr": f"""
        SELECT cnt, substr(root_request_id, 1, 9) AS top_root_req, top_qry, query FROM (
            SELECT count(*) AS cnt, root_request_id, queryid AS top_qry, max(q.query) AS query
            FROM samples JOIN labels_ q ON queryid = query_id WHERE {INTERVAL} AND root_request_id NOT LIKE '0000%'
            GROUP BY root_request_id, queryid ORDER BY cnt DESC, root_request_id, queryid LIMIT 20)""",
    "top_query_per_pid": f"""
        SELECT count(*) AS cnt, pid AS top_pid, queryid AS top_qry, max(q.query) AS query
        FROM samples JOIN labels_ q ON queryid = query_id WHERE {INTERVAL} AND root_request_id NOT LIKE '0000%'
        GROUP BY pid, queryid ORDER BY cnt DESC, top_pid, top_qry LIMIT 20""",
    "slowest_queries": f"""
        SELECT queryid, datediff('microsecond', min(sample_time), max(sample_time)) // 1000000 AS max_sec,
               count(*) AS nr_occ, max(q.query) AS query
        FROM samples JOIN labels_ q ON queryid = query_id WHERE {INTERVAL} AND root_request_id NOT LIKE '0000%'
          AND queryid NOT BETWEEN -7 AND 7 GROUP BY queryid
        HAVING datediff('microsecond', min(sample_time), max(sample_time)) > 1000000""",
    "longest_rr_query": """
        SELECT root_request_id, query_id, min(sample_time) AS min_time, max(sample_time) AS max_time,
               datediff('microsecond', min(sample_time), max(sample_time)) / 1000000.0 AS sec
        FROM samples WHERE root_request_id NOT LIKE '0000%' AND query_id NOT BETWEEN -7 AND 7 GROUP BY 1, 2""",
    "sample_coverage": """SELECT host, min(sample_time) AS earliest_sample, max(sample_time) AS latest_sample
                          FROM samples GROUP BY host""",
    "rr_view": """
        SELECT sess_id, tsrv_uuid, pid, backend_start, host,
               CAST('0x'||substr(replace(rr_uuid, '-', ''), 1, 15) AS BIGINT) AS id, rr_uuid, rr_min_dt, rr_max_dt,
               datediff('microsecond', rr_min_dt, rr_max_dt) / 1000.0 AS dur_ms, app_name
        FROM rr JOIN sessions sm ON rr.sess_id = sm.id""",
    "wait_type_per_minute": f"SELECT date_trunc('minute', sample_time) AS dt, {_WAITS} FROM samples GROUP BY 1",
    "tserver_rw_wide": _wide([("rd_psec", "rds"), ("wr_psec", "wrs")]),
    "tserver_cpu_wide": _wide([("cpu_user", "usr"), ("cpu_syst", "sys")]),
    "snapshot_freshness": f"""
        SELECT ela_sec, ela_sec < 180 AS nogo FROM (SELECT datediff('microsecond',
            coalesce(max(log_dt), {AS_OF} - INTERVAL 3601 SECOND), {AS_OF}) // 1000000 AS ela_sec FROM snapshots)""",
    "database_counter_delta": """
        SELECT datid, log_host, log_dt, sessions, sessions - lag(sessions) OVER w AS delta_sess,
               tup_returned - lag(tup_returned) OVER w AS delta_tup_ret,
               (temp_bytes - lag(temp_bytes) OVER w) // 1024 // 1024 AS delta_temp_mb, tup_returned, temp_bytes
        FROM database_log WINDOW w AS (PARTITION BY log_host, datid ORDER BY log_dt)
        ORDER BY log_dt DESC, log_host, datid LIMIT 100""",
    "latest_rows": """SELECT sample_id, host, sample_time, wait_event FROM samples
                      ORDER BY sample_time DESC, sample_id LIMIT 3""",
    "latest_snapshot": """SELECT snap_id, host, tsrv_uuid FROM tserver_log
                          WHERE snap_id = (SELECT max(snap_id) FROM tserver_log)""",
    "substring_self_join": """
        WITH s1 AS (SELECT substring(text, 10, 3) AS sub, count(*) AS n1 FROM documents GROUP BY 1),
             s2 AS (SELECT substring(text, 90, 3) AS sub, count(*) AS n2 FROM documents GROUP BY 1),
             s3 AS (SELECT substring(text, 50, 3) AS sub, count(*) AS n3 FROM documents GROUP BY 1)
        SELECT sub, n1, n2, n3, n1 * n2 * n3 AS triples FROM s1 JOIN s2 USING (sub) JOIN s3 USING (sub)""",
    "table_inventory": " UNION ALL ".join(f"SELECT '{t}' AS relname, count(*) AS rows FROM {t}" for t in _INVENTORY),
    "build_root_requests": "SELECT * FROM rr",
    "build_root_requests_temporal": f"""
        SELECT sm.id AS sess_id, al.root_request_id AS rr_uuid, min(sample_time) AS rr_min_dt,
               max(sample_time) AS rr_max_dt
        FROM samples al JOIN sessions sm ON al.top_level_node_id = sm.tsrv_uuid AND al.pid = sm.pid
          AND sample_time BETWEEN backend_start AND coalesce(gone_dt, {AS_OF})
        WHERE al.root_request_id NOT LIKE '0000%' AND sample_time > TIMESTAMP '2024-01-01 00:00:00'
          AND usesysid IS NOT NULL GROUP BY 1, 2""",
    "build_rr_query_links": "SELECT * FROM links",
    "merge_spans": "SELECT * FROM rr",
    "merge_links": "SELECT * FROM links WHERE queryid IS NOT NULL",
    "session_info": f"""
        SELECT id AS sess_id, host, pid, app_name, substr(client_addr||':'||client_port, 1, 25) AS client_info,
               strftime(backend_start, '%H:%M:%S') AS sess_start, {_seconds3('backend_start', 'gone_dt')} AS dur_secs
        FROM sessions""",
    "session_rr": f"""
        SELECT pid, substr(rr_uuid, 1, 8) AS rr_short, rr_uuid, strftime(rr_min_dt, '%H:%M:%S') AS rr_start,
               {_seconds3('backend_start', 'rr_min_dt')} AS secs_in, {_seconds3('rr_min_dt', 'rr_max_dt')} AS rr_duration_s
        FROM rr JOIN sessions sm ON rr.sess_id = sm.id""",
    "session_queries": f"""
        SELECT sm.pid, q.queryid, q.query, count(*) AS nr_of_rr, strftime(min(qurr_start_dt), {MS}) AS first_occ,
               CAST(sum(dur_ms) AS BIGINT) AS total_ms
        FROM rr JOIN links l ON rr.rr_uuid = l.rr_uuid JOIN labels_ q ON q.queryid = l.queryid
        JOIN sessions sm ON sm.id = rr.sess_id GROUP BY 1, 2, 3""",
    "session_rr_queries": f"""
        SELECT sm.pid, CASE WHEN rr.rr_uuid = lag(rr.rr_uuid) OVER w THEN NULL ELSE substr(rr.rr_uuid, 1, 4) END AS rr_uuid,
               strftime(qurr_start_dt, {MS}) AS qury_started, q.queryid,
               datediff('microsecond', qurr_start_dt, lead(qurr_start_dt) OVER w) // 1000 AS lag_ms, dur_ms, q.query
        FROM rr JOIN links l ON rr.rr_uuid = l.rr_uuid JOIN labels_ q ON q.queryid = l.queryid
        JOIN sessions sm ON sm.id = rr.sess_id
        WINDOW w AS (PARTITION BY rr.sess_id ORDER BY qurr_start_dt, rr.rr_uuid, q.queryid)""",
    "session_rr_events": """
        SELECT sm.pid, substr(rr.rr_uuid, 1, 8) AS rr_uuid, strftime(sample_time, ' - %H:%M:%S.%g') AS sample_tim,
               al.host, wait_event, query_id
        FROM rr JOIN samples al ON rr.rr_uuid = al.root_request_id JOIN sessions sm ON sm.id = rr.sess_id""",
    "session_events": f"""
        SELECT sm.pid, CASE WHEN rr.rr_uuid = lag(rr.rr_uuid) OVER w THEN NULL ELSE substr(rr.rr_uuid, 1, 8) END AS rr_uuid,
               strftime(sample_time, {MS}) AS time_ms,
               CASE rpc_request_id WHEN 0 THEN al.host ELSE ' L '||al.host END||'     '||substr(wait_event, 1, 15) AS event,
               n.table_name, substr(wait_event_aux, 1, 12) AS ev_aux, rpc_request_id AS rpc_r_id
        FROM samples al LEFT JOIN prefix_names n ON n.prefix = al.wait_event_aux
        JOIN rr ON rr.rr_uuid = al.root_request_id JOIN sessions sm ON sm.id = rr.sess_id
        JOIN queries q ON q.queryid = al.query_id
        WINDOW w AS (PARTITION BY rr.sess_id ORDER BY sample_time, sample_id)""",
    "rr_session": f"""
        SELECT rr_uuid, sess_id, host, app_name, substr(client_addr||':'||client_port, 1, 25) AS client_info,
               strftime(backend_start, '%d %H:%M:%S') AS sess_start, strftime(gone_dt, '%d %H:%M:%S') AS backend_end,
               {_seconds3('backend_start', 'gone_dt')} AS dur_secs FROM rr JOIN sessions sm ON sm.id = rr.sess_id""",
    "rr_timing": f"""
        SELECT CAST('0x'||substr(replace(rr_uuid, '-', ''), 1, 15) AS BIGINT) AS rr_id, host, rr_uuid,
               strftime(rr_min_dt, '%H:%M:%S') AS rr_start, {_seconds3('backend_start', 'rr_min_dt')} AS secs_into_sess,
               datediff('microsecond', rr_min_dt, rr_max_dt) / 1000.0 AS rr_duration_ms
        FROM rr JOIN sessions sm ON sm.id = rr.sess_id""",
    "rr_queries": """SELECT rr.rr_uuid, q.queryid, q.query FROM rr JOIN links l ON l.rr_uuid = rr.rr_uuid
                     JOIN labels_ q ON q.queryid = l.queryid""",
    "rr_events": """SELECT rr_uuid, strftime(sample_time, ' - %H:%M:%S.%g') AS sample_tim, host, wait_event, query_id
                    FROM rr JOIN samples al ON rr.rr_uuid = al.root_request_id""",
    "query_rrs": f"""
        SELECT qm.queryid, substr(rm.rr_uuid, 1, 8) AS root_req,
               CAST('0x'||substr(replace(rm.rr_uuid, '-', ''), 1, 15) AS BIGINT) AS rr_id,
               strftime(rr_min_dt, {MS}) AS st_time, {_seconds3('rr_min_dt', 'rr_max_dt')} AS nr_seconds, count(*) AS cnt_ash
        FROM queries qm JOIN links ql ON qm.queryid = ql.queryid JOIN rr rm ON rm.rr_uuid = ql.rr_uuid
        JOIN samples al ON rm.rr_uuid = al.root_request_id
        WHERE rr_min_dt > TIMESTAMP '2024-01-01 00:00:00' GROUP BY 1, 2, 3, 4, 5, rm.rr_uuid""",
    "query_text": "SELECT * FROM queries",
    "event_tree": _EVENT_TREE,
    "event_tree_tmp": _EVENT_TREE,
    "events_per_pid_list": _EVENTS_LIST,
    "read_kv": "SELECT * FROM kv",
    "normalise_listing": """
        SELECT snap_id, host AS file_host, tsrv_uuid||'|'||host||'|9100|0.5s|ALIVE|'||views||'|'||buys||'|'
               ||(snap_id * 86400)||'|10|MB' AS slurp FROM tserver_log""",
    "parse_masters": f"""
        SELECT snap_id, {_uuid("'mast|'||host")} AS mast_uuid, host, CAST(7100 AS INTEGER) AS port, 'ALIVE' AS state,
               CASE host WHEN 'node2' THEN 'LEADER' ELSE 'FOLLOWER' END AS role FROM tserver_log""",
    "parse_tservers": """
        SELECT snap_id, tsrv_uuid, host, CAST(9100 AS INTEGER) AS port, 'ALIVE' AS status, rd_psec, wr_psec,
               snap_id * 86400 AS uptime_s FROM tserver_log""",
    "parse_universe": f"""
        SELECT *, '{{"universeUuid":"'||univ_uuid||'","clusterUuid":"'||clst_uuid||'","version":'||snap_id||'}}' AS info FROM (
            SELECT id AS snap_id, 'node2' AS log_host, {_uuid("'universe'")} AS univ_uuid,
                   {_uuid("'cluster|'||id")} AS clst_uuid, CAST(id AS INTEGER) AS version FROM snapshots)""",
    "parse_server_metrics": "SELECT * FROM metrics",
    "kv_to_row": "SELECT * FROM kv_wide",
    "resolve_server": "SELECT DISTINCT host, tsrv_uuid FROM samples",
    "merge_columns": f"""
        SELECT t.tblt_uuid, t.table_name, t.schema_name, CASE WHEN k.tblt_uuid IS NULL THEN 'known' END AS role,
               CASE WHEN k.tblt_uuid IS NOT NULL THEN 'closed' END AS state
        FROM tablets t LEFT JOIN (SELECT * FROM known_tablets WHERE gone_dt IS NOT NULL) k USING (tblt_uuid)""",
    "attach_session": f"""
        SELECT sample_id, sm.id AS sess_id FROM samples al JOIN sessions sm ON al.top_level_node_id = sm.tsrv_uuid
          AND al.pid = sm.pid AND sample_time BETWEEN backend_start AND coalesce(gone_dt, {AS_OF})""",
    "attach_tablet": """SELECT sample_id, wait_event_aux, table_name FROM samples
                        LEFT JOIN prefix_names ON prefix = wait_event_aux""",
    "counter_delta": """
        SELECT sample_id, host, sample_time, query_id, query_id - lag(query_id) OVER (
            PARTITION BY host ORDER BY sample_time, sample_id) AS delta FROM samples""",
    "rr_cardinalities": """
        SELECT root_request_id, count(DISTINCT top_level_node_id) AS nodes, count(DISTINCT pid) AS pids,
               count(DISTINCT query_id) AS queries, count(DISTINCT sample_time) AS times FROM samples GROUP BY 1""",
    "check_unique": """SELECT host, root_request_id, wait_event, count(*) AS n_rows FROM samples
                       GROUP BY 1, 2, 3 HAVING count(*) > 1""",
    "line_report": """
        SELECT file_host, verdict, count(*) AS n_lines, CASE WHEN verdict = 'rejected' THEN min(line) END AS example FROM (
            SELECT host AS file_host, unnest(['good', 'skipped']) AS verdict, '' AS line FROM tserver_log
            UNION ALL SELECT 'node2', 'rejected', 'Timed out: no answer' FROM snapshots WHERE id % 10 = 0)
        GROUP BY 1, 2""",
    "key_report": _key_report(),
    "rolled_requests": f"""
        SELECT query_id, count(*) AS cnt_ashev, count(DISTINCT root_request_id) AS nr_rreq, true AS "close"
        FROM samples WHERE {INTERVAL} AND root_request_id NOT LIKE '0000%' AND query_id IS NOT NULL GROUP BY 1""",
    "check_overlaps": f"""
        SELECT tsrv_uuid, pid, count(*) AS n_rows FROM ({_overlapping('all_sessions', 'tsrv_uuid, pid', 'backend_start')})
        GROUP BY 1, 2""",
    "check_orphans": """SELECT query_id AS orphan, count(*) AS n_rows FROM samples
                        WHERE query_id NOT IN (SELECT queryid FROM known_queries) GROUP BY 1""",
    "vanished_tablets": """SELECT tblt_uuid, schema_name, table_name FROM known_tablets WHERE gone_dt IS NULL
                           AND tblt_uuid NOT IN (SELECT tblt_uuid FROM local_tablets)""",
    "session_keys": """SELECT host, count(*) AS n_rows, count(DISTINCT (tsrv_uuid, pid, backend_start)) AS n_ids
                       FROM all_sessions GROUP BY host""",
    "scan_written": """SELECT sample_id, sample_time, host, tsrv_uuid, root_request_id, rpc_request_id, wait_event, query_id, pid
                       FROM samples""",
    "append_returning": """SELECT sample_id, sample_time, host, root_request_id FROM exported""",
    "upsert_new": f"""
        SELECT * FROM known_databases UNION ALL
        SELECT datid, 'db'||datid, min(host), {AS_OF} FROM databases
        WHERE datid NOT IN (SELECT datid FROM known_databases) GROUP BY datid""",
    "log_databases": f"""SELECT datid, tsrv_uuid, {AS_OF} AS log_dt, host AS log_host, {_database_columns()} FROM databases""",
    "close_sessions": f"""
        SELECT k.* REPLACE (CASE WHEN k.gone_dt IS NULL AND k.host IN (SELECT host FROM activity) AND NOT EXISTS (
            SELECT 1 FROM activity a WHERE a.host = k.host AND a.pid = k.pid AND a.backend_start = k.backend_start)
            THEN {AS_OF} ELSE k.gone_dt END AS gone_dt) FROM known_sessions k""",
    "open_sessions": """
        SELECT tsrv_uuid, host, pid, backend_start, CAST(NULL AS TIMESTAMP) AS gone_dt, '10.0.0.'||user_id AS client_addr,
               CAST(5000 + user_id AS INTEGER) AS client_port, CAST(NULL AS VARCHAR) AS client_hostname, datid,
               CAST(10 AS BIGINT) AS usesysid, CAST(NULL AS INTEGER) AS leader_pid, 'app'||(user_id % 3) AS app_name,
               'client backend' AS backend_type FROM opened_sessions""",
    "ghost_sessions": """
        SELECT tsrv_uuid, host, CAST(pid AS INTEGER) AS pid, backend_start, split_part(client_node_ip, ':', 1) AS client_addr,
               CAST(split_part(client_node_ip, ':', 2) AS INTEGER) AS client_port, dbid AS datid FROM ghosts""",
    "session_moves": f"""
        WITH stored AS (SELECT k.*, gone_dt IS NULL AND host IN (SELECT host FROM activity) AND NOT EXISTS (
                SELECT 1 FROM activity a WHERE a.host = k.host AND a.pid = k.pid AND a.backend_start = k.backend_start) AS ends
            FROM some_sessions k),
        guessed AS (SELECT g.*, host IN (SELECT host FROM activity) AND NOT EXISTS (
                SELECT 1 FROM activity a WHERE a.host = g.host AND a.pid = g.pid AND a.backend_start = g.backend_start) AS ends
            FROM ghosts g WHERE (tsrv_uuid, pid) NOT IN (SELECT (tsrv_uuid, pid) FROM activity)),
        moved AS (
            SELECT tsrv_uuid, host, pid, backend_start, CASE WHEN ends THEN {AS_OF} ELSE gone_dt END AS gone_dt, datid,
                   CASE WHEN ends THEN 'closed' ELSE 'kept' END AS move FROM stored
            UNION ALL
            SELECT tsrv_uuid, host, pid, backend_start, NULL, datid, 'opened' FROM activity a WHERE NOT EXISTS (
                SELECT 1 FROM stored k WHERE k.host = a.host AND k.pid = a.pid AND k.backend_start = a.backend_start
                  AND k.gone_dt IS NULL)
            UNION ALL
            SELECT tsrv_uuid, host, CAST(pid AS INTEGER), backend_start, CASE WHEN ends THEN {AS_OF} END, dbid, 'guessed'
            FROM guessed)
        SELECT m.*, a.query_start AS logged_query_start FROM moved m LEFT JOIN activity a
          ON a.tsrv_uuid = m.tsrv_uuid AND a.pid = m.pid AND a.backend_start = m.backend_start""",
    "log_sessions": f"""
        SELECT k.id AS sess_id, a.tsrv_uuid, {AS_OF} AS log_dt, a.host, a.datid, 'db'||a.datid AS datname, a.pid,
               CAST(NULL AS INTEGER) AS leader_pid, CAST(10 AS BIGINT) AS usesysid, 'app' AS usename,
               {_columns(INPUTS['activity'], ACTIVITY_STATE, _ACTIVITY)}
        FROM activity a JOIN known_sessions k ON k.tsrv_uuid = a.tsrv_uuid AND k.pid = a.pid
          AND k.backend_start = a.backend_start""",
    "upsert_queries": "SELECT * FROM all_queries",
    "fill_query_text": f"""
        SELECT k.* REPLACE (CASE WHEN coalesce(trim(query), '') = '' AND log_dt > {AS_OF} - INTERVAL 1 HOUR
            THEN (SELECT min(s.query) FROM statements s WHERE s.queryid = k.queryid) ELSE query END AS query)
        FROM known_queries k""",
    "log_statements": f"""
        SELECT tsrv_uuid, queryid, {AS_OF} AS log_dt, CAST(10 AS BIGINT) AS userid, dbid, true AS toplevel,
               {_statement_counters()} FROM changed_statements""",
    "changed_statements": f"""
        SELECT tsrv_uuid, queryid, {AS_OF} AS log_dt, CAST(10 AS BIGINT) AS userid, dbid, true AS toplevel,
               {_statement_counters()} FROM changed_statements""",
    "merge_latest": """
        SELECT concat_ws('|', queryid, tsrv_uuid, dbid, 10, 'true') AS statement_key,
               coalesce(max(n) FILTER (now), max(n)) AS calls, coalesce(max(n) FILTER (now), max(n)) * 10 AS "rows" FROM (
            SELECT queryid, tsrv_uuid, dbid, n, false AS now FROM known_statements
            UNION ALL SELECT queryid, tsrv_uuid, dbid, n, true FROM statements
            WHERE upper(left(query, 20)) NOT LIKE '%EXPLAIN%') GROUP BY ALL""",
    "open_tablets": f"SELECT *, 'user' AS table_type, {AS_OF} AS log_dt FROM opened_tablets",
    "track_replicas": "SELECT *, '-undetected-' AS role, '-undetected-' AS state FROM tracked",
    "close_tablets": f"""
        SELECT k.* REPLACE (CASE WHEN gone_dt IS NULL AND tblt_uuid NOT IN (
            SELECT tblt_uuid FROM tracked WHERE gone_dt IS NULL) THEN {AS_OF} ELSE gone_dt END AS gone_dt)
        FROM known_tablets k""",
    "load_samples": "SELECT * FROM loaded",
    "upsert_events": """
        SELECT wait_event_component, wait_event, min(wait_event_type) AS wait_event_type,
               min(wait_event_class) AS wait_event_class, arg_min(host, (sample_time, host)) AS log_host,
               'first found on: '||arg_min(host, (sample_time, host))||', at: 2024-01-31 00:00:00' AS wait_event_notes
        FROM exported e WHERE NOT EXISTS (SELECT 1 FROM known_events k WHERE k.wait_event_component = e.wait_event_component
          AND k.wait_event = e.wait_event) GROUP BY 1, 2""",
    "snapshot_header": f"""
        SELECT coalesce(max(id), 0) + 1 AS id, {AS_OF} AS log_dt, 'node2' AS log_host FROM snapshots
        HAVING datediff('microsecond', max(log_dt), {AS_OF}) // 1000000 >= 180""",
    "load_snapshot": """
        SELECT l.snap_id, l.tsrv_uuid, host, CAST(9100 AS INTEGER) AS port, 'ALIVE' AS status, l.snap_id * 86400 AS uptime_s,
               mem_free_mb, mem_total_mb, ts_status FROM tserver_log l JOIN metrics USING (snap_id, tsrv_uuid)""",
    "merge_metrics": """
        SELECT l.snap_id, l.tsrv_uuid, l.host, m.* EXCLUDE (snap_id, tsrv_uuid) FROM tserver_log l
        LEFT JOIN (SELECT * FROM metrics WHERE snap_id > 15) m ON m.snap_id = l.snap_id AND m.tsrv_uuid = l.tsrv_uuid""",
    "host_metrics": """
        SELECT w.*, (SELECT count(*) FROM local_tablets t WHERE t.host = w.host) AS nr_local_tablets FROM kv_wide w""",
    "collect_databases": _counts("databases", {
        "new": "(SELECT DISTINCT datid FROM databases WHERE datid NOT IN (SELECT datid FROM known_databases))",
        "log": "databases"}),
    "collect_queries": _counts("queries", {
        "samples": "from_samples", "activity": "from_activity", "statements": "from_statements",
        "filled": f"all_queries WHERE coalesce(trim(query), '') = '' AND log_dt > {AS_OF} - INTERVAL 1 HOUR",
        "log": "changed_statements"}),
    "collect_sessions": _counts("sessions", {
        "activity": "activity a WHERE NOT EXISTS (SELECT 1 FROM some_sessions k WHERE k.host = a.host AND k.pid = a.pid "
                    "AND k.backend_start = a.backend_start AND k.gone_dt IS NULL)",
        "samples": "ghosts g WHERE NOT EXISTS (SELECT 1 FROM activity a WHERE a.tsrv_uuid = g.tsrv_uuid AND a.pid = g.pid)",
        "closed": """(SELECT host, pid, backend_start FROM some_sessions WHERE gone_dt IS NULL
                      UNION ALL SELECT host, pid, backend_start FROM ghosts g WHERE NOT EXISTS (
                          SELECT 1 FROM activity a WHERE a.tsrv_uuid = g.tsrv_uuid AND a.pid = g.pid)) o
                     WHERE o.host IN (SELECT host FROM activity) AND NOT EXISTS (SELECT 1 FROM activity a
                       WHERE a.host = o.host AND a.pid = o.pid AND a.backend_start = o.backend_start)""",
        "log": """(SELECT k.id FROM activity a JOIN (
                      SELECT id, tsrv_uuid, pid, backend_start FROM some_sessions UNION ALL
                      SELECT NULL, a.tsrv_uuid, a.pid, a.backend_start FROM activity a WHERE NOT EXISTS (
                          SELECT 1 FROM some_sessions k WHERE k.host = a.host AND k.pid = a.pid
                            AND k.backend_start = a.backend_start AND k.gone_dt IS NULL)) k
                   ON k.tsrv_uuid = a.tsrv_uuid AND k.pid = a.pid AND k.backend_start = a.backend_start)"""}),
    "collect_hosts": _counts("hosts", {"log": "kv_wide"}),
    "collect_tablets": _counts("tablets", {
        "m_created": "opened_tablets", "r_created": f"tracked WHERE log_dt = {AS_OF}",
        "r_gone": f"tracked WHERE gone_dt = {AS_OF}",
        "m_gone": "known_tablets WHERE gone_dt IS NULL AND tblt_uuid NOT IN (SELECT tblt_uuid FROM tracked "
                  "WHERE gone_dt IS NULL)"}),
    "collect_samples": _counts("samples", {"log": "loaded"}),
    "collect_events": _counts("events", {
        "new": "(SELECT DISTINCT wait_event_component, wait_event FROM exported EXCEPT "
               "SELECT wait_event_component, wait_event FROM known_events)"}),
    "collect_snapshot": _counts("snapshot", {
        "universe": "snapshots", "new_masters": "(SELECT DISTINCT host FROM tserver_log)", "masters": "tserver_log",
        "new_servers": "(SELECT DISTINCT tsrv_uuid FROM tserver_log WHERE host = 'node5')", "servers": "tserver_log"}),
    "stream_deduplicated": """
        SELECT * FROM quiet QUALIFY row_number() OVER (
            PARTITION BY host, sample_time, root_request_id, rpc_request_id, wait_event ORDER BY sample_id) = 1""",
    "stream_minute_host_counts": """
        SELECT date_trunc('minute', sample_time) AS dt, host, count(*) AS cnt FROM samples GROUP BY 1, 2""",
    "stream_minute_wait_types": f"""
        SELECT date_trunc('minute', sample_time) AS dt, {_WAITS} FROM samples GROUP BY 1""",
    "stream_rr_spans": """SELECT root_request_id AS rr_uuid, min(sample_time) AS rr_min_dt, max(sample_time) AS rr_max_dt,
                          count(*) AS cnt FROM samples WHERE root_request_id NOT LIKE '0000%' GROUP BY 1""",
    "stream_activity_bursts": """
        SELECT top_level_node_id, pid, min(sample_time) AS first_seen, max(sample_time) AS last_seen, count(*) AS cnt
        FROM bursts GROUP BY top_level_node_id, pid, burst""",
    "stream_session_lifetimes": """
        SELECT top_level_node_id, pid, min(sample_time) AS opened, max(sample_time) AS last_seen,
               CASE WHEN max(sample_time) <= (SELECT max(ts) FROM events) - INTERVAL 6 HOUR THEN max(sample_time) END AS gone_dt
        FROM bursts GROUP BY top_level_node_id, pid, burst""",
    "stream_first_seen_events": """SELECT wait_event_component, wait_event, min(wait_event_type) AS wait_event_type,
                                   min(wait_event_class) AS wait_event_class,
                                   arg_min(host, (sample_time, host)) AS log_host FROM samples GROUP BY 1, 2""",
    "stream_file_drop": "SELECT * FROM quiet",
    "stream_late_rows": """SELECT sample_id, sample_time, host FROM samples
                           WHERE sample_time < (SELECT max(ts) FROM events) - INTERVAL 15 DAY""",
}

# Twins that restate another one.
QUERIES |= {
    "rr_session_prefix": f"SELECT * FROM ({QUERIES['rr_session']}) WHERE starts_with(rr_uuid, 'a')",
    "session_events_off": f"SELECT * FROM ({QUERIES['session_events']}) WHERE 1 = 0",
    "report_lines": f"""SELECT 'node2' AS host, concat_ws(' ', rr_uuid, sample_tim, host, wait_event, query_id) AS slurp
                        FROM ({QUERIES['rr_events']})""",
    "run_log": f"""SELECT {AS_OF} AS logged_dt, 'node2' AS log_host, component, CAST(0 AS DOUBLE) AS ela_ms,
                          step||': '||n_rows||'.' AS info_txt FROM ({QUERIES['collect_events']})""",
}


def _needed(sql: str) -> set[str]:
    found: set[str] = set()
    todo = [sql]
    while todo:
        for word in set(re.findall(r"\w+", todo.pop())) & VIEWS.keys() - found:
            found.add(word)
            todo.append(VIEWS[word])
    return found


def oracle(key: str) -> str:
    sql = QUERIES[key]
    views = _needed(sql)
    head = ", ".join(f"{name} AS ({body.strip()})" for name, body in VIEWS.items() if name in views)
    return f"WITH {head} SELECT * FROM ({sql.strip()})" if views else sql.strip()
