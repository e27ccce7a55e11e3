"""Explicit schemas of the history tables and of the exported inputs; nothing is inferred.

`_mst` is a slowly growing dimension, `_log` an append-only series, `_lnk` a link, `_rep` a validity table.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The names below are the fixed column names of the exports and of the history tables.
_TYPES = {
    "long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "float": T.FloatType(),
    "string": T.StringType(), "bool": T.BooleanType(), "binary": T.BinaryType(), "date": T.DateType(),
    "ts": T.TimestampType(), "numeric": T.DecimalType(38, 0),
}


def _fields(text: str) -> T.StructType:
    """`type: name name …` groups, separated by `;`, in column order."""
    out = T.StructType()
    for group in filter(None, (g.strip() for g in text.split(";"))):
        kind, names = group.split(":")
        for name in names.split():
            out = out.add(name, _TYPES[kind.strip()])
    return out


_DATABASE_COUNTERS = """
    int: numbackends;
    long: xact_commit xact_rollback blks_read blks_hit tup_returned tup_fetched tup_inserted tup_updated
          tup_deleted conflicts temp_files temp_bytes deadlocks checksum_failures;
    ts: checksum_last_failure;
    double: blk_read_time blk_write_time session_time active_time idle_in_transaction_time;
    long: sessions sessions_abandoned sessions_fatal sessions_killed;
    ts: stats_reset
"""

_STATEMENT_COUNTERS = """
    long: plans;
    double: total_plan_time min_plan_time max_plan_time mean_plan_time stddev_plan_time;
    long: calls;
    double: total_exec_time min_exec_time max_exec_time mean_exec_time stddev_exec_time;
    long: rows shared_blks_hit shared_blks_read shared_blks_dirtied shared_blks_written
          local_blks_hit local_blks_read local_blks_dirtied local_blks_written temp_blks_read temp_blks_written;
    double: blk_read_time blk_write_time;
    long: wal_records wal_fpi;
    numeric: wal_bytes;
    long: jit_functions; double: jit_generation_time;
    long: jit_inlining_count; double: jit_inlining_time;
    long: jit_optimization_count; double: jit_optimization_time;
    long: jit_emission_count; double: jit_emission_time;
    string: latency_histogram
"""

_ACTIVITY_STATE = """
    string: application_name client_addr client_hostname;
    int: client_port;
    ts: backend_start xact_start query_start state_change;
    string: wait_event_type wait_event state;
    long: backend_xid backend_xmin query_id;
    string: query backend_type;
    long: catalog_version allocated_mem_bytes rss_mem_bytes;
    string: distributed_xid
"""

DATABASE_COUNTERS = _fields(_DATABASE_COUNTERS).fieldNames()
STATEMENT_COUNTERS = _fields(_STATEMENT_COUNTERS).fieldNames()
ACTIVITY_STATE = _fields(_ACTIVITY_STATE).fieldNames()

# Exported statistics views: the inputs of the collection jobs.
INPUTS = {
    "active_history": _fields("""
        ts: sample_time; string: root_request_id; long: rpc_request_id;
        string: wait_event_component wait_event_class wait_event_type wait_event wait_event_aux top_level_node_id;
        long: query_id pid; string: client_node_ip; float: sample_weight; long: dbid"""),
    "activity": _fields(f"""
        int: pid leader_pid; long: datid; string: datname; long: usesysid; string: usename; {_ACTIVITY_STATE}"""),
    "statements": _fields(f"long: queryid userid dbid; bool: toplevel; {_STATEMENT_COUNTERS}; string: query"),
    "databases": _fields(f"long: datid; string: datname; {_DATABASE_COUNTERS}"),
    "local_tablets": _fields("""
        string: tablet_id table_id table_type namespace_name schema_name table_name;
        binary: partition_key_start partition_key_end"""),
    "servers": _fields("string: uuid host"),
    "server_metrics": _fields("string: uuid metrics status error"),
    "settings": _fields("string: name setting"),
}

SERVER_METRICS = _fields("""
    long: memory_free memory_total memory_available tserver_root_memory_limit
          tserver_root_memory_soft_limit tserver_root_memory_consumption;
    float: cpu_usage_user cpu_usage_system""")

# History tables.
TABLES = {
    "sample_log": _fields("""
        long: sample_id; string: tsrv_uuid; ts: sample_time; string: host root_request_id; long: rpc_request_id;
        string: wait_event_component wait_event_class wait_event top_level_node_id; long: query_id session_ref pid;
        string: client_node_ip wait_event_aux; float: sample_weight; string: wait_event_type; long: dbid"""),
    "session_mst": _fields("""
        long: id; string: tsrv_uuid host; int: pid; ts: backend_start gone_dt; string: client_addr;
        int: client_port; string: client_hostname; long: datid usesysid; int: leader_pid;
        string: app_name backend_type"""),
    "session_log": _fields(f"""
        long: sess_id; string: tsrv_uuid; ts: log_dt; string: host; long: datid; string: datname;
        int: pid leader_pid; long: usesysid; string: usename; {_ACTIVITY_STATE}"""),
    "query_mst": _fields("long: queryid; ts: log_dt; string: log_tsrv log_host query"),
    "query_log": _fields(f"""
        long: id; string: tsrv_uuid; long: queryid; ts: log_dt; long: userid dbid; bool: toplevel;
        {_STATEMENT_COUNTERS}"""),
    "query_pln": _fields("long: id queryid; string: tsrv_uuid; ts: log_dt; string: plan_info"),
    "root_request_mst": _fields("long: id sess_id; string: rr_uuid; ts: rr_min_dt rr_max_dt"),
    "root_request_query_lnk": _fields("long: queryid rr_id; string: rr_uuid; ts: qurr_start_dt; long: dur_ms"),
    "database_mst": _fields("long: datid; string: datname log_host; ts: log_dt"),
    "database_log": _fields(f"""
        long: id datid; string: tsrv_uuid; ts: log_dt; string: log_host; {_DATABASE_COUNTERS}"""),
    "tablet_mst": _fields("""
        string: tblt_uuid tabl_uuid log_tsrv; ts: log_dt gone_dt; string: log_host table_type namespace_name
        schema_name table_name; binary: partition_key_start partition_key_end"""),
    "tablet_rep": _fields("string: tblt_uuid tsrv_uuid; ts: log_dt gone_dt; string: role state"),
    "table_mst": _fields("string: tabl_uuid table_name; ts: log_dt"),
    "table_log": _fields("string: tabl_uuid; ts: log_dt"),
    "table_tablet_lnk": _fields("string: tabl_uuid tblt_uuid; ts: log_dt"),
    "tserver_mst": _fields("string: tsrv_uuid; long: snap_id; string: host; int: port"),
    "tserver_log": _fields("""
        long: snap_id; string: tsrv_uuid host; ts: log_dt; int: port hb_delay_s; string: status;
        float: rd_psec wr_psec; long: uptime_s sst_total_mb sst_uncomp_mb sst_nrfiles mem_mb; string: broadcast;
        long: mem_free_mb mem_total_mb mem_avail_mb ts_root_mem_limit_mb ts_root_mem_slimit_mb
        ts_root_mem_cons_mb; float: cpu_user cpu_syst; string: ts_status ts_error"""),
    "master_mst": _fields("long: snap_id; string: mast_uuid host; int: port; ts: log_dt; string: log_host"),
    "master_log": _fields("""
        long: snap_id; string: mast_uuid host; ts: log_dt; int: port; string: role state bcasthp"""),
    "snapshot_log": _fields("long: id; ts: log_dt; string: log_host; long: duration_ms"),
    "universe_mst": _fields("string: univ_uuid; ts: log_dt; string: log_host"),
    "universe_log": _fields("""
        long: snap_id; string: univ_uuid; ts: log_dt; string: log_host clst_uuid; int: version; string: info"""),
    "host_mst": _fields("string: host; ts: log_dt; string: log_host comment_txt"),
    "host_log": _fields("""
        long: id; string: host; ts: log_dt; int: nr_processes; long: master_mem tserver_mem disk_usage_mb
        nr_local_tablets; string: top_info"""),
    "event_mst": _fields("""
        long: id; string: wait_event_component wait_event_type wait_event_class wait_event; ts: log_dt;
        string: log_tsrv log_host wait_event_notes"""),
    "run_log": _fields("long: id; ts: logged_dt; string: log_host component; double: ela_ms; string: info_txt"),
    "kv_stage": _fields("string: host key value"),
    "line_stage": _fields("long: id; ts: log_dt; string: host slurp"),
    "report_line": _fields("long: id; string: output"),
}

# Natural keys, and the parent each child column points at; `operators.quality` reports violations.
UNIQUE_KEYS = {
    "session_mst": ["id"], "session_log": ["sess_id", "log_dt"], "query_mst": ["queryid"],
    "root_request_mst": ["rr_uuid"], "root_request_query_lnk": ["queryid", "rr_uuid"], "database_mst": ["datid"],
    "database_log": ["datid", "log_host", "log_dt"], "tablet_mst": ["tblt_uuid", "log_dt"],
    "tablet_rep": ["tblt_uuid", "tsrv_uuid", "log_dt"], "tserver_mst": ["tsrv_uuid"],
    "tserver_log": ["snap_id", "tsrv_uuid"], "master_mst": ["mast_uuid"], "master_log": ["snap_id", "mast_uuid"],
    "snapshot_log": ["id"], "universe_log": ["snap_id", "univ_uuid"], "kv_stage": ["host", "key"],
    "run_log": ["logged_dt", "id"],
}

FOREIGN_KEYS = [
    ("universe_log", "snap_id", "snapshot_log", "id"), ("master_mst", "snap_id", "snapshot_log", "id"),
    ("master_log", "snap_id", "snapshot_log", "id"), ("tserver_mst", "snap_id", "snapshot_log", "id"),
    ("tserver_log", "snap_id", "snapshot_log", "id"), ("session_log", "sess_id", "session_mst", "id"),
    ("root_request_mst", "sess_id", "session_mst", "id"),
    ("root_request_query_lnk", "queryid", "query_mst", "queryid"),
    ("root_request_query_lnk", "rr_uuid", "root_request_mst", "rr_uuid"),
    ("database_log", "datid", "database_mst", "datid"),
]

# Keys whose rows are intervals of time, with their first and last moment; intervals of one key must not overlap.
VALIDITY_KEYS = {
    "session_mst": (["tsrv_uuid", "pid"], "backend_start", "gone_dt"),
    "tablet_mst": (["tblt_uuid"], "log_dt", "gone_dt"),
    "tablet_rep": (["tblt_uuid", "tsrv_uuid"], "log_dt", "gone_dt"),
}
