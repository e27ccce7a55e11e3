"""Text exports: key=value files, admin-tool listings and JSON documents.

`read_*` turns files into lines with a host tag; `parse_*` turns lines into columns and keeps every other column
of its input. Fields come out by lenient casts: a malformed number is NULL, not a failed job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import int_or_null, json_field, mega
from ..schemas import SERVER_METRICS

# Fixed format: a listing row starts with a dashed uuid; header lines do not.
_STARTS_WITH_UUID = "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}([|]|$)"


def _empty_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def read_lines(spark: SparkSession, path: str, host: str, whole_file: bool = False) -> DataFrame:
    """Lines of text files as (host, slurp); empty lines are NULL. `whole_file` keeps each file as one value,
    for JSON spread over several lines."""
    lines = spark.read.text(path, wholetext=whole_file)
    return lines.select(F.lit(host).alias("host"), _empty_to_null(F.col("value")).alias("slurp"))


def read_kv(spark: SparkSession, path: str, host: str) -> DataFrame:
    return parse_kv(spark.read.text(path).select(F.lit(host).alias("host"), F.col("value").alias("line")))


def parse_kv(lines: DataFrame, column: str = "line") -> DataFrame:
    """`key=value` at the first `=`; an empty value is NULL. Lines without `=` are not pairs."""
    rest = [c for c in lines.columns if c != column]
    cut = F.split(F.col(column), "=", 2)
    return (lines.filter(F.col(column).contains("="))
            .select(*rest, cut[0].alias("key"), _empty_to_null(cut[1]).alias("value")))


# Fixed formats of the listings' first lines.
_HEADER = r"^\s*(Master|Tablet Server) UUID(\s|$)"
GOOD, SKIPPED, REJECTED = "good", "skipped", "rejected"


def judge_lines(lines: DataFrame, kind: str, column: str = "line") -> DataFrame:
    """Adds `verdict`: good lines become rows, header and blank lines are skipped, all others do not fit the format and are
    rejected. `kind` is `kv` or `listing`. Good rows and rejected lines come out of the same scan."""
    text = F.coalesce(F.col(column), F.lit(""))
    skipped = F.trim(text) == ""
    if kind == "kv":
        good = text.contains("=")
    else:
        good = F.translate(text, " \t:", "|||").rlike(_STARTS_WITH_UUID)
        skipped |= text.rlike(_HEADER)
    return lines.withColumn("verdict", F.when(good, GOOD).when(skipped, SKIPPED).otherwise(REJECTED))


def counted_lines(lines: DataFrame, kind: str, seen: Observation, column: str = "line") -> DataFrame:
    """The good lines; when they are written, `seen` holds how many lines there were and how many were rejected."""
    judged = judge_lines(lines, kind, column).observe(
        seen, F.count(F.lit(1)).alias("lines"), F.count_if(F.col("verdict") == REJECTED).alias("rejected"))
    return judged.filter(F.col("verdict") == GOOD).drop("verdict")


def line_report(lines: DataFrame, kind: str, by: Sequence[str], column: str = "line") -> DataFrame:
    """Lines per source and verdict, with the least of the rejected ones as an example."""
    return judge_lines(lines, kind, column).groupBy(*by, "verdict").agg(
        F.count(F.lit(1)).alias("n_lines"), F.min(F.when(F.col("verdict") == REJECTED, F.col(column))).alias("example"))


def normalise_listing(lines: DataFrame, column: str = "line", out: str = "slurp") -> DataFrame:
    """Columnar listing to `|`-separated text: tabs and runs of blanks become one `|`, and so does each `:`.
    Header lines are recognised by not starting with a uuid, so files may be read in any split."""
    text = F.regexp_replace(F.translate(F.col(column), "\t", " "), " +", "|")
    rest = [c for c in lines.columns if c != column]
    return (lines.select(*rest, F.replace(text, F.lit(":"), F.lit("|")).alias(out))
            .filter(F.col(out).rlike(_STARTS_WITH_UUID)))


def _field(column: str, number: int) -> Column:
    return F.split_part(F.col(column), F.lit("|"), F.lit(number))


def parse_masters(lines: DataFrame, column: str = "slurp") -> DataFrame:
    rest = [c for c in lines.columns if c != column]
    return lines.select(*rest, _field(column, 1).alias("mast_uuid"), _field(column, 2).alias("host"),
                        int_or_null(_field(column, 3)).alias("port"), _field(column, 4).alias("state"),
                        _field(column, 5).alias("role"))


def parse_tservers(lines: DataFrame, column: str = "slurp") -> DataFrame:
    """Field 4, the heartbeat delay, is not kept."""
    rest = [c for c in lines.columns if c != column]
    return lines.select(*rest, _field(column, 1).alias("tsrv_uuid"), _field(column, 2).alias("host"),
                        int_or_null(_field(column, 3)).alias("port"), _field(column, 5).alias("status"),
                        int_or_null(_field(column, 6), "float").alias("rd_psec"),
                        int_or_null(_field(column, 7), "float").alias("wr_psec"),
                        int_or_null(_field(column, 8), "long").alias("uptime_s"))


def parse_universe(lines: DataFrame, column: str = "slurp") -> DataFrame:
    rest = [c for c in lines.columns if c != column]
    text = F.col(column)
    return lines.select(*rest, json_field(text, "universeUuid").alias("univ_uuid"),
                        json_field(text, "clusterUuid").alias("clst_uuid"),
                        int_or_null(json_field(text, "version")).alias("version"), text.alias("info"))


_METRIC_COLUMNS = {
    "mem_free_mb": "memory_free", "mem_total_mb": "memory_total", "mem_avail_mb": "memory_available",
    "ts_root_mem_limit_mb": "tserver_root_memory_limit", "ts_root_mem_slimit_mb": "tserver_root_memory_soft_limit",
    "ts_root_mem_cons_mb": "tserver_root_memory_consumption",
}


def parse_server_metrics(df: DataFrame) -> DataFrame:
    """Metrics JSON (numbers or quoted numbers), parsed once per row; byte counts become whole MB."""
    rest = [c for c in df.columns if c not in ("uuid", "metrics", "status", "error")]
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in SERVER_METRICS])
    parsed = df.withColumn("m", F.from_json("metrics", as_text))
    number = lambda name: F.col(f"m.{name}").try_cast("long")
    return parsed.select(
        *rest, F.col("uuid").alias("tsrv_uuid"),
        *[mega(number(source)).alias(name) for name, source in _METRIC_COLUMNS.items()],
        F.col("m.cpu_usage_user").try_cast("float").alias("cpu_user"),
        F.col("m.cpu_usage_system").try_cast("float").alias("cpu_syst"),
        F.col("status").alias("ts_status"), F.col("error").alias("ts_error"))
