"""Comparison of a Spark result with the same query in another engine, independent of row and column order."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[:-len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return repr(value)
    return str(value)


def canonical(columns, rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(df, con, sql: str) -> str | None:
    """None if equal, else what differs first."""
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    theirs = canonical(columns, result.fetchall())
    ours = canonical(df.columns, df.collect())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    for name, kind in df.dtypes:
        want = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
                "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}.get(kind, kind)
        if want != kinds[name]:
            return f"type of {name}: {kind} != {kinds[name]}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} rows != {len(theirs[1])}"
    for a, b in zip(*(x[1] for x in (ours, theirs))):
        if a != b:
            return f"row {a} != {b}"
    return None
