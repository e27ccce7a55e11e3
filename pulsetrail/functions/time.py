"""Column helpers for time labels and durations. They accept TIMESTAMP and TIMESTAMP_NTZ alike."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = [
    "clock", "clock_ms", "clock_ms_colon", "clock_ms_dashed", "day_clock", "stamp", "stamp_day_first",
    "minute_label", "micros", "seconds3", "whole_seconds", "millis_rounded", "millis_truncated",
    "seconds_of_day_wrap", "truncated", "moment", "is_ntz",
]


def _div(value: Column, by: int) -> Column:
    return F.call_function("div", value, F.lit(by))


def clock(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm:ss")


def clock_ms(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm:ss.SSS")


def clock_ms_colon(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm:ss:SSS")


def clock_ms_dashed(ts: Column) -> Column:
    return F.date_format(ts, "' - 'HH:mm:ss.SSS")


def day_clock(ts: Column) -> Column:
    return F.date_format(ts, "dd HH:mm:ss")


def stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def stamp_day_first(ts: Column) -> Column:
    """Year, day, month: the label order the interval report has always printed."""
    return F.date_format(ts, "yyyy-dd-MM HH:mm:ss")


def minute_label(ts: Column) -> Column:
    """Day of year, day name and minute, e.g. `001 MON 00:09:00`."""
    return F.upper(F.date_format(ts, "DDD EEE HH:mm:00"))


def micros(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end)


def seconds3(start: Column, end: Column) -> Column:
    """Seconds between two moments, truncated to three decimals (integer arithmetic until the last step)."""
    return _div(micros(start, end), 1000) / F.lit(1000.0)


def whole_seconds(start: Column, end: Column) -> Column:
    return _div(micros(start, end), 1_000_000)


def millis_rounded(start: Column, end: Column) -> Column:
    """Milliseconds as a whole number, halves rounded up."""
    return F.floor((micros(start, end) + F.lit(500)) / F.lit(1000.0)).cast("long")


def millis_truncated(start: Column, end: Column) -> Column:
    return _div(micros(start, end), 1000)


def seconds_of_day_wrap(start: Column, end: Column) -> Column:
    """Elapsed seconds without the day field, i.e. wrapping at 86 400."""
    return F.pmod(whole_seconds(start, end), F.lit(86400))


def truncated(df: DataFrame, column: str, unit: str) -> Column:
    """date_trunc that keeps the column's own timestamp type."""
    return F.date_trunc(unit, F.col(column)).cast(df.schema[column].dataType)


def is_ntz(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.TimestampNTZType)


def moment(value: dt.datetime | str) -> Column:
    """Literal of a fixed moment. A zone-less literal compares with either timestamp type and
    is still pushed down to the scan."""
    text = value if isinstance(value, str) else value.isoformat(sep=" ")
    return F.expr(f"TIMESTAMP_NTZ '{text}'")
