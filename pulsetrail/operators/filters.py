"""Row predicates of the reports and the collectors. All are plain column predicates, so they reach the scan."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import is_blank, moment

BACKGROUND_PREFIX = "0000"
NOISE_EVENT, NOISE_QUERY_IDS = "Extension", (5, 7)


def parse_moment(value: dt.datetime | str) -> dt.datetime:
    return value if isinstance(value, dt.datetime) else dt.datetime.fromisoformat(value)


def interval_from_offsets(as_of: dt.datetime | str, seconds_ago: int = 900,
                          length: int = 900) -> tuple[dt.datetime, dt.datetime]:
    """Start `seconds_ago` before `as_of`, lasting `length` seconds. Two literals, so scans can prune."""
    start = parse_moment(as_of) - dt.timedelta(seconds=seconds_ago)
    return start, start + dt.timedelta(seconds=length)


def in_interval(df: DataFrame, start, end, column: str = "sample_time") -> DataFrame:
    """Closed interval: both ends belong to it. A log partitioned by day is only read for the interval's days."""
    return _of_day(df, column, lambda day: day.between(F.to_date(moment(start)), F.to_date(moment(end)))).filter(
        F.col(column).between(moment(start), moment(end)))


def lookback(df: DataFrame, column: str, as_of, seconds: int) -> DataFrame:
    """Strictly newer than `as_of` minus `seconds`."""
    limit = moment(parse_moment(as_of) - dt.timedelta(seconds=seconds))
    return _of_day(df, column, lambda day: day >= F.to_date(limit)).filter(F.col(column) > limit)


def _of_day(df: DataFrame, column: str, test) -> DataFrame:
    """Sample logs are partitioned by `day`, the date of the sample time."""
    return df.filter(test(F.col("day"))) if column == "sample_time" and "day" in df.columns else df


def foreground(df: DataFrame, prefix: str = BACKGROUND_PREFIX) -> DataFrame:
    """Drop background requests, recognised by the leading zeros of their id (NULL ids drop out too)."""
    return df.filter(~F.col("root_request_id").startswith(prefix))


def rr_like(df: DataFrame, prefix: str | None, column: str = "rr_uuid") -> DataFrame:
    return df if prefix is None else df.filter(F.col(column).startswith(prefix))


def drop_noise(df: DataFrame) -> DataFrame:
    """Drop `Extension` waits of the catalogue and cron statements; a NULL operand drops the row as well
    unless the other test already settles it."""
    return df.filter(~((F.col("wait_event") == NOISE_EVENT) & F.col("query_id").isin(*NOISE_QUERY_IDS)))


def outside_background_ids(df: DataFrame, column: str = "query_id", bound: int = 100) -> DataFrame:
    return df.filter(~F.col(column).between(-bound, bound))


def alive(df: DataFrame) -> DataFrame:
    return df.filter(F.col("gone_dt").isNull())


def no_ghosts(sessions: DataFrame) -> DataFrame:
    """Sessions confirmed by an activity export; those only guessed from samples have no user id."""
    return sessions.filter(F.col("usesysid").isNotNull())


def blank(df: DataFrame, column: str) -> DataFrame:
    return df.filter(is_blank(F.col(column)))


def not_explain(statements: DataFrame) -> DataFrame:
    return statements.filter(~F.upper(F.substring("query", 1, 20)).like("%EXPLAIN%"))


def starts_with_any(column: Column, prefixes: Sequence[str]) -> Column:
    out = F.lit(False)
    for prefix in prefixes:
        out = out | column.startswith(prefix)
    return out


def only_pid(df: DataFrame, pid: int | None) -> DataFrame:
    return df if pid is None else df.filter(F.col("pid") == pid)
