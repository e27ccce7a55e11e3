"""Group-by building blocks. Every one is a built-in aggregate with a map-side partial step, so a key that
holds a large share of the rows is reduced before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sample_counts(df: DataFrame, keys: Sequence[str], name: str = "cnt") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def span(df: DataFrame, keys: Sequence[str], column: str, first: str, last: str, size: str | None = None) -> DataFrame:
    rows = [] if size is None else [F.count(F.lit(1)).alias(size)]
    return df.groupBy(*keys).agg(F.min(column).alias(first), F.max(column).alias(last), *rows)


def merge_spans(state: DataFrame, batch: DataFrame, keys: Sequence[str], first: str, last: str) -> DataFrame:
    """Extend known spans by newly seen ones; also folds any number of partial spans into one."""
    columns = [*keys, first, last]
    return (state.select(*columns).unionByName(batch.select(*columns))
            .groupBy(*keys).agg(F.min(first).alias(first), F.max(last).alias(last)))


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """Top rows of a report. `order` names every group key, so ties at the cut are settled the same way each run."""
    return df.orderBy(*order).limit(k)


def latest_rows(df: DataFrame, column: str, n: int, ties: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(F.col(column).desc(), *[F.col(t) for t in ties]).limit(n)


def latest_snapshot(log: DataFrame, column: str = "snap_id") -> DataFrame:
    """Rows of the newest snapshot. The one-row maximum is a semi-join, not a trip to the driver."""
    newest = log.agg(F.max(column).alias(column))
    return log.join(newest, column, "left_semi")


def crosstab(df: DataFrame, row: str, column: str, count: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Sums of `count` as rows x columns, NULL where a pair never occurs. With the column values given it is one
    aggregation, and all other values go to the column `other`; without, the values are looked up by an extra job."""
    if columns is None:
        return df.groupBy(row).pivot(column).agg(F.sum(count))
    rest = F.when(~F.coalesce(F.col(column).isin(*columns), F.lit(False)), F.col(count))
    return df.groupBy(row).agg(*[F.sum(F.when(F.col(column) == value, F.col(count))).alias(value) for value in columns],
                               F.sum(rest).alias("other"))


def scalar_or_default(df: DataFrame, column: str, default: Column, name: str) -> DataFrame:
    return df.agg(F.coalesce(F.max(column), default).alias(name))
