"""Lag, lead and running ordinals that do not pull one key's whole history into one task.

A plain window puts every row of a key into a single task. Here each key is cut into time slices and the window
runs inside (key, slice). Only the first and last row of each slice need a neighbour from another slice, and those
rows alone are windowed by key: at most two per slice, whatever the number of rows. Both halves read the same
shuffle, so the rows move once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SLICE = "__slice"


def _sliced(df: DataFrame, time: str, unit: str) -> DataFrame:
    return df.withColumn(_SLICE, F.date_trunc(unit, F.col(time)))


def neighbours(df: DataFrame, keys: Sequence[str], time: str, ties: Sequence[str],
               before: dict[str, str] | None = None, after: dict[str, str] | None = None,
               unit: str = "hour") -> DataFrame:
    """Values of the previous row (`before`: source -> new column) and of the next row (`after`) of the same key
    by (time, ties); NULL where there is none. `unit` is the slice: the shorter, the finer a busy key is spread."""
    before, after = before or {}, after or {}
    order = [F.col(c) for c in (time, *ties)]
    inside, across = (Window.partitionBy(*keys, _SLICE).orderBy(*order), Window.partitionBy(*keys).orderBy(*order))

    rows = (_sliced(df, time, unit).withColumn("__first", F.lag(F.lit(1), 1).over(inside).isNull())
            .withColumn("__last", F.lead(F.lit(1), 1).over(inside).isNull()))
    for source, name in before.items():
        rows = rows.withColumn(name, F.lag(source, 1).over(inside))
    for source, name in after.items():
        rows = rows.withColumn(name, F.lead(source, 1).over(inside))

    at_edge = F.col("__first") | F.col("__last")
    edges = rows.filter(at_edge)
    for source, name in before.items():
        edges = edges.withColumn(name, F.when(F.col("__first"), F.lag(source, 1).over(across)).otherwise(F.col(name)))
    for source, name in after.items():
        edges = edges.withColumn(name, F.when(F.col("__last"), F.lead(source, 1).over(across)).otherwise(F.col(name)))
    return rows.filter(~at_edge).unionByName(edges).drop("__first", "__last", _SLICE)


def ordinal(df: DataFrame, keys: Sequence[str], time: str, ties: Sequence[str], name: str,
            unit: str = "hour", total: str | None = None) -> DataFrame:
    """1-based position of each row within its key by (time, ties); `total` names a column for the key's number of rows.

    A slice's number of earlier rows travels as a row of its own, ahead of the slice's rows, so they need no join."""
    df = _sliced(df, time, unit)
    sizes = df.groupBy(*keys, _SLICE).agg(F.count(F.lit(1)).alias("__n"))
    before = (Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1))
    whole = [] if total is None else [F.sum("__n").over(Window.partitionBy(*keys)).alias("__total")]
    offsets = sizes.select(*keys, _SLICE, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"), *whole)

    rows = df.withColumn("__row", F.lit(True)).unionByName(
        offsets.withColumn("__row", F.lit(False)), allowMissingColumns=True)
    ahead = Window.partitionBy(*keys, _SLICE).orderBy("__row", *[F.col(c) for c in (time, *ties)])
    out = rows.withColumn(name, F.row_number().over(ahead) - 1 + F.first("__offset").over(ahead))
    if total is not None:
        out = out.withColumn(total, F.first("__total").over(ahead))
    return out.filter("__row").drop("__row", "__offset", "__total", _SLICE)


def counter_delta(log: DataFrame, keys: Sequence[str], time: str, columns: dict[str, str],
                  unit: str = "hour", ties: Sequence[str] = ()) -> DataFrame:
    """Value minus the previous value of the same key, for each (counter -> delta name)."""
    moved = neighbours(log, keys, time, ties, before={c: f"__prev_{c}" for c in columns}, unit=unit)
    for source, delta in columns.items():
        moved = moved.withColumn(delta, F.col(source) - F.col(f"__prev_{source}"))
    return moved.drop(*[f"__prev_{c}" for c in columns])


def blank_repeat(column: str, previous: str, shown: Column) -> Column:
    """`shown`, but NULL where `column` repeats the previous row's value."""
    return F.when(F.col(column) == F.col(previous), F.lit(None)).otherwise(shown)
