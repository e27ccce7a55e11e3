"""Reports on keys that the history tables should respect; nothing is enforced at write time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import FOREIGN_KEYS, UNIQUE_KEYS, VALIDITY_KEYS
from .joins import null_safe, renamed_keys


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def check_orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child key values without a parent, with their number of rows. NULL is not an orphan.
    Counting first leaves one row per value to look up."""
    counts = (child.filter(F.col(child_key).isNotNull()).groupBy(F.col(child_key).alias("orphan"))
              .agg(F.count(F.lit(1)).alias("n_rows")))
    known = renamed_keys(parent, [parent_key])
    return counts.join(known, counts["orphan"] == known[f"__k_{parent_key}"], "left_anti")


def check_overlaps(df: DataFrame, keys: Sequence[str], start: str, end: str, unit: str = "day") -> DataFrame:
    """Keys with intervals that begin while another one of the key lasts, with the number of such intervals.

    A sweep: +1 where an interval starts, -1 where it ends (half open; without an end it lasts), summed up in the order of
    time. The sum runs inside (key, time slice) and the slices' totals are summed up by key, so a key with a long history
    spreads over its slices. Rows without a start are left out.
    """
    rows = df.filter(F.col(start).isNotNull() & (F.col(end).isNull() | (F.col(end) > F.col(start))))
    marks = F.array_compact(F.array(F.struct(F.col(start).alias("t"), F.lit(1).alias("step")),
                                    F.when(F.col(end).isNotNull(), F.struct(F.col(end).alias("t"), F.lit(-1).alias("step")))))
    # Equal marks first become one row, so that a moment with very many starts is a single one.
    points = (rows.select(*keys, F.explode(marks).alias("m")).groupBy(*keys, F.col("m.t").alias("t"))
              .agg(F.count_if(F.col("m.step") == 1).alias("starts"), F.count_if(F.col("m.step") == -1).alias("ends"))
              .withColumn("slice", F.date_trunc(unit, "t")))
    inside = Window.partitionBy(*keys, "slice").orderBy("t").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(*keys).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    change = F.col("starts") - F.col("ends")
    totals = points.groupBy(*keys, "slice").agg(F.sum(change).alias("total")) \
        .withColumn("before", F.coalesce(F.sum("total").over(across), F.lit(0)))
    named = totals.select(*[F.col(k).alias(f"__k_{k}") for k in [*keys, "slice"]], "before")
    depth = F.col("before") + F.coalesce(F.col("running"), F.lit(0)) - F.col("ends")
    swept = points.withColumn("running", F.sum(change).over(inside))
    swept = swept.join(named, null_safe(swept, named, [*keys, "slice"]), "inner")
    late = F.when(depth > 0, F.col("starts")).otherwise(F.col("starts") - 1)
    return (swept.filter("starts > 0").groupBy(*keys).agg(F.sum(late).alias("n_rows")).filter("n_rows > 0"))


def key_report(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, constraint, n_rows) for every declared key that the given tables allow to check: rows that share a key,
    rows without a parent, intervals of one key that overlap. A kept constraint has 0 rows."""

    def line(table: str, constraint: str, found: DataFrame) -> DataFrame:
        return found.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).cast("long").alias("n_rows")).select(
            F.lit(table).alias("table_name"), F.lit(constraint).alias("constraint"), "n_rows")

    lines = [line(t, f"unique {', '.join(keys)}", check_unique(tables[t], keys))
             for t, keys in UNIQUE_KEYS.items() if t in tables and set(keys) <= set(tables[t].columns)]
    lines += [line(child, f"{key} in {parent}", check_orphans(tables[child], tables[parent], key, parent_key))
              for child, key, parent, parent_key in FOREIGN_KEYS
              if child in tables and parent in tables and key in tables[child].columns]
    lines += [line(t, f"no overlap of {', '.join(keys)}", check_overlaps(tables[t], keys, start, end))
              for t, (keys, start, end) in VALIDITY_KEYS.items() if t in tables]
    out = lines[0]
    for one in lines[1:]:
        out = out.unionByName(one)
    return out
