"""Reading and writing history tables in Parquet.

Single folders are appended to, refilled and scanned here; tables that change together are kept by `sources.store`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import mega
from ..operators.filters import starts_with_any
from ..schemas import INPUTS, TABLES
from ..session import run_folder
from .store import VersionedTables, rebalanced  # noqa: F401


def scan(spark: SparkSession, name: str, path: str) -> DataFrame:
    """An export or history table with its declared schema."""
    return spark.read.schema(INPUTS.get(name) or TABLES[name]).parquet(path)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Append rows and hand back a reader of what was written: the input runs once, into a folder of its own, and the
    table takes its rows from there."""
    spark, written = df.sparkSession, run_folder(df.sparkSession, "appended")
    df.write.parquet(written)
    rows = spark.read.schema(df.schema).parquet(written)
    rebalanced(rows, partition_by).write.mode("append").partitionBy(*partition_by).parquet(path)
    return rows


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Empty and refill. With `partition_by`, only the partitions present in `df` are replaced."""
    writer = rebalanced(df, partition_by).write.mode("overwrite")
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.parquet(path)
    return df


def write_report(lines: DataFrame, path: str, order: Sequence[str], text: str = "output") -> None:
    """Report lines as text files whose name order is the line order."""
    lines.orderBy(*[F.col(c).asc_nulls_last() for c in order]).select(text).write.mode("overwrite").text(path)


def table_inventory(spark: SparkSession, paths: dict[str, str], prefixes: Sequence[str]) -> DataFrame:
    """Rows, files and MB of each table whose name starts with one of `prefixes`, by name.

    One scan covers all tables. It reads no column: counts come from the file footers, sizes from file metadata.
    """
    names = sorted(paths)
    table = None
    for name in names:
        hit = F.contains(F.col("_metadata.file_path"), F.lit(paths[name]))
        table = F.when(hit, name) if table is None else table.when(hit, name)
    rows = (spark.read.schema(T.StructType([])).parquet(*[paths[n] for n in names])
            .select(table.alias("relname"), F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_size").alias("bytes")))
    files = rows.groupBy("relname", "file").agg(F.max("bytes").alias("bytes"), F.count(F.lit(1)).alias("n"))
    oid = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("relname"))
    return (files.filter(starts_with_any(F.col("relname"), prefixes))
            .groupBy("relname").agg(F.count(F.lit(1)).alias("num_tablets"),
                                    mega(F.sum("bytes")).alias("size_mb"), F.sum("n").alias("rows"))
            .select(oid.alias("oid"), "relname", "num_tablets", "size_mb", "rows").orderBy("oid", "relname"))
