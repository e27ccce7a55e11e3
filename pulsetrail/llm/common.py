"""What the operators share: reading tables, splits by id, and text scans in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows handled at once inside a task. A batch of Spark may hold many long texts; a slice keeps the Python side small.
SLICE = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(doc_id: str | Column, n: int) -> Column:
    """crc32 of the id's text modulo n; a null id counts as the empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return (F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % n).cast("int")


def hashed_share(doc_id: str, share: float) -> Column:
    """A fixed, id-determined share of the rows."""
    return F.pmod(F.xxhash64(F.col(doc_id).cast("string")), F.lit(1_000_000)) < int(share * 1_000_000)


def scan(df: DataFrame, start: Callable[[], Callable[[list], list[tuple]]], schema: str,
         text: str = "text") -> DataFrame:
    """Appends the columns of `schema` to each row, computed from column `text`.

    `start` runs once per task and returns a function from a list of texts (or None) to a list of tuples. All other
    columns pass through untouched; a column of `df` that is named like a new one is replaced.
    """
    from pyspark.sql.types import StructType, _parse_datatype_string

    fresh = _parse_datatype_string(schema)
    added = fresh.names
    kept = [c for c in df.columns if c not in added]
    out = StructType([*[df.schema[c] for c in kept], *fresh.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, arrow = start(), None
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                rows = work(part.column(text).to_pylist())
                columns = list(zip(*rows)) if rows else [[]] * len(added)
                arrow = arrow or to_arrow(out)
                new = [pa.array(list(v), arrow.field(n).type) for n, v in zip(added, columns)]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in kept] + new, names=[*kept, *added])

    return df.select(*[quoted(c) for c in dict.fromkeys([*kept, text])]).mapInArrow(run, out)


def wrapped(docs: DataFrame, *beside: str) -> DataFrame:
    """The whole row as the struct `row`, with some columns beside it: columns that an operator adds clash with none."""
    return docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("row"), *[quoted(c) for c in beside])


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def to_arrow(schema):
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def arrow_schema(columns: str) -> pa.Schema:
    """Arrow form of `name type, ...`; workers have no Spark context that could parse it."""
    plain = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary(),
             "boolean": pa.bool_()}

    def kind(name: str) -> pa.DataType:
        return pa.list_(kind(name[6:-1])) if name.startswith("array<") else plain[name]

    return pa.schema([(n, kind(t)) for n, t in (c.split(" ") for c in columns.split(", "))])


def spread_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join on a key without nulls of a right side that was grouped by it. The null-safe form shuffles the right side
    once more, so that both sides come straight from a shuffle and adaptive execution may split a hot key."""
    named = right.withColumnRenamed(key, f"{key}_right")
    out = left.join(named, F.col(key).eqNullSafe(F.col(f"{key}_right")), how)
    return out if how == "left_semi" else out.drop(f"{key}_right")


def worded(text: Column) -> Column:
    """Words of a text, `[^\\x20\\x09-\\x0D]+`; null and blank texts have none."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))
