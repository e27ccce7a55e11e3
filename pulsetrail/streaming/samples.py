"""Sample history as Structured Streaming.

Exports dropped as files are read once per trigger. Stateless rewrites run on the stream; operators that need the
stored history run in `foreachBatch` with the same functions as the batch jobs. A micro-batch publishes its tables in one
commit under its own id, so a repeated batch changes nothing.

Nothing waits for a watermark: a batch appends what it adds to each group, and groups are put together when they are
read. So a late row counts however late it is, and open groups can be read at any time. What batches add is kept in tiers:
full ones are merged as batches arrive, so that a read folds few of them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import state as st
from ..operators.filters import drop_noise, foreground
from ..operators.joins import only_new
from ..plans.dashboards import wait_type_columns
from ..sources.store import FANOUT, VersionedTables  # noqa: F401

def read_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """Files dropped into a folder (or matching a glob), each read once."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def before_newest(df: DataFrame, column: str, span: dt.timedelta) -> Column:
    """The newest moment of a column minus a time span, as a literal. The moment travels as text, so neither the
    driver's time zone nor the column's timestamp type matters."""
    text = df.agg(F.max(column).cast("string")).first()[0]
    newest = F.lit(text).cast(df.schema[column].dataType)
    return newest - F.make_dt_interval(secs=F.lit(span.total_seconds()).cast("decimal(18,6)"))


def run_batches(stream: DataFrame, handle, folder: str) -> VersionedTables:
    """Run `handle(tables, rows, batch_id)` for every micro-batch over everything available."""
    tables = VersionedTables(stream.sparkSession, f"{folder}/tables")

    def one(rows: DataFrame, batch_id: int) -> None:
        tables.refresh()
        if tables.done(f"batch {batch_id}"):
            return
        rows = rows.persist()
        try:
            with tables.transaction(f"batch {batch_id}") as tx:
                handle(tx, rows, batch_id)
        finally:
            rows.unpersist()

    (stream.writeStream.foreachBatch(one).option("checkpointLocation", f"{folder}/checkpoint")
     .trigger(availableNow=True).start().awaitTermination())
    return tables


# ---- root request spans -----------------------------------------------------------------------------------

SPAN_SCHEMA = T.StructType([
    T.StructField("rr_uuid", T.StringType()), T.StructField("rr_min_dt", T.TimestampNTZType()),
    T.StructField("rr_max_dt", T.TimestampNTZType()), T.StructField("cnt", T.LongType())])


def fold_spans(partial: DataFrame) -> DataFrame:
    return partial.groupBy("rr_uuid").agg(F.min("rr_min_dt").alias("rr_min_dt"), F.max("rr_max_dt").alias("rr_max_dt"),
                                          F.sum("cnt").alias("cnt"))


def add_spans(tables: VersionedTables, rows: DataFrame, batch_id: int) -> None:
    """Each batch appends its partial spans."""
    partial = foreground(rows).groupBy(F.col("root_request_id").alias("rr_uuid")).agg(
        F.min("sample_time").alias("rr_min_dt"), F.max("sample_time").alias("rr_max_dt"),
        F.count(F.lit(1)).alias("cnt"))
    tables.fold("rr_span", partial, fold_spans, batch_id)


def read_spans(tables: VersionedTables) -> DataFrame:
    """Spans as of now: partial spans folded on read."""
    return fold_spans(tables.read_all("rr_span", SPAN_SCHEMA))


# ---- minute counts ----------------------------------------------------------------------------------------

MINUTE_SCHEMA = T.StructType([T.StructField("dt", T.TimestampNTZType()), T.StructField("host", T.StringType()),
                              T.StructField("cnt", T.LongType())])
_WAIT_NAMES = ["timeout", "network", "disk_io", "wait_on_condition", "io", "client", "cpu_active", "cpu_passive"]
WAIT_SCHEMA = T.StructType([T.StructField("dt", T.TimestampNTZType()),
                            *[T.StructField(n, T.LongType()) for n in _WAIT_NAMES]])


def add_minute_hosts(tables: VersionedTables, rows: DataFrame, batch_id: int) -> None:
    """A batch's samples per minute and host."""
    tables.fold("minute_host", rows.groupBy(F.date_trunc("minute", "sample_time").alias("dt"), "host")
                .agg(F.count(F.lit(1)).alias("cnt")), fold_minute_hosts, batch_id)


def fold_minute_hosts(partial: DataFrame) -> DataFrame:
    return partial.groupBy("dt", "host").agg(F.sum("cnt").alias("cnt"))


def read_minute_hosts(tables: VersionedTables) -> DataFrame:
    return fold_minute_hosts(tables.read_all("minute_host", MINUTE_SCHEMA))


def add_minute_waits(tables: VersionedTables, rows: DataFrame, batch_id: int) -> None:
    """A batch's wait types per minute: a fixed list of conditional counts."""
    counts = rows.groupBy(F.date_trunc("minute", "sample_time").alias("dt")).agg(*wait_type_columns())
    tables.fold("minute_wait", counts.select("dt", *_WAIT_NAMES), fold_minute_waits, batch_id)


def fold_minute_waits(partial: DataFrame) -> DataFrame:
    return partial.groupBy("dt").agg(*[F.sum(n).alias(n) for n in _WAIT_NAMES])


def read_minute_waits(tables: VersionedTables) -> DataFrame:
    return fold_minute_waits(tables.read_all("minute_wait", WAIT_SCHEMA))


# ---- process lifetime and bursts --------------------------------------------------------------------------

PIECE_SCHEMA = T.StructType([
    T.StructField("top_level_node_id", T.StringType()), T.StructField("pid", T.LongType()),
    T.StructField("opened", T.TimestampNTZType()), T.StructField("last_seen", T.TimestampNTZType()),
    T.StructField("cnt", T.LongType())])
_LIFE_KEYS = ["top_level_node_id", "pid"]


def add_pieces(tables: VersionedTables, rows: DataFrame, batch_id: int) -> None:
    """One piece per process and minute is what a batch adds; pieces are merged on read, so that a late sample still
    joins or bridges the lifetimes around it."""
    pieces = (rows.groupBy(*_LIFE_KEYS, F.date_trunc("minute", "sample_time").alias("m"))
              .agg(F.min("sample_time").alias("opened"), F.max("sample_time").alias("last_seen"),
                   F.count(F.lit(1)).alias("cnt")))
    tables.fold("piece", pieces.select(*PIECE_SCHEMA.fieldNames()), fold_pieces, batch_id)


def fold_pieces(pieces: DataFrame) -> DataFrame:
    """One piece per process and minute of its start."""
    return (pieces.groupBy(*_LIFE_KEYS, F.date_trunc("minute", "opened").alias("m"))
            .agg(F.min("opened").alias("opened"), F.max("last_seen").alias("last_seen"), F.sum("cnt").alias("cnt"))
            .drop("m"))


def lifetimes(pieces: DataFrame, timeout_seconds: int) -> DataFrame:
    """Merge (opened, last_seen, cnt) pieces of a process that lie within the timeout of each other.

    Pieces of one minute are folded first, then session windows with a per-row gap: a piece reaches from its start to
    its end plus the timeout.
    """
    folded = fold_pieces(pieces)
    seconds = F.timestamp_diff("MICROSECOND", F.col("opened"), F.col("last_seen")) / 1e6 + F.lit(timeout_seconds)
    gap = F.make_interval(secs=seconds)
    return (folded.groupBy(F.session_window("opened", gap).alias("w"), *_LIFE_KEYS)
            .agg(F.min("opened").alias("opened"), F.max("last_seen").alias("last_seen"), F.sum("cnt").alias("cnt"))
            .select(*_LIFE_KEYS, "opened", "last_seen", "cnt"))


def read_bursts(tables: VersionedTables, gap_seconds: int) -> DataFrame:
    """Bursts of one process: samples less than the gap apart."""
    return lifetimes(tables.read_all("piece", PIECE_SCHEMA), gap_seconds).select(
        *_LIFE_KEYS, F.col("opened").alias("first_seen"), "last_seen", "cnt")


def read_lifetimes(tables: VersionedTables, timeout_seconds: int) -> DataFrame:
    """Sessions from their first to their last sample; `gone_dt` is set once nothing was seen for the timeout before the
    newest sample of all."""
    pieces = tables.read_all("piece", PIECE_SCHEMA)
    limit = before_newest(pieces, "last_seen", dt.timedelta(seconds=timeout_seconds))
    gone = F.when(F.col("last_seen") <= limit, F.col("last_seen"))
    return lifetimes(pieces, timeout_seconds).drop("cnt").withColumn("gone_dt", gone)


# ---- first-seen events, incremental load, late rows -------------------------------------------------------

EVENT_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in
                             ("wait_event_component", "wait_event", "wait_event_type", "wait_event_class", "log_host")])


def add_first_seen(tables: VersionedTables, rows: DataFrame, batch_id: int) -> None:
    known = tables.read_all("event_mst", EVENT_SCHEMA)
    tables.add("event_mst", only_new(st.distinct_events(rows), known, ["wait_event_component", "wait_event"]), batch_id)


def load_new_samples(sample_schema: T.StructType):
    """Handler: the batch loader on a stream. The log is partitioned by day, and only the days of the batch
    are read back."""
    stored = T.StructType([*sample_schema.fields, T.StructField("day", T.DateType())])

    def handle(tables: VersionedTables, rows: DataFrame, batch_id: int) -> None:
        log = tables.read_all("sample_log", stored, days=st.days_of(rows))
        fresh = st.load_samples(log, rows).withColumn("day", F.to_date("sample_time"))
        tables.add("sample_log", fresh, batch_id, partition_by=["day"])

    return handle


def first_arrivals(rows: DataFrame) -> DataFrame:
    """One whole row per natural key: of the copies of a batch that which is least by its other columns."""
    others = [c for c in rows.columns if c not in st.SAMPLE_KEY]
    once = rows.groupBy(*st.SAMPLE_KEY).agg(F.min(F.struct(*others)).alias("__r"))
    return once.select(*[F.col(c) if c in st.SAMPLE_KEY else F.col(f"__r.{c}").alias(c) for c in rows.columns])


FILTER_BITS = 8 * 4096    # of one bitmap
FILTER_SCHEMA = T.StructType([T.StructField("day", T.DateType()), T.StructField("slot", T.LongType()),
                              T.StructField("bits", T.BinaryType())])


def _slots(rows: DataFrame, n_slots: int) -> DataFrame:
    """Place of a row's key in the filter of its day: a slot (one bitmap) and a bit."""
    place = F.pmod(F.xxhash64(*st.SAMPLE_KEY), F.lit(n_slots * FILTER_BITS))
    return rows.withColumn("__slot", F.floor(place / FILTER_BITS)).withColumn("__bit", F.pmod(place, F.lit(FILTER_BITS)))


def day_filter(rows: DataFrame, n_slots: int) -> DataFrame:
    """(day, slot, bits): bitmaps of the key hashes of each day, built by Spark's bitmap aggregate."""
    return (_slots(rows, n_slots).groupBy("day", F.col("__slot").alias("slot"))
            .agg(F.bitmap_construct_agg("__bit").alias("bits")))


def fold_filters(parts: DataFrame) -> DataFrame:
    return parts.groupBy("day", "slot").agg(F.bitmap_or_agg("bits").alias("bits"))


def maybe_known(rows: DataFrame, filters: DataFrame, n_slots: int) -> DataFrame:
    """Adds `maybe`: false where the key is certainly not stored."""
    named = filters.select(F.col("day").alias("__day"), F.col("slot").alias("__s"), "bits")
    at = _slots(rows, n_slots)
    joined = at.join(named, at["day"].eqNullSafe(named["__day"]) & (at["__slot"] == named["__s"]), "left")
    byte = F.conv(F.hex(F.substring("bits", (F.col("__bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.getbit(byte, F.pmod("__bit", F.lit(8)).cast("int")) != 0
    return joined.withColumn("maybe", F.coalesce(hit, F.lit(False))).drop("__day", "__s", "bits", "__slot", "__bit")


def load_distinct(sample_schema: T.StructType, n_slots: int = 64):
    """Handler: whole samples once per natural key, however far apart the copies arrive. Noise is dropped, a missing call
    id counts as 0, and the first arrival stays.

    A filter per day (bitmaps of key hashes) tells which rows are certainly new; only the others are looked up in the
    stored rows of their days. `n_slots` bitmaps of 32,768 bits make up a day's filter: a fuller one looks up more rows,
    never fewer than needed.
    """
    stored = T.StructType([*sample_schema.fields, T.StructField("day", T.DateType())])

    def handle(tables, rows: DataFrame, batch_id: int) -> None:
        rows = drop_noise(rows).withColumn("rpc_request_id", F.coalesce("rpc_request_id", F.lit(0).cast("long")))
        once = first_arrivals(rows.select(*sample_schema.fieldNames())).withColumn("day", F.to_date("sample_time"))
        days = st.days_of(rows)
        filters = tables.read_all("sample_filter", FILTER_SCHEMA)
        filters = fold_filters(filters.filter(st.on_days("day", days)))
        judged = maybe_known(once, filters, n_slots).persist()
        try:
            log = tables.read_all("sample_once", stored, days=days)
            again = only_new(judged.filter("maybe"), log, st.SAMPLE_KEY)
            fresh = judged.filter("NOT maybe").unionByName(again).select(*stored.fieldNames())
            written = tables.add("sample_once", fresh, batch_id, partition_by=["day"])
            written = fresh if isinstance(written, int) else written
            tables.fold("sample_filter", day_filter(written, n_slots), fold_filters, batch_id)
        finally:
            judged.unpersist()

    return handle


NEWEST_SCHEMA = T.StructType([T.StructField("newest", T.TimestampNTZType())])


def split_late(horizon: dt.timedelta, schema: T.StructType):
    """Handler: rows older than the horizon, measured from the newest sample seen so far, go to a side table."""

    def handle(tables: VersionedTables, rows: DataFrame, batch_id: int) -> None:
        before = tables.read("newest", NEWEST_SCHEMA)
        newest = before.unionByName(rows.select(F.col("sample_time").alias("newest"))).agg(F.max("newest").alias("newest"))
        limit = before_newest(newest, "newest", horizon)
        tables.replace("newest", newest, batch_id)
        late = F.coalesce(F.col("sample_time") < limit, F.lit(False))
        tables.add("late", rows.filter(late), batch_id)
        tables.add("on_time", rows.filter(~late), batch_id)

    return handle
