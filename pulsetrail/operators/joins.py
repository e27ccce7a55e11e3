"""Join building blocks.

No side is hinted for broadcast: Spark broadcasts a side only when its measured size is under the threshold and
otherwise shuffles, with skewed partitions split at run time. Facts are aggregated before they meet a dimension
wherever the result allows it, so what is shuffled is one row per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import hex_prefix, moment, query_label

NULL_SPREAD = 64


def renamed_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key columns under private names, so two frames of the same origin can meet in a join."""
    return df.select(*[F.col(k).alias(f"__k_{k}") for k in keys])


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]):
    """NULL-safe equality of `keys` with the renamed keys of `right`."""
    condition = None
    for key in keys:
        test = left[key].eqNullSafe(right[f"__k_{key}"])
        condition = test if condition is None else condition & test
    return condition


def splittable(left: DataFrame, right: DataFrame, pairs: dict[str, str]):
    """Equality of non-NULL keys, for a right side that was grouped by them.

    Adaptive execution splits a hot key only where both sides come straight from a shuffle. Plain equality would
    reuse the grouping's layout for the right side and rule that out; the NULL-safe form shuffles the right side,
    one row per key, once more. Callers make sure the right keys are not NULL, so NULL matches nothing.
    """
    condition = None
    for mine, theirs in pairs.items():
        test = left[mine].eqNullSafe(right[theirs])
        condition = test if condition is None else condition & test
    return condition


def only_new(new: DataFrame, old: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `new` whose key is not in `old`; NULL keys compare equal, so a re-run adds nothing."""
    known = renamed_keys(old, keys).distinct()
    return new.join(known, null_safe(new, known, keys), "left_anti")


def vanished(master: DataFrame, current: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `master` that the current export no longer shows."""
    seen = renamed_keys(current, keys).distinct()
    return master.join(seen, null_safe(master, seen, keys), "left_anti")


def with_mark(df: DataFrame, seen: DataFrame, keys: Sequence[str], mark: str) -> DataFrame:
    """`df` plus a flag telling whether its key occurs in `seen`."""
    flagged = renamed_keys(seen, keys).distinct().withColumn(mark, F.lit(True))
    return (df.join(flagged, null_safe(df, flagged, keys), "left").drop(*[f"__k_{k}" for k in keys])
            .withColumn(mark, F.coalesce(mark, F.lit(False))))


def query_labels(queries: DataFrame, length: int = 60) -> DataFrame:
    """Statement ids with their one-line label: the text is cut before it is moved."""
    return queries.select("queryid", query_label(F.col("query"), length).alias("query"))


def join_query(df: DataFrame, queries: DataFrame, key: str = "query_id", length: int = 60) -> DataFrame:
    """Add the statement label; rows without a known statement drop out."""
    labels = query_labels(queries, length).withColumnRenamed("queryid", "__queryid")
    return df.join(labels, df[key] == labels["__queryid"], "inner").drop("__queryid")


def table_by_prefix(tablets: DataFrame) -> DataFrame:
    """One table name per tablet prefix, also when a tablet left and came back."""
    return (tablets.filter(F.col("tblt_uuid").isNotNull()).groupBy(hex_prefix(F.col("tblt_uuid")).alias("tblt_prefix"))
            .agg(F.min("table_name").alias("table_name")))


def attach_tablet(samples: DataFrame, tablets: DataFrame, how: str = "left") -> DataFrame:
    """Add `table_name` to samples through the first 15 hex digits of the tablet id.

    Samples without an aux value match nothing; in the outer form they are spread over many join keys that no
    tablet can have, so they do not pile up in one task.
    """
    names = table_by_prefix(tablets)
    if how == "inner":
        joined = samples.join(names, splittable(samples, names, {"wait_event_aux": "tblt_prefix"}), "inner")
        return joined.drop("tblt_prefix")
    spread = F.pmod(F.xxhash64("sample_time", "pid", "host"), F.lit(NULL_SPREAD)).cast("string")
    keyed = samples.withColumn("__aux_key", F.coalesce("wait_event_aux", F.concat(F.lit("no aux "), spread)))
    joined = keyed.join(names, splittable(keyed, names, {"__aux_key": "tblt_prefix"}), "left")
    return joined.drop("__aux_key", "tblt_prefix")


def attach_session(rows: DataFrame, sessions: DataFrame, time: str | None = None, as_of=None,
                   columns: Sequence[str] = ("id",), since=None) -> DataFrame:
    """Add session columns by (top-level node, process id).

    A process id is re-used over time. With `time`, a row only matches the session that was alive then. Sessions
    are listed once per day they lived, so one busy process id is spread over its days and a long history of
    re-use is never compared row by row; days before `since` are left out.
    """
    carried = [c for c in columns]
    side = sessions.select(F.col("tsrv_uuid").alias("__node"), F.col("pid").cast("long").alias("__pid"),
                           F.col("backend_start").alias("__from"), F.col("gone_dt").alias("__to"),
                           *[F.col(c).alias(f"sess_{c}" if c == "id" else c) for c in carried])
    on = (rows["top_level_node_id"] == side["__node"]) & (rows["pid"] == side["__pid"])
    if time is None:
        return rows.join(side, on, "inner").drop("__node", "__pid", "__from", "__to")
    side = side.withColumn("__to", F.coalesce("__to", moment(as_of)))
    begin = F.col("__from") if since is None else F.greatest(F.col("__from"), moment(since))
    side = (side.filter((F.col("__from") <= F.col("__to")) & (begin <= F.col("__to")))
            .withColumn("__day", F.explode(F.sequence(F.to_date(begin), F.to_date("__to")))))
    on = ((rows["top_level_node_id"] == side["__node"]) & (rows["pid"] == side["__pid"])
          & (F.to_date(rows[time]) == side["__day"])
          & (rows[time] >= side["__from"]) & (rows[time] <= side["__to"]))
    return rows.join(side, on, "inner").drop("__node", "__pid", "__from", "__to", "__day")


def samples_of(samples: DataFrame, requests: DataFrame, key: str = "rr_uuid") -> DataFrame:
    """Samples of a selection of requests, before anything is grouped. For selections that are few compared to the
    samples: the ids are then sent to the samples and nothing else moves."""
    wanted = renamed_keys(requests.filter(F.col(key).isNotNull()), [key]).distinct()
    return samples.join(wanted, splittable(samples, wanted, {"root_request_id": f"__k_{key}"}), "left_semi")


def of_days(samples: DataFrame, requests: DataFrame) -> DataFrame:
    """The samples on days on which some of the requests were seen, and those without a time: what a report on requests
    covers, whatever the layout of the log. The days are a few rows; of a log partitioned by `day` they prune the scan at
    run time, and the partition without a day stays. Requests without a span say nothing about days: all samples."""
    if "rr_min_dt" not in requests.columns:
        return samples
    none = F.lit("0001-01-01").cast("date")
    day = F.coalesce(F.col("day") if "day" in samples.columns else F.to_date("sample_time"), none)
    seen = requests.select(F.explode(F.sequence(F.to_date("rr_min_dt"), F.to_date("rr_max_dt"))).alias("__day"))
    days = seen.distinct().unionByName(samples.sparkSession.range(1).select(none.alias("__day")))
    return samples.join(days, day == F.col("__day"), "left_semi")


def resolve_server(hosts: DataFrame, live: DataFrame, master: DataFrame) -> DataFrame:
    """Server id of each host: from the live list, else from the recorded servers."""
    live_ids = live.groupBy("host").agg(F.min("uuid").alias("__live"))
    known_ids = master.groupBy("host").agg(F.min("tsrv_uuid").alias("__known"))
    return (hosts.join(live_ids, "host", "left").join(known_ids, "host", "left")
            .withColumn("tsrv_uuid", F.coalesce("__live", "__known")).drop("__live", "__known"))


def merge_columns(target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """UPDATE … FROM: matched rows take the source values, NULLs included; others keep theirs. A key that the source
    repeats updates its rows once, with the row that is greatest by its values; an update never adds rows."""
    once = source.groupBy(*keys).agg(F.max(F.struct(*columns)).alias("__v"))
    source = once.select(*keys, *[F.col(f"__v.{c}").alias(c) for c in columns])
    side = source.select(*[F.col(k).alias(f"__k_{k}") for k in keys],
                         *[F.col(c).alias(f"__n_{c}") for c in columns], F.lit(True).alias("__hit"))
    condition = None
    for k in keys:
        test = target[k] == side[f"__k_{k}"]
        condition = test if condition is None else condition & test
    joined = target.join(side, condition, "left")
    merged = [F.when(F.col("__hit"), F.col(f"__n_{c}")).otherwise(F.col(c) if c in target.columns else F.lit(None))
              .alias(c) for c in columns]
    kept = [F.col(c) for c in target.columns if c not in columns]
    return joined.select(*kept, *merged)


def snapshot_wide(snapshots: DataFrame, log: DataFrame, hosts: Sequence[str], metrics: dict[str, str]) -> DataFrame:
    """One row per snapshot with each metric of each host side by side. A snapshot lacking a host is dropped.
    `metrics` maps a log column to the suffix of its output columns (`n2_rds` for host node2)."""
    cells, present = [], []
    for host in hosts:
        short = host.replace("node", "n")
        present.append(F.count_if(F.col("host") == host).alias(f"__has_{short}"))
        cells += [F.max(F.when(F.col("host") == host, F.col(c))).alias(f"{short}_{suffix}")
                  for c, suffix in metrics.items()]
    wide = log.groupBy("snap_id").agg(*cells, *present)
    flags = [c for c in wide.columns if c.startswith("__has_")]
    for flag in flags:
        wide = wide.filter(F.col(flag) > 0)
    return (wide.drop(*flags).join(snapshots.select(F.col("id").alias("snap_id"), "log_dt"), "snap_id", "inner")
            .select("log_dt", *[c for c in wide.columns if c not in flags and c != "snap_id"]).orderBy("log_dt"))


def kv_to_row(kv: DataFrame, keys: dict[str, str], by: Sequence[str] = ("host",)) -> DataFrame:
    """Key/value lines to one row. `keys` maps each key to its type. A group lacking a key gives no row; a key with an
    empty value does. Of a key given twice the greatest text counts; `repeated_keys` lists such keys, and `n_repeated` of
    `kv_rows` counts them."""
    return kv_rows(kv, keys, by).drop("n_repeated")


def kv_rows(kv: DataFrame, keys: dict[str, str], by: Sequence[str] = ("host",)) -> DataFrame:
    """`kv_to_row` with the number of keys that the group gives more than once."""
    values, present = [], []
    for key, kind in keys.items():
        hit = F.col("key") == key
        values.append(F.max(F.when(hit, F.col("value"))).try_cast(kind).alias(key))
        present.append(F.count_if(hit).alias(f"__has_{key}"))
    wide = kv.groupBy(*by).agg(*values, *present)
    wide = wide.withColumn("n_repeated", sum(((F.col(f"__has_{key}") > 1).cast("int") for key in keys), F.lit(0)))
    for key in keys:
        wide = wide.filter(F.col(f"__has_{key}") > 0)
    return wide.drop(*[f"__has_{key}" for key in keys])


def repeated_keys(kv: DataFrame, by: Sequence[str] = ("host",)) -> DataFrame:
    """Keys that a group gives more than once, with their number of lines: what `kv_to_row` cannot keep."""
    return kv.groupBy(*by, "key").agg(F.count(F.lit(1)).alias("n_lines")).filter(F.col("n_lines") > 1)


def substring_matches(df: DataFrame, text: str, cuts: Sequence[tuple[int, int]]) -> DataFrame:
    """Three-way self match on substrings: for every substring that occurs at all three positions, how many rows
    have it at each position and how many row triples that makes.

    Every triple of the join is counted and none is written out: a common substring would give as many triples as
    the cube of its rows. Each side is one aggregation, so a hot substring is reduced map-side.
    """
    sides = F.array(*[F.struct(F.lit(i).alias("side"), F.substring(F.col(text), start, size).alias("sub"))
                      for i, (start, size) in enumerate(cuts)])
    pieces = df.select(F.explode(sides).alias("p")).select("p.side", "p.sub").filter(F.col("sub").isNotNull())
    counts = pieces.groupBy("sub").agg(*[F.count_if(F.col("side") == i).alias(f"n{i + 1}") for i in range(len(cuts))])
    total = None
    for i in range(len(cuts)):
        counts = counts.filter(F.col(f"n{i + 1}") > 0)
        total = F.col(f"n{i + 1}") if total is None else total * F.col(f"n{i + 1}")
    return counts.withColumn("triples", total)
