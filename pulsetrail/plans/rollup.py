"""A roll-up of samples per minute and statement, with mergeable sketches of the requests that ran it.

Interval reports over long spans count distinct requests. Counts of minutes can be summed, distinct counts cannot, but
sketches of them can be merged: a report over a year reads the minutes' sketches instead of the samples. A sketch has
2**LG_K registers; its relative standard error is 1.04 / sqrt(2**LG_K), 1.6 % here, and small counts are exact.
`plans.interval.top_queries` stays the exact report.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import moment
from ..operators.aggregates import top_k
from ..operators.filters import foreground, in_interval
from ..operators.joins import join_query

LG_K = 12
MOST_ERROR = 0.05    # three standard errors


def minute_requests(samples: DataFrame) -> DataFrame:
    """(dt, query_id, cnt, requests): samples and request sketch per minute and statement. Parts of one minute may be
    appended by different runs; readers merge them."""
    seen = foreground(samples).filter(F.col("query_id").isNotNull())
    return seen.groupBy(F.date_trunc("minute", "sample_time").cast("timestamp_ntz").alias("dt"), "query_id").agg(
        F.count(F.lit(1)).alias("cnt"), F.hll_sketch_agg("root_request_id", F.lit(LG_K)).alias("requests"))


def merged(rollup: DataFrame) -> DataFrame:
    """The roll-up with one row per minute and statement: how its small batches are folded."""
    return rollup.groupBy("dt", "query_id").agg(F.sum("cnt").alias("cnt"), F.hll_union_agg("requests").alias("requests"))


def rolled_queries(rollup: DataFrame, start, end) -> DataFrame:
    """(query_id, cnt_ashev, nr_rreq): samples and estimated requests per statement over the minutes from `start` to `end`,
    both whole minutes and included."""
    minutes = rollup.filter(F.col("dt").between(moment(start), moment(end)))
    return minutes.groupBy("query_id").agg(
        F.sum("cnt").alias("cnt_ashev"), F.hll_sketch_estimate(F.hll_union_agg("requests")).alias("nr_rreq"))


def top_rolled_queries(rollup: DataFrame, queries: DataFrame, start, end, k: int = 20) -> DataFrame:
    """Statements with the most samples, from the roll-up; `nr_rreq` is an estimate."""
    found = join_query(rolled_queries(rollup, start, end), queries)
    return top_k(found, [F.desc("cnt_ashev"), F.col("query_id")], k).select("cnt_ashev", "nr_rreq", F.col("query_id").alias("top_qry"), "query")


def sketch_error(samples: DataFrame, rollup: DataFrame, start, end) -> DataFrame:
    """(query_id, cnt_ashev, nr_rreq, close): the exact numbers, and whether the roll-up has the same count of samples and
    an estimate within MOST_ERROR."""
    exact = foreground(in_interval(samples, start, end)).filter(F.col("query_id").isNotNull()).groupBy("query_id").agg(
        F.count(F.lit(1)).alias("cnt_ashev"), F.count_distinct("root_request_id").alias("nr_rreq"))
    told = rolled_queries(rollup, start, end).select(F.col("query_id").alias("__q"), F.col("cnt_ashev").alias("__n"),
                                                     F.col("nr_rreq").alias("__e"))
    near = (F.col("__n") == F.col("cnt_ashev")) & (F.abs(F.col("__e") - F.col("nr_rreq")) <= F.col("nr_rreq") * MOST_ERROR)
    return exact.join(told, exact["query_id"] == told["__q"], "left").select(
        "query_id", "cnt_ashev", "nr_rreq", F.coalesce(near, F.lit(False)).alias("close"))
