"""Quality rules with risk-controlled cutoffs.

Each rule compares one measure of a text with a cutoff and rejects beyond it. Cutoffs are certified on labelled
documents, all of them: for a stratum of text lengths, a rule and a cutoff, the hypothesis "more than `RISK` of the good documents
are rejected" is tested by the exact binomial tail of the good documents that are rejected. Only cutoffs whose p-value
is at most `ERROR` over the number of tests (strata x rules x cutoffs) may be used, so that with probability 1 - ERROR
all of them keep the promise. Of the certified cutoffs of a rule the one that rejects most bad documents, less `PRICE`
good documents each, is taken; ties go to the most lenient. Without labels nothing is certified and no rule rejects.

Everything is column expressions. The measures of a text are computed within its row, in O(n log n), and written once to
the shared folder; both the certification and the verdicts read this small table. Texts that are null, empty or blank
have no words and fail the base rule. Labels with several rows for an id count once each distinct value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsetrail.llm.common import worded
from pulsetrail.session import run_folder

RISK = 0.01
ERROR = 0.05
PRICE = 5
STRATA = (100, 1000)          # texts up to 100 words, up to 1000, longer ones
# Measures and the cutoffs tried, from lenient to strict. A text is rejected if the measure is above the cutoff.
CUTOFFS = {
    "symbol_rate": (1.0, 0.5, 0.3, 0.2, 0.15, 0.1, 0.07, 0.05, 0.03, 0.02, 0.01),
    "dup_line_rate": (0.9, 0.7, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1),
    "repeat_rate": (0.9, 0.7, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1, 0.05, 0.02),
    "word_length": (40.0, 30.0, 20.0, 15.0, 12.0, 10.0, 9.0, 8.0),
    "short_words": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3),
}
LONG = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measures(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds the long columns of `LONG`, n_lines and n_short. Everything happens within the row.

    Five-word windows are hashed first: if all hashes of a text differ, so do the windows, and none is repeated. Else
    the windows are sorted by their words, equal neighbours are marked, and the words that the marked windows cover are
    counted. Each step is a column of its own, so that none runs twice."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    none = F.array().cast("array<int>")
    made = df.withColumn("_w", worded(F.col(text))).withColumn("_l", lines).withColumn("_n", F.size("_w"))
    made = made.withColumn("_all", F.when(F.col("_n") >= 5, F.sequence(F.lit(0), F.col("_n") - 5)).otherwise(none))
    made = made.withColumn("_h", F.transform("_all", lambda i: F.xxhash64(*[F.get("_w", i + k) for k in range(5)])))
    made = made.withColumn("_some", F.when(F.size(F.array_distinct("_h")) < F.size("_h"), F.col("_all")).otherwise(none))
    made = made.withColumn("_s", F.sort_array(F.transform("_some", lambda i: F.struct(
        F.concat_ws(" ", *[F.get("_w", i + k) for k in range(5)]).alias("w"), i.alias("i")))))
    made = made.withColumn("_at", F.sort_array(F.transform(
        F.filter("_s", lambda x, k: x["w"].eqNullSafe(F.get("_s", k - 1)["w"])
                 | x["w"].eqNullSafe(F.get("_s", k + 1)["w"])), lambda x: x["i"])))
    covered = F.aggregate(F.transform("_at", lambda i, k: F.least(F.lit(5), F.coalesce(F.get("_at", k + 1) - i, F.lit(5)))),
                          F.lit(0), lambda a, b: a + b)
    return made.select(
        *df.columns, F.col("_n").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.size("_l").cast("long").alias("n_lines"), covered.cast("long").alias("n_repeat_words"),
        F.size(F.filter("_w", lambda x: F.length(x) <= 1)).cast("long").alias("n_short"))


def rates() -> dict[str, Column]:
    n, c = F.col("n_words"), F.col
    return {
        "symbol_rate": c("n_symbols") / F.greatest(c("word_chars"), F.lit(1)),
        "dup_line_rate": c("n_dup_lines") / F.greatest(c("n_lines"), F.lit(1)),
        "repeat_rate": c("n_repeat_words") / F.greatest(n, F.lit(1)),
        "word_length": c("word_chars") / F.greatest(n, F.lit(1)),
        "short_words": c("n_short") / F.greatest(n, F.lit(1)),
    }


def stratum() -> Column:
    return sum(((F.col("n_words") > limit).cast("int") for limit in STRATA), F.lit(0))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def binomial_tail(n: Column, k: Column, rate: float) -> Column:
    """P(X <= k) for X binomial in n and `rate`, summed exactly in logarithms; 1 beyond the mean, where it is no longer
    small."""
    odds = float(rate / (1 - rate))
    begin = F.struct((n * F.log1p(F.lit(-rate))).alias("term"), (n * F.log1p(F.lit(-rate))).alias("total"))

    def add(acc: Column, i: Column) -> Column:
        term = acc["term"] + F.log((n - i + 1) / i * odds)
        high, low = F.greatest(acc["total"], term), F.least(acc["total"], term)
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("total"))

    steps = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<long>"))
    return F.when(k > n * rate, F.lit(1.0)).otherwise(F.aggregate(steps, begin, add, lambda x: F.exp(x["total"])))


def certify(labelled: DataFrame) -> DataFrame:
    """(stratum, rule, cutoff, n_good, good, bad, p, certified) for each cutoff, from measures and `quality` (0, 1)."""
    tests = F.array(*[F.struct(F.lit(rule).alias("rule"), F.lit(x).alias("cutoff"), (rates()[rule] > x).alias("hit"))
                      for rule, cutoffs in CUTOFFS.items() for x in cutoffs])
    good = F.col("quality") == 1
    m = (len(STRATA) + 1) * sum(map(len, CUTOFFS.values()))
    count = lambda c: F.sum(c.cast("long"))
    per = (labelled.where(~base_failed() & F.col("quality").isin(0, 1))
           .select(stratum().alias("stratum"), "quality", F.explode(tests).alias("t"))
           .groupBy("stratum", "t.rule", "t.cutoff")
           .agg(count(good).alias("n_good"), count(good & F.col("t.hit")).alias("good"),
                count(~good & F.col("t.hit")).alias("bad")))
    return per.withColumn("p", binomial_tail(F.col("n_good"), F.col("good"), RISK)).withColumn(
        "certified", F.col("p") <= ERROR / m)


def cutoffs(certified: DataFrame) -> DataFrame:
    """One row per stratum with a column per rule: the chosen cutoff or null. At most as many rows as strata."""
    gain = F.col("bad") - PRICE * F.col("good")
    best = (certified.where(F.col("certified") & (gain > 0)).groupBy("stratum", "rule")
            .agg(F.max(F.struct(gain.alias("gain"), F.col("cutoff"))).alias("x")))
    return best.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == rule, F.col("x.cutoff"))).alias(rule)
                                         for rule in CUTOFFS])


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the five measures, base_failed, kept and the rules that rejected; one row per input row."""
    spark = docs.sparkSession
    folder = run_folder(spark, "quality")
    measures(docs.select("doc_id", "text")).drop("text").write.parquet(folder)
    measured = spark.read.parquet(folder)
    known = labels.select("doc_id", "quality").where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    chosen = cutoffs(certify(measured.join(known.distinct(), "doc_id")))
    out = measured.withColumn("stratum", stratum()).join(F.broadcast(chosen), "stratum", "left")   # a row per stratum
    hit = F.array_compact(F.array(*[F.when(rate > F.col(rule), F.lit(rule)) for rule, rate in rates().items()]))
    return out.withColumn("rejected_by", F.array_join(hit, ",")).select(
        "doc_id", *LONG, base_failed().alias("base_failed"),
        (~base_failed() & (F.col("rejected_by") == "")).alias("kept"), "rejected_by")
