"""URL filters by path templates.

Per host the paths form a tree of segments, cut to templates: numbers, ids, dates and long or rare segments become
wildcards, so that a host has few templates. Templates of a host whose rates of blocked pages differ no more than chance
(a two-proportion test within the same first segment) are merged. The pages that the given rules decide are the labels:
a template is rejected if its smoothed share of blocked pages is over one half. A template without labels of its own
leans on the same template of all hosts, and that on all labelled pages.

Everything is DataFrame operations: counts per (host, template), and joins on them. Hosts may hold any part of all pages:
counts are made before anything is shuffled, and no page is joined but with the small table of judged templates.
A null url, or one without `://`, has an empty host and path.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsetrail.session import run_folder

DEPTH = 4              # segments of a template; deeper ones are one wildcard
FREQUENT = 20          # pages of a host that make a plain segment a word of its own
PRIOR = 4.0            # pages that the wider group counts for
PURITY = 0.5
Z_MERGE = 1.96


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules of the production query.
RULES = (Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
         Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"))


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; query and fragment are left off."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    low = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return low, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, or nulls. Of rules of one length the first counts."""
    text = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.text)):       # longer ones last, outermost
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text, verdict = F.when(fits, r.text).otherwise(text), F.when(fits, r.verdict).otherwise(verdict)
    return text, verdict


def generalised(segment: Column) -> Column:
    """A wildcard for segments that vary by their form; a file's ending stays."""
    ending = F.regexp_extract(segment, r"(\.[A-Za-z]{2,5})$", 1)
    stem = F.regexp_replace(segment, r"\.[A-Za-z]{2,5}$", "")
    varies = (stem.rlike(r"[0-9]") & ~stem.rlike(r"^v[0-9]$")) | (F.length(stem) > 24) | stem.rlike(r"[%=+]")
    return F.when(varies, F.concat(F.lit("*"), ending)).otherwise(segment)


def segments(path: Column) -> Column:
    """At most `DEPTH` generalised segments; what lies deeper is one wildcard."""
    all_ = F.filter(F.split(path, "/"), lambda x: x != "")
    cut = F.transform(F.slice(all_, 1, DEPTH), generalised)
    return F.when(F.size(all_) > DEPTH, F.concat(cut, F.array(F.lit("**")))).otherwise(cut)


def templates(df: DataFrame) -> DataFrame:
    """(host, raw, template, blocked, allowed) from pages with host, raw segments and label, without merges.

    A first segment that fewer than `FREQUENT` pages of its host have, on a host with more than ten such, is variable and
    becomes a wildcard too. Deeper segments of this kind follow the first."""
    counts = df.groupBy("host", "raw").agg(F.count("*").alias("n"), F.sum((F.col("label") == "block").cast("long")).alias("blocked"),
                                           F.sum((F.col("label") == "allow").cast("long")).alias("allowed"))
    first = F.coalesce(F.get("raw", F.lit(0)), F.lit(""))
    counts = counts.withColumn("first", first)
    per_first = counts.groupBy("host", "first").agg(F.sum("n").alias("pages"))
    rare = (F.col("pages") < FREQUENT) & ~F.col("first").startswith("*") & (F.col("first") != "")
    spread = per_first.groupBy("host").agg(F.sum(rare.cast("long")).alias("rare_ones"))
    variable = per_first.where(rare).join(spread.where(F.col("rare_ones") > 10), "host").select(
        "host", "first", F.lit(True).alias("variable"))
    joined = counts.join(variable, ["host", "first"], "left")
    tail = F.expr("slice(raw, 2, greatest(size(raw) - 1, 0))")
    wide = F.when(F.coalesce("variable", F.lit(False)), F.concat(F.array(F.lit("*")), tail)).otherwise(F.col("raw"))
    return joined.select("host", "raw", wide.alias("template"), F.coalesce("blocked", F.lit(0)).alias("blocked"),
                         F.coalesce("allowed", F.lit(0)).alias("allowed"))


def merged(counted: DataFrame) -> DataFrame:
    """Adds `branch`: templates of a host and first segment whose share of blocked pages is that of their siblings, by a
    two-proportion test against the siblings' total, share one branch."""
    head = F.coalesce(F.get("template", F.lit(0)), F.lit(""))
    per = counted.withColumn("head", head).groupBy("host", "head", "template").agg(
        F.sum("blocked").alias("blocked"), F.sum("allowed").alias("allowed"))
    whole = per.groupBy("host", "head").agg(F.sum("blocked").alias("b"), F.sum("allowed").alias("a"))
    n1, n2 = F.col("blocked") + F.col("allowed"), F.col("a") + F.col("b")
    pooled = F.col("b") / F.greatest(n2, F.lit(1))
    gap = F.abs(F.col("blocked") / F.greatest(n1, F.lit(1)) - pooled)
    apart = (n1 > 0) & (n1 < n2) & (gap > Z_MERGE * F.sqrt(pooled * (1 - pooled) * (1 / F.greatest(n1, F.lit(1)))))
    branch = F.when(apart, F.concat_ws("/", F.col("template"))).otherwise(F.concat(F.col("head"), F.lit("/**")))
    return per.join(whole, ["host", "head"]).select("host", "template", "blocked", "allowed", branch.alias("branch"))


def judged(pages: DataFrame) -> DataFrame:
    """(host, raw, purity): the smoothed share of blocked pages of each (host, raw template)."""
    counted = templates(pages)
    branches = merged(counted)
    sums = [F.sum("blocked").alias("blocked"), F.sum("allowed").alias("allowed")]
    own = branches.groupBy("host", "branch").agg(*sums)
    everywhere = own.groupBy("branch").agg(F.sum("blocked").alias("b2"), F.sum("allowed").alias("a2"))
    overall = own.agg(*sums).first()        # two numbers
    smooth = lambda b, a, prior: (b + PRIOR * prior) / (a + b + PRIOR)
    p3 = smooth(overall["blocked"] or 0, overall["allowed"] or 0, 0.5)
    p2 = smooth(F.col("b2"), F.col("a2"), F.lit(p3))
    purity = (own.join(everywhere, "branch")
              .select("host", "branch", smooth(F.col("blocked"), F.col("allowed"), p2).alias("purity")))
    names = counted.select("host", "raw", "template").distinct()
    return (names.join(branches.select("host", "template", "branch"), ["host", "template"])
            .join(purity, ["host", "branch"]).select("host", "raw", "purity"))


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """Adds host, path, rule and verdict; `purity` is the method's smoothed share of blocked pages."""
    host, path = parts(F.col("url"))
    taken = pages.drop("host", "path").select("*", host.alias("host"), path.alias("path"))
    rule, label = ruled(F.col("host"), F.col("path"), rules)
    taken = taken.withColumn("raw", segments(F.col("path"))).withColumn("rule", rule).withColumn("label", label)
    # Written and reread, so that both sides of the join are plain shuffles, of which hot keys are split.
    spark, folder = pages.sparkSession, run_folder(pages.sparkSession, "url-templates")
    judged(taken.select("host", "raw", "label")).write.parquet(folder)
    out = taken.join(spark.read.parquet(folder), ["host", "raw"], "left")
    verdict = F.coalesce("label", F.when(F.col("purity") > PURITY, F.lit("block")).otherwise(F.lit("allow")))
    return out.withColumn("verdict", verdict).drop("raw", "label")


def report(pages: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict, purity; one row per input row."""
    return judge(pages.select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "purity")
