"""Benchmark decontamination with one Aho-Corasick automaton over normalised benchmark windows.

Texts are normalised to their words (ASCII letters lower-cased; digits, letters and everything beyond ASCII), joined by
single blanks. A window is `size` consecutive words of an item, or all words of a shorter one. Each text is scanned
once; a hit is mapped to word numbers, and from there to code point offsets of the original text.

Null texts have no words. Items without an id count as hits but are not listed. Several rows of one item are one item.
The automaton's size is known before it is built: windows are dealt to parts of at most `part_bytes` bytes of windows,
each part is one automaton and one scan, and what the parts find of a text is put together. One part is the usual case.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsetrail.llm.common import scan, wrapped
from pulsetrail.session import run_folder

WINDOW = 10
PART_BYTES = 3_000_000      # an automaton takes some fifty times this

# Bytes of UTF-8: A-Z to a-z, other ASCII that is no digit or letter to a blank, the rest as it is.
NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(NORMAL).split()


def windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(item_id, phrase), distinct; the phrase is binary text of one character per byte."""

    def start():
        def one(text: str | None) -> tuple[list[str]]:
            w = words_of(text)
            last = max(1, len(w) - size + 1) if w else 0
            return (list({b" ".join(w[i:i + size]).decode("latin-1") for i in range(last)}),)

        return lambda texts: [one(t) for t in texts]

    return scan(benchmark.select("item_id", "text"), start, "phrases array<string>").select(
        "item_id", F.explode("phrases").alias("phrase")).distinct()


def automaton(phrases: dict[str, list]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for phrase, items in phrases.items():
        found.add_word(f" {phrase} ", (phrase.count(" ") + 1, items))
    if phrases:
        found.make_automaton()
    return found


def matches(text: str | None, found) -> tuple[int, list[tuple[int, int]], list]:
    """Number of words, hit runs of words (first, behind the last; apart from each other), ids of hit items."""
    w = words_of(text)
    line = (b" " + b" ".join(w) + b" ").decode("latin-1")
    runs: list[tuple[int, int]] = []
    items: set = set()
    count = at = 0
    for last, (n, ids) in found.iter(line) if len(found) else ():
        count, at = count + line.count(" ", at, last), last      # words that end before the closing blank
        items.update(ids)
        first = count - n
        while runs and runs[-1][1] >= first:
            first = min(first, runs.pop()[0])
        runs.append((first, count))
    return len(w), runs, list(items)


def offsets(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Code point offsets of runs of words."""
    starts, ends = {a for a, _ in runs}, {b - 1 for _, b in runs}
    begin, stop = {}, {}
    for i, m in enumerate(WORD.finditer(text)) if runs else ():
        if i in starts:
            begin[i] = m.start()
        if i in ends:
            stop[i] = m.end()
    return [(begin[a], stop[b - 1]) for a, b in runs]


HITS = "n_words long, runs array<struct<first:int,behind:int>>, spans array<struct<start:int,end:int>>, items array<{id}>"


def find(df: DataFrame, benchmark: DataFrame, size: int = WINDOW, part_bytes: int = PART_BYTES,
         text: str = "text") -> DataFrame:
    """Adds n_words, runs (hit words), spans (hit code points) and items (ids with occurring windows, sorted)."""
    of = windows(benchmark, size).persist()
    id_type = dict(of.dtypes)["item_id"]
    total = of.agg(F.coalesce(F.sum(F.length("phrase") + 16), F.lit(0)).alias("n")).first()["n"]
    parts = max(1, math.ceil(total / part_bytes))
    schema = HITS.format(id=id_type)
    out = df
    for k in range(parts):
        phrases: dict[str, list] = {}
        # Bounded: a part holds about part_bytes bytes of windows.
        for row in of.where(F.pmod(F.xxhash64("phrase"), F.lit(parts)) == k).toLocalIterator():
            phrases.setdefault(row["phrase"], []).extend([] if row["item_id"] is None else [row["item_id"]])
        sent = df.sparkSession.sparkContext.broadcast(phrases)

        def start(sent=sent):
            found = automaton(sent.value)

            def one(t: str | None):
                n, runs, items = matches(t, found)
                return (n, [{"first": a, "behind": b} for a, b in runs],
                        [{"start": a, "end": b} for a, b in offsets(t, runs)] if runs else [], sorted(items))

            return lambda texts: [one(t) for t in texts]

        found = scan(out, start, schema, text)
        if k:  # what an earlier part found has been carried along
            found = (found.withColumn("runs", union_of("runs_", "runs", "first", "behind"))
                     .withColumn("spans", union_of("spans_", "spans", "start", "end"))
                     .withColumn("items", F.array_sort(F.array_union("items_", "items")))
                     .drop("runs_", "spans_", "items_"))
        if k < parts - 1:  # written, so that one automaton is in memory at a time
            folder = run_folder(df.sparkSession, "decontamination")
            found.withColumnsRenamed({c: f"{c}_" for c in ("runs", "spans", "items")}).write.parquet(folder)
            found = df.sparkSession.read.parquet(folder)
        out = found
    of.unpersist()
    return out


def union_of(a: str, b: str, first: str, behind: str):
    """Two arrays of runs as one array of runs that are apart."""
    ordered = F.array_sort(F.concat(a, b))
    start = F.array().cast(f"array<struct<{first}:int,{behind}:int>>")

    def add(done, x):
        last = F.element_at(done, -1)
        grown = F.struct(last[first].alias(first), F.greatest(last[behind], x[behind]).alias(behind))
        return F.when((F.size(done) == 0) | (x[first] > F.coalesce(F.get(done, F.size(done) - 1)[behind], F.lit(-1))),
                      F.concat(done, F.array(x))).otherwise(
            F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(grown)))

    return F.aggregate(ordered, start, add)


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated; one row per input row."""
    found = find(docs.select("doc_id", "text"), benchmark)
    ids = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    hit = F.aggregate("runs", F.lit(0).cast("long"), lambda n, x: n + x["behind"] - x["first"])
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(ids.cast("binary"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any window of the benchmark, unchanged."""
    return find(wrapped(docs, "text"), benchmark).where(F.size("runs") == 0).select("row.*")
