"""License scans as an exact set-similarity join of text blocks with templates.

Texts are words (A-Z lower-cased, cut at ASCII signs and blanks), blocks are windows of 2 x step words that start every
step words, so each run of up to step + 1 words lies within a block; the step is `STEP` or follows the longest template.
A template's words are a set; a block matches if it holds at least the template's threshold of it.

* Words of templates are ordered by how often all texts hold them, rarest first. A matching block holds one of the first
  n - ceil(t n) + 1 words of that order (prefix filter). The counting is one pass over all texts.
* A block with fewer template words than ceil(t n) cannot match (length filter), nor one whose first shared prefix word
  stands so late in the order that too few words are left (position filter).
* What passes is checked exactly. For phrases (threshold 1) the places where the words stand next to each other are then
  looked up in the matching blocks; a place counts in the one block in whose first half it starts.

Everything is column expressions within a text's row, whose work grows in proportion to its words (blocks are cut out of
the text, pairs are numbers); templates are a fixed list of parameters. Only words of templates
leave the split. Null and empty texts have no words. Words beyond ASCII stay as they are.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEP = 64
CONTAINMENT = 0.8

# Phrases of the base and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# Notices in their public wording. A block that holds the given part of a notice's words carries the label;
# notices that differ from others in a word or two need all of them.
NOTICES = {
    "apache": ("licensed under the apache license version 2 0", 1.0),
    "gpl": ("licensed under the gnu general public license version 3", 1.0),
    "lgpl": ("gnu lesser general public license", 1.0),
    "agpl": ("gnu affero general public license", 1.0),
    "cc-by-nc": ("licensed under cc by nc 4 0", 1.0),
    "cc-by-sa": ("licensed under cc by sa 4 0", 1.0),
    "mit": ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction", CONTAINMENT),
    "bsd": ("redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met", CONTAINMENT),
    "mpl": ("this source code form is subject to the terms of the mozilla public license v 2 0", CONTAINMENT),
    "isc": ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
            "granted", CONTAINMENT),
}


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    threshold: float
    phrase: bool = False    # its words must also stand next to each other

    @property
    def words(self) -> list[str]:
        return self.text.split(" ")

    @property
    def need(self) -> int:
        return math.ceil(self.threshold * len(set(self.words)) - 1e-9)


def templates() -> list[Template]:
    return [*[Template(label, text, 1.0, True) for text, label in PHRASES.items()],
            *[Template(label, text, threshold) for label, (text, threshold) in NOTICES.items()]]


def words(text: Column) -> Column:
    """Lower-cased words. Beyond ASCII only the Kelvin sign lower-cases to an ASCII letter, so it is put aside; other
    letters stay no part of a template's word, whatever their case, and words stay words."""
    low = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u0138")))
    return F.array_remove(F.split(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def frequencies(df: DataFrame, vocabulary: list[str], text: str = "text") -> dict[str, int]:
    """How often all texts together hold each word of the templates: as many rows as the templates have words."""
    counted = (df.select(F.explode(F.filter(words(F.col(text)), lambda w: w.isin(vocabulary))).alias("w"))
               .groupBy("w").agg(F.count("*").alias("n")).collect())
    return {r["w"]: r["n"] for r in counted}


def scan(df: DataFrame, wanted: list[Template] | None = None, text: str = "text") -> DataFrame:
    """Adds n_words, blocks (matching blocks: first word, template's number, containment) and places (first word,
    template's number) of phrases."""
    wanted = templates() if wanted is None else wanted
    vocabulary = sorted({w for t in wanted for w in t.words})
    often = frequencies(df, vocabulary, text)
    order = {w: k for k, w in enumerate(sorted(vocabulary, key=lambda w: (often.get(w, 0), w)))}
    # Prefix entries: word, template, place in the template's own order, size and need.
    entries = []
    for number, t in enumerate(wanted):
        own = sorted(set(t.words), key=order.__getitem__)
        entries += [(own[k], number, len(own) - k) for k in range(len(own) - t.need + 1)]
    index = F.array(*[F.struct(F.lit(w).alias("w"), F.lit(n).alias("t"), F.lit(left).alias("left"))
                      for w, n, left in entries])
    prefixes = sorted({w for w, _, _ in entries})
    sets = F.array(*[F.array(*[F.lit(w) for w in sorted(set(t.words))]) for t in wanted])
    needs = F.array(*[F.lit(t.need) for t in wanted])
    phrases = F.array(*[F.array(*[F.lit(w) for w in t.words]) if t.phrase else F.array().cast("array<string>")
                        for t in wanted])

    step = max([STEP, *[len(t.words) - 1 for t in wanted]])
    n = len(wanted)
    block, template = lambda p: F.floor(p / n).cast("int"), lambda p: (p % n).cast("int")
    made = df.withColumn("_w", words(F.col(text)))
    # Prefix and position filter: pairs (block x templates + template) in which a prefix word has enough words behind it.
    begun = F.filter(F.transform("_w", lambda w, i: F.struct(i.alias("i"), w.alias("w"))),
                     lambda x: x["w"].isin(prefixes))
    pairs = F.flatten(F.transform(begun, lambda x: F.flatten(F.transform(
        F.filter(index, lambda e: (e["w"] == x["w"]) & (e["left"] >= F.get(needs, e["t"]))),
        lambda e: F.array(*[(F.floor(x["i"] / step) - back) * n + e["t"] for back in (0, 1)])))))
    made = made.withColumn("_p", F.array_distinct(F.filter(pairs, lambda p: p >= 0)))
    # Length filter and exact containment, from the template words of the block.
    inside = lambda p: F.slice("_w", block(p) * step + 1, F.lit(2 * step))
    held = F.transform("_p", lambda p: F.struct(
        block(p).alias("b"), template(p).alias("t"),
        F.array_distinct(F.filter(inside(p), lambda w: w.isin(vocabulary))).alias("w")))
    made = made.withColumn("_h", F.filter(held, lambda h: F.size(h["w"]) >= F.get(needs, h["t"])))
    scored = F.transform("_h", lambda h: F.struct(
        h["b"].alias("b"), h["t"].alias("t"), F.size(F.array_intersect(h["w"], F.get(sets, h["t"]))).alias("n")))
    made = made.withColumn("blocks", F.filter(scored, lambda m: m["n"] >= F.get(needs, m["t"])))
    # Places of phrases in the matching blocks, each in the one block in whose first half it starts.
    starts = F.flatten(F.transform(
        F.filter("blocks", lambda m: F.size(F.get(phrases, m["t"])) > 0),
        lambda m: F.transform(F.filter(
            F.sequence(m["b"] * step, (m["b"] + 1) * step - 1),
            lambda i: F.get(F.col("_w"), i).eqNullSafe(F.get(F.get(phrases, m["t"]), F.lit(0)))
            & F.aggregate(
                F.transform(F.get(phrases, m["t"]), lambda w, k: w.eqNullSafe(F.get(F.col("_w"), i + k))),
                F.lit(True), lambda a, b: a & b)),
            lambda i: F.struct(i.alias("i"), m["t"].alias("t")))))
    places = F.array_sort(starts)
    size_of = F.array(*[F.lit(len(set(t.words))) for t in wanted])
    return made.select(
        *df.columns, F.size("_w").cast("long").alias("n_words"),
        F.transform("blocks", lambda m: F.struct((m["b"] * step).alias("first_word"), m["t"].alias("template"),
                                                 (m["n"] / F.get(size_of, m["t"])).alias("containment"))).alias("blocks"),
        places.alias("places"))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score; one row per input row.

    A document carries a base label for each phrase that stands in it, and the label of each notice that a block
    contains to the threshold. The score is the largest containment of a notice, or 1 if a phrase stands in it."""
    wanted = templates()
    labels = F.array(*[F.lit(t.label) for t in wanted])
    made = scan(docs.select("doc_id", "text"), wanted)
    base = F.transform("places", lambda p: F.get(labels, p["t"]))
    notices = F.filter("blocks", lambda m: m["template"] >= len(PHRASES))
    more = F.transform(notices, lambda m: F.get(labels, m["template"]))
    joined = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    best = F.greatest(F.coalesce(F.array_max(F.transform(notices, lambda m: m["containment"])), F.lit(0.0)),
                      F.when(F.size("places") > 0, 1.0).otherwise(0.0))
    return made.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(F.transform("places", lambda p: p["i"])).cast("long").alias("first_word"),
        F.array_max(F.transform("places", lambda p: p["i"])).cast("long").alias("last_word"),
        joined(base).alias("base_labels"), joined(F.concat(base, more)).alias("labels"), best.alias("score"))
