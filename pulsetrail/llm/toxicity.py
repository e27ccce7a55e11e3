"""Toxicity by a weighted lexicon.

Texts are folded character by character: lower case, styled letters and look-alikes of other scripts and digit or sign
substitutes to the Latin letter they stand for (l, i, 1, ! and | are one letter). One Aho-Corasick automaton finds the
lexicon's entries, whole words or beginnings of words. The weight of the entries found, without those inside an
exception phrase, is normalised by the text's length and turned into a score by a logistic curve.

Lexicon, exceptions and curve are learned from a bounded sample of labelled rows: about `SAMPLE`, chosen by a hash of
their id. An entry's weight is the smoothed log ratio of the shares of toxic and clean documents that hold it; entries
whose log-likelihood ratio could be chance among so many candidates are left out, as are those that only occur where
enough others explain the label. A word pair around an entry that is frequent in clean documents is an exception phrase.

Null and empty texts get the score of a text without findings, as does every text if there are no labels of both kinds.
"""

from __future__ import annotations

import unicodedata

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsetrail.llm.common import fold, scan
from pulsetrail.session import run_folder

SAMPLE = 30_000
ENTRIES = 5_000
MIN_DOCS = 2           # toxic documents that hold an entry at least
MIN_WEIGHT = 2.5       # smoothed log ratio of an entry
PREFIXES = range(4, 9)
ENOUGH = 3             # accepted entries that explain a toxic document
THRESHOLD = 0.7

# Characters that look like or stand for a Latin letter.
LOOKALIKES = {
    "a": "4@αаɑ", "b": "8вЬ", "c": "(сϲ¢", "e": "3еε€", "g": "9ɡ", "h": "һн", "i": "1!|lіιӏ", "j": "ј", "k": "кκ",
    "m": "м", "n": "пη", "o": "0оοσ", "p": "рρ", "r": "г", "s": "5$ѕ", "t": "7+тτ", "u": "υ", "v": "ѵν", "w": "ԝω", "x": "хχ×",
    "y": "уγү", "z": "2",
}

_FOLDED = None


def folded() -> np.ndarray:
    """Code point by code point; a blank for what is no letter or digit."""
    global _FOLDED
    if _FOLDED is None:
        t = np.full(0x110000, 32, "<u4")
        for c in range(0x110000):
            ch = chr(c)
            if not ch.isalnum():
                continue
            # Letters with accents are letters of their own in many languages, up to the end of Latin Extended-A.
            base = unicodedata.normalize("NFKD", ch)[0] if 0x180 <= c < 0x3100 or c > 0xF000 else ch
            low = base.lower()
            t[c] = ord(low) if len(low) == 1 else ord(base)
        for letter, others in LOOKALIKES.items():
            for o in others:
                for form in {o, o.upper()} if o != "l" else {"l", "L"}:
                    if len(form) == 1:
                        t[ord(form)] = ord(letter)
                t[t == ord(o)] = ord(letter) if o.isalnum() else 32
        for letter, others in LOOKALIKES.items():
            for o in others:
                t[ord(o)] = ord(letter)
        _FOLDED = t
    return _FOLDED


def words_of(text: str | None) -> str:
    """The folded words, each with a blank before and behind. Signs that stand for letters only do so inside words."""
    if not text:
        return " "
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    t = folded()[points]
    signs = _signs()[points]
    if signs.any():   # a sign at a word's end is punctuation
        at = np.flatnonzero(signs)
        plain = (t != 32) & ~signs
        before = np.concatenate(([False], plain[:-1]))
        after = np.concatenate((plain[1:], [False]))
        t = t.copy()
        t[at[~(before[at] & after[at])]] = 32
    return " " + " ".join(t.tobytes().decode("utf-32-le").split()) + " "


_SIGNS = None


def _signs() -> np.ndarray:
    global _SIGNS
    if _SIGNS is None:
        t = np.zeros(0x110000, bool)
        for others in LOOKALIKES.values():
            for o in others:
                t[ord(o)] = not o.isalnum()
        _SIGNS = t
    return _SIGNS


def features(text: str | None) -> set[str]:
    """Entries that a text holds: ` word ` for whole words, ` begin` for beginnings of longer words."""
    out = set()
    for w in set(words_of(text).split()):
        if 2 < len(w) <= 40:
            out.add(f" {w} ")
            out.update(f" {w[:n]}" for n in PREFIXES if n < len(w))
    return out


def automaton(entries: dict[str, float], exceptions: list[str]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for e, weight in entries.items():
        found.add_word(e, (len(e), weight))
    for e in exceptions:
        found.add_word(e, (len(e), None))
    if len(found):
        found.make_automaton()
    return found


def weigh(text: str | None, found) -> tuple[float, int, int, float]:
    """Total weight, number of words hit, number of words and the heaviest entry. Of the entries in one word the heaviest counts."""
    line = words_of(text)
    n = line.count(" ") - 1
    if not len(found):
        return 0.0, 0, n, 0.0
    hits: dict[int, float] = {}
    free: list[tuple[int, int]] = []
    for last, (length, weight) in found.iter(line):
        first = last + 1 - length
        if weight is None:
            free.append((first, last))
        else:
            hits[first] = max(weight, hits.get(first, 0.0))
    if free:
        # one sweep over both in order of position: a hit goes if a phrase that starts before it reaches beyond it
        free.sort(reverse=True)
        reach, gone = -1, set()
        for k in sorted(hits):
            while free and free[-1][0] <= k:
                reach = max(reach, free.pop()[1])
            if k < reach:
                gone.add(k)
        hits = {k: weight for k, weight in hits.items() if k not in gone}
    return sum(hits.values()), len(hits), n, max(hits.values(), default=0.0)


def signals(total: float, hits: int, n: int, strongest: float) -> tuple[float, float, float]:
    """Inputs of the curve: weight by length, weight as such up to a bound, and the heaviest entry."""
    return 10 * total / (n + 20), min(total, 30.0) / 10, strongest / 10


def explaining(entries: list[str], rows: list[tuple[int, list[int]]], share: float, bar: float) -> list[int]:
    """The entries that explain toxic documents beyond those before them.

    Texts come in families of copies, where each rare word of a toxic text looks toxic. An entry only counts in toxic
    documents that fewer than `ENOUGH` accepted entries explain, and must pass the bar with those. An entry that is nearly
    always within the words of accepted beginnings, or the other way round, says nothing new."""
    where: dict[int, list[int]] = {}
    for d, (_, own) in enumerate(rows):
        for k in own:
            where.setdefault(k, []).append(d)
    cover, taken = [0] * len(rows), []
    for k in range(len(entries)):
        own = where.get(k, [])
        a = sum(rows[d][0] == 1 and cover[d] < ENOUGH for d in own)
        b = sum(rows[d][0] == 0 for d in own)
        if not a or a * np.log(a / (a + b) / share) + (b * np.log(b / (a + b) / (1 - share)) if b else 0.0) < bar:
            continue
        near = {d for j in taken if entries[j].startswith(entries[k].rstrip()) or entries[k].startswith(entries[j].rstrip())
                for d in where[j]}
        if len(set(own) - near) * 10 < len(own):
            continue
        taken.append(k)
        for d in own:
            cover[d] += 1
    return taken


class Model:
    def __init__(self, entries: dict[str, float], exceptions: list[str], curve: list[float]):
        self.entries, self.exceptions, self.curve = entries, exceptions, curve

    def score(self, total: float, hits: int, n: int, strongest: float) -> float:
        z = self.curve[0] + sum(a * b for a, b in zip(self.curve[1:], signals(total, hits, n, strongest)))
        return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> list[float]:
    """Newton steps; the intercept comes first."""
    a = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(a.shape[1])
    hold = np.diag([0.0] + [ridge * len(x) / 100] * x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a.T * (p * (1 - p) + 1e-9)) @ a + hold, a.T @ (y - p) - hold @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w.tolist()


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(toxic, text) of about `sample` labelled documents, written once. The ids are drawn before any text is read, and
    go to the texts: a broadcast of bounded size, while no text is shuffled."""
    known = labels.select("doc_id", "toxic").where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).distinct()
    share = min(1.0, sample / max(1, known.count()))
    drawn = known.where(F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1_000_000)) < share * 1_000_000)
    folder = run_folder(docs.sparkSession, "toxicity")
    docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").select("toxic", "text").write.parquet(folder)
    return docs.sparkSession.read.parquet(folder)


def fit(drawn: DataFrame, entries: int = ENTRIES) -> Model:
    """A model from a bounded sample of (toxic, text). At most `entries` entries and pairs, and the rows' labels with the
    numbers of their entries, come to the driver."""
    counts = {r["toxic"]: r["n"] for r in drawn.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return Model({}, [], [-3.0, 0.0, 0.0, 0.0])

    def start():
        return lambda texts: [(sorted(features(t)),) for t in texts]

    toxic, clean = F.count(F.when(F.col("toxic") == 1, 1)), F.count(F.when(F.col("toxic") == 0, 1))
    weight = F.log((F.col("a") + 0.5) / (counts[1] + 1)) - F.log((F.col("b") + 0.5) / (counts[0] + 1))
    both = F.col("a") + F.col("b")
    surprise = (F.col("a") * F.log(F.col("a") / both / (counts[1] / sum(counts.values())))
                + F.when(F.col("b") > 0, F.col("b") * F.log(F.col("b") / both / (counts[0] / sum(counts.values()))))
                .otherwise(0.0))
    held = scan(drawn.select("toxic", "text"), start, "entries array<string>").select(
        "toxic", F.explode("entries").alias("entry"))
    counted = (held.groupBy("entry").agg(toxic.alias("a"), clean.alias("b")).where(F.col("a") >= MIN_DOCS)
               .withColumn("weight", weight).withColumn("surprise", surprise).persist())
    # About one entry passes by chance: the bar is the log of the number of candidates.
    bar = float(np.log(max(2, counted.count())))
    seen = (counted.where((F.col("weight") >= MIN_WEIGHT) & (F.col("surprise") >= bar))
            .orderBy(F.desc("surprise"), "entry").limit(entries).collect())
    counted.unpersist()
    candidates = sorted(((r["entry"], r["weight"], r["surprise"]) for r in seen), key=lambda x: (-x[2], -len(x[0]), x[0]))
    number = {e: k for k, (e, _, _) in enumerate(candidates)}

    def holding():
        def one(text):
            return (sorted(k for e in features(text) if (k := number.get(e)) is not None),)

        return lambda texts: [one(t) for t in texts]

    held = scan(drawn.select("toxic", "text"), holding, "entries array<int>").where(F.size("entries") > 0)
    rows = [(r["toxic"], r["entries"]) for r in held.select("toxic", "entries").collect()]
    lexicon = {candidates[k][0]: candidates[k][1] for k in explaining(
        [e for e, _, _ in candidates], rows, counts[1] / sum(counts.values()), bar)}

    def pairs():
        found = automaton(lexicon, [])

        def one(text):
            line, out = words_of(text), set()
            for last, (length, _) in found.iter(line) if len(found) else ():
                first = last + 1 - length
                before, after = line.rfind(" ", 0, first), line.find(" ", first + 1)
                behind = line.find(" ", after + 1)
                if before >= 0:
                    out.add(line[before:after + 1])
                if behind > 0:
                    out.add(line[first:behind + 1])
            return (sorted(out),)

        return lambda texts: [one(t) for t in texts]

    exceptions = [r["pair"] for r in scan(drawn.select("toxic", "text"), pairs, "pairs array<string>")
                  .select("toxic", F.explode("pairs").alias("pair")).groupBy("pair")
                  .agg(toxic.alias("a"), clean.alias("b")).where((F.col("b") > MIN_DOCS) & (F.col("a") * 4 < F.col("b")))
                  .orderBy(F.desc("b"), "pair").limit(entries).collect()]

    def weights():
        found = automaton(lexicon, exceptions)
        return lambda texts: [weigh(t, found) for t in texts]

    rows = scan(drawn.select("toxic", "text"), weights, FOUND).select("toxic", "weight", "hits", "words", "heaviest").collect()
    x = np.array([signals(r["weight"], r["hits"], r["words"], r["heaviest"]) for r in rows])
    return Model(lexicon, exceptions, logistic(x, np.array([float(r["toxic"]) for r in rows])))


FOUND = "weight double, hits int, words int, heaviest double"


def score(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds weight, hits, words, heaviest and toxicity (0 to 1)."""
    sent = df.sparkSession.sparkContext.broadcast((model.entries, model.exceptions, model.curve))

    def start():
        m = Model(*sent.value)
        found = automaton(m.entries, m.exceptions)
        return lambda texts: [(*(w := weigh(t, found)), m.score(*w)) for t in texts]

    return scan(df, start, FOUND + ", toxicity double", text)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, weight, hits; one row per input row."""
    model = fit(labelled_sample(docs, labels.where(fold("doc_id", 3) != 1)))
    out = score(docs.select("doc_id", "text"), model)
    return out.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), F.col("toxicity").alias("score"),
                      (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted"), "weight", "hits")
