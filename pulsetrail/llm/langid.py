"""Language identification with one bit-sliced Bloom filter for all languages.

A slot of the filter holds one bit per language. The slots of an n-gram, and-ed, are the mask of all languages that
hold it, possibly with others by accident. Per language the masks' bits are counted, the count that chance alone gives
is taken off, and the language with the largest share of a text's n-grams decides.

Texts are lower-cased, each run of other characters than letters counts as one blank, and n-grams are three characters
wide. A language holds an n-gram if it is at least `TYPICAL` times as frequent there as in the language where it is most
frequent, and among the language's `PER_LANGUAGE` most frequent ones.

The filters are fitted on a bounded sample: about `SAMPLE` training documents per language, chosen by a hash of their id.
Any number of languages works: masks have as many 63-bit words as needed. Ties go to the language with more training
documents, then to the first name. A text that is null or without any letter is `und` with score 0.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsetrail.llm.common import fold, scan, wrapped

SAMPLE = 3000
PER_LANGUAGE = 20_000
TYPICAL = 0.4
HASHES = 3
BITS_PER_ENTRY = 24
WORD_BITS = 63
UNKNOWN = "und"
MIN_COVER = 0.05     # `keep` drops texts of which the winning language holds less

_LETTER = None


def letters() -> np.ndarray:
    """Lower-case code point by code point; 32 for everything that is no letter."""
    global _LETTER
    if _LETTER is None:
        t = np.full(0x110000, 32, "<u4")
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                t[c] = ord(low) if len(low) == 1 else c
        _LETTER = t
    return _LETTER


def ngrams(text: str | None) -> np.ndarray:
    """Three-character windows of the folded text as 63-bit numbers; none if the text has no letter."""
    if not text:
        return np.empty(0, "u8")
    c = letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]
    c = np.concatenate(([32], c, [32])).astype("u8")
    keep = np.ones(len(c), bool)
    keep[1:] = (c[1:] != 32) | (c[:-1] != 32)
    c = c[keep]
    if len(c) < 3:
        return np.empty(0, "u8")
    return (c[:-2] << np.uint64(42)) | (c[1:-1] << np.uint64(21)) | c[2:]


def slots(grams: np.ndarray, n: int) -> list[np.ndarray]:
    """The n-grams' slots by double hashing; n is a power of two."""
    h = grams * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    step = (h >> np.uint64(33)) | np.uint64(1)
    return [((h + np.uint64(k) * step) & np.uint64(n - 1)).astype("i8") for k in range(HASHES)]


class Filters:
    """`tables`: one array of slots per word of the mask."""

    def __init__(self, languages: list[str], sets: list[np.ndarray]):
        self.languages = languages
        entries = max([1, *(len(s) for s in sets)])
        self.n = 1 << max(10, int(np.ceil(np.log2(entries * BITS_PER_ENTRY))))
        self.tables = [np.zeros(self.n, "i8") for _ in range(0, max(1, len(languages)), WORD_BITS)]
        for i, grams in enumerate(sets):
            for at in slots(grams, self.n):
                np.bitwise_or.at(self.tables[i // WORD_BITS], at, np.int64(1 << (i % WORD_BITS)))
        full = [np.mean((self.tables[i // WORD_BITS] >> (i % WORD_BITS)) & 1) for i in range(len(languages))]
        self.chance = np.array(full) ** HASHES     # share of foreign n-grams that a language holds by accident
        if len(languages) <= 8:
            self.tables = [t.astype("u1") for t in self.tables]

    def cover(self, grams: np.ndarray) -> np.ndarray:
        """Per language the share of the n-grams that it holds, without accidents."""
        at = slots(grams, self.n)
        counts: list[int] = []
        for w, table in enumerate(self.tables):
            mask = table[at[0]]
            for a in at[1:]:
                mask &= table[a]
            here = min(WORD_BITS, len(self.languages) - w * WORD_BITS)
            if table.dtype == np.uint8:
                seen = np.bincount(mask, minlength=256)
                counts += [int(seen[(np.arange(256) >> i) & 1 == 1].sum()) for i in range(here)]
            else:
                counts += [int(((mask >> i) & 1).sum()) for i in range(here)]
        share = np.array(counts, float) / len(grams)
        return np.clip((share - self.chance) / (1 - self.chance), 0, 1)

    def judge(self, text: str | None) -> tuple[str, float, float]:
        """Language, the winner's part of all languages' cover, and its cover."""
        grams = ngrams(text)
        if not len(grams) or not self.languages:
            return UNKNOWN, 0.0, 0.0
        cover = self.cover(grams)
        best = int(np.argmax(cover))
        return self.languages[best], float(cover[best] / cover.sum()) if cover[best] > 0 else 0.0, float(cover[best])


def training(docs: DataFrame, part: int = 0, parts: int = 5) -> DataFrame:
    return docs.where(F.col("lang").isNotNull() & (fold("doc_id", parts) != part)).select("doc_id", "lang", "text")


def fit(train: DataFrame, sample: int = SAMPLE, per_language: int = PER_LANGUAGE) -> Filters:
    """Filters from (doc_id, lang, text). Only counts per language and the chosen n-grams come to the driver."""
    sizes = {r["lang"]: r["n"] for r in train.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes, key=lambda x: (-sizes[x], x))
    if not languages:
        return Filters([], [])
    share = F.create_map(*[x for k in languages for x in (F.lit(k), F.lit(min(1.0, sample / sizes[k])))])
    drawn = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1_000_000)) < share[F.col("lang")] * 1_000_000

    def start():
        def one(text):
            grams, n = np.unique(ngrams(text), return_counts=True)
            return (grams.astype("i8").tolist(), n.tolist())

        return lambda texts: [one(t) for t in texts]

    counted = (scan(train.where(drawn).select("lang", "text"), start, "grams array<long>, n array<long>")
               .select("lang", F.explode(F.arrays_zip("grams", "n")).alias("x"))
               .groupBy("lang", F.col("x.grams").alias("gram")).agg(F.sum("x.n").alias("n")))
    total = counted.groupBy("lang").agg(F.sum("n").alias("total"))
    rate = counted.join(total, "lang").select("lang", "gram", (F.col("n") / F.col("total")).alias("rate"))
    top = rate.groupBy("gram").agg(F.max("rate").alias("top"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("rate"), "gram"))
    chosen = (rate.join(top, "gram").where(F.col("rate") >= TYPICAL * F.col("top")).withColumn("rank", rank)
              .where(F.col("rank") <= per_language).groupBy("lang").agg(F.collect_list("gram").alias("grams")))
    sets = {r["lang"]: np.array(r["grams"], "i8").astype("u8") for r in chosen.collect()}
    return Filters(languages, [sets.get(k, np.empty(0, "u8")) for k in languages])


def judge(df: DataFrame, filters: Filters, text: str = "text") -> DataFrame:
    """Adds lang_pred, score (0 to 1) and cover (the share of the text's n-grams that the language holds)."""
    sent = df.sparkSession.sparkContext.broadcast(vars(filters))    # plain data: workers need no package

    def start():
        f = Filters.__new__(Filters)
        vars(f).update(sent.value)
        return lambda texts: [f.judge(t) for t in texts]

    return scan(df, start, "lang_pred string, score double, cover double", text)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, cover; one row per input row."""
    filters = fit(training(docs))
    return judge(docs.select("doc_id", "text"), filters).select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score", "cover")


def keep(docs: DataFrame, min_cover: float = MIN_COVER) -> DataFrame:
    """The documents with a recognised language. Texts without letters, and texts of which even the likeliest language
    holds less than `min_cover` of the n-grams, go."""
    filters = fit(training(docs))
    judged = judge(wrapped(docs, "text"), filters)
    return judged.where((F.col("lang_pred") != UNKNOWN) & (F.col("cover") >= min_cover)).select("row.*")
