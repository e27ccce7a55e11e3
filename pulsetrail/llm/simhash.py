"""SimHash near-duplicates with the code words of a covering code as anchors.

A text's fingerprint is the bitwise majority of its shingles' 64-bit hashes. Two texts are linked if their fingerprints
differ in at most `distance` bits; groups are the connected components.

The anchors are the code words of a product code on the 64 bits: two perfect Golay codes of 23 bits (covering radius 3),
one perfect Hamming code of 15 bits (radius 1) and three plain bits. Each 64-bit number has exactly one anchor in its
reach. Two fingerprints that differ in at most d bits have a number m between them that differs from each in at most
r = ceil(d / 2) bits; m's anchor is within the covering radius of m, hence within radius + r of both. So each distinct
fingerprint is sent to the anchors of all numbers within r bits of it (about 19 for d = 2, all of them within radius
plus threshold), and no pair is missed.

Most anchors get one fingerprint and are dropped. Per remaining anchor the fingerprints are compared by the numbers
around them that belong to the anchor: fingerprints that share such a number are at most 2 r bits apart, and each is
linked with the least of them. For d = 2 this is the exact comparison (2 r = d). At most 1 + 64 fingerprints share a
number, so no group is large, however many fingerprints an anchor gets; all comparisons are aggregations.

Only distinct fingerprints are compared, so copies cost nothing. Components are found by large-star/small-star rounds on
tables in the shared folder. Null ids are ignored as a group's least id; texts without words have fingerprint zero.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsetrail.llm.common import scan, spread_join, wrapped
from pulsetrail.session import run_folder

SHINGLE = 3
SEED = 42
DISTANCE = 2     # an even number; r is half of it


def fingerprint(text: str | None, size: int = SHINGLE, seed: int = SEED) -> int:
    """Signed 64-bit number."""
    from xxhash import xxh64_intdigest

    w = (text or "").encode().lower().split()    # bytes: A-Z only, and ASCII blanks
    if not w:
        return 0
    shingles = list(map(b" ".join, zip(*[w[k:] for k in range(size)]))) if len(w) >= size else [b" ".join(w)]
    h = np.fromiter(map(xxh64_intdigest, shingles, repeat(seed)), "<u8", len(shingles))
    ones = np.zeros(64, "i8")
    for at in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[at:at + (1 << 16)].view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype="i8")
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<i8")[0])


def golay() -> tuple[np.ndarray, np.ndarray]:
    """Per 23-bit number's syndrome the error pattern of weight up to 3, and the syndrome of each 23-bit number's bits.

    The code is generated by x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1."""
    poly = 0b110001110101

    def syndrome(v: int) -> int:
        for k in range(22, 10, -1):
            if v >> k & 1:
                v ^= poly << (k - 11)
        return v

    of_bit = np.array([syndrome(1 << k) for k in range(23)], "i8")
    errors = np.zeros(2048, "i8")
    for a in range(23):
        for b in range(a, 23):
            for c in range(b, 23):
                bits = {a, b, c}
                s = 0
                for k in bits:
                    s ^= int(of_bit[k])
                errors[s] = sum(1 << k for k in bits)
    return errors, of_bit


class Anchors:
    def __init__(self, distance: int = DISTANCE):
        if distance % 2:
            raise ValueError("distance must be even")
        self.errors, of_bit = golay()
        # Syndromes of 12-bit halves of a 23-bit number.
        self.low = self._syndromes(of_bit[:12])
        self.high = self._syndromes(of_bit[12:])
        self.hamming = self._syndromes(np.arange(1, 16))
        flips = [0]
        for _ in range(distance // 2):
            flips = sorted({f ^ (1 << k) for f in flips for k in range(64)} | set(flips))
        self.flips = np.array(flips, "u8")

    @staticmethod
    def _syndromes(of_bit: np.ndarray) -> np.ndarray:
        t = np.zeros(1 << len(of_bit), "i8")
        for k, s in enumerate(of_bit):
            half = 1 << k
            t[half:2 * half] = t[:half] ^ int(s)
        return t

    def of(self, v: np.ndarray) -> np.ndarray:
        """The one anchor within the covering radius of each number."""
        out = v.copy()
        for shift in (0, 23):
            b = ((v >> np.uint64(shift)) & np.uint64((1 << 23) - 1)).astype("i8")
            out ^= self.errors[self.low[b & 4095] ^ self.high[b >> 12]].astype("u8") << np.uint64(shift)
        s = self.hamming[((v >> np.uint64(46)) & np.uint64((1 << 15) - 1)).astype("i8")]
        return out ^ (np.where(s > 0, np.left_shift(1, np.maximum(s - 1, 0)), 0).astype("u8") << np.uint64(46))

    def near(self, fp: int) -> tuple[np.ndarray, np.ndarray]:
        """All numbers within r bits of a fingerprint, and their anchors."""
        around = np.uint64(fp & (1 << 64) - 1) ^ self.flips
        return around, self.of(around)


def signed(v: np.ndarray) -> list[int]:
    return v.astype("u8").view("i8").tolist()


def fingerprints(df: DataFrame, text: str = "text", size: int = SHINGLE) -> DataFrame:
    """Adds `fp`, a long."""

    def start():
        return lambda texts: [(fingerprint(t, size),) for t in texts]

    return scan(df, start, "fp long", text)


def links(distinct: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(u, v), v < u, for the distinct fingerprints of column fp: each is linked with the least that shares a number."""

    def start():
        anchors = Anchors(distance)
        return lambda fps: [(sorted(set(signed(anchors.near(v)[1]))),) for v in fps]

    at = scan(distinct.select("fp"), start, "anchors array<long>", "fp").select("fp", F.explode("anchors").alias("anchor"))
    shared = at.groupBy("anchor").agg(F.min("fp").alias("least"), F.max("fp").alias("most")) \
        .where(F.col("least") < F.col("most")).select("anchor")
    crowded = spread_join(at, shared, "anchor", "left_semi").groupBy("fp").agg(F.collect_set("anchor").alias("anchors"))

    def compare():
        anchors = Anchors(distance)

        def one(row: dict) -> tuple[list[int]]:
            around, of = anchors.near(row["fp"])
            return (signed(around[np.isin(of, np.array(row["anchors"], "i8").view("u8"))]),)

        return lambda rows: [one(r) for r in rows]

    # An anchor's share of the comparison: the numbers around a fingerprint that belong to it.
    numbers = scan(crowded.select("fp", F.struct("fp", "anchors").alias("x")), compare, "numbers array<long>", "x") \
        .select("fp", F.explode("numbers").alias("number"))
    least = numbers.groupBy("number").agg(F.min("fp").alias("v"), F.max("fp").alias("most"))
    least = least.where(F.col("v") < F.col("most")).select("number", "v")
    return spread_join(numbers, least, "number").where(F.col("fp") > F.col("v")).select(F.col("fp").alias("u"), "v").distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) from (u, v): root is the least node of the component. Nodes without edges are not listed.

    A round is a large star (greater neighbours of a node are linked with its least neighbour) and a small star (the
    others are); stars only depend on a node's least neighbour, which is aggregated, so a node of any degree is fine."""
    spark = edges.sparkSession
    base = run_folder(spark, "components")

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{base}/{name}")
        return spark.read.parquet(f"{base}/{name}")

    e = kept(edges.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "0")
    before = None
    for k in range(1, rounds + 1):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = (spread_join(both, least, "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = spread_join(large, low, "u")
        e = kept(small.select("u", F.col("m").alias("v")).union(
            small.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct(), str(k))
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return e.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
        before = now
    raise RuntimeError("the components did not settle")


def groups(df: DataFrame, text: str = "text", distance: int = DISTANCE, size: int = SHINGLE) -> DataFrame:
    """Adds fp, root (the least fingerprint of the component) and component_id (its smallest doc_id)."""
    spark, base = df.sparkSession, run_folder(df.sparkSession, "simhash")
    fingerprints(df.select("doc_id", text), text, size).select("doc_id", "fp").write.parquet(f"{base}/prints")
    prints = spark.read.parquet(f"{base}/prints")
    prints.groupBy("fp").agg(F.min("doc_id").alias("first")).write.parquet(f"{base}/distinct")
    distinct = spark.read.parquet(f"{base}/distinct")
    roots = components(links(distinct, distance))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    spread_join(rooted, ids, "root").select("fp", "root", "component_id").write.parquet(f"{base}/groups")
    return prints.join(spark.read.parquet(f"{base}/groups"), "fp")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint, component_id; one row per input row."""
    return groups(docs.select("doc_id", "text")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_each(docs: DataFrame) -> DataFrame:
    """One document of each component: that with the smallest id; rows of the same id and component count as one.
    Of documents without an id one of each fully unidentified component stays."""
    named = groups(docs.select("doc_id", "text"))
    keep = (named.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root")
            .agg(F.min(F.struct("fp", "doc_id")).alias("x")).select("root", "x.fp", F.col("x.doc_id").alias("keep_id")))
    spark, folder = docs.sparkSession, run_folder(docs.sparkSession, "simhash-kept")
    keep.write.parquet(folder)
    marked = fingerprints(wrapped(docs, "text")).drop("text")
    stays = marked.join(spark.read.parquet(folder), "fp").where(F.col("row.doc_id").eqNullSafe(F.col("keep_id")))
    return stays.dropDuplicates(["root"]).select("row.*")
