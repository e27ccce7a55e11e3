"""Language-model scores by Katz backoff over words and word pairs.

    P(w | v) = d(c(v, w)) c(v, w) / c(v)   if the training texts have v w,   else   alpha(v) P(w)
    P(w)     = d(c(w)) c(w) / N            if the training texts have w,     else   what is left, for one unknown word

d is the Good-Turing discount of each order for counts up to `CUTOFF`, from the counts of counts of all training texts.
Where these give no discount between 0 and 1, it takes half a count; greater counts lose `TAIL` of a count, so that each
context keeps mass. alpha(v) makes the probabilities after v sum to one exactly: the discounts taken after v over c(v),
over one less the P(w) of the words seen after v. Each text begins in a start context and ends in an end token.

Documents are dealt to blocks of about `BLOCK` tokens, kept as numbers into the block's own word list. A block asks for
its distinct n-grams only, each as a 63-bit hash, sorted and packed; n-grams are dealt by hash, so that no word or pair
is hot: it is one entry per block. Rounds:

1. `ngrams`: per bucket of hashes the counts are summed and answered to the asking blocks; the summed counts are the
   model's tables, `kind=table`, by order and bucket.
2. `blocks`: a block scores all tokens but for the alphas; it asks for the alphas of contexts of unseen pairs, and sends
   each distinct pair's part in its context's alpha (one of the blocks that hold a pair is told to).
3. `contexts`: per bucket of contexts the alphas are summed up and applied to the askers' documents.

All rounds are written to the shared folder. Sizes per task are bounded by the block and by the number of buckets, which
grows with the tokens. Null texts are empty: one end token. Words are told apart by their hash; two of n words collide
with a probability of n^2 / 2^64.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsetrail.llm.common import SLICE, arrow_schema, fold
from pulsetrail.session import run_folder

CUTOFF = 5
TAIL = 0.01
BLOCK = 3_000_000
PER_BUCKET = 500_000
MIN_BITS = 8
END, START = b"\n", b"\n\n"     # no words: words have no blanks

BLOCKS = "block long, ids array<long>, held array<boolean>, lengths binary, words binary, tokens binary"
ASKED = "ord int, bucket int, block long, keys binary, counts binary"
COUNTS = "kind string, block long, ord int, bucket int, keys binary, counts binary, owner binary, hist array<long>"
SCORED = ("kind string, block long, bucket int, keys binary, mass binary, below binary, counts binary, "
          "asked binary, askers binary, documents binary, doc_id array<long>, held_out array<boolean>, "
          "n_tokens array<long>, n_known array<long>, base_score array<double>, score array<double>")
ALPHAS = "block long, place array<int>, alpha array<double>"


def planes(a: np.ndarray, kind: str = "<u4") -> bytes:
    """Bytes of the numbers, most alike ones together: compresses well."""
    a = np.ascontiguousarray(a, kind)
    return a.view("u1").reshape(len(a), a.itemsize).T.tobytes()


def unplanes(b: bytes, kind: str = "<u4") -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(b, "u1").reshape(size, -1).T).view(kind).ravel()


def pack(keys: np.ndarray) -> bytes:
    return planes(np.diff(keys, prepend=np.uint64(0)), "<u8")


def unpack(b: bytes) -> np.ndarray:
    return np.cumsum(unplanes(b, "<u8"), dtype="u8")


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def hashes(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh64_intdigest

    return np.fromiter(map(xxh64_intdigest, words), "u8", len(words)) >> np.uint64(1)


def pair(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(mix(v) + w * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(1)


def buckets(keys: np.ndarray, bits: int) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of sorted 63-bit keys."""
    b = (keys >> np.uint64(63 - bits)).astype("i8")
    first = np.flatnonzero(np.diff(b, prepend=-1))
    return list(zip(b[first].tolist(), first.tolist(), [*first[1:].tolist(), len(keys)]))


class Words(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def cut_blocks(docs: DataFrame, size: int = BLOCK) -> DataFrame:
    """Blocks of whole documents from (doc_id, held, text)."""

    def run(batches):
        from pyspark import TaskContext

        arrow = arrow_schema(BLOCKS)
        base, made = TaskContext.get().partitionId() << 24, 0
        words, ids, held, parts = Words({END: 0}), [], [], []

        def block():
            tokens = np.concatenate(parts)
            order = np.argsort(-np.bincount(tokens, minlength=len(words)), kind="stable")
            place = np.empty(len(order), "u4")
            place[order] = np.arange(len(order), dtype="u4")
            names = list(words)
            named = [names[i] for i in order]
            row = {"block": base + made, "ids": list(ids), "held": list(held),
                   "lengths": planes(np.array([len(p) for p in parts])), "words": b" ".join(named),
                   "tokens": planes(place[tokens])}
            return pa.RecordBatch.from_pylist([row], arrow)

        n = 0
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                for i, h, t in zip(*(part.column(c).to_pylist() for c in ("doc_id", "held", "text"))):
                    w = (t or "").encode().lower().split()
                    w.append(END)
                    parts.append(np.fromiter(map(words.__getitem__, w), "u4", len(w)))
                    ids.append(i)
                    held.append(h)
                    n += len(w)
                    if n >= size:
                        yield block()
                        made, n = made + 1, 0
                        words, ids, held, parts = Words({END: 0}), [], [], []
        if parts:
            yield block()

    return docs.select("doc_id", "held", "text").mapInArrow(run, BLOCKS)


class Block:
    """A block's tokens as hashes. Pairs are sorted; `spot` is each token's place among the distinct pairs."""

    def __init__(self, row: dict):
        self.block, self.ids = row["block"], row["ids"]
        self.held = np.array(row["held"], bool)
        self.lengths = unplanes(row["lengths"]).astype("i8")
        self.tokens = unplanes(row["tokens"])
        # The end token is a line break and holds no blank, so that the list can be cut at blanks.
        self.names = hashes(row["words"].split(b" "))
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)[:-1])).astype("i8")
        before = np.empty(len(self.tokens), "u8")
        current = self.names[self.tokens]
        before[1:] = current[:-1]
        before[self.starts] = hashes([START])[0]
        self.before, self.current = before, current
        self.train = np.repeat(~self.held, self.lengths)

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted word hashes and their training counts; the word list's order by hash."""
        self.by_hash = np.argsort(self.names)
        counts = np.bincount(self.tokens[self.train], minlength=len(self.names))
        return self.names[self.by_hash], counts[self.by_hash]

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        keys = pair(self.before, self.current)
        order = np.argsort(keys)
        ordered = keys[order]
        first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        self.sample = order[first]            # a token of each distinct pair
        self.spot = np.empty(len(keys), "i8")
        self.spot[order] = np.repeat(np.arange(len(first)), np.diff(first, append=len(keys)))
        return ordered[first], np.add.reduceat(self.train[order].astype("i8"), first)


def ask(bits: int):
    """Blocks to n-gram requests."""
    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                b = Block(batch.slice(k, 1).to_pylist()[0])
                for ord_, (keys, counts) in ((1, b.words()), (2, b.pairs())):
                    rows = [{"ord": ord_, "bucket": x, "block": b.block, "keys": pack(keys[i:j]), "counts": planes(counts[i:j])}
                            for x, i, j in buckets(keys, bits)]
                    yield pa.RecordBatch.from_pylist(rows, arrow_schema(ASKED))
    return run


def count_bucket(table: pa.Table) -> pa.Table:
    """Sums of one bucket, and the answers to the blocks that ask."""
    rows = table.to_pylist()
    keys = [unpack(r["keys"]) for r in rows]
    sizes = [len(k) for k in keys]
    everything = np.concatenate(keys)
    counts = np.concatenate([unplanes(r["counts"]) for r in rows]).astype("i8")
    order = np.argsort(everything, kind="stable")
    ordered = everything[order]
    first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    total = np.add.reduceat(counts[order], first)
    answer, owner = np.empty(len(order), "i8"), np.zeros(len(order), bool)
    answer[order] = np.repeat(total, np.diff(first, append=len(order)))
    owner[order[first]] = total > 0
    seen = total > 0
    hist = [int((total == r).sum()) for r in range(1, CUTOFF + 2)] + [int(total.sum()), int(seen.sum())]
    base = {"ord": rows[0]["ord"], "bucket": rows[0]["bucket"]}
    out = [base | {"kind": "table", "keys": pack(ordered[first][seen]), "counts": planes(total[seen]), "hist": hist}]
    at = 0
    for r, n in zip(rows, sizes):
        out.append(base | {"kind": "answer", "block": r["block"], "counts": planes(answer[at:at + n]),
                           "owner": np.packbits(owner[at:at + n]).tobytes()})
        at += n
    return pa.Table.from_pylist(out, arrow_schema(COUNTS))


def discounts(hist: list[int]) -> np.ndarray:
    """d by count up to CUTOFF; d[0] is not used."""
    n = [0, *hist[:CUTOFF + 1]]
    if all(n[1:]):
        beyond = (CUTOFF + 1) * n[CUTOFF + 1] / n[1]
        if beyond < 1:
            d = [((r + 1) * n[r + 1] / n[r] / r - beyond) / (1 - beyond) for r in range(1, CUTOFF + 1)]
            if all(0 < x < 1 for x in d):
                return np.array([1.0, *d])
    return np.array([1.0, *[(r - 0.5) / r for r in range(1, CUTOFF + 1)]])


def kept(counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Counts after the discount."""
    c = counts.astype("f8")
    return np.where(counts <= CUTOFF, c * d[np.minimum(counts, CUTOFF)], c - TAIL)


class Unigrams:
    def __init__(self, n: int, types: int, d: np.ndarray, left: float):
        self.n, self.types, self.d, self.left = n, types, d, left

    def __call__(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, kept(counts, self.d) / max(1, self.n), self.left)


def left_over(hist: list[int], d: np.ndarray) -> float:
    """The unknown word's probability: what the discounts of all words take."""
    n, types = hist[-2], hist[-1]
    if not n:
        return 1.0
    low = sum(hist[r - 1] * r * (1 - d[r]) for r in range(1, CUTOFF + 1))
    return float((low + TAIL * (types - sum(hist[:CUTOFF]))) / n)


def score_block(state: dict, bits: int, answers: list[dict], p1: Unigrams, d2: np.ndarray) -> list[dict]:
    b = Block(state)
    keys1, _ = b.words()
    keys2, _ = b.pairs()
    by = sorted(answers, key=lambda r: (r["ord"], r["bucket"]))
    of = {o: [r for r in by if r["ord"] == o] for o in (1, 2)}
    c1 = np.empty(len(keys1), "i8")
    c1[b.by_hash] = np.concatenate([unplanes(r["counts"]) for r in of[1]])       # by the word list's order
    c2 = np.concatenate([unplanes(r["counts"]) for r in of[2]]).astype("i8")
    spans = [j - i for _, i, j in buckets(keys2, bits)]
    owner = np.concatenate([np.unpackbits(np.frombuffer(r["owner"], "u1"), count=n) for r, n in zip(of[2], spans)]) == 1
    end = int(np.flatnonzero(b.names == hashes([END])[0])[0])
    cw = c1[b.tokens]                                # count of each token
    cv = np.empty_like(cw)
    cv[1:] = cw[:-1]
    cv[b.starts] = c1[end]                           # as many starts as ends
    pw, pair_count = p1(cw), c2[b.spot]
    seen = pair_count > 0
    logs = np.log10(np.where(seen, kept(pair_count, d2) / np.maximum(cv, 1), pw))
    sums = lambda x: np.add.reduceat(x, b.starts)
    base = np.log10((cw + 0.5) / (p1.n + 0.5 * (p1.types + 1)))
    out = [{"kind": "scores", "block": b.block, "doc_id": b.ids, "held_out": b.held.tolist(),
            "n_tokens": b.lengths.tolist(), "n_known": sums((cw > 0).astype("i8")).tolist(),
            "base_score": sums(base).tolist(), "score": sums(logs).tolist()}]
    # Parts of the alphas: pairs that this block owns, by context.
    mine = np.flatnonzero(owner)
    at = b.sample[mine]
    order = np.argsort(b.before[at], kind="stable")
    mine, at = mine[order], at[order]
    contexts = b.before[at]
    first = np.flatnonzero(np.concatenate(([True], contexts[1:] != contexts[:-1]))) if len(at) else np.empty(0, "i8")
    add = lambda x: np.add.reduceat(x, first) if len(first) else np.empty(0)
    taken, below, total = add(c2[mine] - kept(c2[mine], d2)), add(pw[at]), add(c2[mine])
    contexts = contexts[first]
    # Questions: contexts of unseen pairs, with a document's place for each of their tokens.
    places = np.repeat(np.arange(len(b.lengths)), b.lengths)
    open_ = np.flatnonzero(~seen & (cv > 0))
    open_ = open_[np.argsort(b.before[open_], kind="stable")]
    asked, askers = np.unique(b.before[open_], return_counts=True)
    ends = np.concatenate(([0], np.cumsum(askers)))
    rows: dict[int, dict] = {}
    few = max(2, bits - 2)
    for x, i, j in buckets(contexts, few):
        rows[x] = {"keys": pack(contexts[i:j]), "mass": planes(taken[i:j], "<f4"), "below": planes(below[i:j], "<f4"),
                   "counts": planes(total[i:j])}
    for x, i, j in buckets(asked, few):
        rows.setdefault(x, {}).update(asked=pack(asked[i:j]), askers=planes(askers[i:j]),
                                      documents=planes(places[open_[ends[i]:ends[j]]]))
    return out + [r | {"kind": "contexts", "block": b.block, "bucket": x} for x, r in rows.items()]


def alpha_bucket(table: pa.Table) -> pa.Table:
    rows = table.to_pylist()
    part = lambda name, kind: np.concatenate(
        [unplanes(r[name], kind) for r in rows if r["keys"]] or [np.empty(0, kind)]).astype("f8")
    keys = np.concatenate([unpack(r["keys"]) for r in rows if r["keys"]] or [np.empty(0, "u8")])
    contexts, which = np.unique(keys, return_inverse=True)
    mass, below, total = (np.bincount(which, part(n, k), len(contexts))
                          for n, k in (("mass", "<f4"), ("below", "<f4"), ("counts", "<u4")))
    alpha = np.log10(mass / np.maximum(total, 1) / np.maximum(1 - below, 1e-12)) if len(contexts) else np.empty(0)
    out = []
    for r in rows:
        if r["asked"]:
            asked = unpack(r["asked"])
            value = alpha[np.searchsorted(contexts, asked)]
            place = unplanes(r["documents"])
            each = np.repeat(value, unplanes(r["askers"]))
            documents, back = np.unique(place, return_inverse=True)
            out.append({"block": r["block"], "place": documents.tolist(), "alpha": np.bincount(back, each).tolist()})
    return pa.Table.from_pylist(out, arrow_schema(ALPHAS))


def report(docs: DataFrame, size: int = BLOCK) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; one row per input row. Learns from the
    documents that are not held out."""
    spark = docs.sparkSession
    base = run_folder(spark, "katz")

    def stored(df: DataFrame, name: str, *by: str) -> DataFrame:
        df.write.partitionBy(*by).option("compression", "zstd").parquet(f"{base}/{name}")
        return spark.read.parquet(f"{base}/{name}")

    held = docs.select("doc_id", (fold("doc_id", 5) == 1).alias("held"), "text")
    cut = stored(cut_blocks(held, size), "blocks")
    tokens = cut.agg(F.sum(F.length("tokens"))).first()[0]
    if not tokens:
        return spark.createDataFrame([], "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                         "base_score double, score double")
    bits = min(20, max(MIN_BITS, math.ceil(math.log2(tokens / 4 / PER_BUCKET))))
    asked = cut.mapInArrow(ask(bits), ASKED)
    counted = stored(asked.groupBy("ord", "bucket").applyInArrow(count_bucket, COUNTS), "ngrams", "kind", "ord")
    sums = {r["ord"]: [r[f"h{i}"] for i in range(CUTOFF + 3)] for r in counted.where("kind = 'table'").groupBy("ord").agg(
        *[F.sum(F.get("hist", F.lit(i))).alias(f"h{i}") for i in range(CUTOFF + 3)]).collect()}
    d1, d2 = discounts(sums[1]), discounts(sums[2])
    p1 = (sums[1][-2], sums[1][-1], d1, left_over(sums[1], d1))

    def blocks(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = score_block(left.to_pylist()[0], bits, right.to_pylist(), Unigrams(*p1), d2)
        return pa.Table.from_pylist(rows, arrow_schema(SCORED))

    answers = counted.where("kind = 'answer'").select("block", "ord", "bucket", "counts", "owner")
    scored = stored(cut.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(blocks, SCORED), "scored", "kind")
    alphas = (scored.where("kind = 'contexts'")
              .select("bucket", "block", "keys", "mass", "below", "counts", "asked", "askers", "documents")
              .groupBy("bucket").applyInArrow(alpha_bucket, ALPHAS)
              .select("block", F.explode(F.arrays_zip("place", "alpha")).alias("x"))
              .groupBy("block", F.col("x.place").alias("place")).agg(F.sum("x.alpha").alias("alpha")))
    names = ("doc_id", "held_out", "n_tokens", "n_known", "base_score", "score")
    rows = scored.where("kind = 'scores'").select("block", F.posexplode(F.arrays_zip(*names)).alias("place", "x"))
    return rows.join(alphas, ["block", "place"], "left").select(
        "x.doc_id", "x.held_out", "x.n_tokens", "x.n_known", F.lit(sums[1][-2]).cast("long").alias("train_tokens"),
        "x.base_score", (F.col("x.score") + F.coalesce("alpha", F.lit(0.0))).alias("score"))
