"""Two tokenizers side by side: where their tokens share ends, which tokens overlap, and how often each pair does.

The work is done on Arrow arrays, a block of documents at a time.

* Texts are cut into units at blanks between two visible characters; no token of either vocabulary goes across such a place
  (`cuts_at_blanks` reads this off the files; if it does not hold, a text is one unit). The distinct units of a block are
  encoded and aligned once, documents are lists of units.
* Alignment: the lists of ids are flattened with their parent indices, token lengths are summed up within each parent, and
  the two tables of (parent, end) meet in an Acero hash join, outer on both sides. In the order of these keys, a key of both
  sides ends a group, and each key is one link: the next end at or after it on either side names the two tokens that cover
  the bytes before it, and no two tokens overlap in two such stretches.
* `Table.group_by` counts the pairs of a block, Spark merges these partial counts. A block then asks for its own distinct
  pairs only, and the answers are summed up through units to documents.

A block is one row of a written table (packed and compressed numbers), so a lost executor costs the blocks it was working
on. Blocks are bounded by BLOCK characters or one text. A pair that is in every block is a few numbers per block; its rows
are split by adaptive execution.

Null and empty texts, and texts whose bytes either tokenizer does not give back, have no tokens: zeros and the empty string.
Blank texts are texts. Repeated rows count each. Rows without an id stay. Only `doc_id` and the text are read.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, LongType, StringType, StructType

from pulsetrail.llm.common import spread_join, to_arrow
from pulsetrail.session import run_folder

BLOCK = 3 << 20      # characters of a block
BLOCK_ROWS = 50_000  # documents of a block
UNITS = 100_000      # distinct units aligned in one go
UNIT = re.compile(r"(?<=\S) (?=\S)")
KEYS = ["parent", "end"]
PACKED = ["sizes", "units", "links", "link_pairs"]  # units per document, their numbers, links per unit, their pairs
COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


def byte_alphabet() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: visible Latin-1 characters stand for themselves, the
    other bytes for the characters from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(others)}


class Pair:
    """The two tokenizers: A byte-level (tokenizers), B with byte fallback (sentencepiece)."""

    def __init__(self, a: bytes, b: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals the work out
        self.a = Tokenizer.from_str(a.decode())
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        letters = byte_alphabet()
        self.a_bytes = [b""] * self.a.get_vocab_size(with_added_tokens=True)
        for token, i in self.a.get_vocab(with_added_tokens=True).items():
            self.a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(map(self.b.id_to_piece, range(self.b.vocab_size())))]
        self.lengths = [pa.array(map(len, x), pa.int64()) for x in (self.a_bytes, self.b_bytes)]

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        a = self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        return [x.ids for x in a], self.b.encode(texts, add_bos=False, add_eos=False, num_threads=1)

    def faithful(self, text: str, a: list[int], b: list[int]) -> bool:
        given = (" " + text).encode()
        return (b"".join(map(self.a_bytes.__getitem__, a)) == given and b"".join(map(self.b_bytes.__getitem__, b)) == given)


def cuts_at_blanks(a: bytes, b: bytes) -> bool:
    """No token reaches across a blank between visible characters: A splits there before it merges, B has no piece with a
    blank after another character, and neither rewrites the text."""
    import json

    from sentencepiece import sentencepiece_model_pb2

    first, second = json.loads(a), sentencepiece_model_pb2.ModelProto()
    second.ParseFromString(b)
    split, form, learned = first["pre_tokenizer"] or {}, second.normalizer_spec, second.trainer_spec
    return (first["normalizer"] is None and split.get("type") == "ByteLevel" and split.get("use_regex", True)
            and not split.get("add_prefix_space") and first["model"]["type"] == "BPE"
            and not form.precompiled_charsmap and not form.remove_extra_whitespaces and form.add_dummy_prefix
            and form.escape_whitespaces and not learned.treat_whitespace_as_suffix and learned.model_type == learned.BPE
            and not any("▁" in p.piece.lstrip("▁") or p.type == p.USER_DEFINED for p in second.pieces))


def ends(lists: pa.Array, lengths: pa.Array, name: str) -> pa.Table:
    """(parent, end, id) per token; an end is in bytes from the parent's start."""
    ids, parent = pc.list_flatten(lists), pc.list_parent_indices(lists).cast(pa.int64())
    total = pc.cumulative_sum(pc.take(lengths, ids))
    before = pa.concat_arrays([pa.array([0], pa.int64()), total])
    starts = lists.offsets.slice(0, len(lists))
    within = pc.subtract(total, pc.take(pc.take(before, starts), parent))
    return pa.table({"parent": parent, "end": within, name: ids})


def joined_ids(ids: pa.Array, group: np.ndarray, n: int) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(np.bincount(group, minlength=n))]).astype("i4")
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), ids.cast(pa.string())), ",")


def align(pair: Pair, texts: list[str]) -> tuple[pa.Table, pa.Table]:
    """Per text: faithful, n_a, n_b, n_groups, n_links, groups; per link of a faithful text: parent, a, b, in order."""
    a, b = pair.encode(texts)
    good = [pair.faithful(t, x, y) for t, x, y in zip(texts, a, b)]
    lists = [pa.array([x if ok else [] for x, ok in zip(ids, good)], pa.list_(pa.int32())) for ids in (a, b)]
    left, right = (ends(x, y, n) for x, y, n in zip(lists, pair.lengths, "ab"))
    both = left.join(right, KEYS, join_type="full outer", use_threads=False).sort_by([(k, "ascending") for k in KEYS])
    of = {n: pa.concat_arrays(both[n].chunks or [pa.array([], both[n].type)]) for n in ("parent", "a", "b")}
    parent = of["parent"].to_numpy(zero_copy_only=False)
    has_a, has_b = (pc.is_valid(of[n]).to_numpy(zero_copy_only=False) for n in "ab")
    closes = has_a & has_b
    group = np.cumsum(closes) - closes
    n_groups = int(closes.sum())
    names = pc.binary_join_element_wise(joined_ids(of["a"].drop_null(), group[has_a], n_groups),
                                        joined_ids(of["b"].drop_null(), group[has_b], n_groups), "|")
    per = [np.bincount(parent[at], minlength=len(texts)) for at in (has_a, has_b, closes, slice(None))]
    offsets = pa.array(np.concatenate([[0], np.cumsum(per[2])]).astype("i4"))
    units = pa.table({"faithful": pa.array(good, pa.bool_()), **{n: pa.array(x.astype("i8")) for n, x in zip(COUNTS, per)},
                      "groups": pc.binary_join(pa.ListArray.from_arrays(offsets, names), ";")})
    return units, pa.table({"parent": pa.array(parent), "a": pc.fill_null_backward(of["a"]),
                            "b": pc.fill_null_backward(of["b"])})


def packed(values: np.ndarray) -> bytes:
    raw = values.astype("<u4").tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)
    return np.frombuffer(raw, "<u4").astype("i8")


def segment_sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    at = np.concatenate([[0], np.cumsum(sizes)])
    return total[at[1:]] - total[at[:-1]]


class Block:
    """Documents that are aligned together."""

    def __init__(self, pair: Pair, cut: bool):
        self.pair, self.cut = pair, cut
        self.ids, self.units, self.sizes, self.chars = [], [], [], 0

    def add(self, doc_id, text: str | None) -> None:
        units = (UNIT.split(text) if self.cut else [text]) if text else []
        self.ids.append(doc_id)
        self.units += units
        self.sizes.append(len(units))
        self.chars += len(text or "")

    def full(self) -> bool:
        return self.chars >= BLOCK or len(self.ids) >= BLOCK_ROWS

    def row(self) -> dict:
        coded = pa.array(self.units, pa.large_string()).dictionary_encode()
        at, texts = coded.indices.to_numpy(zero_copy_only=False).astype("i8"), coded.dictionary.to_pylist()
        sizes = np.array(self.sizes, "i8")
        self.units = None
        units, links, base = [], [], 0
        for i in range(0, len(texts), UNITS):
            x, y = align(self.pair, texts[i:i + UNITS])
            units.append(x)
            links.append(y.set_column(0, "parent", pc.add(y["parent"], i)))
        if not texts:
            units, links = ([t] for t in align(self.pair, []))
        units, links = pa.concat_tables(units), pa.concat_tables(links)
        bad = segment_sums(~units["faithful"].to_numpy().astype(bool)[at], sizes) > 0
        at, sizes = at[~np.repeat(bad, sizes)], np.where(bad, 0, sizes)
        docs = {n: segment_sums(units[n].to_numpy()[at], sizes) for n in COUNTS}
        groups, borders = units["groups"].to_pylist(), [0, *accumulate(sizes.tolist())]
        listed = at.tolist()
        hashes = [hashlib.sha256(";".join(map(groups.__getitem__, listed[i:j])).encode()).hexdigest() if i < j else ""
                  for i, j in zip(borders, borders[1:])]
        parent = links["parent"].to_numpy()
        times = np.bincount(at, minlength=len(texts))[parent]
        used = times > 0
        code = (links["a"].to_numpy().astype("i8") << 32 | links["b"].to_numpy().astype("i8"))[used]
        counted = pa.table({"pair": code, "n": times[used]}).group_by("pair").aggregate([("n", "sum")])
        order = np.argsort(counted["pair"].to_numpy())
        pairs = counted["pair"].to_numpy()[order]
        return {"docs": [dict(zip(["doc_id", *COUNTS, "groups_sha256"], x))
                         for x in zip(self.ids, *(docs[n].tolist() for n in COUNTS), hashes)],
                "pairs": pairs, "times": counted["n_sum"].to_numpy()[order], "sizes": packed(sizes), "units": packed(at),
                "links": packed(np.bincount(parent[used], minlength=len(texts))),
                "link_pairs": packed(np.searchsorted(pairs, code))}


def blocks(docs: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """The aligned blocks, lazily. Both files are broadcast; their size does not depend on data."""
    with open(a_path, "rb") as f, open(b_path, "rb") as g:
        files = f.read(), g.read()
    cut, sent = cuts_at_blanks(*files), docs.sparkSession.sparkContext.broadcast(files)
    out = block_schema(docs.schema["doc_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, number, pair = to_arrow(out), 0, Pair(*sent.value)
        block = Block(pair, cut)

        def done() -> pa.RecordBatch:
            row = {"block": f"{TaskContext.get().partitionId()}-{number}", **block.row()}
            return pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in schema], schema=schema)

        for batch in batches:
            for i in range(batch.num_rows):
                block.add(batch.column("doc_id")[i].as_py(), batch.column("text")[i].as_py())
                if block.full():
                    yield done()
                    number, block = number + 1, Block(pair, cut)
        if block.ids:
            yield done()

    return docs.select("doc_id", F.col(text).alias("text")).mapInArrow(run, out)


def block_schema(doc_id: DataType) -> StructType:
    document = StructType().add("doc_id", doc_id)
    for name in COUNTS:
        document = document.add(name, LongType())
    out = StructType().add("block", StringType()).add("docs", ArrayType(document.add("groups_sha256", StringType())))
    for name in ("pairs", "times"):
        out = out.add(name, ArrayType(LongType()))
    for name in PACKED:
        out = out.add(name, BinaryType())
    return out


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): how often two ids are linked, and whether no other A id is linked more often with this B id. A B id
    has at most as many rows as A has ids."""
    part = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("x.pairs", "x.times")
    n = part.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("n"))
    b = Window.partitionBy(F.col("pair").bitwiseAND((1 << 32) - 1))
    return n.withColumn("best", F.col("n") == F.max("n").over(b))


def links_table(aligned: DataFrame) -> DataFrame:
    """(a, b, n, best): the counts with the ids apart."""
    return pair_counts(aligned).select(F.shiftright("pair", 32).cast("int").alias("a"),
                                       F.col("pair").bitwiseAND((1 << 32) - 1).cast("int").alias("b"), "n", "best")


def scored(aligned: DataFrame) -> DataFrame:
    """A row per document with all counts, from written blocks."""
    asked = aligned.select("block", F.posexplode("pairs").alias("at", "pair"))
    answers = spread_join(asked, pair_counts(aligned), "pair").groupBy("block").agg(
        F.collect_list(F.struct("at", "n", "best")).alias("answers"))
    full = aligned.drop("pairs", "times").join(answers, "block", "left").drop("block")
    document = aligned.schema["docs"].dataType.elementType
    out = StructType([*document.fields[:-1]]).add("n_best", LongType()).add("count_sum", LongType()).add(document.fields[-1])

    def sums(row: dict, known: pa.StructArray) -> tuple[np.ndarray, np.ndarray]:
        """n_best and count_sum per document: from pairs to links, units and documents."""
        sizes, units, links, link_pairs = (unpacked(row[n]) for n in PACKED)
        n, best = np.zeros(len(known), "i8"), np.zeros(len(known), "i8")
        at = known.field("at").to_numpy()
        n[at], best[at] = known.field("n").to_numpy(), known.field("best").to_numpy(zero_copy_only=False)
        return tuple(segment_sums(segment_sums(x[link_pairs], links)[units], sizes) for x in (best, n))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow(out)
        for batch in batches:
            for i in range(batch.num_rows):
                docs, known = batch.column("docs")[i].values, batch.column("answers")[i].values
                row = {n: batch.column(n)[i].as_py() for n in PACKED}
                best, n = sums(row, known) if known is not None else [np.zeros(len(docs), "i8")] * 2
                columns = {**{f.name: docs.field(f.name) for f in docs.type}, "n_best": pa.array(best), "count_sum": pa.array(n)}
                yield pa.RecordBatch.from_arrays([columns[f.name] for f in schema], schema=schema)

    return full.mapInArrow(run, out)


def report(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256; one row per input row. The blocks are written
    when this is called."""
    folder = run_folder(docs.sparkSession, "alignment")
    blocks(docs, a_path, b_path).write.option("compression", "zstd").parquet(folder)
    return scored(docs.sparkSession.read.parquet(folder))
