"""Byte-level BPE by tree reduction: halves are encoded on their own and joined by re-encoding a window at the seam.

Two facts make the joins exact.

* The split pattern only looks forward, and no match goes across a place before a blank that precedes a visible
  character. Texts are cut into blocks there. A block that ends at least two characters before the end of a half is a
  block of the whole text, and once a window that is cut anew hits a border of the right half, its later blocks stand.
* A token sequence is the encoding of its bytes exactly if each two neighbours are (`fits`). So a window is grown until
  its outer tokens fit their neighbours; nothing outside can change then.

Ids are kept as little-endian unsigned 32-bit integers in a binary column. Null texts are empty and have no tokens.
"""

from __future__ import annotations

import base64
import heapq
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsetrail.llm.common import scan

LEAF_CHARS = 8192     # texts up to this length are split in one go
LEAF_BLOCKS = 1024    # blocks whose matches are found in one go
LEAF_BYTES = 32       # pieces up to this length are merged in one go
LEAF_IDS = 4096       # ids decoded in one go
CACHE = 400_000       # entries of a generation of remembered results per task
NONE = 1 << 40        # above any rank

# Unicode's White_Space characters.
WHITE = r"\t-\r \x85\xa0  -     　"
# No match of the pattern goes across a place before a blank that stands before a visible character.
SEAM = re.compile(f" (?=[^{WHITE}])")
WIDE = re.compile(f" [{WHITE}]")


def blocks(text: str) -> list[str]:
    """The text cut before each blank that is followed by a visible character."""
    if not WIDE.search(text):
        first, *rest = text.split(" ")
        return [first, *[" " + x for x in rest]] if first else [" " + x for x in rest]
    cuts = [0, *[m.start() for m in SEAM.finditer(text)], len(text)]
    return [text[a:b] for a, b in zip(cuts, cuts[1:]) if a < b]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class ByteBpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks, self.bytes_of = ranks, {i: b for b, i in ranks.items()}
        self.pieces = regex.compile(pattern).findall
        self.fit: dict[tuple[int, int], bool] = {}
        self.parts = _Known(self.part)

    def merge(self, data: bytes) -> list[int]:
        """The merges by rank, leftmost first, over the whole of `data`; O(n log n)."""
        ranks, n = self.ranks, len(data)
        if n <= LEAF_BYTES:
            return self.merge_short(data)
        end = list(range(1, n + 1))           # end of the part that starts here
        before = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(data[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, stop = heapq.heappop(heap)
            if end[i] < 0 or end[i] == n or end[end[i]] != stop or ranks.get(data[i:stop]) != r:
                continue
            middle = end[i]
            end[i], end[middle] = stop, -1
            if stop < n:
                before[stop] = i
                if (r := ranks.get(data[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (p := before[i]) >= 0 and (r := ranks.get(data[p:stop])) is not None:
                heapq.heappush(heap, (r, p, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[data[i:end[i]]])
            i = end[i]
        return out

    def merge_short(self, data: bytes) -> list[int]:
        get, parts = self.ranks.get, [data[i:i + 1] for i in range(len(data))]
        pairs = [get(data[i:i + 2], NONE) for i in range(len(data) - 1)]
        while pairs and (low := min(pairs)) < NONE:
            i = pairs.index(low)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = get(parts[i] + parts[i + 1], NONE)
            if i:
                pairs[i - 1] = get(parts[i - 1] + parts[i], NONE)
        return [self.ranks[p] for p in parts]

    def fits(self, a: int, b: int) -> bool:
        if (known := self.fit.get((a, b))) is None:
            if len(self.fit) > CACHE:
                self.fit.clear()
            known = self.fit[a, b] = self.merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        return known

    def join(self, a: list[int], b: list[int]) -> list[int]:
        if not a or not b or self.fits(a[-1], b[0]):
            return a + b
        i = j = 1
        while True:
            window = self.merge(b"".join(map(self.bytes_of.__getitem__, [*a[-i:], *b[:j]])))
            left = i == len(a) or self.fits(a[-i - 1], window[0])
            right = j == len(b) or self.fits(window[-1], b[j])
            if left and right:
                return a[:-i] + window + b[j:]
            i, j = (i if left else min(2 * i, len(a))), (j if right else min(2 * j, len(b)))

    def piece(self, data: bytes) -> list[int]:
        if len(data) <= LEAF_BYTES:
            return self.merge(data)
        half = len(data) // 2
        return self.join(self.piece(data[:half]), self.piece(data[half:]))

    def part(self, text: str) -> bytes:
        """Packed ids of a match of the pattern; one that is a token is this token."""
        data = text.encode()
        whole = self.ranks.get(data)
        return whole.to_bytes(4, "little") if whole is not None else np.array(self.piece(data), "<u4").tobytes()

    def split(self, text: str) -> list[str]:
        """Blocks of the text."""
        if len(text) <= LEAF_CHARS:
            return blocks(text)
        half = len(text) // 2
        return join_blocks(self.split(text[:half]), self.split(text[half:]))

    def leaves(self, text: str) -> list[str]:
        """The text cut at borders of blocks into runs of blocks; matches of the pattern stay whole."""
        if len(text) <= LEAF_CHARS:
            return [text]
        cut = self.split(text)
        return ["".join(cut[i:i + LEAF_BLOCKS]) for i in range(0, len(cut), LEAF_BLOCKS)]

    def encode(self, text: str | None) -> bytes:
        return b"".join([x for leaf in self.leaves(text or "") for x in map(self.parts.now.__getitem__, self.pieces(leaf))])

    def decode(self, ids: bytes | None) -> bytes:
        return self._decode(np.frombuffer(ids or b"", "<u4").tolist())

    def _decode(self, ids: list[int]) -> bytes:
        if len(ids) <= LEAF_IDS:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        half = len(ids) // 2
        return self._decode(ids[:half]) + self._decode(ids[half:])


class _Known:
    """Results by text in two generations: a full one becomes the older one, from which what is used again is taken over.
    Long texts are not kept."""

    def __init__(self, make):
        self.make, self.older, self.now = make, {}, _Generation(self)

    def look(self, text: str) -> bytes:
        if (made := self.older.get(text)) is None:
            made = self.make(text)
        if len(text) <= 64:
            if len(self.now) >= CACHE:
                self.older, self.now = self.now, _Generation(self)
            self.now[text] = made
        return made


class _Generation(dict):
    def __init__(self, known: _Known):
        super().__init__()
        self.known = known

    def __missing__(self, text: str) -> bytes:
        return self.known.look(text)


def join_blocks(a: list[str], b: list[str]) -> list[str]:
    """Blocks of a text from those of its halves."""
    if not a or not b:
        return a + b
    tail, length = 0, 0
    while tail < len(a) and length < 2:
        tail += 1
        length += len(a[-tail])
    j = 1
    while True:
        window = blocks("".join(a[-tail:]) + "".join(b[:j]))
        if j == len(b):
            return a[:-tail] + window
        borders, at = {}, length
        for k in range(j):
            at += len(b[k])
            borders[at] = k + 1
        total, at = at, 0
        for k, block in enumerate(window):
            at += len(block)
            if at in borders and at + 2 <= total:
                return a[:-tail] + window[:k + 1] + b[borders[at]:]
        j = min(2 * j, len(b))


def encode(df: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """Adds `ids` (packed ids). The vocabulary is read on the driver; its file is a parameter of fixed size."""
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def start():
        bpe = ByteBpe(ranks.value, pattern)
        return lambda texts: [(bpe.encode(t),) for t in texts]

    return scan(df, start, "ids binary", text)


def decode(df: DataFrame, ranks_path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """Adds `decoded` (bytes) from packed ids."""
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def start():
        bpe = ByteBpe(ranks.value, pattern)
        return lambda packed: [(bpe.decode(p),) for p in packed]

    return scan(df, start, "decoded binary", ids)


def round_trip(df: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """Adds `ids` and `decoded`, the bytes decoded from these ids, in one scan: each task holds one vocabulary."""
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def start():
        bpe = ByteBpe(ranks.value, pattern)
        return lambda texts: [(ids := bpe.encode(t), bpe.decode(ids)) for t in texts]

    return scan(df, start, "ids binary, decoded binary", text)


def digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256; one row per input row."""
    return round_trip(docs.select("doc_id", "text"), ranks_path, pattern).select(
        "doc_id", F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
