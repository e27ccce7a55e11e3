"""Repair of the turn structure of conversations at least cost.

Rows of a conversation stand by turn (nulls first), rows of one turn by role and then by two hashes of their text. A row's
signature letter names the initial of its role (s, u, a or another one) and its first fault: blank, duplicate (role and text
seen earlier in the conversation), truncated, or none. All that a repair costs follows from the letters.

* Signatures are made in slices of turns, so that a conversation of any length spreads over tasks; only its letters come
  together, and these are as many as its audit has characters. Rows that repeat are marked by a join with the first turn of
  the texts that have several.
* Distinct signatures are sorted from their ends and walked as an automaton that shares suffixes: neighbours in this order
  keep the nodes of their common suffix, so a node is made once (once more at the border of a partition). A node knows, for
  each state of the grammar `(s?(ua)+)?`, the least cost from here to the end and the first edit of the best audit, whose
  next one is found at the node and state it leads to; and the counts of faults behind it. Edits of equal cost differ in
  their first letter, so the least letter is the ASCII-least audit.
* Each conversation gets the audit of its signature. Then its rows stream by in order behind the audit, are edited and
  hashed; nothing of a conversation is kept but the running hash. (A hash over a conversation's text is computed in one
  sequence, so a conversation's rows pass through one task here, one batch at a time.)

Null roles and texts count as one space, a null conversation id names a conversation, a null turn stands first and is
ignored in the gaps. Rows that are equal in all columns are repeated rows: the first counts, the others are duplicates.
Conversations without rows keep their id. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

from pulsetrail.llm.common import arrow_schema, spread_join, to_arrow
from pulsetrail.session import run_folder

SLICE_TURNS = 512
LETTERS = "ABCDEFGHIJKLMNOP"                 # 4 * initial + fault
INITIALS = "sua"                             # the fourth is any other
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)
ROLES = {"u": "user", "a": "assistant"}
ORDER = ["turn", "role", "h1", "h2"]
FACTS = ["cost", "blank", "duplicate", "truncated", "illegal"]

# Costs and grammar, as given. States: nothing yet, after s, after u, after a.
DELETE, REROLE, INSERT, CUT_OFF = 4, 3, 3, 3
MOVES = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
FILL = [(2, "u"), (2, "u"), (3, "a"), (2, "u")]  # the one state that a user or assistant turn leads to, and its initial
LEGAL = {"su", "ua", "au"}
END = ((0, 6, 3, 0), (".", "I", "I", "."), 0, 0, 0, 0, "")


def damage(rows: DataFrame) -> DataFrame:
    """Damages rows by a hash of id and turn; `copies` says how often a row is there (0: dropped)."""
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(told("text"), "[.!?]", "")).otherwise(told("text"))
    return rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(told("role")).alias("role"),
                       text.alias("text"), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def given(rows: DataFrame) -> DataFrame:
    """Rows as they are, in the form of `damage`."""
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    return rows.select("conv_id", "turn", told("role"), told("text"), F.lit(1).alias("copies"))


def hashed(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64("text", F.lit(1))})


def light(rows: DataFrame) -> DataFrame:
    """Rows without their texts: initial and own fault as numbers, hashes for the text."""
    last = F.substring(F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r")), -1, 1)
    fault = F.when(last == "", BLANK).when(~last.isin(".", "!", "?"), TRUNCATED).otherwise(NONE)
    first = F.substring("role", 1, 1)
    initial = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    return hashed(rows).select("conv_id", *ORDER, "copies", initial.alias("initial"), fault.alias("fault"))


def signatures(rows: DataFrame) -> DataFrame:
    """conv_id, signature, gaps: one row per conversation."""
    plain = light(rows)
    same = ["conv_id", "role", "h1", "h2"]
    again = plain.where("copies > 0").groupBy(*same).agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("n")) \
        .where("n > 1").drop("n")
    named = again.select(*[F.col(c).alias(f"{c}_again") for c in same], "first")
    on = F.col("conv_id").eqNullSafe(F.col("conv_id_again"))
    for c in same[1:]:
        on &= F.col(c) == F.col(f"{c}_again")
    seen = F.col("first").isNotNull() & ~F.col("first.turn").eqNullSafe(F.col("turn"))
    one = F.struct(*ORDER, "copies", "initial", "fault", "seen")
    pieces = plain.join(named, on, "left").withColumn("seen", seen) \
        .groupBy("conv_id", F.floor(F.col("turn") / SLICE_TURNS).alias("slice")) \
        .agg(F.sort_array(F.collect_list(F.when(F.col("copies") > 0, one))).alias("rows"))
    turns = F.array_distinct(F.transform("rows", lambda x: x["turn"]))
    turns = F.filter(turns, lambda x: x.isNotNull())
    pieces = pieces.select("conv_id", "slice", spelled(F.col("rows")).alias("piece"), F.size(turns).alias("turns"),
                           F.array_min(turns).alias("low"), F.array_max(turns).alias("high"))
    listed = F.sort_array(F.collect_list(F.struct("slice", "piece")))
    gaps = F.max("high") - F.min("low") + 1 - F.sum("turns")
    return pieces.groupBy("conv_id").agg(F.array_join(F.transform(listed, lambda x: x["piece"]), "").alias("signature"),
                                         F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"))


def spelled(rows: Column) -> Column:
    """Letters of sorted rows; further copies of a row are duplicates unless they are blank."""

    def letters(x: Column, i: Column) -> Column:
        before = F.get(rows, i - 1)
        repeats = (i > 0) & before["turn"].eqNullSafe(x["turn"]) & (before["role"] == x["role"]) \
            & (before["h1"] == x["h1"]) & (before["h2"] == x["h2"])
        letter = lambda fault: F.substr(F.lit(LETTERS), x["initial"] * 4 + fault + 1, F.lit(1))
        later = F.when(x["fault"] == BLANK, BLANK).otherwise(DUPLICATE)
        first = F.when(x["seen"] | F.coalesce(repeats, F.lit(False)), later).otherwise(x["fault"])
        return F.concat(letter(first), F.repeat(letter(later), x["copies"] - 1))

    return F.array_join(F.transform(rows, letters), "")


@lru_cache(maxsize=1 << 14)
def step(letter: str, after: tuple[int, ...]) -> tuple[tuple[int, ...], tuple[str, ...]]:
    """Costs from before a row and first edits, by state, from the costs behind it."""
    number, far = LETTERS.index(letter), 1 << 40
    fault, initial = number % 4, (INITIALS + "?")[number // 4]
    extra = CUT_OFF if fault == TRUNCATED else 0
    own = []
    for q in range(4):
        ways = [(DELETE + after[q], "D")]
        if fault not in (BLANK, DUPLICATE):
            ways += [(extra + after[MOVES[q][initial]] if initial in MOVES[q] else far, "K"),
                     (REROLE + extra + after[FILL[q][0]], "R")]
        own.append(min(ways))
    best = [None, None, min(own[2], (INSERT + own[3][0], "I")), min(own[3], (INSERT + own[2][0], "I"))]
    best[:2] = [min(own[q], (INSERT + best[2][0], "I")) for q in (0, 1)]
    return tuple(c for c, _ in best), tuple(e for _, e in best)


def node(letter: str, behind: tuple) -> tuple:
    """(costs, first edits, blank, duplicate, truncated, illegal, letter) of a suffix that starts with `letter`."""
    costs, edits, blank, duplicate, truncated, illegal, follower = behind
    low = min(costs)
    costs, edits = step(letter, tuple(c - low for c in costs))
    number = LETTERS.index(letter)
    pair = (INITIALS + "?")[number // 4] + ((INITIALS + "?")[LETTERS.index(follower) // 4] if follower else "")
    fault = number % 4
    return (tuple(c + low for c in costs), edits, blank + (fault == BLANK), duplicate + (fault == DUPLICATE),
            truncated + (fault == TRUNCATED), illegal + (bool(follower) and pair not in LEGAL), letter)


class Walk:
    """A walk over signatures that come from their ends, in order; holds the nodes of the current one."""

    def __init__(self):
        self.path, self.last = [END], ""

    def solve(self, backward: str) -> tuple:
        """(cost, blank, duplicate, truncated, illegal, audit)"""
        same = 0
        while same < min(len(self.last), len(backward)) and self.last[same] == backward[same]:
            same += 1
        del self.path[same + 1:]
        for letter in backward[same:]:
            self.path.append(node(letter, self.path[-1]))
        self.last, top = backward, self.path[-1]
        return top[0][0], *top[2:6], self.audit()

    def audit(self) -> str:
        """First edits from the first row to the end, state by state."""
        out, q = [], 0
        for at in reversed(self.path):
            while (edit := at[1][q]) == "I":
                out.append(edit)
                q = FILL[q][0]
            if at is not END:
                out.append(edit)
                q = {"D": q, "R": FILL[q][0]}[edit] if edit != "K" else MOVES[q][(INITIALS + "?")[LETTERS.index(at[6]) // 4]]
        return "".join(out)


def solve(signed: DataFrame) -> DataFrame:
    """signature, cost, blank, duplicate, truncated, illegal, audit: a row per distinct signature."""
    out = ", ".join(["signature string", *[f"{n} long" for n in FACTS], "audit string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, walk = arrow_schema(out), Walk()
        for batch in batches:
            rows = [(word[::-1], *walk.solve(word)) for word in batch.column("backward").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    words = signed.select(F.reverse("signature").alias("backward")).distinct()
    return words.repartitionByRange("backward").sortWithinPartitions("backward").mapInArrow(run, out)


class Editor:
    """Applies an audit to the rows of a conversation, one by one; `out` takes (role, text) of what stands."""

    def __init__(self, audit: str, out: Callable[[str, str], None]):
        self.audit, self.at, self.before, self.out = audit, 0, "", out

    def stand(self, role: str, text: str) -> None:
        self.before = role[:1]
        self.out(role, text)

    def next_role(self) -> str:
        return ROLES["a" if self.before == "u" else "u"]

    def insert(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            self.stand(self.next_role(), "")

    def row(self, role: str, text: str) -> None:
        self.insert()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit != "D":
            self.stand(role if edit == "K" else self.next_role(), text)


class Digest:
    """SHA-256 of `role:text` lines."""

    def __init__(self):
        self.hash, self.between = hashlib.sha256(), b""

    def __call__(self, role: str, text: str) -> None:
        self.hash.update(self.between + f"{role}:{text}".encode())
        self.between = b"\n"


class Lines(list):
    def __call__(self, role: str, text: str) -> None:
        self.append({"role": role, "text": text})


def edited(rows: DataFrame, heads: DataFrame, start: Callable, end: Callable, name: str, kind: DataType) -> DataFrame:
    """The rows of `heads` (conv_id, audit, ...) with a column: `start` makes what takes the lines of a conversation, `end`
    turns it into the value. A conversation is a head and, behind it, its rows in order; they pass in batches."""
    texts = hashed(rows.where("copies > 0")).select("conv_id", F.lit(None).cast(heads.schema).alias("head"), *ORDER, "text", "copies")
    fronts = heads.select("conv_id", F.struct(*heads.columns).alias("head"),
                          *[F.lit(None).cast(texts.schema[c].dataType).alias(c) for c in [*ORDER, "text", "copies"]])
    queue = fronts.union(texts).withColumn("first", F.col("head").isNull()).repartition("conv_id") \
        .sortWithinPartitions("conv_id", "first", *ORDER).drop("first")
    out = StructType([*heads.schema.fields]).add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, head, editor = to_arrow(out), None, None
        def done() -> dict:
            editor.insert()
            return {**head, name: end(editor.out)}

        for batch in batches:
            ready = []
            fronts_, roles, said, copies = (batch.column(c).to_pylist() for c in ("head", "role", "text", "copies"))
            for fresh, role, text, n in zip(fronts_, roles, said, copies):
                if fresh is not None:
                    if head is not None:
                        ready.append(done())
                    head, editor = fresh, Editor(fresh["audit"], start())
                else:
                    for _ in range(n):
                        editor.row(role, text)
            yield pa.RecordBatch.from_pylist(ready, schema=schema)
        if head is not None:
            yield pa.RecordBatch.from_pylist([done()], schema=schema)

    return queue.mapInArrow(run, out)


def judged(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, cost, blank, duplicate, truncated, illegal, audit. Signatures and audits are written when this is
    called: both are used twice."""
    spark, base = rows.sparkSession, run_folder(rows.sparkSession, "conversations")
    signatures(rows).write.parquet(f"{base}/signatures")
    signed = spark.read.parquet(f"{base}/signatures")
    solve(signed).write.parquet(f"{base}/audits")
    return spread_join(signed, spark.read.parquet(f"{base}/audits"), "signature").drop("signature")


def repaired(rows: DataFrame) -> DataFrame:
    """The columns of `judged` and `turns`, the repaired rows in order, for rows that come as they are. Here a conversation's
    rows are one value; `report` only hashes them."""
    prepared = given(rows)
    kind = ArrayType(StructType().add("role", StringType()).add("text", StringType()))
    return edited(prepared, judged(prepared), Lines, list, "turns", kind)


def report(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of damaged rows; one row per
    conversation."""
    hurt = damage(rows)
    out = edited(hurt, judged(hurt), Digest, lambda d: d.hash.hexdigest(), "repaired_sha256", StringType())
    return out.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
