"""Repair of conversations against a uniform-cost search per conversation."""

import random

import pyspark.sql.functions as F
import pytest
from by_hand import conversations as by_hand

from pulsetrail.llm import conversations as c
from pulsetrail.llm.common import table

SCHEMA = "conv_id long, turn long, role string, text string, head string, h1 string, copies string, slice int"
FACTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", 1) for r in rows], SCHEMA)


def results(df):
    return {r["conv_id"]: tuple(r[n] for n in FACTS) for r in df.collect()}


def random_rows(n, seed):
    rng, rows = random.Random(seed), []
    texts = ["Hello.", "hello", "why?", "", " \t", "One. Two.", "ok!", "naïve…", " ", "a\nb."]
    for conv in range(n):
        for turn in range(rng.randint(1, 9)):
            if rng.random() < 0.9:
                rows.append((conv, None if rng.random() < 0.03 else turn + rng.choice([0, 0, 0, 5]),
                             rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"]),
                             rng.choice([*texts, None])))
    return rows


def order_of(spark, rows):
    """Rank of (role, text hashes), by which rows of one turn are ordered."""
    seen = sorted({(t[2] if t[2] is not None else " ", t[3] if t[3] is not None else " ") for t in rows}
                  | {(r, x) for t in rows for r in (t[2] or " ", "user", t[2] if t[2] is not None else " ")
                     for x in (t[3] or " ", "", "".join(ch for ch in (t[3] or " ") if ch not in ".!?"))})
    h = c.hashed(spark.createDataFrame(seen, "role string, text string")).collect()
    rank = {(r["role"], r["text"]): (r["role"].encode(), r["h1"], r["h2"]) for r in h}
    return lambda row: rank[row[1], row[2]]


@pytest.mark.parametrize("turns", [c.SLICE_TURNS, 2])
def test_random_conversations(spark, turns, monkeypatch):
    monkeypatch.setattr(c, "SLICE_TURNS", turns)
    rows = random_rows(400, turns)
    rows += [(None, k, "user", "Who?") for k in range(3)] + [(5000, None, "user", "Hm."), (5000, None, "assistant", "Hm.")]
    rows += [(6000, 1, "user", "Same.")] * 4 + [(6001, -4, "assistant", "Yes."), (6001, 4_000_000_000, "user", "No.")]
    got = results(c.report(frame(spark, rows).repartition(5)))
    assert got == by_hand(rows, order_of(spark, rows))


def test_long_conversation(spark):
    rng = random.Random(5)
    rows = [(1, k, rng.choice(["user", "assistant", "user", "assistant", "tool"]), f"Line {k}{rng.choice(['.', '', '!'])}")
            for k in range(6000)] + [(2, k, ["user", "assistant"][k % 2], f"Line {k}.") for k in range(6000)]
    got = results(c.report(frame(spark, rows)))
    assert set(got) == {1, 2} and len(got[1][6]) >= 5000 and got[2][4] > 0
    small = [r for r in rows if r[1] < 300]
    assert results(c.report(frame(spark, small))) == by_hand(small)


def test_lost_and_empty(spark):
    lost = next(k for k in range(1000) if by_hand([(k, 0, "user", "Hi.")])[k][6] == "")
    rows = [(lost, 0, "user", "Hi.")]
    empty = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert results(c.report(frame(spark, rows))) == {lost: (0, 0, 0, 0, 0, 0, "", empty)}
    assert c.report(frame(spark, []).where("false")).count() == 0


def test_nodes_are_made_once_per_suffix(monkeypatch):
    made, real = [], c.node
    monkeypatch.setattr(c, "node", lambda letter, behind: made.append(1) or real(letter, behind))
    rng = random.Random(2)
    words = sorted({"".join(rng.choice(c.LETTERS) for _ in range(rng.randint(0, 5))) for _ in range(3000)})
    walk = c.Walk()
    for w in words:
        walk.solve(w)
    assert len(made) == len({w[:k] for w in words for k in range(1, len(w) + 1)})


def test_repaired_rows(spark):
    rows = [(1, 0, "assistant", "Hi."), (1, 1, "user", "How?"), (1, 2, "user", "How?"), (2, 0, "system", "Be kind.")]
    got = {r["conv_id"]: r for r in c.repaired(frame(spark, rows)).collect()}
    assert got[1]["audit"] == "DID" or got[1]["cost"] <= 11
    for r in got.values():
        roles = "".join(t["role"][0] for t in r["turns"])
        assert roles in ("", "ua", "uaua", "sua")


def test_small_tables(spark):
    rows = table(spark, "/root/testdata/sf0.01", "conversations")
    want = by_hand([tuple(r) for r in rows.select("conv_id", "turn", "role", "text").collect()])
    assert results(c.report(rows)) == want
    extra = rows.withColumn("audit", F.lit("x")).withColumn("signature", F.lit("y"))
    assert results(c.report(extra)) == want
