"""Language identification and the language model: held-out accuracy, and the model's sums against plain Python."""

import math
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
from edge import documents, no_documents

from pulsetrail.llm import katz, langid
from pulsetrail.llm.common import table


def test_language_on_held_out_rows(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = langid.report(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert len(got) > 100 and (got.lang == got.lang_pred).mean() > 0.99


def test_language_edges(spark):
    docs = documents(spark)
    got = {r["doc_id"]: r for r in langid.report(docs).collect()}
    assert langid.report(docs).count() == docs.count()
    for i in (2, 3, 4, 9):
        assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
    assert all(0 <= r["score"] <= 1 for r in got.values())
    kept = langid.keep(docs)
    assert kept.columns == docs.columns and {7, 8} <= {r["doc_id"] for r in kept.collect()}
    assert langid.report(no_documents(spark)).count() == 0


def test_filters_of_many_languages():
    rng = np.random.default_rng(0)
    sets = [rng.integers(0, 1 << 62, 300).astype("u8") for _ in range(130)]
    f = langid.Filters([f"l{i}" for i in range(130)], sets)
    for i in (0, 62, 63, 129):
        cover = f.cover(sets[i])
        assert int(np.argmax(cover)) == i and cover[i] == 1.0 and np.sort(cover)[-2] < 0.2


def by_hand(rows):
    """The model in plain Python."""
    tokens = {}
    for k, (i, t) in enumerate(rows):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        tokens[k] = [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w] + ["\n"]
    held = {k: crc32(("" if i is None else str(i)).encode()) % 5 == 1 for k, (i, _) in enumerate(rows)}
    uni, bi, ctx = Counter(), Counter(), Counter()
    for k, ts in tokens.items():
        if not held[k]:
            uni.update(ts)
            bi.update(zip(["<s>", *ts], ts))
            ctx.update(["<s>", *ts[:-1]])

    def hist(counts):
        return [sum(c == r for c in counts.values()) for r in range(1, katz.CUTOFF + 2)] + [sum(counts.values()), len(counts)]

    d1, d2 = katz.discounts(hist(uni)), katz.discounts(hist(bi))
    keep = lambda c, d: c * d[c] if c <= katz.CUTOFF else c - katz.TAIL
    n, types = sum(uni.values()), len(uni)
    left = 1 - sum(keep(c, d1) for c in uni.values()) / n
    p1 = lambda w: keep(uni[w], d1) / n if uni[w] else left
    after = defaultdict(list)
    for (v, w), c in bi.items():
        after[v].append((w, c))
    alpha = {v: (1 - sum(keep(c, d2) for _, c in ws) / ctx[v]) / (1 - sum(p1(w) for w, _ in ws)) for v, ws in after.items()}
    p2 = lambda v, w: keep(bi[v, w], d2) / ctx[v] if bi[v, w] else alpha.get(v, 1.0) * p1(w)
    for v in list(after)[:200]:      # all words after a context, the unknown one included, sum to one
        assert abs(sum(p2(v, w) for w in uni) + p2(v, "an unknown word") - 1) < 1e-9
    return [(len(ts), sum(uni[w] > 0 for w in ts), n,
             sum(math.log10((uni[w] + 0.5) / (n + 0.5 * (types + 1))) for w in ts),
             sum(math.log10(p2(v, w)) for v, w in zip(["<s>", *ts], ts))) for ts in tokens.values()]


def test_language_model(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    docs = docs.unionByName(documents(spark).select("doc_id", "text")).coalesce(2)
    want = sorted(by_hand([(r["doc_id"], r["text"]) for r in docs.collect()]))
    for size in (katz.BLOCK, 5000):      # one block per task, and many
        rows = sorted((r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"])
                      for r in katz.report(docs, size).collect())
        assert len(rows) == len(want)
        for a, b in zip(rows, want):
            assert a[:3] == b[:3] and abs(a[3] - b[3]) < 1e-6 * max(1, abs(b[3])) and abs(a[4] - b[4]) < 1e-5 * max(1, abs(b[4]))


def test_language_model_edges(spark):
    assert katz.report(no_documents(spark)).count() == 0
    alone = documents(spark).where("doc_id = 2")
    assert katz.report(alone).count() == 1
