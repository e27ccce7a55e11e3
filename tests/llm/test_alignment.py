"""Token alignment against a merge of the two lists of tokens, document by document."""

import public_tokenizers
import pytest
from by_hand import aligned
from edge import documents, no_documents

from pulsetrail.llm import alignment
from pulsetrail.llm.common import table

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["<|endoftext|> is plain <s> text </s> <unk> <0x41>", " two  blanks   three", "▁ is no blank", "tab\tand\r\n line",
         "日本語 emoji 👩‍👩‍👧 ﬁ ß", "a b c d e " * 50, " ", "x" * 3000, " hard blanks\u001cand separators \u001d x",
         "don't we'll  'tis 12 345,678.9"]


@pytest.fixture(scope="module")
def pair():
    with open(A, "rb") as a, open(B, "rb") as b:
        return alignment.Pair(a.read(), b.read())


def by_row(rows):
    return sorted((str(r["doc_id"]), *(r[n] for n in [*alignment.COUNTS, "n_best", "count_sum", "groups_sha256"])) for r in rows)


def check(pair, docs):
    rows = docs.select("doc_id", "text").collect()
    want = aligned([(k, r["text"]) for k, r in enumerate(rows)], pair)
    got = by_row(alignment.report(docs, A, B).collect())
    assert got == sorted((str(r["doc_id"]), *want[k]) for k, r in enumerate(rows))
    return want


def test_awkward_texts(spark, pair, monkeypatch):
    want = check(pair, documents(spark, TEXTS))
    assert sum(w[0] == 0 for w in want.values()) == 4           # null, null, empty, and the text with U+2581
    monkeypatch.setattr(alignment, "BLOCK", 500)                # many blocks, units aligned in many parts
    monkeypatch.setattr(alignment, "UNITS", 7)
    check(pair, documents(spark, TEXTS).repartition(3))
    monkeypatch.setattr(alignment, "cuts_at_blanks", lambda a, b: False)
    check(pair, documents(spark, TEXTS))
    assert alignment.report(no_documents(spark), A, B).count() == 0


def test_small_tables(spark, pair):
    check(pair, table(spark, "/root/testdata/sf0.001", "documents"))


def test_links_table_sums_to_the_links(spark, pair, tmp_path):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    alignment.blocks(docs, A, B).write.parquet(f"{tmp_path}/blocks")
    kept = spark.read.parquet(f"{tmp_path}/blocks")
    counts = alignment.links_table(kept).toPandas()
    assert not counts.duplicated(["a", "b"]).any()
    assert counts.n.sum() == sum(r["n_links"] for r in alignment.scored(kept).collect())
    assert (counts[counts.best].groupby("b").n.nunique() == 1).all() and counts[counts.best].b.nunique() == counts.b.nunique()
