"""Token counts through the cache against the libraries."""

import public_tokenizers
import pytest
from edge import documents, no_documents

from pulsetrail.llm import token_counts as tc
from pulsetrail.llm.common import table

PATHS = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model")]
TEXTS = ["<|endoftext|> and <s>", "Mixed CASE\t\ttext  here", "mixed case text here", "İstanbul ΣΑΣ É", " x y", "x" * 5000]


def by_library(path, texts):
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        own = Tokenizer.from_file(path)
        return [len(own.encode(t or "", add_special_tokens=False).ids) for t in texts]
    import sentencepiece

    return [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=path).encode([t or "" for t in texts])]


@pytest.mark.parametrize("path", PATHS)
def test_counts(spark, path):
    docs = documents(spark, TEXTS)
    rows = docs.collect()
    got = sorted(map(str, tc.report(docs, path).collect()))
    texts = [r["text"] for r in rows]
    want = [(r["doc_id"], len((t or "").encode()), n, n > 512) for r, t, n in zip(rows, texts, by_library(path, texts))]
    assert got == sorted(f"Row(doc_id={i}, n_bytes={b}, n_tokens={n}, over_limit={o})" for i, b, n, o in want)
    assert tc.report(no_documents(spark), path).count() == 0


def test_only_distinct_misses_are_encoded(spark, tmp_path):
    tokenizer, cache = tc.Tokenizer(PATHS[1]), f"{tmp_path}/cache"
    docs = documents(spark, TEXTS)

    def stored():
        return {bytes(r["digest"]): r["n_tokens"] for r in spark.read.parquet(cache).collect()}

    tc.fill(docs.where("doc_id < 100"), tokenizer, cache)
    first = stored()
    texts = {r["text"] or "" for r in docs.where("doc_id < 100").collect()}
    assert len(first) == spark.read.parquet(cache).count() <= len(texts)
    tc.fill(docs, tokenizer, cache)
    rows = spark.read.parquet(cache)
    assert rows.count() == rows.select("digest").distinct().count() > len(first)
    # "Mixed CASE\t\ttext  here" and "mixed case text here" share a normal form here.
    assert rows.count() == len(first) + 1 + len(TEXTS) - 1
    tc.fill(docs, tokenizer, cache)
    assert spark.read.parquet(cache).count() == rows.count()
    # What is stored is used as it is; another version of the tokenizer has its own counts.
    lies = spark.read.parquet(cache).drop("tokenizer").withColumn("n_tokens", tc.F.lit(7).cast("long"))
    lies.write.parquet(f"{tmp_path}/lies/tokenizer={tokenizer.version()}")
    assert {r["n_tokens"] for r in tc.report(docs, PATHS[1], f"{tmp_path}/lies").collect()} == {7}
    assert {r["n_tokens"] for r in tc.report(docs, PATHS[0], f"{tmp_path}/lies").collect()} != {7}


def test_rows_keep_their_columns(spark, tmp_path):
    docs = documents(spark, TEXTS).withColumn("n_tokens", tc.F.lit("x")).withColumn("digest", tc.F.lit("y"))
    out = tc.counted(docs, tc.Tokenizer(PATHS[0]), f"{tmp_path}/cache")
    assert out.columns == [c for c in docs.columns if c != "n_tokens"] + ["n_tokens"]
    assert out.count() == docs.count() and out.where("digest = 'y'").count() == docs.count()


def test_small_tables(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    want = dict(zip(*zip(*[(r["doc_id"], r["text"]) for r in docs.collect()])))
    want = dict(zip(want, by_library(PATHS[0], want.values())))
    assert {r["doc_id"]: r["n_tokens"] for r in tc.report(docs, PATHS[0]).collect()} == want
