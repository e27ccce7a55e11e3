import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from edge import documents, no_documents
from hypothesis import given, settings
from hypothesis import strategies as st

from pulsetrail.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
RANKS = bpe.read_ranks(PATH)
OTHER = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})
MINE = bpe.ByteBpe(RANKS, PATTERN)


def ids(text):
    return np.frombuffer(MINE.encode(text), "<u4").tolist()


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=200), st.text("ab '\nsé1.\t", max_size=300), st.text("aaab", max_size=200)))
def test_same_ids_as_the_other_library(text):
    assert ids(text) == OTHER.encode_ordinary(text)
    assert MINE.decode(MINE.encode(text)) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.text("ab '\n\t  é1.x", max_size=300), st.sampled_from([2, 5, 8]), st.sampled_from([2, 4]))
def test_small_leaves_join_exactly(text, chars, size):
    before = bpe.LEAF_CHARS, bpe.LEAF_BYTES
    bpe.LEAF_CHARS, bpe.LEAF_BYTES = chars, size
    try:
        own = bpe.ByteBpe(RANKS, PATTERN)
        assert np.frombuffer(own.encode(text), "<u4").tolist() == OTHER.encode_ordinary(text)
    finally:
        bpe.LEAF_CHARS, bpe.LEAF_BYTES = before


@pytest.mark.parametrize("text", ["a" * 50_000, "ab" * 30_000, " " * 20_000 + "x", "xyzzy" * 9_000, "\n" * 9_000, "é" * 9_001])
def test_long_runs(text):
    assert ids(text) == OTHER.encode_ordinary(text)


def test_report(spark):
    docs = documents(spark)
    got = bpe.digests(docs, PATH, PATTERN).collect()
    texts = [r["text"] or "" for r in docs.collect()]
    want = sorted((len(e := OTHER.encode_ordinary(t)), hashlib.sha256(np.array(e, "<u4").tobytes()).hexdigest(),
                   hashlib.sha256(t.encode()).hexdigest()) for t in texts)
    assert sorted((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got) == want
    assert bpe.digests(no_documents(spark), PATH, PATTERN).count() == 0
