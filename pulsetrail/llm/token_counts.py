"""Token counts through a cache of digests.

A row of the cache is the digest of a normalised content under the digest of a tokenizer version, with the count. Contents
are looked up by a join; only distinct contents without a stored count are encoded, once each, and appended.

* `Tokenizer` names a file, its library and the content's normal form. Its version digest covers the bytes of the file, the
  library, the library's version and the settings of the calls, so that another file or release never meets old counts.
* A normal form only undoes what the tokenizer itself ignores, as its file says: nothing for most; lower case of A-Z and
  one blank for runs of white space where the file's own normaliser does the same.
* Contents travel as 256-bit digests. Texts move only where they have to be encoded: the first of each digest in a task
  goes on (so a text that a third of all rows repeat is one row per task), is matched with the misses and encoded after one
  more fold by digest.

Null texts are empty: no tokens, no bytes. Empty and blank texts, repeated rows and long texts have no special treatment; a
text of any length is one call of the library. Rows come out once each, whatever their id. Columns of the input that share
a name with a new column are kept in the row and do not disturb (`counted` returns the input's columns and `n_tokens`,
which replaces one of that name).
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from importlib.metadata import version

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsetrail.llm.common import quoted, scan, spread_join, wrapped
from pulsetrail.session import run_folder

LIMIT = 512          # tokens above which a text is over the limit
BATCH_CHARS = 1 << 20  # characters that one call of a library takes, unless one text is longer
CACHE_SCHEMA = "digest binary, n_tokens long"


@dataclass(frozen=True)
class Tokenizer:
    """A tokenizer file for `tokenizers` (.json) or `sentencepiece` (.model)."""

    path: str

    @property
    def library(self) -> str:
        return "tokenizers" if self.path.endswith(".json") else "sentencepiece"

    def content(self) -> bytes:
        with open(self.path, "rb") as f:
            return f.read()

    def version(self) -> str:
        """Hex digest of all that a count depends on besides the text."""
        told = [self.library, version(self.library), "no special tokens added", hashlib.sha256(self.content()).hexdigest()]
        return hashlib.sha256("\n".join(told).encode()).hexdigest()

    def normal(self, text: Column) -> Column:
        """Texts with the same normal form have the same count."""
        text = F.coalesce(text, F.lit(""))
        if self.library != "tokenizers":
            return text
        steps = json.loads(self.content())["normalizer"] or {}
        steps = steps["normalizers"] if steps.get("type") == "Sequence" else [steps]
        if any(s.get("type") == "Replace" and s["pattern"] == {"Regex": r"\s+"} and s["content"] == " " for s in steps):
            text = F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")
        if any(s.get("type") == "Lowercase" for s in steps):
            upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
            text = F.translate(text, upper, upper.lower())
        return text


def counter(library: str, content: bytes) -> Callable[[list[str]], list[int]]:
    """The library's counts of a list of texts: no special tokens added, no truncation or padding."""
    if library == "tokenizers":
        from tokenizers import Tokenizer as Library

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals the work out
        own = Library.from_str(content.decode())
        own.no_truncation()
        own.no_padding()
        return lambda texts: [len(x) for x in own.encode_batch_fast(texts, add_special_tokens=False)]
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_proto=content)
    return lambda texts: [len(x) for x in own.encode(texts, add_bos=False, add_eos=False, num_threads=1)]


def slices(texts: list[str]) -> Iterator[list[str]]:
    """Runs of texts of at most BATCH_CHARS characters together, or a single longer one."""
    part, size = [], 0
    for text in texts:
        if part and size + len(text) > BATCH_CHARS:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def stored(spark: SparkSession, cache: str, tokenizer: Tokenizer) -> DataFrame:
    """(digest, n_tokens) of one tokenizer version; a digest that two runs appended at once comes once."""
    try:
        rows = spark.read.schema(CACHE_SCHEMA).parquet(f"{cache}/tokenizer={tokenizer.version()}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CACHE_SCHEMA)
    return rows.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))


def first_of_each(texts: DataFrame) -> DataFrame:
    """(digest, text): of each digest in a task the first row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            keep = []
            for key in batch.column("digest").to_pylist():
                keep.append(key not in seen)
                seen.add(key)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return texts.select("digest", "text").mapInArrow(run, "digest binary, text string")


def misses(contents: DataFrame, known: DataFrame) -> DataFrame:
    """(digest, text) of each distinct content without a stored count, once."""
    wanted = contents.select("digest").distinct().join(known.select("digest"), "digest", "left_anti")
    # A plain join: its layout by digest serves the fold as well, so texts move once; where few are wanted, Spark broadcasts
    # these and only their texts move.
    found = first_of_each(contents).join(wanted, "digest", "left_semi")
    return found.groupBy("digest").agg(F.any_value("text").alias("text"))


def counts_of(texts: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """Adds `n_tokens` to every row of (text, ...). The tokenizer's file is broadcast; its size does not depend on data."""
    library, content = tokenizer.library, texts.sparkSession.sparkContext.broadcast(tokenizer.content())

    def start():
        count = counter(library, content.value)
        return lambda batch: [(n,) for part in slices([t or "" for t in batch]) for n in count(part)]

    return scan(texts, start, "n_tokens long")


def fill(docs: DataFrame, tokenizer: Tokenizer, cache: str, text: str = "text") -> None:
    """Appends the counts of the contents that the cache does not have. A job; a failed one leaves nothing behind, a
    repeated one finds nothing to do."""
    normal = docs.select(tokenizer.normal(F.col(quoted(text))).alias("text"))
    fresh = misses(normal.withColumn("digest", digest(F.col("text"))), stored(docs.sparkSession, cache, tokenizer))
    counted = counts_of(fresh, tokenizer).select("digest", "n_tokens")
    counted.write.mode("append").parquet(f"{cache}/tokenizer={tokenizer.version()}")


def counted(docs: DataFrame, tokenizer: Tokenizer, cache: str, text: str = "text") -> DataFrame:
    """The rows of `docs` with `n_tokens`, a long; fills the cache first (a job runs when this is called)."""
    fill(docs, tokenizer, cache, text)
    keyed = wrapped(docs, text).withColumn("digest", digest(tokenizer.normal(F.col(quoted(text))))).select("row", "digest")
    out = spread_join(keyed, stored(docs.sparkSession, cache, tokenizer), "digest")
    return out.select(*[F.col("row")[c].alias(c) for c in docs.columns if c != "n_tokens"], "n_tokens")


def report(docs: DataFrame, path: str, cache: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit; one row per input row. Without a cache folder a new one is filled."""
    tokenizer, cache = Tokenizer(path), cache or run_folder(docs.sparkSession, "token-counts")
    fill(docs, tokenizer, cache)
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"),
                        digest(tokenizer.normal(F.col("text"))).alias("digest"))
    return spread_join(keyed, stored(docs.sparkSession, cache, tokenizer), "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))
