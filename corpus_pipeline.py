"""Cleaning of `documents` into token ids: language, near-duplicates, benchmark passages, personal data, tokens."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsetrail.llm import bpe, decontaminate, langid, pii, simhash
from pulsetrail.llm.common import table
from pulsetrail.session import run_folder

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose language is recognised."""
    return langid.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near-duplicates: SimHash of three-word shingles, linked at
    two or fewer differing bits."""
    return simhash.one_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents without any window of a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked; n_chars follows the text where it changed."""
    before = docs.withColumn("text_before", F.col("text"))
    masked = pii.redact(before)
    n = F.when(F.col("text").eqNullSafe(F.col("text_before")), F.col("n_chars")).otherwise(F.length("text").cast("long"))
    return masked.withColumn("n_chars", n.cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, the packed ids, and the hashes of ids and decoded bytes, for all documents."""
    path, pattern = public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
    return bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), path, pattern).select(
        "doc_id", "lang", "source", F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"), "ids",
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("personal_data", personal_data), ("tokens", tokens)]

# SQL can express neither the trained language filter nor the tokenizer; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs every stage and returns the rows of the last; the jobs run while this is called."""
    docs, base = table(spark, sf_dir, "documents"), run_folder(spark, "corpus")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
