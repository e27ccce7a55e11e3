"""The registered queries of the subpackage, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pulsetrail.llm import (
    alignment,
    bpe,
    conversations,
    decontaminate,
    katz,
    langid,
    licenses,
    pii,
    quality,
    simhash,
    token_counts,
    toxicity,
    urls,
)
from pulsetrail.llm.common import table
from pulsetrail.llm.oracle import SQL  # noqa: F401

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": lambda s, d: toxicity.report(table(s, d, "documents"), table(s, d, "labels")),
    "op2_decontamination": lambda s, d: decontaminate.report(table(s, d, "documents"), table(s, d, "benchmark")),
    "op3_language": lambda s, d: langid.report(table(s, d, "documents")),
    "op4_katz": lambda s, d: katz.report(table(s, d, "documents")),
    "op5_pii": lambda s, d: pii.report(table(s, d, "documents")),
    "op6_bpe": lambda s, d: bpe.digests(table(s, d, "documents"), public_tokenizers.path(VOCABULARY),
                                        public_tokenizers.PATTERN),
    "op7_url_templates": lambda s, d: urls.report(table(s, d, "pages")),
    "op8_simhash": lambda s, d: simhash.report(table(s, d, "documents")),
    "op9_licenses": lambda s, d: licenses.report(table(s, d, "documents")),
    "op10_quality": lambda s, d: quality.report(table(s, d, "documents"), table(s, d, "labels")),
    "op11_alignment": lambda s, d: alignment.report(table(s, d, "documents"), public_tokenizers.path(BYTE_LEVEL),
                                                    public_tokenizers.path(PIECES)),
    "op12_token_counts": lambda s, d: token_counts.report(table(s, d, "documents"), public_tokenizers.path(BYTE_LEVEL)),
    "op13_conversations": lambda s, d: conversations.report(table(s, d, "conversations")),
}
