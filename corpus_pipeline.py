"""A corpus from raw documents to packed sequences: quality rules, deduplication in three steps, packing.

Each stage works on what its predecessor kept, written as Parquet below ``spark.checkpoint.dir`` and read back, so that a
lost executor costs no earlier stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tickflow.llm.common import documents, stored
from tickflow.llm.exact_dedup import drop_exact_copies
from tickflow.llm.line_frequency import keep_good_documents
from tickflow.llm.simhash_golay import drop_near_copies
from tickflow.llm.slack_packing import packed
from tickflow.llm.suffix_dedup import drop_repeated_passages

TOKENIZER = "word_bpe_49k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go, and too frequent lines of the others."""
    return keep_good_documents(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of equal documents stays."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return drop_near_copies(docs)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds go."""
    return drop_repeated_passages(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids with their place in a sequence."""
    return packed(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("passage_dedup", passage_dedup),
    ("packing", packing),
]

#: SQL can't pack with least slack, nor remove passages byte by byte.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
