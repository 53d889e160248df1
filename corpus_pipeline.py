"""A training-data pipeline over ``documents``: five operators, each stage written and reread.

``STAGES`` holds (name, function); a function takes (spark, docs, sf_dir) and returns the
next documents, the last one their tokens. No SQL can express suffix arrays, sketches or
byte-pair merges, so ``ORACLE_SQL`` is None; tests compare the stages with brute force.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from matchboard.llm.decontamination import decontaminate
from matchboard.llm.merge_replay import bpe_digests
from matchboard.llm.near_dedup import FIVE_WORDS, Similarity, drop_near_duplicates
from matchboard.llm.quality_rules import good_documents
from matchboard.llm.registry import ship, table
from matchboard.llm.suffix_dedup import remove_repeats
from matchboard.sources.staging import stage

ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    ship(spark)
    return good_documents(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at 0.80 or by the rule of operator 5."""
    ship(spark)
    return drop_near_duplicates(docs, Similarity(), FIVE_WORDS)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without strings of 200 bytes that start twice."""
    ship(spark)
    return remove_repeats(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark items."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number and digest of ids, digest of the decoded bytes, and the ids."""
    ship(spark)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe_digests(docs, path, public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near),
    ("suffix_dedup", repeats),
    ("decontamination", benchmark),
    ("byte_bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, for the documents of a data folder."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
