"""Registered queries of the operators, over whole tables."""

from __future__ import annotations

import pathlib
import tempfile
import zipfile

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from matchboard.llm.decontamination import SQL as OP6_SQL
from matchboard.llm.decontamination import contamination
from matchboard.llm.html_text import extract_main_text
from matchboard.llm.merge_replay import bpe_digests
from matchboard.llm.near_dedup import near_duplicates
from matchboard.llm.packed_tokens import token_digests
from matchboard.llm.prefix_trie import SQL as OP12_SQL
from matchboard.llm.prefix_trie import prefix_trie
from matchboard.llm.quality_rules import quality_rules
from matchboard.llm.small_world import SQL as OP11_SQL
from matchboard.llm.small_world import near_vectors
from matchboard.llm.substring_dedup import earlier_digests
from matchboard.llm.suffix_dedup import repeat_digests
from matchboard.llm.token_counts import token_counts
from matchboard.llm.turn_repair import repair_report
from matchboard.llm.zstd_quality import quality_scores

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, and keep Arrow batches small.

    Tasks run side by side in an executor, and texts are expanded inside them.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = pathlib.Path(__file__).resolve().parents[2]
    path = pathlib.Path(tempfile.mkdtemp()).resolve() / "matchboard_llm.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in (root / "matchboard").rglob("*.py"):
            archive.write(file, file.relative_to(root))
    context.addPyFile(str(path))
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_digests(table(spark, sf_dir, "documents"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op4_packed_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_merge_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe_digests(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash", "hit")


def op7_zstd_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return earlier_digests(table(spark, sf_dir, "documents"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_report(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_html_extraction": op3_html_extraction,
    "op4_packed_tokens": op4_packed_tokens,
    "op5_near_dedup": op5_near_dedup,
    "op6_decontamination": op6_decontamination,
    "op7_zstd_quality": op7_zstd_quality,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_token_counts": op9_token_counts,
    "op10_merge_replay": op10_merge_replay,
    "op11_embedding_dedup": op11_embedding_dedup,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_turn_repair": op13_turn_repair,
}

ORACLE = {"op6_decontamination": OP6_SQL, "op11_embedding_dedup": OP11_SQL, "op12_prefix_trie": OP12_SQL}
