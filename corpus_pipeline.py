"""The corpus pipeline: language ID, quality rules, near-duplicates, decontamination, BPE. Every stage is written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siftwright.llm import bpe, decontaminate, language_id, quality_rules, simhash
from siftwright.llm.common import materialize
from siftwright.llm.vocabularies import pieces, word_bpe

#: Near-duplicates share at least NEAR_SHARE of their NEAR_SHINGLE-word shingles, compared exactly. Candidates are pairs whose fingerprints of three-word
#: shingles differ by NEAR_REACH bits or fewer, and all pairs of a group linked at NEAR_BITS (README).
NEAR_WORDS, NEAR_BITS, NEAR_REACH = 3, 7, 11
NEAR_SHINGLE, NEAR_SHARE = 5, 0.8


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose best learned language has a posterior of 0.5 among the learned ones, which are those that documents name. Texts in other languages
    pass too, as some learned language is always best; in effect only texts without letters go."""
    return language_id.keep(docs, language_id.fit(docs, pieces()))


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the plain and the divergence rules keep."""
    return quality_rules.keep(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group."""
    return simhash.keep_near(docs, words=NEAR_WORDS, core=NEAR_BITS, reach=NEAR_REACH, shingle=NEAR_SHINGLE, least=NEAR_SHARE)


def decontaminate_from_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no copy of a benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """For each document its tokens' number and digests."""
    return bpe.round_trip(docs, word_bpe())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", identify_language),
    ("quality rules", apply_quality_rules),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", decontaminate_from_benchmark),
    ("BPE encoding and decoding", encode_bpe),
]

#: SQL can't express the stages; tests/llm/test_pipeline.py holds them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
