"""A corpus pipeline: five stages, each on all that its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wearlake.llm import bpe, decontaminate, line_dedup, minhash, quality_rules
from wearlake.llm.common import kept, table

NEAR_PERCENT = 80


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.passing(docs)


def repeated_lines_cut(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, later copies of runs of lines cut; ``n_chars`` follows the text."""
    return line_dedup.cut_texts(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return minhash.one_of_each(docs, percent=NEAR_PERCENT)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids and what these decode to."""
    vocabulary = bpe.Vocabulary(
        spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )
    return bpe.decode(bpe.encode(docs, vocabulary), vocabulary, content="decoded")


STAGES = [
    ("quality_rules", good_quality),
    ("line_dedup", repeated_lines_cut),
    ("minhash_near_dedup", one_of_each_group),
    ("decontamination", no_benchmark),
    ("byte_bpe", encoded),
]

# Minima and merges are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
