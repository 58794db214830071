"""A corpus pipeline: quality rules, near-duplicates, benchmark passages, personal data, packing.

Each stage reads what its predecessor kept and returns the columns of ``documents``; the last returns one row per
packed piece. ``run`` applies the stages to the whole ``documents`` table. Every stage is an operator of
``caseweave.llm`` and takes effect: rejected, duplicate and contaminated documents go, personal data is replaced by
its kind in brackets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from caseweave.llm import decontaminate, near_dedup, packing, pii, quality
from caseweave.llm.common import read, stored
from caseweave.session import ship_package


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the learned decision list keep."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    ship_package(spark)
    return near_dedup.keep_one(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    ship_package(spark)
    return pii.redact(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, with its ids and its place in a sequence."""
    ship_package(spark)
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_passages", benchmark_passages),
    ("personal_data", personal_data),
    ("packed_sequences", packed_sequences),
]

#: Learned rules, sampled candidates and tokenizers have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
