"""The corpus pipeline: stages that each read what the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scorefold.llm import decontaminate, packing, secrets, simhash, toxicity
from scorefold.llm.components import written
from scorefold.llm.queries import table, tokenizer_file

#: SQL has neither the models nor the fingerprints; the tests compare with brute force.
ORACLE_SQL = None


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; the model learns from all labels."""
    return toxicity.without_toxic(docs, toxicity.trained(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, that with the smallest id."""
    return simhash.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets in their texts are masked."""
    return secrets.redacted(docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of token sequences that training reads."""
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity_filter),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark_decontamination),
    ("secrets", secret_redaction),
    ("packing", sequence_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written before the next stage reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
