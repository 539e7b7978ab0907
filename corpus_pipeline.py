"""From raw documents to packed training sequences; every stage calls one operator of ledgerloom.llm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import decontamination, packing, simhash, substrings, toxicity
from ledgerloom.llm.common import load, stage
from ledgerloom.llm.tokens import default_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the toxicity classifier doesn't reject."""
    return toxicity.without_toxic(docs, load(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that an earlier document has."""
    return substrings.cut_repeats(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in which no window of a benchmark item occurs."""
    return decontamination.without_contaminated(docs, load(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents' pieces in sequences."""
    return packing.pack(docs, default_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

# The tokenizer, the fitted classifier and the packing plan can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents, each written and read again before the next."""
    held, docs = stage(spark, "pipeline"), load(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = held.save(name, function(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
