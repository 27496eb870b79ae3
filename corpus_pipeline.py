"""From raw documents to packed training sequences, in five stages over the whole table.

Each stage takes all that its predecessor kept, as written Parquet, and returns a DataFrame: documents
with the columns they came with, or, at the end, the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgermill.llm import jaccard, mixing, packing, pii, rules
from ledgermill.llm.common import staged, table

# The largest source is read once, none more often than this.
MOST_READINGS = 2.0


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass policy v1 of the rule ledger."""
    return rules.apply_rules(docs, "v1")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard.drop_near_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind, and their length brought up to date."""
    return pii.redact(docs, length="n_chars")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once or more, as the weights of its source ask."""
    return mixing.repeat_documents(docs, repetition=MOST_READINGS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mix_sources", mix_sources),
    ("pack", pack),
]

# Similarity joins, trained span classifiers and tokenizers have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written to the scratch folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
