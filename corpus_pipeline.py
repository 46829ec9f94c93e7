"""From raw documents to token ids: quality rules, near-duplicates, personal data, source weights, encoding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again
as the next stage's `docs`. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stockloom.llm import bpe, mixing, pii, quality_rules, simhash
from stockloom.llm.common import stored
from stockloom.llm.queries import surrogate_key, table, vocabulary_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy rejects go."""
    return quality_rules.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.first_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets give way to surrogates."""
    return pii.replace_entities(docs, surrogate_key()).select(*docs.columns)


def source_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources repeat or thin out to the square root of their sizes; rows are shuffled."""
    return mixing.mix(docs).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row."""
    carried = [c for c in docs.columns if c.lower() not in ("text", "token_ids")]
    return bpe.encode(docs, vocabulary_path(), carry=carried)


STAGES = [
    ("quality_rules", quality), ("near_duplicates", near_duplicates), ("pii_surrogates", personal_data),
    ("poisson_mix", source_weights), ("encode", encode),
]

# The fingerprints, surrogates and token ids of the later stages have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, name)
    return docs
