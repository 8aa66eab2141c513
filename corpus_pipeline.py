"""The corpus pipeline: quality, language, near-duplicates, mixing, packing.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's docs. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession

from tesserae.llm import language, mixing, neardup, packing, quality
from tesserae.llm.common import Scratch, table
from tesserae.llm.queries import word_tokenizer


def by_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity under the model of trusted text lies within their language's bounds."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which one known language holds most letters."""
    return language.accepted(docs)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80 % of its five-word shingles."""
    return neardup.representatives(docs, words=5, threshold=Fraction(8, 10))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the sources' target weights ask for."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens and 16 pieces: beside the tokens, the count limits sequences of short documents."""
    return packing.pack_documents(docs, word_tokenizer(), packing.Capacity(documents=16))


STAGES = [
    ("quality classifier", by_quality),
    ("language id", by_language),
    ("near-duplicates", without_near_duplicates),
    ("mixing", mixed),
    ("packing", packed),
]

#: Stages learn models and tokenise: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the table `documents`."""
    scratch, docs = Scratch(spark, "pipeline"), table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"stage{i}")
        if i > 1:
            scratch.drop(f"stage{i - 2}")
    return docs
