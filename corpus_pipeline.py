"""Corpus pipeline: quality, toxicity, near duplicates, mix, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes it as
Parquet in the shared folder and reads it again as the next stage's ``docs``. All
stages but the last return the columns of ``docs``.

Rows with null or empty texts are judged like any others: the classifiers score
them, they have no shingles, hold no tokens for the mix and encode to no ids. The
operators' docstrings state what each does with nulls, ties and repeated rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from visitflow.llm import bpe, jaccard_join, mixing, quality_mil, toxicity_nb
from visitflow.llm.common import stored, table

#: Five-word shingles, similarity 0.8 or more.
NEAR = jaccard_join.Rule(words=5, num=80, den=100)
#: No document is read twice: the mix takes each at most once.
MIX_EPOCHS = 1


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least 0.5."""
    return quality_mil.keep_good(docs, table(spark, sf_dir, "labels"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.7."""
    return toxicity_nb.drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component, the one with the smallest doc_id."""
    return jaccard_join.keep_one(docs, NEAR)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the target mix takes."""
    return mixing.mix(docs, max_epochs=MIX_EPOCHS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document left."""
    return bpe.encode_documents(docs)


STAGES = [
    ("quality", quality),
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("mixing", mix),
    ("tokens", tokens),
]

#: The classifiers can't be expressed in SQL; tests/llm compares each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
