"""Registered queries of the numbered operators, and the pipeline.

Each applies its operator, with production parameters, to its whole table.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from visitflow.llm import (
    ann_tree,
    bpe,
    epsilon_grid,
    html_mss,
    jaccard_join,
    lexical,
    mixing,
    quality_mil,
    sharding,
    token_align,
    topk_histogram,
    toxicity_nb,
    warc,
)
from visitflow.llm.common import ship, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_ann_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors (cosine) found for every vec_id divisible by 50."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann_tree.search(rows.where(F.col("vec_id") % 50 == 0), rows, k=5)


def op2_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality_mil.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_topk_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 largest integer inner products for every vec_id divisible by 20."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk_histogram.top_k(rows.where(F.col("vec_id") % 20 == 0), rows, k=20, scale=64)


def op4_toxicity_nb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity_nb.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents, epoch by epoch, that the target mix takes."""
    return mixing.mixed_report(table(spark, sf_dir, "documents"))


def op7_html_mss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_mss.extract_pages(table(spark, sf_dir, "pages"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    return bpe.encode_documents(table(spark, sf_dir, "documents"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document: three-word shingles, similarity 0.9 or more."""
    return jaccard_join.components(table(spark, sf_dir, "documents"), jaccard_join.Rule(3, 90, 100))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document: 40 shards of nearly equal bytes."""
    return sharding.shard(table(spark, sf_dir, "documents"), shards=40, law="bytes")


def op11_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's alignment under two tokenizers, with corpus-wide pair counts."""
    return token_align.alignments(table(spark, sf_dir, "documents"))


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest-scoring documents for every benchmark item."""
    return lexical.search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"), k=20)


def op13_epsilon_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector: cosine 0.95 or more."""
    return epsilon_grid.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.95)


def _shipped(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {
    q.__name__: _shipped(q)
    for q in (
        op1_ann_tree,
        op2_quality_mil,
        op3_topk_histogram,
        op4_toxicity_nb,
        op5_warc,
        op6_mixing,
        op7_html_mss,
        op8_bpe,
        op9_jaccard_join,
        op10_sharding,
        op11_token_align,
        op12_lexical,
        op13_epsilon_grid,
    )
} | {"pipeline": _shipped(corpus_pipeline.run)}
