"""Cleaning of a training corpus, stage by stage: poor text, exact copies, near copies and benchmark leaks go, and what
is left is packed into training windows."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linetally.env import written
from linetally.llm import decontaminate, exact_dedup, jaccard_join, packing, quality
from linetally.llm.common import fresh, learns, table

#: Documents under this score are rejected.
LEAST_QUALITY = 0.3


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled classifier does not reject; it learns from four fifths of them."""
    model, _ = quality.trained(docs, table(spark, sf_dir, "labels"), learns("doc_id", 5, 0))
    (score,) = fresh(docs.columns, "__score")
    return quality.with_score(docs, model, score).where(F.col(score) >= LEAST_QUALITY).drop(score)


def without_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, that with the largest id."""
    return exact_dedup.without_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 5-word shingles at a similarity of 0.75, that with the smallest id."""
    return jaccard_join.without_near_copies(docs)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"), short_items=True)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 4096 tokens, with their ids."""
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", without_exact_copies),
    ("n-gram Jaccard join", without_near_copies),
    ("benchmark decontamination", without_leaks),
    ("packing", packed),
]

#: A classifier, a transitive closure and a tokenizer: not for SQL. Tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
