"""From raw documents to packed training sequences.

Each stage works on all that the one before it kept and returns the columns of
``documents``; the last returns packed sequences of tokens. The classifiers learn from
``labels`` as their queries do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontoloom.llm import exact_dedup, near_dedup, quality, queries, toxicity
from ontoloom.llm.common import materialize, read

#: Documents below the first score, or at or above the second, go.
GOOD, TOXIC = 0.7, 0.5


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    rows = docs.select(F.struct("*").alias("row"), quality.score(F.col("text"), model).alias("score"))
    return rows.where(F.col("score") >= GOOD).select("row.*")


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    rows = docs.select(F.struct("*").alias("row"), toxicity.score(F.col("text"), model).alias("score"))
    return rows.where(F.col("score") < TOXIC).select("row.*")


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.dedup(docs, words=5, percent=80)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return queries.sequences(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("toxicity", toxicity_filter),
    ("exact dedup", exact_duplicates),
    ("MinHash near-dedup", near_duplicates),
    ("best-fit packing", best_fit_packing),
]

#: SQL can't express trained classifiers or sketches; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written and read again before the next."""
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"stage{k}")
    return docs
