"""Shared pieces: white-space rule, durable intermediate tables, bounded samples."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ontoloom.durable import discard, materialize, scratch, shared_dir

__all__ = ["WS", "discard", "fold", "give_back", "labelled", "materialize", "read", "scratch", "shared_dir", "whole"]

#: The white space that separates words everywhere in this subpackage.
WS = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def give_back() -> None:
    """Hand memory that this process no longer uses back to the system.

    Python workers serve one operator after the other; each would keep what the
    largest of them had needed.
    """
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def whole(text: Column) -> Column:
    """Null counts as empty."""
    return F.coalesce(text.cast("string"), F.lit(""))


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id is in no fold (null)."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(folds))


def labelled(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int, rows: int, most_bytes: int) -> DataFrame:
    """At most ``rows`` labelled documents, of ``most_bytes`` in all, that are not held out: (doc_id, text, y).

    The bounds are the classifiers' documented sample: whole texts in the order
    of a hash of their ids, the same ones at each run; a text of more than an
    eighth of the bytes takes no part. Labels that are null take no part; of
    contradicting ones the largest counts, of texts that share an id the least.
    """
    train = fold(F.col("doc_id"), folds) != held
    ids = docs.select("doc_id").where(train).distinct()
    picked = (
        labels.where(F.col(label).isNotNull() & train)
        .groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
        .join(ids, "doc_id", "left_semi")
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    picked = materialize(picked, "labelled")  # rows are bounded, so the broadcast is
    found = docs.select("doc_id", whole(F.col("text")).alias("text")).where(F.octet_length("text") <= most_bytes // 8).join(F.broadcast(picked), "doc_id")
    found = materialize(found.groupBy("doc_id", "y").agg(F.min("text").alias("text")), "labelled-texts")
    order = Window.orderBy(F.xxhash64("doc_id"), "doc_id")  # of ``rows`` sizes at most
    sizes = found.select("doc_id", F.sum(F.octet_length("text")).over(order).alias("total")).where(F.col("total") <= most_bytes)
    return found.join(F.broadcast(sizes.select("doc_id")), "doc_id", "left_semi")
