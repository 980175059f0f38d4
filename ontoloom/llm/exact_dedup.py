"""Exact deduplication by two-pass Bloom filtering.

Pass one folds the hashes of all texts into a filter of the bits that were set
twice. Pass two tests each row: rows that miss are unique beyond doubt and
pass straight through; only possible repeats shuffle, and an exact grouping on
SHA-256 settles them. A filter is at most ``bloom.MAX_BLOCKS`` large. Where that
is too small for all hashes (``bloom.repeats``), pass one counts the 8-byte hashes
in shards and the filter holds the repeated ones; no result changes.

Defined cases: a null text counts as empty; empty texts are equal to each
other. Of equal texts the smallest id stays, a null id after all others; of
rows that share both text and smallest id exactly one stays. An empty table
gives an empty result. Extra columns pass through ``dedup`` whatever their
names are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bloom
from .common import WS, materialize, whole


def normal(text: Column) -> Column:
    return F.regexp_replace(whole(text), WS, " ")


def _groups(keys: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """keys (id, sha, h) -> the filter, the groups (sha, keep_id, ties, size) of possible repeats, blocks."""
    filt, blocks = bloom.repeats(keys, "h")
    maybe = bloom.hits(keys, "h", filt, blocks, "maybe").where("maybe")
    by_id = maybe.groupBy("sha", "id").agg(F.count(F.lit(1)).alias("n"))
    least = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "n"))
    groups = by_id.groupBy("sha").agg(least.alias("m"), F.sum("n").alias("size"))
    groups = groups.select("sha", F.col("m.id").alias("keep_id"), F.col("m.n").alias("ties"), "size")
    return filt, materialize(groups, "groups"), blocks


def _keys(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = normal(F.col(text_col))
    return docs.select(F.col(id_col).alias("id"), F.unhex(F.sha2(text, 256)).alias("sha"), F.xxhash64(text).alias("h"))


def decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document, dropped ones too: (id, keep_id, group_size, kept, text_sha256)."""
    keys = materialize(_keys(docs, id_col, text_col), "hashes")
    filt, groups, blocks = _groups(keys)
    tested = bloom.hits(keys, "h", filt, blocks, "maybe")
    alone = tested.where("not maybe").select("id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha")
    met = tested.where("maybe").join(groups, "sha")
    first = F.col("id").eqNullSafe(F.col("keep_id"))
    several = first & (F.col("ties") > 1)
    rows = met.where(~several).select("id", "keep_id", F.col("size").alias("group_size"), first.alias("kept"), "sha")
    if groups.where("ties > 1").isEmpty():
        return _named(alone.unionByName(rows), id_col)
    tied = groups.where("ties > 1").select(
        F.col("keep_id").alias("id"), "keep_id", F.col("size").alias("group_size"), F.explode(F.sequence(F.lit(1).cast("long"), "ties")).alias("k"), "sha"
    ).select("id", "keep_id", "group_size", (F.col("k") == 1).alias("kept"), "sha")
    return _named(alone.unionByName(rows).unionByName(tied), id_col)


def _named(rows: DataFrame, id_col: str) -> DataFrame:
    return rows.select(F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns."""
    keys = materialize(_keys(docs, id_col, text_col), "hashes")
    filt, groups, blocks = _groups(keys)
    text = normal(F.col(text_col))
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.unhex(F.sha2(text, 256)).alias("sha"), F.xxhash64(text).alias("h"))
    tested = bloom.hits(rows, "h", filt, blocks, "maybe")
    alone = tested.where("not maybe").select("row")
    met = tested.where("maybe").join(groups, "sha").where(F.col("id").eqNullSafe(F.col("keep_id")))
    single = met.where("ties = 1").select("row")
    if groups.where("ties > 1").isEmpty():
        return alone.unionByName(single).select("row.*")
    tied = met.where("ties > 1").groupBy("sha").agg(F.first("row").alias("row")).select("row")
    return alone.unionByName(single).unionByName(tied).select("row.*")
