"""The registered queries: thin digests of the operators' results, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, chat, exact_dedup, near_dedup, packing, quality, toxicity, url_filter, warc
from .common import fold, read


def sequences(docs: DataFrame) -> DataFrame:
    """Texts as packed sequences of the public vocabulary's ids."""
    import public_tokenizers

    vocabulary = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    tokens = bpe.encode_by_library(F.col("text"), vocabulary, public_tokenizers.PATTERN)
    return packing.pack(docs, tokens, bpe.width_of(vocabulary)).withColumnRenamed("ids", "doc_ids")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences(read(spark, sf_dir, "documents"))


#: The rules of the URL query: (verdict, host and path).
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_filter.judge(pages, url_filter.rules_table(spark, RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op3_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ann.search(read(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)
    return found.withColumnRenamed("id", "vec_id")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decisions(read(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", _held(toxicity.FOLDS, toxicity.HELD), toxicity.score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op6_warc_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as WARC records against a replica with planted faults.

    In the replica the letter after the first hundred of every page whose id
    leaves 13 modulo 97 is overwritten, and records whose id leaves 5 modulo
    1009 are lost.
    """
    pages = read(spark, sf_dir, "pages")
    rotten = F.when(F.col("page_id") % 97 == 13, F.overlay("html", F.lit("#"), F.lit(101))).otherwise(F.col("html"))
    replica = warc.records(pages, rotten).where("page_id is null or page_id % 1009 <> 5")
    return warc.audit(warc.records(pages), replica).withColumnRenamed("offset", "start")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", _held(quality.FOLDS, quality.HELD), quality.score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render(read(spark, sf_dir, "conversations"))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.components(read(spark, sf_dir, "documents"), words=3, percent=85)
    kept = F.col("id").eqNullSafe(F.col("component_id"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", kept.alias("kept"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    ids = read(spark, sf_dir, "documents").select("doc_id", bpe.encode(F.col("text"), vocabulary, public_tokenizers.PATTERN).alias("ids"))
    both = ids.select("doc_id", "ids", bpe.decode(F.col("ids"), vocabulary).alias("decoded"))
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def _held(folds: int, held: int):
    return F.coalesce(fold(F.col("doc_id"), folds) == held, F.lit(False)).alias("held_out")


_QUERIES = (
    op1_best_fit_packing, op2_url_filter, op3_ann, op4_exact_dedup, op5_toxicity,
    op6_warc_audit, op7_quality, op8_chat_format, op9_minhash_near_dedup, op10_byte_bpe,
)
ALL: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _QUERIES}
