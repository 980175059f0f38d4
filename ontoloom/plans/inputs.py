"""The test tables in the shapes that the operators take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as a download report, their outcome by what their key leaves modulo small numbers."""
    k = F.col("s_suppkey")
    reason = F.when(k % 7 == 0, "license_restricted").when(k % 11 == 0, "too_large").when(k % 13 == 0, "no_submission").otherwise("")
    status = F.when(reason == "", "downloaded").when(reason == "too_large", "skipped").otherwise("error")
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("S"), k.cast("string")).alias("id"), F.col("s_name").alias("name"), F.lit("1").alias("version"), (k % 5).cast("string").alias("submission_id"),
        (k * 100).alias("source_bytes"), status.alias("status"), reason.alias("reason"), k.alias("pos"),
    )


REPORT_SQL = """
SELECT 'S' || s_suppkey AS id, s_name AS name, '1' AS version, CAST(s_suppkey % 5 AS VARCHAR) AS submission_id, s_suppkey * 100 AS source_bytes,
  CASE WHEN s_suppkey % 7 = 0 THEN 'error' WHEN s_suppkey % 11 = 0 THEN 'skipped' WHEN s_suppkey % 13 = 0 THEN 'error' ELSE 'downloaded' END AS status,
  CASE WHEN s_suppkey % 7 = 0 THEN 'license_restricted' WHEN s_suppkey % 11 = 0 THEN 'too_large' WHEN s_suppkey % 13 = 0 THEN 'no_submission' ELSE '' END AS reason,
  s_suppkey AS pos FROM supplier
"""


def _slice(spark: SparkSession, sf_dir: str, newer: bool) -> DataFrame:
    """Per customer, its orders of one half of the time as an index row."""
    o = table(spark, sf_dir, "orders")
    half = F.to_date(F.lit("1995-07-01")).cast("timestamp_ntz")
    o = o.where(F.col("o_orderdate") >= half) if newer else o.where(F.col("o_orderdate") < half)
    g = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("nodecount"), F.count_if(F.col("o_orderstatus") == "F").alias("edgecount"))
    ok = F.col("o_custkey") % 9 != 0 if newer else F.lit(True)
    id_ = F.concat(F.lit("C"), F.col("o_custkey").cast("string"))
    out = g.select(
        id_.alias("id"), F.when(ok, "OK").otherwise("Failed").alias("status"), F.when(ok, "").otherwise("transform_error").alias("reason"), id_.alias("name"), F.lit("1").alias("version"),
        F.when(ok, F.col("nodecount")).otherwise(0).alias("nodecount"), F.when(ok, F.col("edgecount")).otherwise(0).alias("edgecount"), (F.col("o_custkey") % 3).cast("string").alias("submission_id"), F.col("o_custkey").alias("pos"),
    )
    return out if newer else out.withColumn("download_url", F.concat(F.lit("base/"), "id", F.lit(".tar.gz")))


def base_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _slice(spark, sf_dir, False)


def fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _slice(spark, sf_dir, True)


BASE_SQL = """
SELECT 'C' || o_custkey AS id, 'OK' AS status, '' AS reason, 'C' || o_custkey AS name, '1' AS version, count(*) AS nodecount,
  count(*) FILTER (o_orderstatus = 'F') AS edgecount, CAST(o_custkey % 3 AS VARCHAR) AS submission_id, o_custkey AS pos, 'base/C' || o_custkey || '.tar.gz' AS download_url
FROM orders WHERE o_orderdate < TIMESTAMP '1995-07-01' GROUP BY o_custkey
"""
FRAGMENT_SQL = """
SELECT 'C' || o_custkey AS id, CASE WHEN o_custkey % 9 <> 0 THEN 'OK' ELSE 'Failed' END AS status, CASE WHEN o_custkey % 9 <> 0 THEN '' ELSE 'transform_error' END AS reason,
  'C' || o_custkey AS name, '1' AS version, CASE WHEN o_custkey % 9 <> 0 THEN count(*) ELSE 0 END AS nodecount,
  CASE WHEN o_custkey % 9 <> 0 THEN count(*) FILTER (o_orderstatus = 'F') ELSE 0 END AS edgecount, CAST(o_custkey % 3 AS VARCHAR) AS submission_id, o_custkey AS pos,
  CASE WHEN o_custkey % 9 <> 0 THEN 'new/C' || o_custkey || '.tar.gz' END AS download_url
FROM orders WHERE o_orderdate >= TIMESTAMP '1995-07-01' GROUP BY o_custkey
"""
INDEX_SQL = f"""
WITH b AS ({BASE_SQL}), f AS ({FRAGMENT_SQL}),
idx AS (SELECT * FROM f UNION ALL BY NAME SELECT * FROM b WHERE id NOT IN (SELECT id FROM f))
"""


def resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as registered resources: their line items' parts are products, parts' brands the products' sources."""
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    source = F.concat(F.lit("R"), ((F.col("l_partkey") * 7) % 50).cast("string"))
    product = F.struct(
        F.col("l_orderkey").alias("pos"), F.col("l_linenumber").alias("line"), F.col("l_partkey").cast("string").alias("id"), F.lit(None).cast("string").alias("name"),
        F.when(F.col("l_partkey") % 3 == 0, "GraphProduct").otherwise("Product").alias("category"),
        F.element_at(F.array(F.lit("kgx"), F.lit("ttl"), F.lit(""), F.lit("json")), (F.col("l_partkey") % 4 + 1).cast("int")).alias("format"),
        F.when(F.col("l_partkey") % 5 != 0, F.col("l_quantity").cast("long") * 1000).alias("node_count"), (F.col("l_orderkey") % 1000).alias("edge_count"),
        F.transform(F.sequence(F.lit(1), (F.col("l_partkey") % 4 + 1).cast("int")), lambda i: F.concat(F.lit("c"), i.cast("string"))).alias("node_categories"),
        F.array(F.lit("p1"), F.lit("p2")).alias("predicates"), F.array(F.struct(source.alias("source"))).alias("original_source"),
    )
    # by order key and line number, then by the rest, as line items can repeat both: so that the list is stable
    lists = li.groupBy(F.col("l_suppkey").alias("k")).agg(F.sort_array(F.collect_list(product)).alias("p"))
    products = F.transform("p", lambda x: F.struct(*[x[c].alias(c) for c in ("id", "name", "category", "format", "node_count", "edge_count", "node_categories", "predicates", "original_source")]))
    return lists.select(
        F.concat(F.lit("R"), F.col("k").cast("string")).alias("id"), F.when(F.col("k") % 6 != 0, F.concat(F.lit("Resource "), F.col("k").cast("string"))).alias("name"), F.lit("d").alias("description"),
        F.when(F.col("k") % 2 == 0, "KnowledgeGraph").otherwise("Other").alias("category"), F.array(F.concat(F.lit("dom"), (F.col("k") % 15).cast("string"))).alias("domains"),
        F.when(F.col("k") % 4 == 0, "active").alias("activity_status"), F.lit("2024-05-06T07").alias("last_modified_date"), products.alias("products"), F.col("k").cast("long").alias("pos"),
    )


#: One row for each product, in the order of a resource's products.
PRODUCT_SQL = """
SELECT l_suppkey AS k, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR), l_quantity) AS i,
  CASE WHEN l_partkey % 3 = 0 THEN 'GraphProduct' ELSE 'Product' END AS category, (['kgx', 'ttl', '', 'json'])[l_partkey % 4 + 1] AS format,
  CASE WHEN l_partkey % 5 <> 0 THEN CAST(l_quantity AS BIGINT) * 1000 END AS node_count, l_orderkey % 1000 AS edge_count, l_partkey % 4 + 1 AS ncat,
  'R' || CAST((l_partkey * 7) % 50 AS VARCHAR) AS source, CAST(l_partkey AS VARCHAR) AS id
FROM lineitem
"""
