"""Null ids and repeated rows in bulk: defined results, and no task that gets them all."""

import gzip

from pyspark.sql import functions as F

from ontoloom.llm import ann, chat, near_dedup, url_filter, warc


def test_pages_without_ids_spread_over_files(spark):
    pages = spark.range(4000).select(F.when(F.col("id") % 4 == 0, F.col("id")).alias("page_id"), F.lit("http://x").alias("url"), F.concat(F.lit("h"), F.col("id").cast("string")).alias("html"))
    got = warc.records(pages)
    sizes = {r.file: r["count"] for r in got.where("page_id is null").groupBy("file").count().collect()}
    assert sum(sizes.values()) == 3000 and all(f < 0 for f in sizes) and len(sizes) == 11 and max(sizes.values()) < 450
    assert got.select("file", "offset").distinct().count() == 4000
    assert warc.audit(got, got).count() == 0
    assert {(r.problem, r["count"]) for r in warc.audit(got, got.where("offset > 0")).groupBy("problem").count().collect()} == {("missing", got.where("offset = 0").count())}


def test_equal_pages_lie_one_behind_the_other(spark):
    pages = spark.range(3000).select(F.lit(7).cast("long").alias("page_id"), F.lit("u").alias("url"), F.lit("h").alias("html"))
    rows = warc.records(pages)
    n = rows.first().length
    assert sorted(r.offset for r in rows.collect()) == [n * k for k in range(3000)]
    assert warc.audit(rows, rows.where(F.col("offset") != 0)).count() == 1


def test_warc_files_are_scanned(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://{i}", "\u00fc" * (i % 50) + "\r\n\r\nWARC/1.1") for i in range(300)], "page_id long, url string, html string")
    want = {(r.file, r.offset, r.length, bytes(r.hash)) for r in warc.records(pages).collect()}
    data = {}
    for r in pages.select("page_id", warc.record(F.col("url"), F.col("html"), F.col("page_id")).alias("r")).orderBy("page_id").collect():
        data.setdefault(r.page_id // 256, []).append(bytes(r.r))
    for side in ("a", "b", "z"):
        (tmp_path / side).mkdir()
        for f, records in data.items():
            whole = b"".join(map(gzip.compress, records)) if side == "z" else b"".join(records)
            (tmp_path / side / str(f)).write_bytes(whole.replace(b"http://77", b"http://78") if side == "b" else whole)
    read = lambda side: warc.scan(spark.read.format("binaryFile").load(str(tmp_path / side))).withColumn("file", F.regexp_extract("file", "[0-9]+$", 0))
    a = read("a")
    assert {(int(r.file), r.offset, r.length, bytes(r.hash)) for r in a.collect()} == want
    assert [(r.file, r.problem) for r in warc.audit(a, read("b")).collect()] == [("0", "changed")]
    assert read("z").count() == 300 and read("z").agg(F.sum("length")).first()[0] == sum(len(gzip.compress(x)) for v in data.values() for x in v)
    odd = spark.createDataFrame([("p", bytearray(b"no warc")), ("q", bytearray(b"\x1f\x8bbroken")), ("r", bytearray(b"")), ("s", None)], "path string, content binary")
    assert {(r.file, r.offset, r.length) for r in warc.scan(odd).collect()} == {("p", 0, 7), ("q", 0, 8)}


def test_turns_without_a_conversation(spark):
    turns = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.col("id")).alias("conv_id"), F.lit(0).cast("long").alias("turn"), F.lit("user").alias("role"), F.concat(F.lit("t"), (F.col("id") % 10).cast("string")).alias("text"))
    got = sorted((r.conv_id, r.n_turns, r.copies, r.text) for r in chat.render(turns).collect())
    assert got == sorted((min(i for i in range(3000) if i % 10 == k and i % 3 == 0), 1, 300, f"<|user|>\nt{k}\n") for k in range(10))
    only = chat.render(turns.where("conv_id is null")).collect()
    assert len(only) == 10 and all(r.conv_id is None and r.copies == 200 for r in only)


def test_repeated_turns(spark):
    turns = spark.range(2000).select(F.lit(5).cast("long").alias("conv_id"), F.lit(1).cast("long").alias("turn"), F.lit("user").alias("role"), F.lit("again").alias("text"))
    got = chat.render(turns).first()
    assert (got.n_turns, got.copies, len(got.text)) == (2000, 1, 2000 * len("<|user|>\nagain\n"))


def test_near_dedup_of_repeated_and_null_ids(spark):
    """1,000 rows of one id and text, 1,000 copies without ids, one near copy of each and a text of its own."""
    text = " ".join(f"w{k}" for k in range(100))
    other = " ".join(f"v{k}" for k in range(100))
    rows = spark.range(1000).select(F.lit(9).cast("long").alias("doc_id"), F.lit(text).alias("text")).unionByName(spark.range(1000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(other).alias("text")))
    more = spark.createDataFrame([(3, text + " x"), (None, other + " y"), (4, "a text of its own here")], rows.schema)
    got = near_dedup.components(rows.unionByName(more)).groupBy("id", "component_id").count().collect()
    assert {(r.id, r.component_id, r["count"]) for r in got} == {(9, 3, 1000), (3, 3, 1), (None, None, 1001), (4, 4, 1)}


def test_urls_in_bulk(spark):
    pages = spark.range(3000).select(F.when(F.col("id") % 2 == 0, F.col("id") % 5).alias("page_id"), F.when(F.col("id") % 3 > 0, "http://a.net/x").alias("url"), F.lit(1).alias("a.b"), F.lit(2).alias("__id"), F.lit("mine").alias("Host"))
    got = url_filter.judge(pages, url_filter.rules_table(spark, [("block", "net/")]))
    assert got.columns == ["page_id", "url", "a.b", "__id", "host", "path", "rule", "verdict"]
    assert {(r.url, r.host, r.rule, r.verdict): r["count"] for r in got.groupBy("url", "host", "rule", "verdict").count().collect()} == {("http://a.net/x", "a.net", "net/", "block"): 2000, (None, "", None, "allow"): 1000}


def test_one_vector_many_times(spark):
    # 1,001 rows have the id 100
    v = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 100).otherwise(F.col("id")).alias("vec_id"), F.array(F.lit(1.0), F.lit(2.0)).alias("embedding")).where("vec_id = 100 or vec_id % 100 > 0")
    got = ann.search(v, F.col("id") == 100, k=3)
    assert got.count() == 3003 and got.where("score = 0").count() == 3003 and {(r.rank, r.id) for r in got.distinct().collect()} == {(1, 1), (2, 2), (3, 4)}
