"""What a catalogue's files hold where they are larger than one process takes, or lie in several parts."""

import tracemalloc

import duckdb
import pytest
import yaml
from pyspark.sql import functions as F

from ontoloom.plans import registry
from ontoloom.sources import sinks, tables

SPLIT = "20011"
ODD = ("NO", "a: b", "x # y", "- z", "null", "é", "two\nlines", "it's", 'say "so"', "1", "word " * 40, "ontologies:", "&a", "*a", "#", "a\n- b\nc: d", "", " ")


@pytest.fixture
def pieces(spark, monkeypatch):
    """Every YAML file counts as large and is dealt over tasks of some thousand bytes."""
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    monkeypatch.setattr(tables, "WHOLE_BYTES", 0, raising=False)
    spark.conf.set("spark.sql.files.maxPartitionBytes", SPLIT)
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def rows_of(spark, path, text, key="ontologies"):
    path.write_text(text)
    return sorted(((r.name, r.is_umls) for r in tables.test_list(spark, str(path), key).collect()), key=str)


def test_known_submissions_hold_no_index_in_the_driver(spark, tmp_path, pieces):
    index = spark.range(2000).select(F.concat(F.lit("C"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("id"), F.lit("OK").alias("status"), (F.col("id") % 3).cast("string").alias("submission_id"), F.lit("x" * 100).alias("name"))
    at = str(tmp_path / "i.yaml")
    tracemalloc.start()
    try:
        sinks.index_yaml(index, at)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 2_000_000
    with open(at) as f:
        text = f.read()
    ids = [x[6:] for x in text.splitlines() if x.startswith("- id: ")]
    assert text.startswith("ontologies:\n- id: C00000\n") and ids == sorted(ids) and len(ids) == 2000
    known = tables.index_submissions(spark, at)
    assert known.rdd.getNumPartitions() > 1
    assert sorted(map(tuple, known.collect())) == [(f"C{k:05}", str(k % 3)) for k in range(2000)]


def test_index_round_trip_holds_no_index_in_the_driver(spark, tmp_path, pieces):
    """The whole query: nothing of its 4000 rows in the driver's Python, the file read by several tasks, rows as in SQL."""
    k = F.col("id")
    day = F.when(k % 3 == 0, "1996-02-03").otherwise("1994-02-03").cast("timestamp_ntz")
    orders = spark.range(0, 10_000, 1, 4).select((k * 7 % 4000).alias("o_custkey"), F.when(k % 2 == 0, "F").otherwise("O").alias("o_orderstatus"), day.alias("o_orderdate"))
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    tracemalloc.start()
    try:
        back = registry.QUERIES["index_round_trip"](spark, str(tmp_path))
        back.write.parquet(str(tmp_path / "back"))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 2_000_000
    assert back.rdd.getNumPartitions() > 1
    got = sorted(map(tuple, spark.read.parquet(str(tmp_path / "back")).collect()))
    assert len(got) == 4000 and got == of_sql("index_round_trip", orders=tmp_path / "orders.parquet/*.parquet")


def test_index_in_yaml_is_that_of_the_library(spark, tmp_path):
    rows = [{"id": f"i{k:02}", "name": v, "nodecount": k - 3, "NO": None if k % 2 else "off"} for k, v in enumerate((*ODD, "NO", "1e3", "0x1f", "2024-01-02", "1_0", "y", "C1/x.tar.gz", "a" * 120, "null", "_", "."))]
    sinks.index_yaml(spark.createDataFrame(rows, "id string, name string, nodecount long, NO string"), str(tmp_path / "i.yaml"))
    want = [{k: v for k, v in r.items() if v is not None} for r in rows]
    assert yaml.safe_load((tmp_path / "i.yaml").read_text()) == {"ontologies": want}
    for r in want:
        assert yaml.safe_load(sinks._yaml_item(r)) == [r]
        if len(r["name"]) < 50 and "\n" not in r["name"] and r["name"].isascii():
            assert sinks._yaml_item(r) + "\n" == yaml.safe_dump([r], sort_keys=False, allow_unicode=True)
    sinks.index_yaml(spark.createDataFrame([], "id string"), str(tmp_path / "none.yaml"))
    assert (tmp_path / "none.yaml").read_text() == "ontologies: []\n"



LISTS = {
    "sole": "ontologies:\n- name: A\n  is_umls: true\n- name: B\n",
    "indented": "# list\n---\nontologies:  # of\n\n  - name: A\n    is_umls: true\n    more:\n      - name: x\n  -\n    name: B\n",
    "nested": "ontologies:\n- name: A\n  more:\n  - name: x\n  - y\n  is_umls: true\n- name: B\n",
    "between": "first:\n- name: x\n- plain\nontologies:\n- name: A\n  is_umls: true\n# end\n- name: B\nlast: 1\nmore:\n- name: z\n",
    "flow": "x: 1\nontologies: [{name: A, is_umls: true}, {name: B}]\ny:\n- name: z\n",
    "twice": "ontologies:\n- name: z\nx:\n- q\nontologies:\n- name: A\n  is_umls: true\n- name: B\n",
    "alias": "ontologies:\n- name: &a A\n  is_umls: true\n- name: B\n  other: *a\nx: *a\n",
    "quoted": "ontologies:\n- name: A\n  is_umls: true\n  text: 'b\n\n- name: no\n\n- c'\n- name: B\n",
    "block": "ontologies:\n- name: A\n  text: |\n    x\n    - name: no\n    ontologies:\n  is_umls: true\n- name: B\n",
    "crlf": "ontologies:\r\n- name: A\r\n  is_umls: true\r\n- name: B\r\n",
    "unindented mapping": "ontologies:\n-   name: A\n    is_umls: true\n- {name: B}\n",
}


@pytest.mark.parametrize("kind", LISTS)
def test_yaml_in_pieces(spark, tmp_path, pieces, kind):
    assert rows_of(spark, tmp_path / "l.yaml", LISTS[kind]) == [("A", True), ("B", None)]


def test_yaml_without_the_list(spark, tmp_path, pieces):
    assert rows_of(spark, tmp_path / "a.yaml", "x:\n- name: A\n") == []
    assert rows_of(spark, tmp_path / "b.yaml", "x: 1\nontologies:\ny:\n- name: A\n") == []
    assert rows_of(spark, tmp_path / "c.yaml", "ontologies: []\n") == []


def test_odd_text_in_pieces(spark, tmp_path, pieces):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "997")
    items = [{"name": f"{v} {k}" if k % 3 else v, "is_umls": k % 2 == 0, "more": v} for k, v in enumerate(ODD * 6)]
    text = yaml.safe_dump({"before": list(ODD), "ontologies": items, "after": [{"name": "x"}]}, sort_keys=False, allow_unicode=True)
    want = sorted(((None if r["name"] == "null" else r["name"], r["is_umls"]) for r in items), key=str)
    assert rows_of(spark, tmp_path / "l.yaml", text) == want


def of_sql(name, **files):
    """The rows of a query's SQL over Parquet files."""
    c = duckdb.connect()
    for table, at in files.items():
        c.execute(f"create view {table} as select * from '{at}'")
    return sorted(c.execute(registry.ORACLES[name]).fetchall())


def test_sizes_beyond_gigabytes(spark, tmp_path):
    keys = (0, 1, 31, 32, 1023, 1024, 32767, 32768, 1_048_575, 1_048_576, 1_048_577, 8_999_999, 33_554_432, 3_000_000_000)
    spark.createDataFrame([(k,) for k in keys], "o_orderkey long").coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    got = sorted(map(tuple, registry.QUERIES["human_sizes"](spark, str(tmp_path)).select("o_orderkey", "size").collect()))
    assert (1_048_576, "1024.0 GB") in got
    assert got == of_sql("human_sizes", orders=tmp_path / "orders.parquet/*.parquet")


def test_the_last_row_of_a_report_in_parts(spark, tmp_path):
    """Files are read by size, the largest first; a row's place is that in the report."""
    rows = [(k, "A" if k % 50 == 0 else f"B{k % 7}", f"s{k}") for k in range(1000)]
    parts = (rows[:30], rows[30:100], rows[100:400], rows[400:990], rows[990:])
    at = str(tmp_path / "a report")
    (tmp_path / "a report").mkdir()
    for k, part in enumerate(parts):
        lines = ["\t".join(sinks.REPORT_COLUMNS), *("\t".join([i] + [""] * 4 + [status] + [""] * 3) for _, i, status in part)]
        (tmp_path / "a report" / f"part-{k:05}-x.csv").write_text("\n".join(lines) + "\n")
    want = {i: s for _, i, s in rows}
    for split in ("128m", "1009"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            assert dict(tables.report_by_id(spark, at).select("id", "status").collect()) == want
            assert [r.status for r in tables.download_report(spark, at).orderBy("pos").collect()] == [r[2] for r in rows]
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_parts_follow_by_number(spark, tmp_path):
    for k, ids in ((99_999, "a"), (100_000, "bcd"), (2, "ef")):
        (tmp_path / f"part-{k:05}-x.csv").write_text("id\n" + "".join(f"{i}\n" for i in ids))
    assert [r.id for r in tables.acronyms(spark, str(tmp_path)).orderBy("pos").collect()] == list("efabcd")


def test_last_report_rows_of_more_events(spark, tmp_path):
    """Enough events for several parts of unequal sizes."""
    e = spark.range(0, 60_000, 1, 6).select(F.col("id").alias("event_id"), (F.col("id") * 7 % 1500).alias("user_id"), F.concat(F.lit("t"), (F.col("id") * F.col("id") % 11).cast("string"), F.repeat(F.lit("x"), (F.col("id") / 3000).cast("int"))).alias("event_type"))
    e.write.parquet(str(tmp_path / "events.parquet"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = sorted(map(tuple, registry.QUERIES["last_report_rows"](spark, str(tmp_path)).select("id", "status").collect()))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == of_sql("last_report_rows", events=tmp_path / "events.parquet/*.parquet")
