"""Repeated and null ids, records that share an offset."""

from ontoloom.llm import near_dedup, warc


def test_one_near_copy_stays_without_distinct_ids(spark):
    """Five near copies that share an id, and five, of two equal word lists at least, that have none; texts of few words stay."""
    base = [f"w{k}" for k in range(300)]
    rows = [(7, " ".join(base[:-1] + [f"a{k}"])) for k in range(5)]
    rows += [(None, " ".join(base[::-1] + [f"b{k // 2}"]) + " " * (k % 2)) for k in range(5)]
    rows += [(7, "another text of more than five words"), (None, "lonely text without any id or copy"), (7, None), (None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = [(r.doc_id, (r.text or "").split(" ")[0]) for r in near_dedup.dedup(df).collect()]
    assert sorted(out, key=str) == sorted([(7, "w0"), (None, "w299"), (7, "another"), (None, "lonely"), (7, ""), (None, "x")], key=str)


def test_audit_of_records_that_share_an_offset(spark):
    def side(*rows):
        return spark.createDataFrame([(1, o, 10, bytearray(h)) for o, h in rows], "file long, offset long, length long, hash binary")

    a = side((0, b"a"), (0, b"b"), (0, b"c"), (50, b"k"), (50, b"k"), (50, b"k"), (90, b"z"), (95, b"s"))
    b = side((0, b"a"), (0, b"d"), (0, b"e"), (0, b"f"), (50, b"k"), (90, b"z"), (95, b"t"))
    got = sorted((r.offset, r.problem, r.hash_a or "", r.hash_b or "") for r in warc.audit(a, b).collect())
    k = [(50, "missing", "6b", "")] * 2
    assert got == [(0, "changed", "62", "64"), (0, "changed", "63", "65"), (0, "extra", "", "66"), *k, (95, "changed", "73", "74")]
