"""WARC records and Merkle fixity audits.

A file of records is a tree. Leaves are the SHA-256 hashes of whole records
with their offsets and lengths; a node above covers a fixed range of offsets
(``LEAF_RANGE`` bytes, then ``FANOUT`` ranges of the level below) and hashes
its children in the order of their offsets; the root covers the file. Two
replicas are compared root by root, and only under a mismatching node its
children are compared, so equal files and equal branches are never descended.
What is left at the bottom are the records that differ, are missing or extra.

A node has a bounded number of children whatever the size of the file: FANOUT
nodes, or the records that start within LEAF_RANGE bytes. So no group grows
with a file, and a file that holds a third of all records is no hot spot.

Defined cases: null payloads count as empty; a null URL is written as an empty
one. Pages with a null id are dealt to files of their own (-1, -2, ...) by their
hashes. Equal records, of repeated rows or at one offset, are counted and never
gathered one by one; records of equal offset are ordered by hash.
A file that one replica lacks mismatches at its root. Empty replicas are equal.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

FANOUT = 16
LEAF_RANGE = 1 << 16
#: Records of a file, as pages are dealt to files by their ids.
FILE_RECORDS = 256
_STEP = 1 << 16


def record(url: Column, payload: Column, number: Column) -> Column:
    """A WARC/1.1 resource record as bytes."""
    body = F.encode(F.coalesce(payload, F.lit("")), "UTF-8")
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), F.coalesce(number.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"),
    )
    return F.concat(F.encode(head, "UTF-8"), body, F.lit(b"\r\n\r\n"))


def records(pages: DataFrame, payload: Column | None = None) -> DataFrame:
    """pages (page_id, url, html) -> (file, page_id, length, hash, offset): what a writer would lay down.

    ``payload`` takes the place of html in a replica. A file's order is that of ids, then of hashes.
    """
    html = F.col("html") if payload is None else payload
    data = record(F.col("url"), html, F.col("page_id"))
    rows = pages.select("page_id", F.octet_length(data).cast("long").alias("length"), F.unhex(F.sha2(data, 256)).alias("hash"))
    nulls = pages.where("page_id is null").count()
    own = -1 - F.pmod(F.xxhash64("hash"), F.lit(max(1, nulls // FILE_RECORDS)))
    file = F.when(F.col("page_id").isNull(), own).otherwise(F.floor(F.col("page_id") / FILE_RECORDS)).cast("long")
    rows = rows.groupBy(file.alias("file"), "page_id", "hash", "length").agg(F.count(F.lit(1)).alias("copies"))
    order = Window.partitionBy("file").orderBy("page_id", "hash").rowsBetween(Window.unboundedPreceding, 0)
    size = F.col("length") * F.col("copies")
    rows = rows.withColumn("start", F.sum(size).over(order) - size)
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy")
    return rows.select("file", "page_id", "length", "hash", "start", copy).select("file", "page_id", "length", "hash", (F.col("start") + F.col("copy") * F.col("length")).alias("offset"))


def split(data: bytes) -> Iterator[tuple[int, int]]:
    """(offset, length) of the records of a WARC file, plain or with each record compressed on its own.

    Where a header makes no sense, the rest of the file is one record.
    """
    at = 0
    while at < len(data):
        if data[at : at + 2] == b"\x1f\x8b":
            member = zlib.decompressobj(31)
            try:
                done = at
                while not member.eof and done < len(data):
                    member.decompress(data[done : done + _STEP])
                    done += _STEP
                end = min(done, len(data)) - len(member.unused_data) if member.eof else len(data)
            except zlib.error:
                end = len(data)
        else:
            head = data.find(b"\r\n\r\n", at)
            found = re.search(rb"(?im)^content-length:[ \t]*(\d+)[ \t]*\r$", data[at : head + 1]) if head >= 0 and data[at : at + 5] == b"WARC/" else None
            end = min(head + 4 + int(found[1]) + 4, len(data)) if found else len(data)
        yield at, end - at
        at = end


def scan(files: DataFrame) -> DataFrame:
    """files (path, content), as ``binaryFile`` gives them -> (file, offset, length, hash): the records as they are stored, for ``audit``.

    A file is read by one task and is one row, so 2 GB at most, as WARC files are.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column(0), b.column(1), strict=True):
                data = content.as_buffer().to_pybytes() if content.is_valid else b""
                spans = list(split(data))
                cols = [pa.array([path.as_py()] * len(spans), pa.string()), *(pa.array([s[k] for s in spans], pa.int64()) for k in (0, 1))]
                yield pa.RecordBatch.from_arrays([*cols, pa.array([hashlib.sha256(data[o : o + n]).digest() for o, n in spans], pa.binary())], ["file", "offset", "length", "hash"])

    return files.select(F.col("path").cast("string"), "content").mapInArrow(work, "file string, offset long, length long, hash binary")


def _hash(children: Column) -> Column:
    """Of the sorted structs (key, hash)."""
    return F.unhex(F.sha2(F.array_join(F.transform(children, lambda c: F.concat(c["k"].cast("string"), F.lit(":"), F.hex(c["hash"]))), "|"), 256))


def height(*replicas: DataFrame) -> int:
    """The level of the roots, so that the largest offset of all replicas is under one."""
    last = max(r.agg(F.max("offset")).first()[0] or 0 for r in replicas)
    level, ranges = 0, last // LEAF_RANGE + 1
    while ranges > 1:
        level, ranges = level + 1, -(-ranges // FANOUT)
    return level


def tree(leaves: DataFrame, top: int) -> DataFrame:
    """(file, offset, length, hash) -> (file, level, idx, hash): level 0 ranges up to a root per file at ``top``."""
    each = leaves.groupBy("file", "offset", "length", "hash").agg(F.count(F.lit(1)).alias("n"))
    place = F.concat_ws("+", F.lpad(F.col("offset").cast("string"), 20, "0"), F.col("length").cast("string"), F.col("n").cast("string"))
    level0 = each.select("file", F.floor(F.col("offset") / LEAF_RANGE).alias("idx"), F.struct(place.alias("k"), "hash").alias("c"))
    out = now = materialize(level0.groupBy("file", "idx").agg(_hash(F.sort_array(F.collect_list("c"))).alias("hash")).select("file", F.lit(0).alias("level"), "idx", "hash"), "tree")
    for level in range(1, top + 1):
        up = now.select("file", F.floor(F.col("idx") / FANOUT).alias("idx"), F.struct(F.col("idx").alias("k"), "hash").alias("c"))
        now = materialize(up.groupBy("file", "idx").agg(_hash(F.sort_array(F.collect_list("c"))).alias("hash")).select("file", F.lit(level).alias("level"), "idx", "hash"), "tree")
        out = out.unionByName(now)
    return out


def audit(a: DataFrame, b: DataFrame) -> DataFrame:
    """(file, offset, problem, length_a, length_b, hash_a, hash_b): the records in which two replicas differ.

    a, b: (file, offset, length, hash). problem: changed, missing (in b) or extra (in b).
    Records that share an offset are compared as multisets: a changed row pairs one that only a has with one that only b has.
    """
    a, b = (materialize(x.select("file", "offset", "length", "hash"), "replica") for x in (a, b))
    top = height(a, b)
    ta, tb = tree(a, top), tree(b, top)
    suspects = None
    for level in range(top, -1, -1):
        x, y = (t.where(F.col("level") == level).select("file", "idx", F.col("hash").alias(n)) for t, n in ((ta, "ha"), (tb, "hb")))
        if suspects is not None:
            parents = suspects.select(F.col("file").alias("f"), F.col("idx").alias("parent"))
            x, y = (t.join(parents, (F.col("file") == F.col("f")) & (F.floor(F.col("idx") / FANOUT) == F.col("parent")), "left_semi") for t in (x, y))
        suspects = materialize(x.join(y, ["file", "idx"], "full").where(~F.col("ha").eqNullSafe(F.col("hb"))).select("file", "idx"), "suspects")
    bad = suspects.select(F.col("file").alias("f"), F.col("idx").alias("i"))
    x, y = (t.join(bad, (F.col("file") == F.col("f")) & (F.floor(F.col("offset") / LEAF_RANGE) == F.col("i")), "left_semi") for t in (a, b))
    # what one side holds more often than the other, in the order of hashes
    rows = x.withColumn("w", F.lit(1)).unionByName(y.withColumn("w", F.lit(-1))).groupBy("file", "offset", "length", "hash").agg(F.sum("w").alias("w")).where("w <> 0")
    over = lambda sign: F.sort_array(F.collect_list(F.when(F.col("w") * sign > 0, F.struct("hash", "length", F.abs("w").cast("int").alias("n")))))
    each = lambda c: F.flatten(F.transform(c, lambda r: F.array_repeat(F.struct(r["hash"].alias("hash"), r["length"].alias("length")), r["n"])))
    met = rows.groupBy("file", "offset").agg(over(1).alias("a"), over(-1).alias("b")).select("file", "offset", each(F.col("a")).alias("a"), each(F.col("b")).alias("b"))
    met = met.select("file", "offset", F.explode(F.arrays_zip("a", "b")).alias("z")).select("file", "offset", "z.a", "z.b")
    problem = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").otherwise("changed")
    return met.select(
        "file", "offset", problem.alias("problem"), F.col("a.length").alias("length_a"), F.col("b.length").alias("length_b"),
        F.lower(F.hex("a.hash")).alias("hash_a"), F.lower(F.hex("b.hash")).alias("hash_b"),
    )
