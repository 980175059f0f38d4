"""Archives as tables: members of zip, tar and gzip files, read in memory.

Nothing is ever written to a path that an archive names. A broken archive, one
that takes too long and a member that is too large are rows with a reason, not
errors. One archive at a time is unpacked, and no member beyond the limit.
"""

from __future__ import annotations

import gzip
import io
import tarfile
import time
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ontoloom.functions import text as X
from ontoloom.functions import vocab as V

MEMBER = "array<struct<member:string,size:bigint,content:binary,ok:boolean,reason:string>>"
_MEMBER = pa.list_(pa.struct([("member", pa.string()), ("size", pa.int64()), ("content", pa.binary()), ("ok", pa.bool_()), ("reason", pa.string())]))
LISTED = "array<struct<member:string,size:bigint>>"
#: Not sources, though they lie among them.
CATALOGUE_FILES = ("ontologylist.tsv", "download_report.tsv")
CHUNK = 1 << 20


class TooSlow(Exception):
    """The time for one source is over."""


class Clock:
    """Time for one source, in seconds; 0 is no bound."""

    def __init__(self, seconds: float):
        self.until = time.monotonic() + seconds if seconds else None

    def check(self) -> None:
        if self.until is not None and time.monotonic() > self.until:
            raise TooSlow


def _read(stream, limit: int, clock: Clock, keep: bool) -> tuple[int, bytes | None]:
    """The size of a stream and, if wanted and not beyond the limit, its bytes. Stops behind the limit; 0 is no limit."""
    parts, n = [], 0
    while data := stream.read(CHUNK):
        clock.check()
        n += len(data)
        if limit and n > limit:
            return n, None
        if keep:
            parts.append(data)
    return n, b"".join(parts) if keep else None


def unpack(content: bytes, name: str, limit: int = 0, clock: Clock | None = None, keep: bool = True, only: str | None = None) -> Iterator[tuple[str, int, bytes | None]]:
    """(member, size, bytes) of the regular members of an archive, or of the one called ``only``.

    The type of a tarball goes by its content, of the others by their first
    bytes. Members beyond the limit have no bytes, and their size is the one
    declared, or what had been read when the limit was passed. ``keep=False``
    reads no more than is needed to know names and sizes.
    """
    clock = clock or Clock(0)
    wanted = lambda m: only is None or m == only
    if content[:2] == b"PK":
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            for i in z.infolist():
                clock.check()
                if i.is_dir() or not wanted(i.filename):
                    continue
                if not keep or limit and i.file_size > limit:
                    yield i.filename, i.file_size, None
                else:
                    with z.open(i) as f:
                        yield i.filename, *_read(f, limit, clock, True)
    elif tarfile.is_tarfile(io.BytesIO(content)):
        with tarfile.open(fileobj=io.BytesIO(content)) as t:
            for m in t:
                clock.check()
                if not m.isfile() or not wanted(m.name):
                    continue
                if not keep or limit and m.size > limit:
                    yield m.name, m.size, None
                else:
                    yield m.name, *_read(t.extractfile(m), limit, clock, True)
    elif content[:2] == b"\x1f\x8b":
        inner = name.rsplit("/", 1)[-1]
        inner = inner[:-3] if inner.lower().endswith(".gz") else inner
        if wanted(inner):
            with gzip.GzipFile(fileobj=io.BytesIO(content)) as f:
                yield inner, *_read(f, limit, clock, keep)
    else:
        plain = name.rsplit("/", 1)[-1]
        if wanted(plain):
            yield plain, len(content), None if limit and len(content) > limit else content


def _outcome(reason: str) -> list[dict]:
    return [{"member": None, "size": 0, "content": None, "ok": False, "reason": reason}]


def members(content: Column, path: Column, seconds: float = 0, limit_bytes: int = 0) -> Column:
    """Each file's members as an array; ``seconds`` bounds the work on one archive, ``limit_bytes`` each member (0: no bound)."""

    def found(c: bytes, p: str) -> list[dict]:
        try:
            got = []
            for m, n, data in unpack(c, p, limit_bytes, Clock(seconds)):
                got.append({"member": m, "size": n, "content": data, "ok": data is not None, "reason": "" if data is not None else V.TOO_LARGE})
            return got
        except TooSlow:
            return _outcome(V.TOO_SLOW)
        except Exception:  # noqa: BLE001  whatever a broken archive raises is its outcome
            return _outcome("transform_error")

    @F.arrow_udf(MEMBER)
    def of(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for contents, paths in batches:
            for c, p in zip(contents, paths, strict=True):
                yield pa.array([found(c.as_py() or b"", p.as_py() or "")], _MEMBER)

    return of(content, path)


def listing(content: Column, path: Column, seconds: float = 0, limit_bytes: int = 0) -> Column:
    """The names and sizes of each file's members, without their bytes; none for an archive that can't be read."""

    def found(c: bytes, p: str) -> list[dict]:
        try:
            return [{"member": m, "size": n} for m, n, _ in unpack(c, p, limit_bytes, Clock(seconds), keep=False)]
        except Exception:  # noqa: BLE001
            return []

    @F.arrow_udf(LISTED)
    def of(contents: pa.Array, paths: pa.Array) -> pa.Array:
        rows = [found(c.as_py() or b"", p.as_py() or "") for c, p in zip(contents, paths, strict=True)]
        return pa.array(rows, pa.list_(pa.struct([("member", pa.string()), ("size", pa.int64())])))

    return of(content, path)


def extract(content: Column, path: Column, member: Column, seconds: float = 0, limit_bytes: int = 0) -> Column:
    """struct(size, content, reason) of one member of each file; a null member is an error of the transform."""
    kind = pa.struct([("size", pa.int64()), ("content", pa.binary()), ("reason", pa.string())])

    def found(c: bytes, p: str, m: str | None) -> dict:
        try:
            if m is not None:
                for _, n, data in unpack(c, p, limit_bytes, Clock(seconds), only=m):
                    return {"size": n, "content": data, "reason": "" if data is not None else V.TOO_LARGE}
        except TooSlow:
            return {"size": 0, "content": None, "reason": V.TOO_SLOW}
        except Exception:  # noqa: BLE001
            pass
        return {"size": 0, "content": None, "reason": "transform_error"}

    @F.arrow_udf("struct<size:bigint,content:binary,reason:string>")
    def of(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for contents, paths, names in batches:
            for c, p, m in zip(contents, paths, names, strict=True):
                yield pa.array([found(c.as_py() or b"", p.as_py() or "", m.as_py())], kind)

    return of(content, path, member)


def raw_files(spark: SparkSession, root: str, limit_bytes: int = 0) -> DataFrame:
    """(path, id, submission_id, length, content, reason) of the files under ``root``/id/submission/.

    The key is the path; files at a lesser depth and the catalogue's own are left
    out. A file beyond ``limit_bytes`` (0: no limit) is a row without content
    whose reason is ``too_large``.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    base = root.rstrip("/").split("://")[-1].lstrip("/")
    rel = F.regexp_replace(F.col("path"), rf"^[a-z]+:/*\Q{base}\E/", "")
    large = (F.col("length") > limit_bytes) & F.lit(limit_bytes > 0)

    def shaped(rows: DataFrame, content: Column, reason: str) -> DataFrame:
        rows = rows.select(rel.alias("path"), "length", content.alias("content")).where(F.size(F.split("path", "/")) >= 3)
        rows = rows.where(~X.basename(F.col("path")).isin(*CATALOGUE_FILES))
        return rows.select("path", X.path_part(F.col("path"), 1).alias("id"), X.path_part(F.col("path"), 2).alias("submission_id"), "length", "content", F.lit(reason).alias("reason"))

    if not limit_bytes:
        return shaped(files, F.col("content"), "")
    # the scan skips a file's bytes where only its length is asked for
    return shaped(files.where(~large), F.col("content"), "").unionByName(shaped(files.where(large), F.lit(None).cast("binary"), V.TOO_LARGE))


def stored_files(spark: SparkSession, root: str, limit_bytes: int = 0) -> DataFrame:
    """What ``raw_files`` gives, of the files that ``sinks.raw_files`` has stored under ``root``."""
    rows = spark.read.schema("path string, submission_id string, length bigint, content binary, id string").parquet(root)
    large = (F.col("length") > limit_bytes) & F.lit(limit_bytes > 0)
    rows = rows.where(~X.basename(F.col("path")).isin(*CATALOGUE_FILES))
    return rows.select("path", "id", "submission_id", "length", F.when(~large, F.col("content")).alias("content"), F.when(large, V.TOO_LARGE).otherwise("").alias("reason"))


def junk(member: Column) -> Column:
    name = X.basename(member)
    bad = name == ""
    for p in V.JUNK:
        bad = bad | F.startswith(member, F.lit(p)) | F.startswith(name, F.lit(p))
    return bad


def pick_member(rows: DataFrame, by: list[str], acronym: str = "acronym", archive: str = "archive_path") -> DataFrame:
    """One member of each archive: its stem is the archive's, else the acronym, else it has an
    ontology's extension, else any; larger before smaller, then by name. Junk never counts: an
    archive of nothing else has one row whose member and size are null."""
    stem = F.lower(X.stem(F.col("member")))
    bad = F.coalesce(junk(F.col("member")), F.lit(True))
    rule = (
        F.when(bad, 5).when(stem == X.archive_stem(F.coalesce(F.col(archive), F.lit(""))), 1).when(stem == F.lower(acronym), 2)
        .when(X.extension(F.col("member")).isin(*V.EXTENSIONS), 3).otherwise(4)
    )
    order = Window.partitionBy(*by).orderBy(rule, F.desc("size"), "member")
    best = rows.withColumn("_r", F.row_number().over(order)).where("_r = 1")
    none = {c: F.when(~bad, F.col(c)) for c in ("size", "member")}
    return best.withColumn("size", none["size"]).withColumn("member", none["member"]).drop("_r")
