"""Writers. Large tables go out in parallel; indexes and manifests, of a catalogue's size, as single files."""

from __future__ import annotations

import io
import json
import re
import tarfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontoloom.durable import discard, materialize, shared_dir
from ontoloom.operators.graph import join_values

REPORT_COLUMNS = ("id", "name", "version", "submission_id", "source_bytes", "status", "reason", "http_status", "path")


@contextmanager
def _file(df: DataFrame, path: str) -> Iterator:
    """One file through Hadoop's file systems, so any store that Spark can write; what is written goes out at once."""
    sc = df.sparkSession.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(sc._jsc.hadoopConfiguration()).create(at, True)

    class Out:
        def write(self, data: bytes) -> int:
            out.write(bytearray(data))
            return len(data)

    buffer = io.BufferedWriter(_Raw(Out()), 1 << 20)
    try:
        yield buffer
        buffer.flush()
    finally:
        out.close()


class _Raw(io.RawIOBase):
    def __init__(self, out):
        self.out = out

    def writable(self) -> bool:
        return True

    def write(self, data) -> int:
        return self.out.write(bytes(data))


class _Lines(io.RawIOBase):
    """Lines as a file to read, one after the other."""

    def __init__(self, lines: Iterator[bytes]):
        self.lines, self.rest = lines, b""

    def read(self, n: int = -1) -> bytes:
        while len(self.rest) < n and (line := next(self.lines, None)) is not None:
            self.rest += line
        out, self.rest = self.rest[:n], self.rest[n:]
        return out


def _put(df: DataFrame, path: str, data: bytes) -> None:
    with _file(df, path) as out:
        out.write(data)


def tsv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").option("nullValue", "").csv(path)


def catalogue(df: DataFrame, path: str) -> None:
    """The catalogue: id, name, version, submission."""
    tsv(df.select("id", "name", "current_version", "submission_id"), path)


def download_report(df: DataFrame, path: str) -> None:
    """Fixed column order; what is missing is empty."""
    tsv(df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c) for c in REPORT_COLUMNS]), path)


def graph(nodes: DataFrame, edges: DataFrame, path: str, partition: str = "provided_by") -> None:
    """Node and edge tables as Parquet, a folder for each provider."""
    nodes.write.mode("overwrite").partitionBy(partition).parquet(f"{path}/nodes")
    edges.write.mode("overwrite").partitionBy(partition).parquet(f"{path}/edges")


def flat(df: DataFrame) -> DataFrame:
    """Array columns as pipe-delimited text."""
    return df.select(*[join_values(F.col(c)).alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes])


def _lines(df: DataFrame) -> DataFrame:
    """The rows as TSV lines."""
    df = flat(df)
    return df.select(F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]).alias("line"))


def _encoded(lines: DataFrame, columns: list[str]) -> Iterator[bytes]:
    """A header and the lines, those of one partition at a time on the driver."""
    yield ("\t".join(columns) + "\n").encode()
    for r in lines.toLocalIterator():
        yield (r.line + "\n").encode()


def bundle(nodes: DataFrame, edges: DataFrame, path: str, name: str) -> None:
    """One graph's two TSVs in a tar.gz, for exchange. Neither a table nor the bundle is ever whole in memory."""
    with _file(nodes, path) as out, tarfile.open(fileobj=out, mode="w|gz") as t:
        for kind, df in (("nodes", nodes), ("edges", edges)):
            lines = materialize(_lines(df), "lines")
            info = tarfile.TarInfo(f"{name}_{kind}.tsv")
            size = lines.agg(F.sum(F.octet_length("line") + 1)).first()[0] or 0
            info.size = size + len("\t".join(df.columns).encode()) + 1
            t.addfile(info, _Lines(_encoded(lines, df.columns)))
            discard(lines)


def _joined(lines: DataFrame, path: str, head: bytes, empty: bytes) -> None:
    """One file of ``head`` and the lines in their order, or of ``empty`` if there are none.

    Executors write the lines in parts, whose bytes then go through a buffer of the
    driver's JVM; no line is ever in its memory or in Python's.
    """
    sc = lines.sparkSession.sparkContext
    fs, conf = sc._jvm.org.apache.hadoop.fs, sc._jsc.hadoopConfiguration()
    folder = fs.Path(f"{shared_dir(lines.sparkSession)}/ontoloom-lines-{uuid.uuid4().hex}")
    store = folder.getFileSystem(conf)
    try:
        lines.write.option("compression", "none").text(folder.toString())
        parts = {f.getPath().getName(): f.getPath() for f in store.listStatus(folder) if f.getLen() > 0}
        names = sorted((n for n in parts if n.startswith("part-")), key=lambda n: int(n.split("-")[1]))
        at = fs.Path(path)
        out = at.getFileSystem(conf).create(at, True)
        try:
            out.write(bytearray(head if names else empty))
            for n in names:
                part = store.open(parts[n])
                try:
                    sc._jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, conf, False)
                finally:
                    part.close()
        finally:
            out.close()
    finally:
        store.delete(folder, True)


#: Text that YAML writes as it is, or in single quotes if it reads as something else than text.
_PLAIN = re.compile(r"[A-Za-z0-9_][A-Za-z0-9_./-]{0,99}")


def _yaml_item(row: dict) -> str:
    """A row as an item of a YAML list, as ``yaml.safe_dump`` has it; that is called only for what needs more than a look at the text."""
    import yaml

    def scalar(v) -> str | None:
        if type(v) is int:
            return str(v)
        if v == "":
            return "''"
        if type(v) is not str or not _PLAIN.fullmatch(v):
            return None
        return f"'{v}'" if any(r.match(v) for _, r in yaml.SafeDumper.yaml_implicit_resolvers.get(v[0], ())) else v

    pairs = [(scalar(c), scalar(v)) for c, v in row.items()]
    if not pairs or any(x is None for p in pairs for x in p):
        dumper = getattr(yaml, "CSafeDumper", yaml.SafeDumper)
        return yaml.dump([row], Dumper=dumper, sort_keys=False, allow_unicode=True, default_flow_style=False).removesuffix("\n")
    return "- " + "\n  ".join(f"{c}: {v}" for c, v in pairs)


def index_yaml(index: DataFrame, path: str, key: str = "ontologies") -> None:
    """Rows sorted by id, keys in the order of the columns, nulls left out. Executors turn the rows into YAML."""
    import pyarrow as pa
    import yaml

    def work(batches):
        for b in batches:
            for k in range(0, b.num_rows, 1000):
                items = [_yaml_item({c: v for c, v in r.items() if v is not None}) for r in b.slice(k, 1000).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(items, pa.string())], ["value"])

    empty = yaml.safe_dump({key: []}, allow_unicode=True)
    _joined(index.orderBy("id").mapInArrow(work, "value string"), path, (empty.removesuffix(" []\n") + "\n").encode(), empty.encode())


def totals_yaml(totals: DataFrame, path: str, date: str | None = None) -> None:
    import yaml

    row = totals.first().asDict() | ({"transform_date": date} if date else {})
    _put(totals, path, yaml.safe_dump(row, sort_keys=False).encode())


def manifest(urls: DataFrame, path: str) -> None:
    """A header and one line for each artifact; written even if there is none."""
    urls = urls.select("id", "download_url")
    with _file(urls, path) as out:
        out.writelines(_encoded(_lines(urls.orderBy("id")), urls.columns))


def shards_json(plan: DataFrame) -> str:
    """A JSON array of space-joined acronyms, one for each shard."""
    return json.dumps([r.acronyms for r in plan.orderBy("shard").toLocalIterator()])


def search_json(index: DataFrame, path: str) -> None:
    with _file(index, path) as out:
        out.write(b"[")
        for k, r in enumerate(index.toLocalIterator()):
            out.write((b"," if k else b"") + json.dumps(r.asDict(), separators=(",", ":"), ensure_ascii=False).encode())
        out.write(b"]")


def raw_files(downloads: DataFrame, root: str) -> None:
    """Downloaded files as Parquet rows (path, submission_id, length, content) under ``root``, a folder for each id.

    The path <id>/<submission>/<filename> stays the key; ``archives.stored_files`` reads them back as ``archives.raw_files`` reads a folder of files.
    """
    path = F.concat_ws("/", "id", "submission_id", F.coalesce("filename", F.col("id")))
    rows = downloads.where(F.col("content").isNotNull()).select(path.alias("path"), "id", "submission_id", F.octet_length("content").cast("long").alias("length"), "content")
    rows.write.mode("overwrite").partitionBy("id").parquet(root)


def stats_yaml(facets: DataFrame, path: str, name: str) -> None:
    """Facet counts of a merged graph: kind, facet, key, value. As many entries as there are facets' values."""
    import yaml

    tree: dict = {}
    for r in facets.orderBy("kind", "facet", "key", "value").toLocalIterator():
        tree.setdefault(f"{r.kind}_stats", {}).setdefault(r.facet, {}).setdefault(r.key, {})[r.value] = r.n
    _put(facets, path, yaml.safe_dump({"graph_name": name, **tree}, sort_keys=False).encode())
