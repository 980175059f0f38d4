"""Readers of lists, reports, indexes and graphs in TSV, YAML and JSON."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontoloom.durable import discard, materialize
from ontoloom.functions import text as X
from ontoloom.operators.browse import RESOURCE

REPORT = "id string, name string, version string, submission_id string, source_bytes string, status string, reason string, http_status string, path string"
CATALOGUE = "id string, name string, current_version string, submission_id string"
INDEX = (
    "id string, status string, reason string, name string, version string, nodecount bigint, edgecount bigint,"
    " submission_id string, source_bytes bigint, http_status int, download_url string"
)


def exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def placed(df: DataFrame, path: str) -> DataFrame:
    """The rows of text files with ``pos``, a row's place: files in the order of their names, parts by number, and rows as they lie there.

    Spark deals the pieces of files out by size, so the order in which it reads them is none. A place is where
    the row's piece begins, counted over all files, times a factor, plus the row's number in its task.
    """
    spark = df.sparkSession
    files = spark.read.format("binaryFile").load(path).select("_metadata.file_path", "_metadata.file_size").collect()  # a row for each file
    starts, total = [], 0
    for f in sorted(files, key=lambda f: [int(x) if k % 2 else x for k, x in enumerate(re.split(r"(\d+)", f.file_path))]):
        starts.append((f.file_path, total))
        total += f.file_size
    factor = 1 << min(33, 62 - total.bit_length())
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), row.alias("_row"))
    if len(starts) > 1:
        rows = rows.join(F.broadcast(spark.createDataFrame(starts, "_file string, _start long")), "_file", "left")
    else:
        rows = rows.withColumn("_start", F.lit(0))
    return rows.withColumn("pos", (F.col("_start") + F.col("_block")) * factor + F.col("_row")).drop("_file", "_block", "_row", "_start")


def tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A TSV file with a header, no quoting; short rows are filled with nulls; ``pos`` is a row's place."""
    return placed(spark.read.schema(schema).option("sep", "\t").option("header", True).option("quote", "").option("mode", "PERMISSIVE").csv(path), path)


def acronyms(spark: SparkSession, path: str) -> DataFrame:
    """The first column of a TSV list, blank lines skipped."""
    return tsv(spark, path, CATALOGUE).where(X.or_default(X.ws_strip(F.col("id")), "") != "").select("id", "pos")


def literal_acronyms(spark: SparkSession, text: str) -> DataFrame:
    """A white-space separated string of acronyms."""
    return spark.createDataFrame([(text,)], "t string").select(F.posexplode(X.words(F.col("t"))).alias("pos", "id")).select("id", F.col("pos").cast("long").alias("pos"))


def catalogue(spark: SparkSession, path: str) -> DataFrame:
    return tsv(spark, path, CATALOGUE).where(X.or_default(F.col("id"), "") != "").withColumn("submission_id", F.coalesce("submission_id", F.lit("")))


def download_report(spark: SparkSession, path: str) -> DataFrame:
    """Typed report rows; a missing file is an empty report. Bytes that aren't a number are 0."""
    if not exists(spark, path):
        return spark.createDataFrame([], REPORT + ", pos bigint").withColumns({"source_bytes": F.col("source_bytes").cast("long"), "http_status": F.col("http_status").cast("int")})
    df = tsv(spark, path, REPORT)
    text = {c: F.coalesce(c, F.lit("")) for c in ("name", "version", "submission_id", "reason", "path")}
    return df.withColumns({**text, "source_bytes": F.coalesce(F.col("source_bytes").try_cast("long"), F.lit(0)), "http_status": F.col("http_status").try_cast("int")})


#: YAML files of more bytes are parsed piece by piece, by all executors.
WHOLE_BYTES = 1 << 20
#: A line that belongs to no item: a top-level key or a marker of documents.
_TOP = re.compile(rb"[\r\n](?=[^\s#-]|-\S)")

#: A line of an item that needs no parser: a name and plain text, or text in single quotes without any inside.
_LINE = r"[A-Za-z_]\w*: (?:[A-Za-z0-9_][\w./-]*|'[ -&(-~]*')"


def yaml_rows(spark: SparkSession, path: str, key: str, schema: str) -> DataFrame:
    """The list under ``key`` of a YAML file. All scalars are read as text and then cast, so an id NO stays NO.

    A missing file is an empty relation.
    """
    names = [f.name for f in spark.createDataFrame([], schema).schema]
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    text = _yaml_pieces(spark, path, key, names)
    if text is None:
        text = _yaml_whole(spark, path, key, names)
    kinds = {f.name: f.dataType for f in spark.createDataFrame([], schema).schema}
    return text.select(*[F.col(n).try_cast(kinds[n]).alias(n) for n in names])


def _yaml_values(item: dict, names: list[str]) -> list:
    return [None if item.get(n) in (None, "null", "~") else str(item.get(n)) for n in names]


def _yaml_whole(spark: SparkSession, path: str, key: str, names: list[str]) -> DataFrame:
    """Each file at once, as one row of ``binaryFile``."""
    import pyarrow as pa
    import yaml

    def work(batches):
        for b in batches:
            for content in b.column(0).to_pylist():
                rows = [_yaml_values(r, names) for r in (yaml.load(content, Loader=yaml.BaseLoader) or {}).get(key) or []]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in range(len(names))], names)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(work, ", ".join(f"{n} string" for n in names))


def _yaml_pieces(spark: SparkSession, path: str, key: str, names: list[str]) -> DataFrame | None:
    """The same rows of one large file, cut where its list's items begin; None where it has to be parsed whole.

    A dash in the column of the list begins an item there, or lies with another
    key. A top-level key in a piece ends its last item and says whose the items
    behind it are. Whatever else could reach from one piece into another (quoted
    text, anchors, several documents) leaves a piece that doesn't parse, and then
    the file is parsed whole.
    """
    import pyarrow as pa
    import yaml

    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    status = store.getFileStatus(at)
    if status.isDirectory() or status.getLen() <= WHOLE_BYTES:
        return None
    stream = store.open(at)
    try:
        head = bytes(stream.readNBytes(1 << 16))
    finally:
        stream.close()
    blank = rb"[ \t]*(?:#.*)?\r?\n"
    first = re.search(rb"(?m)^" + re.escape(key).encode() + rb":" + blank + rb"(?:" + blank + rb")*( *)- ", head)
    item = (first[1].decode() if first else "") + "- "
    inner = "\n" + " " * len(item)
    flat = re.compile(f"{_LINE}(?:{inner}{_LINE})*\n?".encode())

    def parse(batches):
        loader = getattr(yaml, "CBaseLoader", yaml.BaseLoader)

        def items(text: bytes):
            rows = yaml.load(item.encode() + text, Loader=loader)
            return [("item", _yaml_values(r, names)) if isinstance(r, dict) else ("odd", None) for r in rows]

        def lines(text: bytes):
            pairs = (x.split(": ", 1) for x in text.decode().removesuffix("\n").split(inner))
            return [("item", _yaml_values({k: v[1:-1] if v[0] == "'" else v for k, v in pairs}, names))]

        def keys(text: bytes):
            """Of top-level keys: is the list among them, and what of it?"""
            found = [k.value for k, _ in yaml.compose(text, Loader=loader).value]
            if key not in found:
                return [("other", None)]
            value = yaml.load(text, Loader=loader)[key]
            if not value and found[-1] == key:
                return [("open" if value == "" else "closed", None)]
            return [("closed", None), *[("inline", _yaml_values(r, names)) for r in value or []]]

        def parsed(places, pieces):
            run = []
            for pos, piece in [*zip(places, pieces, strict=True), (-1, b"")]:
                top = _TOP.search(piece) if pos > 0 else None
                simple = pos > 0 and flat.fullmatch(piece)
                if pos > 0 and not top and not simple:
                    run.append((pos, piece))
                    continue
                if run:  # neighbours only
                    yield run[0][0], items(("\n" + item).encode().join(x for _, x in run))
                    run = []
                if simple:
                    yield pos, lines(piece)
                elif top:
                    yield pos, items(piece[: top.end()])
                    yield pos, keys(piece[top.end() :])
                elif pos == 0:
                    yield pos, keys(piece)

        for b in batches:
            for k in range(0, b.num_rows, 1000):
                part = b.slice(k, 1000)
                try:
                    rows = [(pos, kind, values or [None] * len(names)) for pos, found in parsed(part.column(0).to_pylist(), part.column(1).to_pylist()) for kind, values in found]
                except Exception:  # noqa: BLE001  whatever it is, the whole file tells
                    rows = [(0, "error", [None] * len(names))]
                columns = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()), *[pa.array([r[2][j] for r in rows], pa.string()) for j in range(len(names))]]
                yield pa.RecordBatch.from_arrays(columns, ["_pos", "_kind", *names])

    text = placed(spark.read.option("lineSep", "\n" + item).text(path), path).select("pos", F.col("value").cast("binary").alias("value"))
    found = materialize(text.mapInArrow(parse, "_pos long, _kind string, " + ", ".join(f"{n} string" for n in names)), "yaml")
    kind, pos = F.col("_kind"), F.col("_pos")
    errors, last = found.agg(F.count_if(kind == "error"), F.max(F.when(kind.isin("open", "closed"), F.struct(pos, kind)))).first()
    if last is None:
        rows = found.where(F.lit(False))
    elif last._kind == "closed":
        rows = found.where((kind == "inline") & (pos == last._pos))
    else:
        end = found.where((kind == "other") & (pos > last._pos)).agg(F.min(pos)).first()[0]
        rows = found.where(kind.isin("item", "odd") & (pos > last._pos) & (pos <= (1 << 62 if end is None else end)))
    if errors or not rows.where(kind == "odd").isEmpty():
        discard(found)
        return None
    return rows.select(*names)


def index(spark: SparkSession, path: str) -> DataFrame:
    return yaml_rows(spark, path, "ontologies", INDEX)


def index_submissions(spark: SparkSession, path: str) -> DataFrame:
    """(id, submission_id) of the index rows that name a submission: neither empty nor NA."""
    known = index(spark, path).select("id", "submission_id")
    return known.where(F.coalesce((F.col("submission_id") != "") & (F.col("submission_id") != "NA"), F.lit(False)))


def report_by_id(spark: SparkSession, path: str) -> DataFrame:
    """The download report with one row for each id, the last one."""
    from ontoloom.operators.catalog import last_of_each

    df = download_report(spark, path)
    return last_of_each(df, "id", "pos")


def graph_table(spark: SparkSession, path: str, multivalued: tuple[str, ...] = ()) -> DataFrame:
    """A node or edge TSV; multi-valued columns become sorted arrays."""
    from ontoloom.operators.graph import split_values

    df = spark.read.option("sep", "\t").option("header", True).option("quote", "").csv(path)
    return df.withColumns({c: split_values(F.col(c)) for c in multivalued if c in df.columns})


def resources(spark: SparkSession, path: str) -> DataFrame:
    """The registry's ``resources`` with their positions."""
    schema = f"resources array<struct<{RESOURCE.rsplit(', pos long', 1)[0].replace(' string', ':string').replace(' array<', ':array<')}>>"
    return spark.read.schema(schema).option("multiLine", True).json(path).select(F.posexplode("resources").alias("pos", "r")).select("r.*", F.col("pos").cast("long").alias("pos"))


def whole_text(spark: SparkSession, path: str) -> DataFrame:
    """(path, text): files as text, bytes that aren't UTF-8 replaced."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", X.utf8(F.col("content")).alias("text"))


def totals(spark: SparkSession, path: str) -> DataFrame:
    """The totals beside an index as one row of text columns; no row if the file is missing."""
    names = ("totalcount", "skippedcount", "failedcount", "licensedcount", "totalnodecount", "totaledgecount")
    schema = ", ".join(f"{n} bigint" for n in names) + ", transform_date string"
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    lines = spark.read.text(path).select(F.split("value", r":\s*", 2).alias("kv")).where(F.size("kv") == 2)
    value = lambda n: F.max(F.when(F.get("kv", F.lit(0)) == n, F.regexp_replace(F.get("kv", F.lit(1)), "^['\"]|['\"]$", "")))
    out = lines.agg(*[value(n).alias(n) for n in (*names, "transform_date")])
    return out.select(*[F.col(n).try_cast("bigint").alias(n) for n in names], "transform_date")


FLAGS = "name string, is_umls boolean, test_set boolean"


def test_list(spark: SparkSession, path: str, key: str = "ontologies") -> DataFrame:
    """A YAML list of ontologies with optional flags; a flag that isn't there is null."""
    return yaml_rows(spark, path, key, FLAGS)


def flagged(df: DataFrame, flag: str) -> DataFrame:
    """Rows whose flag is set; a missing flag counts as unset."""
    return df.where(F.coalesce(F.col(flag), F.lit(False)))


def requested(listed: DataFrame | None, given: DataFrame | None, catalogue_: DataFrame) -> DataFrame:
    """The acronyms to work on: file list and literal list together, repeats kept; the catalogue if there is neither."""
    parts = [d.select("id") for d in (given, listed) if d is not None]
    if not parts:
        return catalogue_.select("id")
    return parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0]
