"""Queries of whole flows: sources through the transform, every serialisation, readers of what writers wrote."""

from __future__ import annotations

import gzip
import io
import json
import tarfile
import uuid
import zipfile

import pyarrow as pa
from pyspark.sql import functions as F

from ontoloom import durable
from ontoloom.functions import formats as N
from ontoloom.functions import text as X
from ontoloom.operators import browse as B
from ontoloom.operators import catalog as C
from ontoloom.operators import graph as G
from ontoloom.operators import merge as M
from ontoloom.operators import transform as T
from ontoloom.plans import inputs as I
from ontoloom.plans.base import query
from ontoloom.sources import archives, rdf, serial, sinks, tables
from ontoloom.streaming import incremental

_HEAD = (
    '<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:rdfs="http://www.w3.org/2000/01/rdf-schema#" xmlns:owl="http://www.w3.org/2002/07/owl#">\n'
    '<owl:Ontology rdf:about="http://x/o"><owl:imports rdf:resource="http://x/elsewhere"/></owl:Ontology>\n'
)


def place(spark, name: str) -> str:
    """A new folder for what a query writes and reads back."""
    return f"{durable.shared_dir(spark)}/ontoloom-{name}-{uuid.uuid4().hex}"


# --- the transform ----------------------------------------------------------------------


def class_document(k, name):
    """A class below eight others and one restriction, as RDF/XML with an import and a language tag that is none."""
    members = "".join(f'<rdf:Description rdf:about="http://x/m{j}"/>' for j in range(7))
    some = '<owl:Restriction><owl:onProperty rdf:resource="http://x/in"/><owl:someValuesFrom rdf:resource="http://x/r"/></owl:Restriction>'
    return F.concat(
        F.lit(_HEAD + '<owl:Class rdf:about="http://x/s'), k.cast("string"), F.lit('"><rdfs:label xml:lang="mail.example">'), name, F.lit("</rdfs:label>"),
        F.lit(f'<owl:equivalentClass><owl:Class><owl:intersectionOf rdf:parseType="Collection">{members}{some}</owl:intersectionOf></owl:Class></owl:equivalentClass></owl:Class></rdf:RDF>'),
    )


def turtle_document(k, name):
    members = " ".join(f"<http://x/m{j}>" for j in range(7))
    return F.concat(
        F.lit("@prefix rdfs: <http://www.w3.org/2000/01/rdf-schema#> .\n@prefix owl: <http://www.w3.org/2002/07/owl#> .\n<http://x/s"), k.cast("string"), F.lit('> a owl:Class ; rdfs:label "'), name,
        F.lit(f'"@en ; owl:equivalentClass [ a owl:Class ; owl:intersectionOf ( {members} [ a owl:Restriction ; owl:onProperty <http://x/in> ; owl:someValuesFrom <http://x/r> ] ) ] .\n'),
    )


def _pack(form: int, doc: bytes, name: str) -> bytes:
    out = io.BytesIO()
    if form == 1:
        return gzip.compress(doc, 1)
    if form in (2, 5):
        with zipfile.ZipFile(out, "w") as z:
            z.writestr("__MACOSX/._" + name + ".owl", b"junk" * 100)
            if form == 2:
                z.writestr("readme.txt", b"r" * 9000)
                z.writestr(f"d/{name}.owl", doc)
        return out.getvalue()
    if form == 3:
        with tarfile.open(fileobj=out, mode="w:gz") as t:
            for member, data in (("notes.txt", b"n" * 50), ("o/" + name + ".OWL", doc)):
                info = tarfile.TarInfo(member)
                info.size = len(data)
                t.addfile(info, io.BytesIO(data))
        return out.getvalue()
    if form == 4:
        return b"PK\x03\x04 broken"
    if form == 6:
        return gzip.compress(doc + b"<!-- " + b"x" * 60_000 + b" -->", 1)
    if form == 7:
        return doc[: len(doc) // 2]
    if form == 9:
        return doc.replace(b"<rdfs:label", b"<owl:x><owl:Class>" * 3000 + b"<rdfs:label", 1).replace(b"</rdfs:label>", b"</rdfs:label>" + b"</owl:Class></owl:x>" * 3000, 1)
    return doc


def raw_sources(spark, sf_dir):
    """Suppliers as raw files of ten kinds, by the last digit of their key: plain, gzip, zip, tarball, four broken ones, Turtle, and one nested too deep."""

    @F.arrow_udf("binary")
    def packed(forms: pa.Array, docs: pa.Array, names: pa.Array) -> pa.Array:
        return pa.array([_pack(f, (d or "").encode(), n or "") for f, d, n in zip(forms.to_pylist(), docs.to_pylist(), names.to_pylist(), strict=True)], pa.binary())

    k = F.col("s_suppkey")
    form = (k % 10).cast("int")
    id_ = F.concat(F.lit("S"), k.cast("string"))
    doc = F.when(form == 8, turtle_document(k, F.col("s_name"))).otherwise(class_document(k, F.col("s_name")))
    end = F.element_at(F.array(*[F.lit(x) for x in (".owl", ".owl.gz", ".zip", ".tar.gz", ".zip", ".zip", ".owl.gz", ".owl", ".ttl", ".owl")]), form + 1)
    content = packed(form, doc, id_)
    rows = I.table(spark, sf_dir, "supplier").select(F.concat_ws("/", id_, F.lit("1"), F.concat(id_, end)).alias("path"), id_.alias("id"), F.lit("1").alias("submission_id"), content.alias("content"))
    return rows.withColumn("length", F.octet_length("content").cast("long"))


def raw_report(spark, sf_dir):
    """The download report of the even suppliers, and of nations that were skipped or failed."""
    s = I.table(spark, sf_dir, "supplier").where("s_suppkey % 2 = 0")
    n = I.table(spark, sf_dir, "nation")
    cols = lambda i, name, version, sub, size, status, reason, code: (i.alias("id"), name.alias("name"), version.alias("version"), sub.alias("submission_id"), size.cast("long").alias("source_bytes"), status.alias("status"), reason.alias("reason"), code.cast("int").alias("http_status"))
    none = F.lit(None)
    down = s.select(*cols(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")), F.col("s_name"), F.lit("2.0"), F.lit("1"), F.col("s_suppkey") * 3, F.lit("downloaded"), F.lit(""), none))
    skipped = F.col("n_nationkey") % 2 == 0
    other = n.select(*cols(
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")), F.col("n_name"), F.lit(""), F.lit("NA"), F.lit(0), F.when(skipped, "skipped").otherwise("error"),
        F.when(skipped, "too_large").otherwise("license_restricted"), F.when(~skipped, 403),
    ))
    return down.unionByName(other)


_LIMIT = 50_000
_STATS = """
SELECT 'S' || k AS id, CASE WHEN d IN (4, 5, 7, 9) THEN 'Failed' WHEN d = 6 THEN 'Skipped' ELSE 'OK' END AS status,
  CASE WHEN d IN (4, 5, 7, 9) THEN 'transform_error' WHEN d = 6 THEN 'too_large' ELSE '' END AS reason,
  CASE WHEN k % 2 = 0 THEN s_name ELSE '' END AS name, CASE WHEN k % 2 = 0 THEN '2.0' ELSE '' END AS version,
  CAST(CASE WHEN d IN (4, 5, 6, 7, 9) THEN 0 ELSE 1 END AS BIGINT) AS nodecount, CAST(CASE WHEN d IN (4, 5, 6, 7, 9) THEN 0 ELSE 8 END AS BIGINT) AS edgecount,
  CASE WHEN k % 2 = 0 THEN '1' ELSE 'NA' END AS submission_id, CAST(CASE WHEN k % 2 = 0 THEN k * 3 ELSE 0 END AS BIGINT) AS source_bytes, CAST(NULL AS INTEGER) AS http_status
FROM (SELECT s_suppkey AS k, s_suppkey % 10 AS d, s_name FROM supplier)
UNION ALL SELECT 'N' || n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN 'Skipped' ELSE 'Failed' END, CASE WHEN n_nationkey % 2 = 0 THEN 'too_large' ELSE 'license_restricted' END, n_name, '', 0, 0, 'NA', 0,
  CASE WHEN n_nationkey % 2 = 1 THEN 403 END FROM nation
"""


def _transform(spark, sf_dir):
    return T.transform(raw_sources(spark, sf_dir), raw_report(spark, sf_dir), _LIMIT)


@query(_STATS)
def transform_stats(spark, sf_dir):
    return _transform(spark, sf_dir)[2]


@query("""
SELECT 'http://x/s' || s_suppkey AS id, 'biolink:OntologyClass' AS category, s_name AS name, 'S' || s_suppkey AS provided_by, 'infores:any' AS aggregator_knowledge_source
FROM supplier WHERE s_suppkey % 10 IN (0, 1, 2, 3, 8)
""")
def transform_nodes(spark, sf_dir):
    return _transform(spark, sf_dir)[0].select("id", "category", "name", "provided_by", "aggregator_knowledge_source")


@query("""
SELECT 'http://x/s' || s_suppkey AS subject, CASE WHEN j = 7 THEN 'biolink:related_to' ELSE 'biolink:subclass_of' END AS predicate, CASE WHEN j = 7 THEN 'http://x/r' ELSE 'http://x/m' || j END AS object,
  CASE WHEN j = 7 THEN 'http://x/in' ELSE 'http://www.w3.org/2000/01/rdf-schema#subClassOf' END AS relation, 'S' || s_suppkey AS provided_by
FROM supplier, range(8) t(j) WHERE s_suppkey % 10 IN (0, 1, 2, 3, 8)
""")
def transform_edges(spark, sf_dir):
    return _transform(spark, sf_dir)[1].select("subject", "predicate", "object", "relation", "provided_by")


@query(f"SELECT count(*) FILTER (status = 'OK') AS totalcount, count(*) FILTER (status = 'Skipped') AS skippedcount, count(*) FILTER (status = 'Failed' AND reason <> 'license_restricted') AS failedcount, count(*) FILTER (reason = 'license_restricted') AS licensedcount, CAST(sum(nodecount) AS BIGINT) AS totalnodecount, CAST(sum(edgecount) AS BIGINT) AS totaledgecount FROM ({_STATS})")
def transform_totals(spark, sf_dir):
    return C.totals(_transform(spark, sf_dir)[2])


# --- serialisations ---------------------------------------------------------------------

_RDFS = "http://www.w3.org/2000/01/rdf-schema#"
_FORM_SQL = f"""
SELECT 'http://x/s' || s_suppkey AS subject, 'biolink:subclass_of' AS predicate, 'http://x/n' || s_nationkey AS object, '{_RDFS}subClassOf' AS relation FROM supplier
UNION ALL SELECT 'http://x/s' || s_suppkey, 'biolink:related_to', 'http://x/r' || (s_nationkey % 5), 'http://x/in' FROM supplier
UNION ALL SELECT 'http://x/s' || s_suppkey, 'biolink:subclass_of', 'http://x/top', '{_RDFS}subClassOf' FROM supplier
"""


def _form(form: str, template: str):
    """Edges of suppliers as classes below a top and equal to (nation and in some region), written in one form."""

    def of(spark, sf_dir):
        put = {"@S": F.concat(F.lit("s"), F.col("s_suppkey").cast("string")), "@N": F.concat(F.lit("n"), F.col("s_nationkey").cast("string")), "@R": F.concat(F.lit("r"), (F.col("s_nationkey") % 5).cast("string")), "@L": F.col("s_name")}
        doc = F.lit(template)
        for mark, value in put.items():
            doc = F.replace(doc, F.lit(mark), value)
        t = I.table(spark, sf_dir, "supplier").select(serial.triples(doc, F.col("s_suppkey").cast("string"), form).alias("t"))
        return G.triple_edges(G.relax(t.select(F.explode("t.triples").alias("t")).select("t.*")))

    return of


def _register(name: str, form: str, template: str) -> None:
    f = _form(form, template)
    f.__name__ = name
    query(_FORM_SQL)(f)


_register("form_turtle", "any", """
@prefix : <http://x/> . @prefix owl: <http://www.w3.org/2002/07/owl#> .
@prefix rdfs: <http://www.w3.org/2000/01/rdf-schema#> .
:@S a owl:Class ; rdfs:label "@L"@en ; rdfs:subClassOf :top ;  # a note
  owl:equivalentClass [ a owl:Class ; owl:intersectionOf ( :@N [ a owl:Restriction ; owl:onProperty :in ; owl:someValuesFrom :@R ] ) ] .
""")
_register("form_ntriples", "any", """
<http://x/@S> <http://www.w3.org/1999/02/22-rdf-syntax-ns#type> <http://www.w3.org/2002/07/owl#Class> .
<http://x/@S> <http://www.w3.org/2000/01/rdf-schema#subClassOf> <http://x/top> .
<http://x/@S> <http://www.w3.org/2002/07/owl#equivalentClass> _:e .
_:e <http://www.w3.org/2002/07/owl#intersectionOf> _:l1 .
_:l1 <http://www.w3.org/1999/02/22-rdf-syntax-ns#first> <http://x/@N> .
_:l1 <http://www.w3.org/1999/02/22-rdf-syntax-ns#rest> _:l2 .
_:l2 <http://www.w3.org/1999/02/22-rdf-syntax-ns#first> _:q .
_:l2 <http://www.w3.org/1999/02/22-rdf-syntax-ns#rest> <http://www.w3.org/1999/02/22-rdf-syntax-ns#nil> .
_:q <http://www.w3.org/2002/07/owl#onProperty> <http://x/in> .
_:q <http://www.w3.org/2002/07/owl#someValuesFrom> <http://x/@R> .
""")
_register("form_obo", "any", """format-version: 1.4
ontology: x

[Term]
id: http://x/@S
name: @L
is_a: http://x/top ! the top
intersection_of: http://x/@N
intersection_of: http://x/in http://x/@R
""")
_register("form_owl_xml", "any", """<?xml version="1.0"?>
<Ontology xmlns="http://www.w3.org/2002/07/owl#" xml:base="http://x/" ontologyIRI="http://x/o">
  <Prefix name="rdfs" IRI="http://www.w3.org/2000/01/rdf-schema#"/>
  <Declaration><Class IRI="@S"/></Declaration>
  <SubClassOf><Class IRI="@S"/><Class IRI="top"/></SubClassOf>
  <EquivalentClasses><Class IRI="@S"/><ObjectIntersectionOf><Class IRI="@N"/><ObjectSomeValuesFrom><ObjectProperty IRI="in"/><Class IRI="@R"/></ObjectSomeValuesFrom></ObjectIntersectionOf></EquivalentClasses>
  <AnnotationAssertion><AnnotationProperty abbreviatedIRI="rdfs:label"/><IRI>@S</IRI><Literal xml:lang="en">@L</Literal></AnnotationAssertion>
</Ontology>""")
_register("form_functional", "any", """Prefix(:=<http://x/>)
Prefix(rdfs:=<http://www.w3.org/2000/01/rdf-schema#>)
Ontology(<http://x/o>
  Declaration(Class(:@S))
  SubClassOf(Annotation(rdfs:comment "why") :@S :top)
  EquivalentClasses(:@S ObjectIntersectionOf(:@N ObjectSomeValuesFrom(:in :@R)))
  AnnotationAssertion(rdfs:label :@S "@L"@en)
)""")
_register("form_manchester", "any", """Prefix: : <http://x/>
Prefix: rdfs: <http://www.w3.org/2000/01/rdf-schema#>
Ontology: <http://x/o>
Class: @S
  Annotations: rdfs:label "@L"@en
  SubClassOf: top
  EquivalentTo: @N and (in some @R)
""")


def _world(spark, sf_dir):
    """Nations as individuals of regions, with properties, in Turtle."""
    n = I.table(spark, sf_dir, "nation")
    doc = F.concat(
        F.lit("@prefix : <http://x/> . @prefix owl: <http://www.w3.org/2002/07/owl#> . @prefix rdfs: <http://www.w3.org/2000/01/rdf-schema#> . @prefix oio: <http://www.geneontology.org/formats/oboInOwl#> .\n"),
        F.lit(":near a owl:ObjectProperty ; rdfs:domain :Nation ; rdfs:range :Nation ; rdfs:subPropertyOf :rel .\n:n"), F.col("n_nationkey").cast("string"), F.lit(" a owl:NamedIndividual , :r"), F.col("n_regionkey").cast("string"),
        F.lit(' ; :near :n0 ; rdfs:label "'), F.col("n_name"), F.lit('" ; oio:hasDbXref "X:'), F.col("n_nationkey").cast("string"), F.lit('" .\n'),
    )
    t = n.select(serial.triples(doc, F.col("n_nationkey").cast("string"), "turtle").alias("t"))
    return t.select(F.explode("t.triples").alias("t")).select("t.s", "t.p", "t.o").distinct()


@query("""
SELECT 'http://x/n' || n_nationkey AS id, 'biolink:NamedThing' AS category, n_name AS name FROM nation
UNION ALL SELECT 'http://x/near', 'biolink:RelationshipType', NULL
""")
def individuals_nodes(spark, sf_dir):
    return G.triple_nodes(_world(spark, sf_dir), G.KINDS).select("id", "category", "name")


@query("""
SELECT 'http://x/n' || n_nationkey AS subject, 'rdf:type' AS predicate, 'http://x/r' || n_regionkey AS object FROM nation
UNION ALL SELECT 'http://x/n' || n_nationkey, 'biolink:related_to', 'http://x/n0' FROM nation
UNION ALL SELECT 'http://x/n' || n_nationkey, 'biolink:xref', 'X:' || n_nationkey FROM nation
UNION ALL SELECT 'http://x/near', p, o FROM (VALUES ('rdfs:domain', 'http://x/Nation'), ('rdfs:range', 'http://x/Nation'), ('rdfs:subPropertyOf', 'http://x/rel')) t(p, o)
""")
def individuals_edges(spark, sf_dir):
    return G.triple_edges(_world(spark, sf_dir), G.AXIOMS, individuals=True).select("subject", "predicate", "object")


def _labels(spark, sf_dir):
    """Suppliers as classes with no, one or two labels, and with or without a parent."""
    k = F.col("s_suppkey")
    label = lambda x: F.concat(F.lit("<rdfs:label>"), F.col("s_name"), F.lit(x + "</rdfs:label>"))
    doc = F.concat(
        F.lit(_HEAD + '<owl:Class rdf:about="http://x/s'), k.cast("string"), F.lit('">'), F.when(k % 3 > 0, label("")).otherwise(""), F.when(k % 3 == 2, label(" too")).otherwise(""),
        F.when(k % 4 > 0, F.lit('<rdfs:subClassOf rdf:resource="http://x/top"/>')).otherwise(""), F.lit("</owl:Class></rdf:RDF>"),
    )
    t = I.table(spark, sf_dir, "supplier").select(rdf.triples(doc, k.cast("string")).alias("t"))
    return t.select(F.explode("t.triples").alias("t")).select("t.s", "t.p", "t.o")


@query("""
SELECT 'missing_label' AS rule, 'http://x/s' || s_suppkey AS subject FROM supplier WHERE s_suppkey % 3 = 0
UNION ALL SELECT 'multiple_labels', 'http://x/s' || s_suppkey FROM supplier WHERE s_suppkey % 3 = 2
UNION ALL SELECT 'no_parent', 'http://x/s' || s_suppkey FROM supplier WHERE s_suppkey % 4 = 0
""")
def quality_rules(spark, sf_dir):
    return G.quality_report(_labels(spark, sf_dir))


@query("SELECT CAST(count(*) + count(*) FILTER (s_suppkey % 3 > 0) + count(*) FILTER (s_suppkey % 3 = 2) AS BIGINT) AS n FROM supplier WHERE s_suppkey <> 4")
def removed_term(spark, sf_dir):
    left = G.remove_term(G.remove_term(_labels(spark, sf_dir), "http://x/s4"), "http://x/top")
    return left.where(F.col("s") != "http://x/o").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT 'http://x/s' || s_suppkey AS subject, 'http://x/top' AS object FROM supplier WHERE s_suppkey % 4 > 0 UNION SELECT 'http://x/n' || n_nationkey, 'http://x/r' || n_regionkey FROM nation
""")
def merged_ontologies(spark, sf_dir):
    t = G.merge_ontologies(_labels(spark, sf_dir), _labels(spark, sf_dir), _world(spark, sf_dir))
    return t.where(F.col("p").isin(G.RDFS + "subClassOf", G.RDF + "type") & (F.col("o") == "http://x/top") | F.col("o").rlike("^http://x/r[0-9]")).select(F.col("s").alias("subject"), F.col("o").alias("object"))


# --- archives and files -------------------------------------------------------------------


@query("""
SELECT 'S' || k AS id, m AS member, size, ok, reason FROM (
  SELECT s_suppkey AS k, s_suppkey % 10 AS d FROM supplier) s, LATERAL (
  SELECT 'readme.txt' AS m, CAST(9000 AS BIGINT) AS size, true AS ok, '' AS reason WHERE d = 2
  UNION ALL SELECT '__MACOSX/._S' || k || '.owl', 400, true, '' WHERE d IN (2, 5)
  UNION ALL SELECT 'notes.txt', 50, true, '' WHERE d = 3
  UNION ALL SELECT NULL, 0, false, 'transform_error' WHERE d = 4) x
""")
def archive_kinds(spark, sf_dir):
    """The side members of zip files and tarballs, and the broken ones."""
    files = raw_sources(spark, sf_dir).where(F.col("path").rlike(r"\.(zip|tar\.gz)$"))
    rows = files.select("id", F.explode(archives.members(F.col("content"), F.col("path"), limit_bytes=_LIMIT)).alias("m")).select("id", "m.member", "m.size", "m.ok", "m.reason")
    return rows.where(~F.lower(F.coalesce("member", F.lit(""))).rlike(r"^[do]/"))


@query("""
SELECT 'S' || s_suppkey AS id, CASE s_suppkey % 10 WHEN 1 THEN 'S' || s_suppkey || '.owl' WHEN 2 THEN 'd/S' || s_suppkey || '.owl' WHEN 3 THEN 'o/S' || s_suppkey || '.OWL' WHEN 6 THEN 'S' || s_suppkey || '.owl' END AS member,
  CASE WHEN s_suppkey % 10 IN (4, 5) THEN 'transform_error' WHEN s_suppkey % 10 = 6 THEN 'too_large' ELSE '' END AS reason
FROM supplier WHERE s_suppkey % 10 BETWEEN 1 AND 6
""")
def picked_sources(spark, sf_dir):
    """The member of each archive that is its source; a null one and a reason where there is none."""
    files = raw_sources(spark, sf_dir)
    return T.sources(files.where(T.compressed(F.col("path"))), _LIMIT).select("id", "member", "reason")


@query("""
SELECT 'S' || s_suppkey || '/1/S' || s_suppkey || CASE WHEN s_suppkey % 10 = 8 THEN '.ttl' ELSE '.owl' END AS path, 'S' || s_suppkey AS id, '1' AS submission_id, s_suppkey % 10 = 9 AS large FROM supplier WHERE s_suppkey % 10 IN (0, 7, 8, 9)
""")
def stored_files(spark, sf_dir):
    """Plain files written by the sink and read back; the large ones keep their row and not their bytes."""
    at = place(spark, "stored")
    files = raw_sources(spark, sf_dir).where(~T.compressed(F.col("path")))
    sinks.raw_files(files.withColumn("filename", X.basename(F.col("path"))), at)
    back = archives.stored_files(spark, at, _LIMIT)
    return back.select("path", "id", "submission_id", (F.col("content").isNull() & (F.col("reason") == "too_large")).alias("large"))


@query("SELECT 'N' || n_nationkey || '/1/' || n_name || '.txt' AS path, 'N' || n_nationkey AS id, n_nationkey % 5 = 0 AS large FROM nation")
def file_scan(spark, sf_dir):
    """Files of a folder; those beyond the limit are rows with a reason, files that lie too high don't count."""
    at = place(spark, "files")
    n = I.table(spark, sf_dir, "nation")
    for r in n.select("n_nationkey", "n_name").toLocalIterator():
        sinks._put(n, f"{at}/N{r.n_nationkey}/1/{r.n_name}.txt", b"x" * (2000 if r.n_nationkey % 5 == 0 else 10))
    sinks._put(n, f"{at}/stray.owl", b"x")
    sinks._put(n, f"{at}/N0/download_report.tsv", b"x")
    return archives.raw_files(spark, at, 1000).select("path", "id", (F.col("reason") == "too_large").alias("large"))


@query("SELECT n_nationkey, '�' || n_name || 'é' AS text FROM nation")
def bad_bytes(spark, sf_dir):
    """Whole files as text; what isn't UTF-8 is replaced."""
    at = place(spark, "bytes")
    n = I.table(spark, sf_dir, "nation")
    for r in n.select("n_nationkey", "n_name").toLocalIterator():
        sinks._put(n, f"{at}/{r.n_nationkey}.txt", b"\xff" + r.n_name.encode() + "é".encode())
    key = F.regexp_extract("path", r"(\d+)\.txt$", 1).cast(I.table(spark, sf_dir, "nation").schema["n_nationkey"].dataType)
    return tables.whole_text(spark, at).select(key.alias("n_nationkey"), "text")


# --- what writers wrote -------------------------------------------------------------------


@query(f"SELECT id, name, version, submission_id, source_bytes, status, reason, CAST(NULL AS INTEGER) AS http_status, '' AS path FROM ({I.REPORT_SQL})")
def report_round_trip(spark, sf_dir):
    at = place(spark, "report")
    sinks.download_report(I.report(spark, sf_dir), at)
    return tables.download_report(spark, at).drop("pos")


@query("SELECT 'P' || p_partkey AS id, p_name AS name, p_size || ' of ' || p_size AS current_version, CAST(p_partkey % 50 AS VARCHAR) AS submission_id FROM part")
def catalogue_round_trip(spark, sf_dir):
    at = place(spark, "catalogue")
    size = F.col("p_size").cast("string")
    p = I.table(spark, sf_dir, "part").select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("id"), F.col("p_name").alias("name"), X.short_version(F.concat(size, F.lit("\tof\n"), size, F.lit(" and more"))).alias("current_version"), (F.col("p_partkey") % 50).cast("string").alias("submission_id"))
    sinks.catalogue(p, at)
    return tables.catalogue(spark, at).select("id", "name", "current_version", "submission_id")


@query(I.INDEX_SQL + "SELECT id, status, reason, name, version, nodecount, edgecount, submission_id, download_url FROM idx")
def index_round_trip(spark, sf_dir):
    at = place(spark, "index") + ".yaml"
    index = C.index_overlay(I.base_index(spark, sf_dir), I.fragments(spark, sf_dir), "new").drop("pos")
    sinks.index_yaml(index, at)
    back = tables.index(spark, at)
    return back.select("id", "status", F.coalesce("reason", F.lit("")).alias("reason"), "name", "version", "nodecount", "edgecount", "submission_id", "download_url")


@query(I.INDEX_SQL + """
SELECT count(*) FILTER (status = 'OK') AS totalcount, count(*) FILTER (status = 'Skipped') AS skippedcount, count(*) FILTER (status = 'Failed') AS failedcount, CAST(0 AS BIGINT) AS licensedcount,
  CAST(sum(nodecount) AS BIGINT) AS totalnodecount, CAST(sum(edgecount) AS BIGINT) AS totaledgecount, '2026-01-02' AS transform_date FROM idx
""")
def totals_round_trip(spark, sf_dir):
    at = place(spark, "totals") + ".yaml"
    sinks.totals_yaml(C.totals(C.index_overlay(I.base_index(spark, sf_dir), I.fragments(spark, sf_dir), "new")), at, "2026-01-02")
    return tables.totals(spark, at)


@query(I.INDEX_SQL + "SELECT id, status, nodecount, download_url FROM idx")
def streamed_index(spark, sf_dir):
    """The index as two runs of the stream leave it: the base, then the fragments over it."""
    frag, index, checkpoint = (place(spark, x) for x in ("fragments", "streamed", "checkpoint"))
    for rows, prefix in ((I.base_index(spark, sf_dir), "base"), (I.fragments(spark, sf_dir), "new")):
        shaped = rows.select(*[F.col(c).cast(t).alias(c) if c in rows.columns else F.lit(None).cast(t).alias(c) for c, t in (x.split() for x in tables.INDEX.split(", "))])
        shaped.write.mode("append").parquet(frag)
        incremental.run(spark, frag, index, checkpoint, prefix).awaitTermination()
    return incremental.current(spark, index).select("id", "status", "nodecount", "download_url")


@query("""
WITH n AS (SELECT 'r:' || r_regionkey AS id, 'Region' AS category, r_name AS name, 'two' AS provided_by FROM region UNION ALL SELECT 'n:' || n_nationkey, 'Nation', n_name, 'one' FROM nation
  UNION ALL SELECT 'n:' || n_nationkey, 'Place', n_name, 'two' FROM nation)
SELECT id, string_agg(DISTINCT category, '|' ORDER BY category) AS category, min(name) AS name, string_agg(DISTINCT provided_by, '|' ORDER BY provided_by) AS provided_by FROM n GROUP BY id
""")
def merge_config(spark, sf_dir):
    """Graphs written as TSV, then merged as a configuration says; one source is left out."""
    at = place(spark, "merge")
    n, r = I.table(spark, sf_dir, "nation"), I.table(spark, sf_dir, "region")
    nation = lambda c: n.select(F.concat(F.lit("n:"), F.col("n_nationkey").cast("string")).alias("id"), F.lit(c).alias("category"), F.col("n_name").alias("name"))
    regions = r.select(F.concat(F.lit("r:"), F.col("r_regionkey").cast("string")).alias("id"), F.lit("Region").alias("category"), F.col("r_name").alias("name"))
    edges = n.select(F.concat(F.lit("n:"), F.col("n_nationkey").cast("string")).alias("subject"), F.lit("in").alias("predicate"), F.concat(F.lit("r:"), F.col("n_regionkey").cast("string")).alias("object"))
    for name, nodes in (("one", nation("Nation")), ("two", nation("Place").unionByName(regions)), ("three", nation("Never"))):
        sinks.tsv(nodes, f"{at}/{name}_nodes.tsv")
        sinks.tsv(edges, f"{at}/{name}_edges.tsv")
    files = "".join(f"    s_{x}:\n      name: {x}\n      input:\n        format: tsv\n        filename: [{at}/{x}_nodes.tsv, {at}/{x}_edges.tsv]\n" for x in ("one", "two", "three"))
    config = M.config("merged_graph:\n  name: g\n  source:\n" + files)
    nodes, _, _ = M.run(spark, config, exclude=["three"])
    return sinks.flat(nodes).select("id", "category", "name", "provided_by")


# --- small rules --------------------------------------------------------------------------


@query("SELECT doc_id, trim(regexp_replace(left(coalesce(text, ''), 200), '[\\x09-\\x0d\\x1c-\\x20\\x85\\xa0]+', ' ', 'g'), ' ') AS snippet FROM documents")
def snippets(spark, sf_dir):
    return I.table(spark, sf_dir, "documents").select("doc_id", X.snippet(F.col("text")).alias("snippet"))


@query("SELECT p_brand AS id, list_sort(list_distinct(list(p_type)))[1:3] AS fmts, list_sort(list_distinct(list(p_name)))[1:3] AS domains FROM part GROUP BY p_brand")
def card_lists(spark, sf_dir):
    sets = lambda c: F.array_sort(F.collect_set(c))
    p = I.table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("id")).agg(sets("p_type").alias("fmts"), sets("p_name").alias("domains"))
    return B.card(p).select("id", "fmts", "domains")


@query("SELECT p_brand AS id, list_sort(list_distinct(list(p_type)))[1:4] AS fmts, list_sort(list_distinct(list(p_name)))[1:4] AS taxa FROM part GROUP BY p_brand")
def page_lists(spark, sf_dir):
    sets = lambda c: F.array_sort(F.collect_set(c))
    p = I.table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("id")).agg(B.details(sets("p_type"), sets("p_name")).alias("d"))
    return p.select("id", "d.fmts", "d.taxa")


@query("SELECT page_id, 'https://catalogue.example/ontologies/p' || page_id AS link FROM pages")
def deep_links(spark, sf_dir):
    return I.table(spark, sf_dir, "pages").select("page_id", X.deep_link("https://catalogue.example/ontologies/", F.concat(F.lit("p"), F.col("page_id").cast("string"))).alias("link"))


@query("""
SELECT o_custkey AS id, string_agg(d, '|' ORDER BY d) AS dates FROM (SELECT DISTINCT o_custkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS d FROM orders) GROUP BY o_custkey
""")
def date_sort(spark, sf_dir):
    v = F.struct(F.to_date("o_orderdate").cast("string").alias("lex"), F.lit("date").alias("datatype"), F.lit(None).cast("string").alias("lang"))
    g = I.table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.collect_list(v).alias("v"))
    return g.select("id", G.join_values(G.sort_property(F.col("v"))).alias("dates"))


@query("SELECT count(*) AS sizes FROM (SELECT p_brand FROM part GROUP BY p_brand HAVING count(DISTINCT p_size % 2) = 2)")
def mixed_cells(spark, sf_dir):
    kind = F.when(F.col("p_size") % 2 == 0, "string").otherwise("int")
    v = F.struct(F.col("p_size").cast("string").alias("lex"), kind.alias("datatype"), F.lit(None).cast("string").alias("lang"))
    g = I.table(spark, sf_dir, "part").groupBy("p_brand").agg(F.collect_list(v).alias("sizes"))
    return G.mixed_count(g, "sizes")


@query(I.INDEX_SQL + "SELECT id, CASE WHEN status = 'OK' THEN 'Ontology transformed to a graph' ELSE 'Ontology — ' || lower(status) || CASE WHEN reason <> '' THEN ' (' || reason || ')' ELSE '' END END AS blurb, '1' AS version FROM idx")
def item_blurbs(spark, sf_dir):
    index = C.index_overlay(I.base_index(spark, sf_dir), I.fragments(spark, sf_dir), "new")
    return B.ontology_items(index).select("id", "blurb", "version")


@query("SELECT 'd' || doc_id AS id, row_number() OVER (ORDER BY lower(source || ' ' || lang || ' ' || doc_id), source, doc_id) AS place FROM documents")
def browse_places(spark, sf_dir):
    """The place of each item in the browse order, by ranges of the sort key instead of one task."""
    from ontoloom.plans.registry import _doc_items

    ordered = durable.materialize(B.browse_order(_doc_items(spark, sf_dir)).select("id").withColumn("pos", F.monotonically_increasing_id()), "order")
    return C.global_rank(ordered, "pos").select("id", (F.col("rank") + 1).alias("place"))


@query("SELECT 'd' || doc_id AS id, n_chars * 2 AS edges FROM documents WHERE n_chars % 4 <> 0 ORDER BY n_chars DESC, doc_id LIMIT 10")
def top10_edges(spark, sf_dir):
    from ontoloom.plans.registry import _doc_items

    return B.top_by(_doc_items(spark, sf_dir), "edges").select("id", "edges")


@query("""
SELECT 'd' || doc_id AS id, printf('%.2f', greatest(n_chars / m * 100, 0.8)) AS width FROM documents, (SELECT CAST(max(n_chars) AS DOUBLE) AS m FROM documents)
""")
def bar_widths(spark, sf_dir):
    d = I.table(spark, sf_dir, "documents")
    top = d.agg(F.max("n_chars").cast("double").alias("m"))  # one row
    return d.join(F.broadcast(top)).select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), N.two_decimals(N.bar_percent(F.col("n_chars"), F.col("m"))).alias("width"))


# --- more of what writers wrote ---------------------------------------------------------------


@query("SELECT 'P' || p_partkey AS id FROM part WHERE p_partkey % 3 > 0")
def listed_acronyms(spark, sf_dir):
    """The first column of a list, blank lines skipped."""
    at = place(spark, "list")
    id_ = F.when(F.col("p_partkey") % 3 > 0, F.concat(F.lit("P"), F.col("p_partkey").cast("string"))).otherwise(F.lit(" "))
    sinks.tsv(I.table(spark, sf_dir, "part").select(id_.alias("id"), F.col("p_name").alias("name")), at)
    return tables.acronyms(spark, at).select("id")


@query("SELECT t AS id, CAST(i AS BIGINT) AS pos FROM (VALUES ('GO', 0), ('hp', 1), ('X-1', 2)) v(t, i)")
def given_acronyms(spark, sf_dir):
    return tables.literal_acronyms(spark, "  GO\thp\n\nX-1 ").select("id", "pos")


@query(I.INDEX_SQL + "SELECT id, submission_id FROM idx WHERE pos % 3 > 0")
def known_submissions(spark, sf_dir):
    """The submissions of an index that names none for a third of its rows."""
    at = place(spark, "known") + ".yaml"
    index = C.index_overlay(I.base_index(spark, sf_dir), I.fragments(spark, sf_dir), "new")
    none = F.when(F.col("pos") % 2 == 0, "NA").otherwise("")
    sinks.index_yaml(index.withColumn("submission_id", F.when(F.col("pos") % 3 == 0, none).otherwise(F.col("submission_id"))).drop("pos"), at)
    return tables.index_submissions(spark, at)


@query("SELECT 'U' || user_id AS id, arg_max(event_type, event_id) AS status FROM events GROUP BY user_id")
def last_report_rows(spark, sf_dir):
    """A report in which most ids have several rows: the last one counts."""
    at = place(spark, "repeated-report")
    e = I.table(spark, sf_dir, "events").select(F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("id"), F.col("event_type").alias("status"), "event_id")
    sinks.download_report(e.orderBy("event_id"), at)
    return tables.report_by_id(spark, at).select("id", "status")


@query("SELECT 'n' || n_nationkey AS source, 'r' || r AS resource FROM (SELECT n_nationkey, unnest([n_nationkey % 5, 7]) AS r FROM nation)")
def registry_round_trip(spark, sf_dir):
    """Nations as registered graphs, drawn on by other resources, through the registry's JSON."""
    n = I.table(spark, sf_dir, "nation")
    names = [r[0] for r in n.select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string"))).collect()]  # a registry is of a catalogue's size
    graph = [{"id": x, "category": "KnowledgeGraph", "domains": ["d"], "products": [{"category": "GraphProduct", "original_source": [{"source": x}]}]} for x in names]
    drawn = [{"id": f"r{k}", "products": [{"id": "p", "original_source": [{"source": x} for x in names if k == 7 or int(x[1:]) % 5 == k] + [{"source": "nobody"}]}]} for k in (0, 1, 2, 3, 4, 7)]
    at = place(spark, "registry") + ".json"
    sinks._put(n, at, json.dumps({"resources": graph + drawn}).encode())
    return B.reverse_index(tables.resources(spark, at)).select("source", "resource")


@query("SELECT p_brand AS id, string_agg(DISTINCT p_type, '|' ORDER BY p_type) AS category, CAST(count(DISTINCT p_type) AS INTEGER) AS n FROM part GROUP BY p_brand")
def graph_table_round_trip(spark, sf_dir):
    at = place(spark, "table")
    p = I.table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("id")).agg(F.collect_list("p_type").alias("category"))
    sinks.tsv(sinks.flat(p), at)
    back = tables.graph_table(spark, at, ("category",))
    return back.select("id", G.join_values(F.col("category")).alias("category"), F.size("category").alias("n"))


@query("SELECT 'G_nodes.tsv' AS member, CAST(sum(strlen(n_name) + strlen('n' || n_nationkey) + 2) + 8 AS BIGINT) AS size, CAST(count(*) + 1 AS BIGINT) AS lines FROM nation UNION ALL SELECT 'G_edges.tsv', CAST(sum(strlen('n' || n_nationkey) + strlen('r' || n_regionkey) + 2) + 15 AS BIGINT), count(*) + 1 FROM nation")
def bundle_round_trip(spark, sf_dir):
    """Both tables of a graph in one tarball, read back as members."""
    at = place(spark, "bundle") + ".tar.gz"
    n = I.table(spark, sf_dir, "nation")
    id_ = lambda t, k: F.concat(F.lit(t), F.col(k).cast("string"))
    sinks.bundle(n.select(id_("n", "n_nationkey").alias("id"), F.col("n_name").alias("name")), n.select(id_("n", "n_nationkey").alias("subject"), id_("r", "n_regionkey").alias("object")), at, "G")
    rows = spark.read.format("binaryFile").load(at).select(F.explode(archives.members(F.col("content"), F.col("path"))).alias("m"))
    return rows.select("m.member", "m.size", (F.size(F.split(X.utf8(F.col("m.content")), "\n")) - 1).cast("long").alias("lines"))


@query(I.INDEX_SQL + "SELECT id, download_url FROM idx WHERE status = 'OK' AND download_url IS NOT NULL")
def manifest_round_trip(spark, sf_dir):
    at = place(spark, "manifest") + ".tsv"
    sinks.manifest(C.url_manifest(C.index_overlay(I.base_index(spark, sf_dir), I.fragments(spark, sf_dir), "new")), at)
    return tables.tsv(spark, at, "id string, download_url string").drop("pos")


@query("SELECT 'D' || doc_id AS a, source || ' ' || lang || ' ' || doc_id AS n, 'x' AS h, 'Doc' AS s FROM documents")
def search_json_round_trip(spark, sf_dir):
    from ontoloom.plans.registry import _doc_items

    at = place(spark, "search") + ".json"
    sinks.search_json(B.search_index(_doc_items(spark, sf_dir)), at)
    return spark.read.schema("a string, n string, h string, s string").option("multiLine", True).json(at)


@query("SELECT rank % 7 AS shard, string_agg(id, ' ' ORDER BY rank) AS acronyms FROM (SELECT 'S' || s_suppkey AS id, row_number() OVER (ORDER BY s_suppkey) - 1 AS rank FROM supplier) GROUP BY rank % 7")
def shards_json(spark, sf_dir):
    """The shard plan through its JSON, whose order is that of shards."""
    s = I.table(spark, sf_dir, "supplier").select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("id"), F.col("s_suppkey").alias("pos"))
    text = sinks.shards_json(C.shard_plan(s, 7))
    plan = spark.range(1).select(F.posexplode(F.from_json(F.lit(text), "array<string>")).alias("shard", "acronyms"))
    return plan.select(F.col("shard").cast("long").alias("shard"), "acronyms")


@query("SELECT 'node_stats' AS kind, 'provided_by' AS facet, 'nation' AS key, 'Nation' AS value, count(*) AS n FROM nation UNION ALL SELECT 'edge_stats', 'provided_by', 'nation', 'in_region', count(*) FROM nation")
def stats_round_trip(spark, sf_dir):
    """Facet counts of a graph through their YAML."""
    import yaml

    at = place(spark, "stats") + ".yaml"
    pick = lambda df: df.where("provided_by = 'nation'")
    counts = G.facets(pick(G.star_nodes(spark, sf_dir)), pick(G.star_edges(spark, sf_dir))).where("facet = 'provided_by'")
    sinks.stats_yaml(counts, at, "g")
    tree = yaml.safe_load("\n".join(r.value for r in spark.read.text(at, wholetext=True).collect()))
    rows = [(k, f, x, v, n) for k, facets in tree.items() if k != "graph_name" for f, keys in facets.items() for x, vs in keys.items() for v, n in vs.items()]
    return spark.createDataFrame(rows, "kind string, facet string, key string, value string, n long")
