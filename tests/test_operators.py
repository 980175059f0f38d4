"""Invariants and edge cases of the operators, on small tables."""

import gzip
import io
import json
import os
import re
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from ontoloom.functions import formats, vocab
from ontoloom.functions import text as X
from ontoloom.operators import browse, catalog, graph
from ontoloom.sources import archives, rdf, rest, sinks, tables
from ontoloom.streaming import incremental


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first().y


def entry(i, status="OK", reason="", **kw):
    ok = status == "OK"
    row = dict(id=i, status=status, reason=reason, name=i, version="1", nodecount=10 if ok else 0, edgecount=20 if ok else 0, submission_id="1", source_bytes=100, http_status=None, download_url=None)
    return row | kw


def index(spark, rows):
    names = [c.split()[0] for c in tables.INDEX.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], tables.INDEX)


# --- text ---------------------------------------------------------------------------


@pytest.mark.parametrize("text, want, n", [
    ('<?xml version="1.0"?>\n<a>\n  <owl:imports rdf:resource="x"/>\n<b/></a>', '<?xml version="1.0"?>\n<a>\n<b/></a>', 1),
    ('\n\t <rdf:RDF><owl:imports>\nx</owl:imports>\n<c/></rdf:RDF>', "\n\t <rdf:RDF><c/></rdf:RDF>", 1),
    ("<Ontology><Import>http://x</Import>\n<Import>y</Import></Ontology>", "<Ontology></Ontology>", 2),
    ("@prefix owl: <x> .\n<a> owl:imports <b> .", "@prefix owl: <x> .\n<a> owl:imports <b> .", 0),
    ("<?xml?><a/>", "<?xml?><a/>", 0),
    ("", "", 0),
])
def test_strip_imports(spark, text, want, n):
    assert one(spark, text, X.strip_imports) == want
    assert one(spark, text, X.count_imports) == n


@pytest.mark.parametrize("tag, kept", [
    ("de", True), ("fr-CH", True), ("sr-Latn-RS", True), ("deutschsprachig", True), ("q-own", True), ("art-2x3", True), ("", True), ("nl\n", True),
    ("a.b", False), ("pt_BR", False), ("two words", False), ("7", False), ("de-", False), ("-de", False), ("de--AT", False), ("d\u00e9", False), ("x1", False),
])
def test_language_tags(spark, tag, kept):
    for quote in "\"'":
        text = f"<a xml:lang={quote}{tag}{quote}>t</a>"
        assert one(spark, text, X.strip_bad_lang) == (text if kept else "<a>t</a>")
        assert one(spark, text, X.bad_langs) == ([] if kept else [tag])


def test_white_space_is_not_only_spaces(spark):
    assert one(spark, "\n\t x\r\n", X.ws_strip) == "x"
    assert one(spark, "  v1\n2024 (rc\t1) more", X.short_version) == "v1 2024 (rc"
    assert one(spark, " \t", X.short_version) == "NA"
    assert one(spark, None, X.short_version) == "NA"


@pytest.mark.parametrize("path, want", [("a/PatientSafety.zip", "patientsafety"), ("x/onto.tar.gz", "onto"), ("y.owl.gz", "y"), ("z", "z"), ("submission-23.zip", "submission-23")])
def test_archive_stem(spark, path, want):
    assert one(spark, path, X.archive_stem) == want


def test_small_text_functions(spark):
    assert one(spark, 'attachment; filename="a b.owl"', X.header_filename) == "a b.owl"
    assert one(spark, "inline", X.header_filename) is None
    assert one(spark, "biolink:A:b", X.short_category) == "A:b"
    assert one(spark, "plain", X.short_category) == "plain"
    assert one(spark, "<a & 'b'>", X.html_escape) == "&lt;a &amp; &#x27;b&#x27;&gt;"
    assert one(spark, None, X.html_escape) == ""
    assert one(spark, "x" * 111, X.blurb) == "x" * 110 + "…"
    assert one(spark, ".hidden", X.extension) == "" and one(spark, "d/a.OWL", X.extension) == ".owl"


@pytest.mark.parametrize("n, want", [(None, "—"), (0, "0"), (999, "999"), (1000, "1K"), (2500, "2K"), (999_999, "1000K"), (1_050_000, "1.1M"), (1_150_000, "1.1M"), (1_250_000, "1.2M")])
def test_abbrev(spark, n, want):
    assert spark.createDataFrame([(n,)], "x long").select(formats.abbrev(F.col("x")).alias("y")).first().y == want


@pytest.mark.parametrize("n, want", [(None, "—"), (0, "—"), (1023, "1023 B"), (1024, "1.0 KB"), (230_900_000, "220.2 MB"), (1 << 52, "4096.0 TB")])
def test_human_size(spark, n, want):
    assert spark.createDataFrame([(n,)], "x long").select(formats.human_size(F.col("x")).alias("y")).first().y == want


# --- catalogue ----------------------------------------------------------------------


def test_outcomes(spark):
    cases = [
        (" mesh ", 200, True, False, 200, True, None, "skiplist"), ("A", 500, True, False, 200, True, None, "metadata_http_error"), ("A", 200, False, False, 200, True, None, "no_submission"),
        ("A", 200, True, True, None, None, None, "download_error"), ("A", 200, True, False, 401, False, None, "license_restricted"), ("A", 200, True, False, 403, False, None, "license_restricted"),
        ("A", 200, True, False, 404, False, None, "no_download_file"), ("A", 200, True, False, 502, False, None, "download_http_error"), ("A", 200, True, False, 200, False, None, "not_downloadable"),
        ("A", 200, True, False, 200, True, 101, "too_large"), ("A", 200, True, False, 200, True, 100, ""), ("A", 200, True, False, 200, True, None, ""),
    ]
    df = spark.createDataFrame(cases, "a string, m int, s boolean, e boolean, c int, f boolean, n long, want string")
    reason = catalog.outcome(*[F.col(c) for c in ("a", "m", "s", "e", "c", "f", "n")], F.lit(None).cast("long"), 100)
    assert [r for r in df.select("a", "want", reason.alias("got")).collect() if r.want != r.got] == []
    assert set(vocab.REASON_TEXT) >= {c[-1] for c in cases} - {""}


def test_overlay_rules(spark):
    base = index(spark, [entry("A", download_url="old/A"), entry("B", download_url="old/B"), entry("C", "Failed", "transform_error")])
    new = index(spark, [entry("B", "Failed", "too_slow"), entry("C"), entry("D")])
    got = {r.id: r for r in catalog.index_overlay(base, new, "new").collect()}
    assert got["A"].download_url == "old/A"
    assert got["B"].status == "Failed" and got["B"].download_url is None
    assert got["C"].download_url == "new/C.tar.gz" and got["D"].download_url == "new/D.tar.gz"
    urls = catalog.url_manifest(catalog.index_overlay(base, new, "new")).collect()
    assert sorted(r.id for r in urls) == ["A", "C", "D"]


def test_giants_join_the_index_once(spark):
    idx = index(spark, [entry("MESH"), entry("A")])
    got = {r.id: r.status for r in catalog.add_giants(idx, spark.createDataFrame([("MESH",), ("GAZ",), ("GAZ",)], "id string")).collect()}
    assert got == {"MESH": "OK", "A": "OK", "GAZ": "Skipped"}


def test_totals(spark):
    rows = [entry("A"), entry("B", nodecount=5, edgecount=7), entry("C", "Skipped", "skiplist"), entry("D", "Skipped", "too_large"), entry("E", "Failed", "x"), entry("F", "Failed", "y"), entry("G", "Failed", vocab.LICENSED), entry("H", "Failed", vocab.LICENSED)]
    idx = index(spark, rows)
    assert tuple(catalog.totals(idx).first()) == (2, 2, 2, 2, 15, 27)
    assert catalog.accounted(idx).first().balanced
    assert tuple(catalog.totals(idx.where("false")).first()) == (0, 0, 0, 0, 0, 0)


def test_version_skip(spark):
    cat = spark.createDataFrame([("A", "1"), ("B", "2"), ("C", "NA"), ("D", "4"), ("E", None)], "id string, submission_id string")
    idx = index(spark, [entry("A", submission_id="1"), entry("B", submission_id="1"), entry("C", submission_id="NA"), entry("E", submission_id="")])
    assert sorted(r.id for r in catalog.changed(cat, idx).collect()) == ["B", "C", "D"]
    assert catalog.changed(cat, idx.where("false")).where("id <> 'E'").count() == 4


@pytest.mark.parametrize("n, shards", [(0, 3), (1, 3), (7, 3), (7, 0), (200, 20)])
def test_shards(spark, n, shards):
    items = spark.range(n).select(F.concat(F.lit("a"), F.col("id").cast("string")).alias("id"), (F.col("id") * 30_000).alias("pos"))
    got = {r.shard: r.acronyms.split() for r in catalog.shard_plan(items, shards).collect()}
    k = max(1, min(max(1, shards), n))
    assert got == {s: [f"a{i}" for i in range(s, n, k)] for s in range(k) if n}


# --- archives -------------------------------------------------------------------------


@pytest.mark.parametrize("members, acronym, archive, want", [
    ([("only.owl", 5)], "ZZ", "", "only.owl"),  # the only one
    ([("wide.owl", 7000), ("Qrs.owl", 3)], "QRS", "", "Qrs.owl"),  # the acronym, in any case of letters
    ([("wide.owl", 7000), ("qrs.ttl", 1)], "QRS", "", "qrs.ttl"),  # of any extension
    ([("low.rdf", 10), ("high.obo", 20), ("manual.pdf", 9000)], "QRS", "", "high.obo"),  # an ontology's extension, the larger one
    ([("LICENCE", 4), ("dump", 40)], "QRS", "", "dump"),  # no extension at all
    ([("__MACOSX/._qrs.owl", 8000), ("a/qrs.owl", 2)], "QRS", "", "a/qrs.owl"), ([("._qrs.owl", 8000), ("t.txt", 1)], "QRS", "", "t.txt"),  # junk
    ([("__MACOSX/y", 3), ("folder/", 0)], "QRS", "", None), ([], "QRS", "", None),  # nothing but junk
    ([("n.owl", 50), ("m.owl", 50)], "QRS", "", "m.owl"),  # ties by name
    ([("base.owl", 900), ("Stem.Owl", 90)], "QRS", "v/stem.zip", "Stem.Owl"),  # the archive's own name before size
    ([("qrs.owl", 900), ("stem.owl", 9)], "QRS", "stem.owl.tar.gz", "stem.owl"), ([("other.owl", 900), ("QRS.owl", 9)], "qrs", "release-4.zip", "QRS.owl"),  # before the acronym
])
def test_pick_member(spark, members, acronym, archive, want):
    """One row for each archive; a null member where none is left."""
    rows = members or [(None, None)]
    df = spark.createDataFrame([(m, n, acronym, archive, 1) for m, n in rows], "member string, size long, acronym string, archive_path string, k int")
    got = archives.pick_member(df, ["k"]).collect()
    assert [(r.member, r.size) for r in got] == [(want, dict(members).get(want))]


def packed():
    z, t = io.BytesIO(), io.BytesIO()
    with zipfile.ZipFile(z, "w") as f:
        f.writestr("d/", "")
        f.writestr("d/a.owl", "zip!")
    with tarfile.open(fileobj=t, mode="w:gz") as f:
        i = tarfile.TarInfo("b.owl")
        i.size = 4
        f.addfile(i, io.BytesIO(b"tar!"))
    return [("A/1/a.zip", z.getvalue()), ("A/1/odd-name", t.getvalue()), ("A/1/c.owl.gz", gzip.compress(b"gz!")), ("A/1/d.owl", b"plain"), ("A/1/bad.zip", b"PK\3\4broken"), ("A/1/none", None)]


def test_members(spark):
    df = spark.createDataFrame(packed(), "path string, content binary")
    rows = df.select("path", F.explode(archives.members(F.col("content"), F.col("path"))).alias("m")).select("path", "m.*").collect()
    assert {(r.member, bytes(r.content)) for r in rows if r.ok} == {("d/a.owl", b"zip!"), ("b.owl", b"tar!"), ("c.owl", b"gz!"), ("d.owl", b"plain"), ("none", b"")}
    assert [(r.path, r.reason) for r in rows if not r.ok] == [("A/1/bad.zip", "transform_error")]


def test_members_within_limits(spark):
    """A gzip bomb stops at the limit, a zip's large member isn't read, the others stay."""
    z = io.BytesIO()
    with zipfile.ZipFile(z, "w", zipfile.ZIP_DEFLATED) as f:
        f.writestr("big.owl", b"0" * 5_000_000)
        f.writestr("small.owl", b"s")
    df = spark.createDataFrame([("A/1/a.zip", bytearray(z.getvalue())), ("A/1/b.owl.gz", bytearray(gzip.compress(b"0" * 50_000_000)))], "path string, content binary")
    rows = df.select("path", F.explode(archives.members(F.col("content"), F.col("path"), limit_bytes=1_000_000)).alias("m")).select("m.*").collect()
    got = {r.member: (r.ok, r.reason, r.content and bytes(r.content)) for r in rows}
    assert got == {"big.owl": (False, "too_large", None), "small.owl": (True, "", b"s"), "b.owl": (False, "too_large", None)}
    assert {r.member: r.size for r in rows}["b.owl"] < 5_000_000
    with pytest.raises(archives.TooSlow):
        clock = archives.Clock(1e-9)
        list(archives.unpack(z.getvalue(), "a.zip", clock=clock))


def test_raw_files(spark, tmp_path):
    for p in ("GO/1/go.owl", "GO/download_report.tsv", "stray.owl", "HP/2/x/hp.owl"):
        (tmp_path / p).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / p).write_text("x")
    got = archives.raw_files(spark, str(tmp_path)).collect()
    assert {(r.path, r.id, r.submission_id) for r in got} == {("GO/1/go.owl", "GO", "1"), ("HP/2/x/hp.owl", "HP", "2")}
    (tmp_path / "HP/2/x/hp.owl").write_text("x" * 100)
    got = {r.id: (r.content and bytes(r.content), r.reason) for r in archives.raw_files(spark, str(tmp_path), 50).collect()}
    assert got == {"GO": (b"x", ""), "HP": (None, "too_large")}


# --- graphs ---------------------------------------------------------------------------

DOC = """<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:rdfs="http://www.w3.org/2000/01/rdf-schema#" xmlns:owl="http://www.w3.org/2002/07/owl#" xml:base="http://x/">
<owl:Class rdf:ID="A"><rdfs:label xml:lang="en">a</rdfs:label><rdfs:subClassOf rdf:resource="http://x/B"/>
<rdfs:subClassOf><owl:Restriction><owl:onProperty rdf:resource="http://x/p"/><owl:someValuesFrom rdf:resource="http://x/C"/></owl:Restriction></rdfs:subClassOf>
<owl:equivalentClass><owl:Class><owl:intersectionOf rdf:parseType="Collection"><rdf:Description rdf:about="http://x/D"/><rdf:Description rdf:about="http://x/E"/></owl:intersectionOf></owl:Class></owl:equivalentClass></owl:Class></rdf:RDF>"""


def test_rdf_to_graph(spark):
    df = spark.createDataFrame([(DOC, "1"), ("<broken", "2"), (None, "3")], "t string, k string")
    parsed = df.select("k", rdf.triples(F.col("t"), F.col("k")).alias("r"))
    assert [r.k for r in parsed.where("not r.ok").collect()] == ["2", "3"]
    t = parsed.select(F.explode("r.triples").alias("x")).select("x.*")
    edges = {(r.subject, r.relation.rsplit("/", 1)[-1], r.object) for r in graph.triple_edges(graph.relax(t)).collect()}
    sub = "rdf-schema#subClassOf"
    assert edges == {("http://x/#A", sub, "http://x/B"), ("http://x/#A", "p", "http://x/C"), ("http://x/#A", sub, "http://x/D"), ("http://x/#A", sub, "http://x/E")}
    assert [(r.id, r.name) for r in graph.triple_nodes(t).collect()] == [("http://x/#A", "a")]
    assert graph.remove_term(t, "http://x/p").count() == t.count() - 1
    assert {(r.rule, r.subject) for r in graph.quality_report(t.where("p not like '%label'")).collect()} == {("missing_label", "http://x/#A")}


def values(*pairs):
    return [(x, k, None) for x, k in pairs]


@pytest.mark.parametrize("vals, want, is_mixed", [
    (values(("10", "int"), ("2", "int"), ("1", "int"), ("2", "int")), ["1", "2", "10"], False), (values(("b", "string"), ("a", "string")), ["a", "b"], False),
    (values(("9007199254740993", "long"), ("9007199254740992", "long"), ("1e300", "double")), ["9007199254740992", "9007199254740993", "1e300"], False),
    (values(("2024-10-01", "date"), ("2024-9-30", "date")), ["2024-9-30", "2024-10-01"], False),
    (values(("10", "int"), ("9", "string")), ["10", "9"], True), (values(("2024-01-01", "date"), ("x", "string")), ["2024-01-01", "x"], True), ([], [], False),
])
def test_property_sort(spark, vals, want, is_mixed):
    df = spark.createDataFrame([(vals,)], "v array<struct<lex:string,datatype:string,lang:string>>")
    r = df.select(graph.sort_property(F.col("v")).alias("s"), graph.mixed(F.col("v")).alias("m")).first()
    assert r.s == want and r.m == is_mixed


def test_reachable_ends_in_cycles(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "subject string, object string")
    got = graph.reachable(e, spark.createDataFrame([("a",)], "id string"), 10).collect()
    assert {(r.id, r.hops) for r in got} == {("a", 0), ("b", 1), ("c", 2)}


# --- browse ----------------------------------------------------------------------------


def test_items_and_pages(spark):
    idx = index(spark, [entry("a", download_url="u", version="NA"), entry("b"), entry("c", "Failed", vocab.LICENSED), entry("d", "Skipped", "skiplist"), entry("e", "", "")]).withColumn("pos", F.lit(0))
    got = {r.id: r for r in browse.ontology_items(idx).collect()}
    assert got["a"].version == "" and got["a"].nodes == 10 and got["a"].fmts == ["kgx"]
    assert got["c"].status_label == "Licensed" and got["c"].nodes is None and got["d"].blurb.endswith("skipped (skiplist)") and got["e"].status_label == "—"
    states = {r.id: r.state for r in browse.page_state(browse.ontology_items(idx)).collect()}
    assert states == {"a": "download", "b": "unlocated", "c": "explained", "d": "explained", "e": "explained"}


def test_metrics_of_nothing(spark):
    df = spark.createDataFrame([("x", None)], "id string, n string").select(F.lit(None).cast(f"array<{browse._PRODUCT}>").alias("p"))
    m = df.select(browse.metrics(F.col("p")).alias("m"), browse.primary_product(F.col("p")).alias("b"), browse.formats(F.col("p")).alias("f")).first()
    assert m.m.nodes is None and m.m.categories is None and m.b is None and m.f == []


# --- sources, sinks, streams ---------------------------------------------------------------


def test_tables_round_trip(spark, tmp_path):
    (tmp_path / "l.tsv").write_text("id\tname\tcurrent_version\tsubmission_id\nGO\tGene\t1\t7\n\nHP\tx\t2\nGO\tGene\t1\t8\n")
    cat = tables.catalogue(spark, str(tmp_path / "l.tsv"))
    assert [(r.id, r.submission_id) for r in catalog.submissions(cat).orderBy("pos").collect()] == [("GO", "8"), ("HP", "")]
    assert tables.download_report(spark, str(tmp_path / "none.tsv")).count() == 0
    assert [r.id for r in tables.literal_acronyms(spark, " GO\n HP ").collect()] == ["GO", "HP"]
    idx = index(spark, [entry("NO"), entry("B", download_url="u")])
    sinks.index_yaml(idx, str(tmp_path / "i.yaml"))
    back = tables.index(spark, str(tmp_path / "i.yaml"))
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, idx.collect()), key=str)
    sinks.totals_yaml(catalog.totals(idx), str(tmp_path / "t.yaml"), "2026-01-01")
    assert tuple(tables.totals(spark, str(tmp_path / "t.yaml")).first()) == (2, 0, 0, 0, 20, 40, "2026-01-01")
    assert tables.totals(spark, str(tmp_path / "none.yaml")).count() == 0
    (tmp_path / "f.yaml").write_text("ontologies:\n- name: A\n  test_set: true\n- name: B\n")
    assert [r.name for r in tables.flagged(tables.test_list(spark, str(tmp_path / "f.yaml")), "test_set").collect()] == ["A"]
    facets = spark.createDataFrame([("node", "provided_by", "s1", "Class", 3)], "kind string, facet string, key string, value string, n long")
    sinks.stats_yaml(facets, str(tmp_path / "s.yaml"), "g")
    assert "Class: 3" in (tmp_path / "s.yaml").read_text()
    sinks.raw_files(spark.createDataFrame([("GO", "7", "go.owl", bytearray(b"x")), ("HP", "1", None, None)], "id string, submission_id string, filename string, content binary"), str(tmp_path / "raw"))
    assert [(r.path, r.id, r.submission_id, r.length, bytes(r.content), r.reason) for r in archives.stored_files(spark, str(tmp_path / "raw")).collect()] == [("GO/7/go.owl", "GO", "7", 1, b"x", "")]
    sinks.manifest(catalog.url_manifest(idx), str(tmp_path / "m.tsv"))
    assert (tmp_path / "m.tsv").read_text() == "id\tdownload_url\nB\tu\n"
    sinks.bundle(spark.createDataFrame([("n1", ["b", "a"])], "id string, category array<string>"), spark.createDataFrame([("n1", "n2")], "subject string, object string"), str(tmp_path / "g.tar.gz"), "G")
    with tarfile.open(tmp_path / "g.tar.gz") as t:
        assert t.extractfile("G_nodes.tsv").read() == b"id\tcategory\nn1\tb|a\n"


def test_registry_json(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps({"resources": [{"id": "k", "category": "KnowledgeGraph", "products": [{"category": "GraphProduct", "node_count": 3, "format": "ttl", "original_source": [{"source": "k"}]}]}, {"id": "l", "name": None, "products": [{"original_source": [{"source": "k"}, {"source": "k"}]}]}]}))
    r = tables.resources(spark, str(tmp_path / "r.json"))
    assert [(x.source, x.resource) for x in browse.reverse_index(r).collect()] == [("k", "l")]
    item = browse.graph_items(r).first()
    assert (item.name, item.nodes, item.fmts) == ("k", 3, ["ttl"])


def fake(url, key, limit):
    path = re.sub("^x/", "", url)
    if path == "analytics":
        return 200, {}, b'{"GO": 1, "LIC": 1, "GONE": 1, "BAD": 1, "MESH": 1, "ODD": 1, "BIG": 1}'
    name = path.split("/")[1]
    if path.endswith("/download"):
        code = {"LIC": 403, "GONE": 404}.get(name, 200)
        header = {} if name == "ODD" else {"Content-Disposition": f'attachment; filename="{name}.owl"'}
        return code, header, b"x" * (200 if name == "BIG" else 3)
    if path.endswith("latest_submission"):
        return 200, {}, b'{"submissionId": 5, "version": null}'
    return (500 if name == "BAD" else 200), {}, json.dumps({"name": name.lower()}).encode()


def test_rest_reader():
    reader = rest.RestReader({"url": "x", "limit_bytes": "100", "parallel": "3"}, fake)
    rows = {r[0]: r for p in reader.partitions() for r in reader.read(p)}
    assert {k: r[6] for k, r in rows.items()} == {"GO": "", "LIC": "license_restricted", "GONE": "no_download_file", "BAD": "metadata_http_error", "MESH": "skiplist", "ODD": "not_downloadable", "BIG": "too_large"}
    assert rows["GO"][1:5] == ("go", "NA", "5", 3) and rows["GO"][8:] == ("GO.owl", b"xxx")


def test_rest_catalogue(spark, tmp_path):
    import http.client

    def answers(url, key, limit):
        name = url.split("/")[2] if "/" in url[2:] else ""
        if name == "CUT":
            raise http.client.IncompleteRead(b"x")
        body = {"A": {"submissionId": 4, "version": "one\ttwo three four", "ontology": {"name": "a\nb"}}, "B": {}, "C": {"submissionId": 1, "version": None, "ontology": {"name": "c"}}}
        return 200, {}, json.dumps(body.get(name, {})).encode()

    reader = rest.RestReader({"url": "x", "what": "catalogue", "acronyms": "A,B,C,CUT"}, answers)
    rows = sorted(r for p in reader.partitions() for r in reader.read(p))
    assert rows == [("A", "a b", "one two three", "4"), ("B", "B", "NA", "NA"), ("C", "c", "NA", "1"), ("CUT", "CUT", "NA", "NA")]
    sinks.catalogue(spark.createDataFrame(rows, rest.CATALOGUE_SCHEMA), str(tmp_path / "c.tsv"))
    assert sorted(map(tuple, tables.catalogue(spark, str(tmp_path / "c.tsv")).drop("pos").collect())) == rows
    assert rest.acquire("x", "CUT", "", 0, answers)[6] == "metadata_http_error"


def test_rest_source_registers(spark):
    spark.dataSource.register(rest.RestCatalogue)
    got = spark.read.format("rest_catalogue").option("url", "x").option("acronyms", "MESH, GAZ").load()
    assert sorted((r.id, r.reason) for r in got.collect()) == [("GAZ", "skiplist"), ("MESH", "skiplist")]


def test_stream_of_fragments(spark, tmp_path):
    frag, out, cp = (str(tmp_path / x) for x in ("frag", "out", "cp"))
    index(spark, [entry("A"), entry("B", "Failed", "too_slow")]).write.mode("append").parquet(frag)
    incremental.run(spark, frag, out, cp, "r1").awaitTermination()
    index(spark, [entry("B"), entry("A", "Failed", "x")]).where("id = 'B'").write.mode("append").parquet(frag)
    incremental.run(spark, frag, out, cp, "r2").awaitTermination()
    got = {r.id: r.download_url for r in incremental.current(spark, out).collect()}
    assert got == {"A": "r1/A.tar.gz", "B": "r2/B.tar.gz"}
    assert incremental.current(spark, str(tmp_path / "none")) is None
    assert os.path.isdir(out)
