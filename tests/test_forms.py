"""Readers of ontology serialisations, by hand."""

import pytest
from pyspark.sql import functions as F

from ontoloom.operators import graph, merge, transform
from ontoloom.sources import rdf, serial, sinks, tables
from ontoloom.sources.archives import Clock, TooSlow

O, R = serial.OWL, serial.RDFS


def plain(triples):
    """Triples with blank nodes written out as what they hold."""
    by = {}
    for t in triples:
        by.setdefault(t["s"], []).append(t)

    def shown(x, literal):
        return "[" + " ".join(sorted(t["p"] + " " + shown(t["o"], t["literal"]) for t in by.get(x, []))) + "]" if not literal and x.startswith("_:") else x

    return sorted((t["s"], t["p"], shown(t["o"], t["literal"]), t["lang"]) for t in triples if not t["s"].startswith("_:"))


def test_turtle_syntax():
    doc = """@base <http://b/d/> . PREFIX : <#>
    <x> :p "a", '''long "one"
    two'''@de-AT ; :q 1, -2.5, 3e2, true ; .   # rest
    [ :p [] ] :q ( 1 ( ) <../y> ) .
    _:n :p _:n, "\\u00e9\\t"^^<http://t> . :a.b :p :c\\,d ."""
    got = serial.turtle(doc)
    assert ("http://b/d/x", "http://b/d/#p", 'long "one"\n    two', "de-AT") in plain(got)
    assert {(t["o"], t["datatype"].split("#")[1]) for t in got if t["p"].endswith("#q") and t["literal"]} == {("1", "integer"), ("-2.5", "decimal"), ("3e2", "double"), ("true", "boolean")}
    assert {t["o"] for t in got if t["s"] == "_:n"} == {"_:n", "\u00e9\t"} and ("http://b/d/#a.b", "http://b/d/#p", "http://b/d/#c,d", None) in plain(got)
    assert any(t["o"] == "http://b/y" for t in got) and sum(t["o"] == rdf.RDF + "nil" for t in got) == 2


@pytest.mark.parametrize("form, doc", [
    ("turtle", "<a> <b>"), ("turtle", "x:y x:z x:w ."), ("turtle", '<a> <b> "open'), ("obo", "[Term]\nname: x"), ("obo", "[Term]\nno tag"), ("owl_xml", "<a/>"), ("owl_xml", "<Ontology><SubClassOf><What/></SubClassOf></Ontology>"),
    ("functional", "Ontology(SubClassOf(<a>"), ("functional", "Ontology(SubClassOf(<a> What(<b>)))"), ("manchester", "Class: <a> SubClassOf: (<b>"), ("any", ""), ("any", "<broken"),
])
def test_broken_documents_are_rows(spark, form, doc):
    r = spark.createDataFrame([(doc,), (None,)], "t string").select(serial.triples(F.col("t"), F.lit("k"), form).alias("r")).collect()
    assert (r[0].r.ok, r[0].r.reason, r[0].r.triples) == (False, "transform_error", [])


def test_obo_tags():
    doc = """format-version: 1.2
ontology: z

[Term]
id: Z:1
name: one ! not a note? no
def: "what ! it \\"is\\"" [A:1, B:2] {by="me"}
synonym: "uno" BROAD [X:1]
synonym: "eins" []
xref: Q:9 "a name"
is_a: Z:2 {all="x"} ! two
relationship: part_of Z:3 ! three
equivalent_to: Z:7
disjoint_from: Z:8
is_obsolete: true

[Typedef]
id: part_of
is_a: rel
domain: Z:1
"""
    z, ns = "http://purl.obolibrary.org/obo/Z_", "http://purl.obolibrary.org/obo/z#"
    got = {(p.rsplit("#", 1)[-1].rsplit("/", 1)[-1], o) for s, p, o, _ in plain(serial.obo(doc)) if s == z + "1"}
    some = f"[{rdf.RDF}type {O}Restriction {O}onProperty {ns}part_of {O}someValuesFrom {z}3]"
    assert {("label", "one"), ("IAO_0000115", 'what ! it "is"'), ("hasBroadSynonym", "uno"), ("hasRelatedSynonym", "eins"), ("hasDbXref", "Q:9"), ("subClassOf", z + "2"), ("subClassOf", some)} <= got
    assert {("equivalentClass", z + "7"), ("disjointWith", z + "8"), ("deprecated", "true"), ("type", O + "Class")} <= got
    assert (ns + "part_of", R + "subPropertyOf", ns + "rel", None) in plain(serial.obo(doc)) and (ns + "part_of", R + "domain", z + "1", None) in plain(serial.obo(doc))


def test_expressions_agree():
    """Union, complement, value, cardinality and one-of in three forms."""
    fun = """Prefix(:=<http://x/>) Ontology(Declaration(Class(:A)) SubClassOf(:A ObjectUnionOf(:B ObjectComplementOf(:C))) SubClassOf(:A ObjectHasValue(:p :i))
      SubClassOf(:A ObjectMinCardinality(2 :p :D)) SubClassOf(:A ObjectExactCardinality(1 :p)) EquivalentClasses(:A ObjectOneOf(:i :j)) SubClassOf(:A ObjectAllValuesFrom(:p :D)))"""
    man = """Prefix: : <http://x/>
      Class: A
        SubClassOf: B or not C, p value i, p min 2 D, p exactly 1, p only D
        EquivalentTo: {i, j}"""
    xml = """<Ontology xmlns="http://www.w3.org/2002/07/owl#" xml:base="http://x/"><Declaration><Class IRI="A"/></Declaration>
      <SubClassOf><Class IRI="A"/><ObjectUnionOf><Class IRI="B"/><ObjectComplementOf><Class IRI="C"/></ObjectComplementOf></ObjectUnionOf></SubClassOf>
      <SubClassOf><Class IRI="A"/><ObjectHasValue><ObjectProperty IRI="p"/><NamedIndividual IRI="i"/></ObjectHasValue></SubClassOf>
      <SubClassOf><Class IRI="A"/><ObjectMinCardinality cardinality="2"><ObjectProperty IRI="p"/><Class IRI="D"/></ObjectMinCardinality></SubClassOf>
      <SubClassOf><Class IRI="A"/><ObjectExactCardinality cardinality="1"><ObjectProperty IRI="p"/></ObjectExactCardinality></SubClassOf>
      <EquivalentClasses><Class IRI="A"/><ObjectOneOf><NamedIndividual IRI="i"/><NamedIndividual IRI="j"/></ObjectOneOf></EquivalentClasses>
      <SubClassOf><Class IRI="A"/><ObjectAllValuesFrom><ObjectProperty IRI="p"/><Class IRI="D"/></ObjectAllValuesFrom></SubClassOf></Ontology>"""
    a, b, c = plain(serial.functional(fun)), plain(serial.manchester(man)), plain(serial.owl_xml(xml))
    assert len(a) == 7 and a == b == c


def test_time_and_depth(spark):
    with pytest.raises(TooSlow):
        serial.turtle("<a> <b> <c> .\n" * 20_000, clock=Clock(1e-6))
    deep = "<a>" * 3000 + "</a>" * 3000
    r = spark.createDataFrame([(deep,)], "t string").select(rdf.triples(F.col("t"), F.lit("")).alias("r")).first().r
    assert (r.ok, r.reason) == (False, "transform_error")


def test_base_is_resolved():
    doc = '<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:e="http://e/" xml:base="http://b/c/d.owl"><rdf:Description rdf:about="x"><e:p rdf:resource="../y"/><e:q rdf:nodeID="anon-1"/></rdf:Description><rdf:Description><e:p rdf:resource="#z"/></rdf:Description></rdf:RDF>'
    got = rdf.parse(doc)
    assert ("http://b/c/x", "http://e/p", "http://b/y") in {(t["s"], t["p"], t["o"]) for t in got}
    assert any(t["o"] == "http://b/c/d.owl#z" for t in got)


def test_graphs_stay_apart(spark):
    """The same blank node in two graphs, and an equivalence in one of them only."""
    some = [("_:r", O + "onProperty", "p"), ("_:r", O + "someValuesFrom", "c")]
    rows = [("g1", "a", R + "subClassOf", "_:r"), *[("g1", *t) for t in some], ("g2", "b", R + "subClassOf", "_:r"), ("g2", "_:r", O + "onProperty", "q"), ("g2", "_:r", O + "someValuesFrom", "d")]
    t = spark.createDataFrame(rows, "g string, s string, p string, o string")
    assert sorted((r.g, r.subject, r.relation, r.object) for r in graph.triple_edges(graph.relax(t)).collect()) == [("g1", "a", "p", "c"), ("g2", "b", "q", "d")]


def test_units():
    assert (transform.megabytes(0.0000015), transform.megabytes(100), transform.minutes(0.51), transform.minutes(30)) == (1, 104857600, 30, 1800)


def test_merge_writes_what_is_configured(spark, tmp_path):
    for n in ("a", "b"):
        sinks.tsv(spark.createDataFrame([("x", n.upper() + "|K")], "id string, category string"), str(tmp_path / f"{n}_nodes.tsv"))
        sinks.tsv(spark.createDataFrame([("x", "is", "y")], "subject string, predicate string, object string"), str(tmp_path / f"{n}_edges.tsv"))
    text = "merged_graph:\n  name: m\n  source:\n" + "".join(f"    s{n}:\n      name: {n}\n      input: {{format: tsv, filename: [{tmp_path}/{n}_nodes.tsv, {tmp_path}/{n}_edges.tsv]}}\n" for n in "ab")
    text += "  operations:\n    - name: stats\n      args: {graph_name: g, filename: s.yaml, node_facet_properties: [provided_by], edge_facet_properties: [provided_by]}\n  destination:\n    d: {format: tsv, compression: tar.gz, filename: out}\n"
    nodes, edges, facets = merge.run(spark, merge.config(text), str(tmp_path))
    assert [(r.id, r.category, r.provided_by) for r in nodes.collect()] == [("x", ["A", "B", "K"], ["a", "b"])] and edges.count() == 1
    assert {(r.kind, r.key, r.value, r.n) for r in facets.collect()} == {("node", k, v, 1) for k in "ab" for v in ("A", "B", "K")} | {("edge", k, "is", 1) for k in "ab"}
    assert (tmp_path / "out.tar.gz").exists() and "graph_name: g" in (tmp_path / "s.yaml").read_text()
    assert merge.run(spark, merge.config(text), include=["b"])[0].first().provided_by == ["b"]
    assert tables.graph_table(spark, str(tmp_path / "a_nodes.tsv")).count() == 1
