"""What lies behind a prefix, a depth or a subset counts like the rest."""

from pyspark.sql import functions as F

from ontoloom.operators import browse, graph
from ontoloom.plans import inputs, registry
from ontoloom.sources import rdf


def save(spark, folder, **frames):
    for name, (rows, schema) in frames.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_whole_pages_are_stripped(spark, tmp_path):
    far = "x" * 70_000
    html = f'{far}<owl:imports rdf:resource="http://x/b"/>\n<b xml:lang="a.b">{far}</b>\n<Import>{far}</Import>end'
    sf = save(spark, tmp_path, pages=([(1, html), (2, far), (3, None)], "page_id long, html string"))
    head = '<?xml version="1.0"?>\n<rdf:RDF>\n'
    got = {r.page_id: (r.removed, r.text) for r in registry.strip_imports(spark, sf).collect()}
    assert got[1] == (3, f'{head}<a xml:lang="en-GB">{far}<b xml:lang="a.b">{far}</b>\nend</a></rdf:RDF>')
    assert got[2] == (1, f'{head}<a xml:lang="gmail.com">{far}</a></rdf:RDF>')
    assert got[3][1] is None
    kept = {r.page_id: r.text for r in registry.strip_langtag(spark, sf).collect()}
    imports = '  <owl:imports rdf:resource="http://x/a"/>\n'
    assert kept[1] == f'{head}{imports}<a xml:lang="en-GB">' + html.replace(' xml:lang="a.b"', "") + "</a></rdf:RDF>"
    assert kept[2] == f"{head}{imports}<a>{far}</a></rdf:RDF>"
    assert {r.tag: r.n for r in registry.removed_tags(spark, sf).collect()} == {"gmail.com": 1, "a.b": 1}


def test_long_intersections(spark):
    """21 members each, the last of them a restriction; one list of one member, and one that leads back into itself."""
    names = "".join(f'<rdf:Description rdf:about="http://x/m{i}"/>' for i in range(20))
    some = '<owl:Restriction><owl:onProperty rdf:resource="http://x/p"/><owl:someValuesFrom rdf:resource="http://x/c"/></owl:Restriction>'
    doc = (
        '<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:owl="http://www.w3.org/2002/07/owl#"><owl:Class rdf:about="http://x/a">'
        '<owl:equivalentClass><owl:Class><owl:intersectionOf rdf:parseType="Collection">{}</owl:intersectionOf></owl:Class></owl:equivalentClass></owl:Class></rdf:RDF>'
    )
    docs = spark.createDataFrame([(doc.format(names + some), "1"), (doc.replace("x/a", "x/b").format(names[: names.index("/>") + 2]), "2")], "t string, k string")
    t = docs.select(F.explode(rdf.triples(F.col("t"), F.col("k"))["triples"]).alias("x")).select("x.s", "x.p", "x.o")
    ring = [("r", graph.OWL + "equivalentClass", "_:x"), ("_:x", graph.OWL + "intersectionOf", "_:0")]
    ring += [(f"_:{i}", graph.RDF + p, o) for i in range(5) for p, o in (("first", f"y{i}"), ("rest", f"_:{(i + 1) % 5}"))]
    edges = graph.triple_edges(graph.relax(t.unionByName(spark.createDataFrame(ring, t.schema))))
    got = sorted((r.subject, r.predicate, r.object) for r in edges.collect())
    sub = "biolink:subclass_of"
    want = [("http://x/a", sub, f"http://x/m{i}") for i in range(20)] + [("http://x/a", "biolink:related_to", "http://x/c"), ("http://x/b", sub, "http://x/m0")]
    assert got == sorted(want + [("r", sub, f"y{i}") for i in range(5)])


def test_every_line_item_is_a_product(spark, tmp_path):
    """Suppliers 2 and 202 stay two resources; an order's lines come by number, lines of equal number by part."""
    lines = [(2, 7, 3, 3, 9.0), (2, 7, 2, 6, 8.0), (2, 7, 1, 1, 5.0), (2, 7, 1, 12, 8.0), (202, 5, 2, 2, 1.0), (202, 4, 2, 5, 1.0)]
    sf = save(spark, tmp_path, lineitem=(lines, "l_suppkey long, l_orderkey long, l_linenumber int, l_partkey long, l_quantity double"))
    got = {r.id: r for r in inputs.resources(spark, sf).collect()}
    assert {k: [p.id for p in r.products] for k, r in got.items()} == {"R2": ["1", "12", "6", "3"], "R202": ["5", "2"]}
    assert {r.id: (r.nodes, r.best) for r in registry.graph_metrics(spark, sf).collect()} == {"R2": (9000, "3"), "R202": (None, None)}
    assert {r.id: r.fmts for r in registry.graph_formats(spark, sf).collect()} == {"R2": "ttl,kgx,json", "R202": "ttl"}
    assert {(r.source, r.resource) for r in registry.reverse_index(spark, sf).collect()} == set()
    lines += [(14, 1, 2, 2, 1.0), (28, 1, 2, 4, 1.0), (228, 1, 2, 4, 1.0), (35, 1, 2, 2, 1.0)]
    (more := tmp_path / "more").mkdir()
    sf = save(spark, more, lineitem=(lines, "l_suppkey long, l_orderkey long, l_linenumber int, l_partkey long, l_quantity double"))
    assert {(r.source, r.resource) for r in registry.reverse_index(spark, sf).collect()} == {("R14", "R202"), ("R14", "R35"), ("R28", "R228")}
    assert {r.source: r.users for r in registry.used_by(spark, sf).collect()} == {"R14": "R35 R202", "R28": "R228"}
    assert {r.id for r in browse.graph_items(inputs.resources(spark, sf)).collect()} == {"R2", "R202", "R14", "R28", "R228"}


def test_whole_texts_are_escaped(spark, tmp_path):
    text = "a" * 200 + "<b>&\"'"
    sf = save(spark, tmp_path, documents=([(1, text), (2, None)], "doc_id long, text string"))
    got = {r.doc_id: (r.blurb, r.escaped) for r in registry.blurb_escape(spark, sf).collect()}
    assert got == {1: ("a" * 110 + "…", "a" * 200 + "&lt;b&gt;&amp;&quot;&#x27;"), 2: ("", "")}
