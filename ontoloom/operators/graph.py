"""Graph tables: nodes (id, category, name, provided_by) and edges (subject, predicate, object, ...)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ontoloom.durable import materialize

NODE_SPEC = (
    # table, key column, category, name column
    ("region", "r_regionkey", "Region", "r_name"),
    ("nation", "n_nationkey", "Nation", "n_name"),
    ("supplier", "s_suppkey", "Supplier", "s_name"),
    ("customer", "c_custkey", "Customer", "c_name"),
    ("part", "p_partkey", "Part", "p_name"),
    ("orders", "o_orderkey", "Order", "o_orderpriority"),
)
EDGE_SPEC = (
    # table, subject (table, key), predicate, object (table, key)
    ("nation", ("nation", "n_nationkey"), "in_region", ("region", "n_regionkey")),
    ("supplier", ("supplier", "s_suppkey"), "in_nation", ("nation", "s_nationkey")),
    ("customer", ("customer", "c_custkey"), "in_nation", ("nation", "c_nationkey")),
    ("orders", ("orders", "o_orderkey"), "placed_by", ("customer", "o_custkey")),
    ("lineitem", ("orders", "l_orderkey"), "has_part", ("part", "l_partkey")),
    ("lineitem", ("orders", "l_orderkey"), "has_supplier", ("supplier", "l_suppkey")),
)


def curie(table: str, key: str) -> Column:
    return F.concat(F.lit(table + ":"), F.col(key).cast("string"))


def star_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        spark.read.parquet(f"{sf_dir}/{t}.parquet").select(curie(t, k).alias("id"), F.lit(c).alias("category"), F.col(n).alias("name"), F.lit(t).alias("provided_by"))
        for t, k, c, n in NODE_SPEC
    ]
    return reduce(DataFrame.unionByName, parts)


def star_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        spark.read.parquet(f"{sf_dir}/{t}.parquet").select(
            curie(*s).alias("subject"), F.lit(p).alias("predicate"), curie(*o).alias("object"), F.lit(t).alias("provided_by"), F.lit(f"infores:{t}").alias("primary_knowledge_source")
        )
        for t, s, p, o in EDGE_SPEC
    ]
    return reduce(DataFrame.unionByName, parts)


def stamp(df: DataFrame, source: str, aggregator: str) -> DataFrame:
    """Provenance of a graph table that is about to be written."""
    return df.withColumns({"provided_by": F.lit(source), "aggregator_knowledge_source": F.lit(aggregator)})


def source_stats(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, nodecount, edgecount) for each provider; rows are counted, not lines."""
    n = nodes.groupBy(F.col("provided_by").alias("id")).agg(F.count(F.lit(1)).alias("nodecount"))
    e = edges.groupBy(F.col("provided_by").alias("id")).agg(F.count(F.lit(1)).alias("edgecount"))
    return n.join(e, "id", "full").select("id", F.coalesce("nodecount", F.lit(0)).alias("nodecount"), F.coalesce("edgecount", F.lit(0)).alias("edgecount"))


def facets(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(kind, facet, key, value, n): node categories and edge predicates by provider, predicates also by primary source.

    Both edge facets come from one pass with grouping sets.
    """
    by_node = nodes.groupBy("provided_by", "category").agg(F.count(F.lit(1)).alias("n"))
    by_node = by_node.select(F.lit("node").alias("kind"), F.lit("provided_by").alias("facet"), F.col("provided_by").alias("key"), F.col("category").alias("value"), "n")
    sets = edges.groupingSets([["provided_by", "predicate"], ["primary_knowledge_source", "predicate"]], "provided_by", "primary_knowledge_source", "predicate")
    by_edge = sets.agg(F.count(F.lit(1)).alias("n"), F.grouping("provided_by").alias("g"))
    by_edge = by_edge.select(
        F.lit("edge").alias("kind"), F.when(F.col("g") == 0, "provided_by").otherwise("primary_knowledge_source").alias("facet"),
        F.when(F.col("g") == 0, F.col("provided_by")).otherwise(F.col("primary_knowledge_source")).alias("key"), F.col("predicate").alias("value"), "n",
    )
    return by_node.unionByName(by_edge)


def select_sources(df: DataFrame, include: list[str] | None = None, exclude: list[str] | None = None, col: str = "provided_by") -> DataFrame:
    if include:
        df = df.where(F.col(col).isin(include))
    return df.where(~F.col(col).isin(exclude)) if exclude else df


def merge_nodes(*graphs: DataFrame) -> DataFrame:
    """One row per id: categories and providers as sorted sets, the least name that isn't null."""
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), graphs)
    return every.groupBy("id").agg(
        F.array_sort(F.collect_set("category")).alias("category"), F.min("name").alias("name"), F.array_sort(F.collect_set("provided_by")).alias("provided_by"),
    )


def merge_edges(*graphs: DataFrame) -> DataFrame:
    """One row per (subject, predicate, object) with its providers and primary sources."""
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), graphs)
    return every.groupBy("subject", "predicate", "object").agg(
        F.array_sort(F.collect_set("provided_by")).alias("provided_by"), F.array_sort(F.collect_set("primary_knowledge_source")).alias("primary_knowledge_source"),
    )


def dangling(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edge ends that are no node: (id, role, edges)."""
    ends = edges.select(F.explode(F.array(F.struct(F.lit("subject").alias("role"), F.col("subject").alias("id")), F.struct(F.lit("object").alias("role"), F.col("object").alias("id")))).alias("e"))
    used = ends.groupBy(F.col("e.id").alias("id"), F.col("e.role").alias("role")).agg(F.count(F.lit(1)).alias("edges"))
    return used.join(nodes.select("id"), "id", "left_anti")


def reachable(edges: DataFrame, start: DataFrame, depth: int) -> DataFrame:
    """(start, id, hops): what can be reached along edges in at most ``depth`` hops, by the shortest way.

    The bound also ends walks in cycles. Each hop joins the frontier with the
    edges; ids that were reached before don't go on. The edges are written once
    and each hop before the next one, so that neither the plan nor what a lost
    executor costs grows, and a hub's edges are split where a hop is skewed.
    """
    e = materialize(edges.select(F.col("subject").alias("_s"), F.col("object").alias("_o")).distinct(), "edges")
    seen = front = materialize(start.select(F.col("id").alias("start"), F.col("id"), F.lit(0).alias("hops")).distinct(), "start")
    for hop in range(1, depth + 1):
        step = front.join(e, F.col("id") == F.col("_s")).select("start", F.col("_o").alias("id")).distinct()
        front = materialize(step.join(seen.select("start", "id"), ["start", "id"], "left_anti").withColumn("hops", F.lit(hop)), "hop")
        if front.isEmpty():
            break
        seen = seen.unionByName(front)
    return seen


# --- multi-valued properties ------------------------------------------------------


def split_values(x: Column) -> Column:
    """A pipe-delimited cell as a sorted set; blanks drop out."""
    return F.array_sort(F.array_distinct(F.filter(F.split(x, r"\|"), lambda v: v != "")))


def join_values(x: Column) -> Column:
    return F.array_join(x, "|")


# Datatypes that sort as numbers, as dates, as points in time.
NUMERIC = ("int", "integer", "long", "decimal", "double", "float")
DATES = ("date",)
TIMES = ("datetime",)


def _all(values: Column, kinds: tuple[str, ...]) -> Column:
    return F.forall(values, lambda v: v["datatype"].isin(*kinds))


def mixed(values: Column) -> Column:
    """Do the values (array of lex, datatype, lang) have no order in common?"""
    kinds = F.array_distinct(F.transform(values, lambda v: F.when(v["datatype"].isin(*NUMERIC), "number").otherwise(v["datatype"])))
    return F.size(kinds) > 1


def mixed_count(df: DataFrame, *cols: str) -> DataFrame:
    """One row: in how many cells of each column the values had no order in common."""
    return df.agg(*[F.count_if(mixed(F.col(c))).alias(c) for c in cols])


def sort_property(values: Column, reverse: bool = False) -> Column:
    """The distinct lexical forms: as numbers, dates or points in time if all are, else by their text; nothing is coerced."""
    # the double orders all magnitudes; where two doubles tie, exact decimals decide
    number = lambda v: F.struct(v["lex"].try_cast("double").alias("k"), v["lex"].try_cast("decimal(38,6)").alias("d"), v["lex"].alias("lex"))
    numbers = F.transform(F.array_sort(F.transform(values, number)), lambda v: v["lex"])
    texts = F.array_sort(F.transform(values, lambda v: v["lex"]))
    moment = lambda v: F.struct(v["lex"].try_cast("timestamp").alias("k"), v["lex"].alias("lex"))
    moments = F.transform(F.array_sort(F.transform(values, moment)), lambda v: v["lex"])
    dated = _all(values, DATES) | _all(values, TIMES)
    out = F.array_distinct(F.when(_all(values, NUMERIC), numbers).when(dated, moments).otherwise(texts))
    return F.reverse(out) if reverse else out


# --- triples ----------------------------------------------------------------------

# Terms of the public RDF, RDFS and OWL vocabularies.
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
OWL = "http://www.w3.org/2002/07/owl#"
OBO_DEFINITION = "http://purl.obolibrary.org/obo/IAO_0000115"
SYNONYM = "http://www.geneontology.org/formats/oboInOwl#hasExactSynonym"
DBXREF = "http://www.geneontology.org/formats/oboInOwl#hasDbXref"


# Triples are tables (s, p, o), with a column g where they are of several graphs: then nothing crosses from one to another.


def _g(triples: DataFrame) -> list[str]:
    return ["g"] if "g" in triples.columns else []


def _restrictions(t: DataFrame) -> DataFrame:
    """(r, rp, c): the existential restrictions among triples."""
    g = _g(t)
    on = t.where(F.col("p") == OWL + "onProperty").select(*g, F.col("s").alias("r"), F.col("o").alias("rp"))
    some = t.where(F.col("p") == OWL + "someValuesFrom").select(*g, F.col("s").alias("r"), F.col("o").alias("c"))
    return on.join(some, [*g, "r"])


def _list_members(t: DataFrame, heads: DataFrame) -> DataFrame:
    """(head, member): all members of the RDF lists that start at ``heads`` (head).

    Each step doubles the reach of the links, so a list of n cells takes about
    log2(n) steps, and is written before the next one. A list that leads back
    into itself ends once no pair of head and cell is new.
    """
    g = _g(t)
    first = t.where(F.col("p") == RDF + "first").select(*g, F.col("s").alias("cell"), F.col("o").alias("member"))
    rest = t.where((F.col("p") == RDF + "rest") & (F.col("o") != RDF + "nil")).select(*g, F.col("s").alias("cell"), F.col("o").alias("next"))
    link = materialize(rest.distinct(), "link")
    at = materialize(heads.select(*g, "head", F.col("head").alias("cell")).distinct(), "cell")
    while not link.isEmpty():
        step = at.join(link, [*g, "cell"]).select(*g, "head", F.col("next").alias("cell")).distinct()
        new = materialize(step.join(at, [*g, "head", "cell"], "left_anti"), "cell")
        if new.isEmpty():
            break
        at = at.unionByName(new)
        onward = link.select(*g, F.col("cell").alias("next"), F.col("next").alias("far"))
        link = materialize(link.join(onward, [*g, "next"]).select(*g, "cell", F.col("far").alias("next")).distinct(), "link")
    return at.join(first, [*g, "cell"]).select(*g, "head", "member")


def relax(triples: DataFrame) -> DataFrame:
    """Triples and what equivalences to intersections imply: A = B and r some C gives A < B and A < r some C."""
    g = _g(triples)
    eq = triples.where(F.col("p") == OWL + "equivalentClass").select(*g, "s", F.col("o").alias("x"))
    inter = triples.where(F.col("p") == OWL + "intersectionOf").select(*g, F.col("s").alias("x"), F.col("o").alias("head"))
    lists = eq.join(inter, [*g, "x"]).select(*g, "s", "head")
    parts = lists.join(_list_members(triples, lists.select(*g, "head")), [*g, "head"]).select(*g, "s", F.lit(RDFS + "subClassOf").alias("p"), F.col("member").alias("o"))
    named = eq.where(~F.col("x").startswith("_:")).select(*g, "s", F.lit(RDFS + "subClassOf").alias("p"), F.col("x").alias("o"))
    return triples.select(*g, "s", "p", "o").unionByName(parts).unionByName(named).distinct()


#: What a declared resource is as a node.
KINDS = {
    OWL + "Class": "biolink:OntologyClass", OWL + "ObjectProperty": "biolink:RelationshipType", OWL + "DatatypeProperty": "biolink:RelationshipType",
    OWL + "AnnotationProperty": "biolink:RelationshipType", OWL + "NamedIndividual": "biolink:NamedThing",
}
CLASSES = {OWL + "Class": "biolink:OntologyClass"}


def triple_nodes(triples: DataFrame, kinds: dict[str, str] = CLASSES) -> DataFrame:
    """A node for each named resource of some declared kinds: (id, category, name, description, synonym); of several kinds the least category."""
    g = _g(triples)
    category = F.create_map(*[F.lit(x) for kv in kinds.items() for x in kv])
    typed = triples.where((F.col("p") == RDF + "type") & F.col("o").isin(*kinds) & ~F.col("s").startswith("_:"))
    typed = typed.groupBy(*g, "s").agg(F.min(F.element_at(category, F.col("o"))).alias("category"))
    props = triples.where(F.col("p").isin(RDFS + "label", OBO_DEFINITION, SYNONYM)).groupBy(*g, "s").agg(
        F.min(F.when(F.col("p") == RDFS + "label", F.col("o"))).alias("name"), F.min(F.when(F.col("p") == OBO_DEFINITION, F.col("o"))).alias("description"),
        F.array_sort(F.collect_set(F.when(F.col("p") == SYNONYM, F.col("o")))).alias("synonym"),
    )
    return typed.join(props, [*g, "s"], "left").select(*g, F.col("s").alias("id"), "category", "name", "description", F.coalesce("synonym", F.array().cast("array<string>")).alias("synonym"))


#: Edges between named resources, by the predicate of their triple.
AXIOMS = {
    RDFS + "subPropertyOf": "rdfs:subPropertyOf", RDFS + "domain": "rdfs:domain", RDFS + "range": "rdfs:range",
    OWL + "inverseOf": "owl:inverseOf", OWL + "equivalentClass": "biolink:same_as", OWL + "sameAs": "biolink:same_as",
    OWL + "disjointWith": "owl:disjointWith", DBXREF: "biolink:xref",
}


def triple_edges(triples: DataFrame, axioms: dict[str, str] | None = None, individuals: bool = False) -> DataFrame:
    """subClassOf edges between named classes, and one edge for each existential restriction above a class.

    ``axioms`` (predicate of the triple, predicate of the edge) adds others, such as AXIOMS; ``individuals`` adds those
    from named individuals: to their classes, and along object properties to each other.
    """
    g = _g(triples)
    sub = triples.where((F.col("p") == RDFS + "subClassOf") & ~F.col("s").startswith("_:")).select(*g, "s", "o")
    edge = lambda df, predicate, o, relation: df.select(*g, F.col("s").alias("subject"), predicate.alias("predicate"), F.col(o).alias("object"), relation.alias("relation"))
    out = edge(sub.where(~F.col("o").startswith("_:")), F.lit("biolink:subclass_of"), "o", F.lit(RDFS + "subClassOf"))
    some = sub.join(_restrictions(triples).withColumnRenamed("r", "o"), [*g, "o"]).where(~F.col("c").startswith("_:"))
    out = out.unionByName(edge(some, F.lit("biolink:related_to"), "c", F.col("rp")))
    named = triples.where(~F.col("s").startswith("_:") & ~F.col("o").startswith("_:"))
    if axioms:
        shown = F.element_at(F.create_map(*[F.lit(x) for kv in axioms.items() for x in kv]), F.col("p"))
        out = out.unionByName(edge(named.where(F.col("p").isin(*axioms)), shown, "o", F.col("p")))
    if individuals:
        typed = triples.where(F.col("p") == RDF + "type")
        own = typed.where(F.col("o") == OWL + "NamedIndividual").select(*g, "s").distinct()
        classes = named.where((F.col("p") == RDF + "type") & ~F.col("o").startswith(OWL)).join(own, [*g, "s"], "left_semi")
        links = typed.where(F.col("o") == OWL + "ObjectProperty").select(*g, F.col("s").alias("p")).distinct()
        out = out.unionByName(edge(classes, F.lit("rdf:type"), "o", F.col("p")))
        out = out.unionByName(edge(named.join(links, [*g, "p"], "left_semi").join(own, [*g, "s"], "left_semi"), F.lit("biolink:related_to"), "o", F.col("p")))
    return out.distinct()


def merge_ontologies(*graphs: DataFrame) -> DataFrame:
    """One set of triples of several; blank nodes are apart by the prefixes of their readers."""
    return reduce(lambda a, b: a.unionByName(b), [g.select("s", "p", "o") for g in graphs]).distinct()


def remove_term(triples: DataFrame, term: str) -> DataFrame:
    """Without the triples that name a term anywhere."""
    return triples.where((F.col("s") != term) & (F.col("p") != term) & (F.col("o") != term))


def metrics(triples: DataFrame) -> DataFrame:
    """One row: triples, classes, properties, axioms of subclass and equivalence."""
    typed = lambda o: F.count_if((F.col("p") == RDF + "type") & (F.col("o") == OWL + o))
    return triples.agg(
        F.count(F.lit(1)).alias("triples"), typed("Class").alias("classes"), typed("ObjectProperty").alias("object_properties"),
        F.count_if(F.col("p") == RDFS + "subClassOf").alias("subclass_axioms"), F.count_if(F.col("p") == OWL + "equivalentClass").alias("equivalences"),
    )


def quality_report(triples: DataFrame) -> DataFrame:
    """(rule, subject): classes without a label, with several labels, and without any parent."""
    nodes = triples.where((F.col("p") == RDF + "type") & (F.col("o") == OWL + "Class") & ~F.col("s").startswith("_:")).select("s").distinct()
    per = triples.groupBy("s").agg(F.count_if(F.col("p") == RDFS + "label").alias("labels"), F.count_if(F.col("p") == RDFS + "subClassOf").alias("parents"))
    met = nodes.join(per, "s", "left").fillna(0, ["labels", "parents"])
    rules = F.filter(F.array(F.when(F.col("labels") == 0, "missing_label"), F.when(F.col("labels") > 1, "multiple_labels"), F.when(F.col("parents") == 0, "no_parent")), lambda x: x.isNotNull())
    return met.select(F.explode(rules).alias("rule"), F.col("s").alias("subject"))
