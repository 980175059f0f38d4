"""Graph merge as a configuration says: sources in, merged nodes and edges, counts by facets, and files out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontoloom.operators import graph as G
from ontoloom.sources import sinks, tables

MULTIVALUED = ("category", "provided_by", "synonym", "xref", "publications", "primary_knowledge_source", "aggregator_knowledge_source")


def config(text: str) -> dict:
    """The part ``merged_graph`` of a YAML configuration."""
    import yaml

    return (yaml.safe_load(text) or {}).get("merged_graph") or {}


def chosen(sources: dict, include: list[str] | None = None, exclude: list[str] | None = None) -> dict:
    """Of the sources, by key or name: only some, all but some, or all."""
    names = lambda k, v: {k, (v or {}).get("name", k)}
    out = {k: v for k, v in sources.items() if not include or names(k, v) & set(include)}
    return {k: v for k, v in out.items() if not names(k, v) & set(exclude or ())}


def load(spark: SparkSession, sources: dict) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of all sources: a pair of TSV tables each, named by what they end in."""
    sides: dict[str, list[DataFrame]] = {"nodes": [], "edges": []}
    for key, source in sources.items():
        for path in source["input"]["filename"]:
            side = "edges" if "edges" in path.rsplit("/", 1)[-1] else "nodes"
            df = tables.graph_table(spark, path)
            if "provided_by" not in df.columns:
                df = df.withColumn("provided_by", F.lit(source.get("name", key)))
            sides[side].append(df)
    every = lambda dfs: reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
    split = lambda df: df.withColumns({c: G.split_values(F.col(c)) for c in MULTIVALUED if c in df.columns})
    return split(every(sides["nodes"])), split(every(sides["edges"]))


def _sets(c: str):
    return F.array_sort(F.array_distinct(F.flatten(F.collect_set(c)))).alias(c)


def _merged(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each key: sets of the multi-valued columns, of the others the least value."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(*[_sets(c) if c in MULTIVALUED else F.min(c).alias(c) for c in rest])


def facets(nodes: DataFrame, edges: DataFrame, node_facets: list[str], edge_facets: list[str]) -> DataFrame:
    """(kind, facet, key, value, n): categories and predicates by the facets asked for."""
    parts = []
    for kind, df, names, value in (("node", nodes, node_facets, "category"), ("edge", edges, edge_facets, "predicate")):
        one = df.withColumn(value, F.explode(value)) if value in MULTIVALUED else df
        for f in names:
            keyed = one.withColumn("key", F.explode_outer(f)) if f in MULTIVALUED else one.withColumn("key", F.col(f))
            parts.append(keyed.groupBy("key", F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), F.lit(f).alias("facet"), "key", "value", "n"))
    return reduce(DataFrame.unionByName, parts) if parts else nodes.sparkSession.createDataFrame([], "kind string, facet string, key string, value string, n bigint")


def run(spark: SparkSession, merged_graph: dict, out: str | None = None, include: list[str] | None = None, exclude: list[str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nodes, edges, facets) of a configuration; with ``out`` also written there, as the configuration's destinations and operations say."""
    nodes, edges = load(spark, chosen(merged_graph.get("source") or {}, include, exclude))
    nodes, edges = _merged(nodes, ["id"]), _merged(edges, ["subject", "predicate", "object"])
    args: dict = next((o.get("args") or {} for o in merged_graph.get("operations") or [] if o.get("args")), {})
    counts = facets(nodes, edges, args.get("node_facet_properties") or [], args.get("edge_facet_properties") or [])
    if out:
        for target in (merged_graph.get("destination") or {}).values():
            if target.get("compression") == "tar.gz":
                sinks.bundle(nodes, edges, f"{out}/{target['filename']}.tar.gz", target["filename"])
            else:
                sinks.tsv(sinks.flat(nodes), f"{out}/{target['filename']}_nodes.tsv")
                sinks.tsv(sinks.flat(edges), f"{out}/{target['filename']}_edges.tsv")
        if args.get("filename"):
            sinks.stats_yaml(counts, f"{out}/{args['filename']}", args.get("graph_name") or merged_graph.get("name") or "")
    return nodes, edges, counts
