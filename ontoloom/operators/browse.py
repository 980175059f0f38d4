"""Marts behind browse, search and summary pages.

Resources are nested: id, name, description, category, domains, activity_status,
last_modified_date, products[{id, name, category, format, node_count,
edge_count, node_categories, predicates, original_source[{source}]}],
contacts[{label, contact_details[{contact_type, value}]}]; ``pos`` is their
place in the registry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ontoloom.functions import text as X
from ontoloom.functions import vocab as V

RESOURCE = (
    "id string, name string, description string, category string, domains array<string>, activity_status string, last_modified_date string,"
    " products array<struct<id:string,name:string,category:string,format:string,node_count:long,edge_count:long,"
    "node_categories:array<string>,predicates:array<string>,original_source:array<struct<source:string>>>>,"
    " contacts array<struct<label:string,contact_details:array<struct<contact_type:string,value:string>>>>, pos long"
)


def graphs(resources: DataFrame) -> DataFrame:
    return resources.where(F.col("category") == "KnowledgeGraph")


def graph_products(products: Column) -> Column:
    return F.filter(F.coalesce(products, F.array().cast(f"array<{_PRODUCT}>")), lambda p: p["category"] == "GraphProduct")


_PRODUCT = (
    "struct<id:string,name:string,category:string,format:string,node_count:bigint,edge_count:bigint,"
    "node_categories:array<string>,predicates:array<string>,original_source:array<struct<source:string>>>"
)


def _first_largest(values: Column, measure) -> Column:
    """The place (from 0) of the value with the largest measure, the first of equals; null if all measures are null. One pass."""
    ranked = F.transform(values, lambda x, i: F.when(measure(x).isNotNull(), F.struct(measure(x).alias("m"), (-i).alias("i"))))
    return -F.array_max(ranked)["i"]


def _longest(lists: Column) -> Column:
    """The longest of some lists, the first of equals; null if all are null."""
    return F.get(lists, _first_largest(lists, lambda x: F.when(x.isNotNull(), F.size(x))))


def metrics(products: Column) -> Column:
    """struct(nodes, edges, categories, predicates) of the graph products: largest counts, longest lists."""
    p = graph_products(products)
    return F.struct(
        F.array_max(F.transform(p, lambda x: x["node_count"])).alias("nodes"), F.array_max(F.transform(p, lambda x: x["edge_count"])).alias("edges"),
        _longest(F.transform(p, lambda x: x["node_categories"])).alias("categories"), _longest(F.transform(p, lambda x: x["predicates"])).alias("predicates"),
    )


def primary_product(products: Column) -> Column:
    """The graph product with most nodes (the first of equals), else the first one, else null."""
    p = graph_products(products)
    return F.coalesce(F.get(p, _first_largest(p, lambda x: x["node_count"])), F.get(p, F.lit(0)))


def formats(products: Column) -> Column:
    """Distinct formats of all products, in their order."""
    all_ = F.transform(F.coalesce(products, F.array().cast(f"array<{_PRODUCT}>")), lambda p: p["format"])
    return F.array_distinct(F.filter(all_, lambda f: f.isNotNull() & (f != "")))


def contact_value(details: Column, kind: str) -> Column:
    """The first contact detail of a kind."""
    return F.get(F.transform(F.filter(details, lambda d: d["contact_type"] == kind), lambda d: d["value"]), F.lit(0))


def format_class(fmt: Column) -> Column:
    pairs = [F.lit(x) for kv in V.FORMAT_CLASS.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.coalesce(fmt, F.lit(""))), F.lit(V.FORMAT_CLASS_DEFAULT))


def reason_text(reason: Column) -> Column:
    pairs = [F.lit(x) for kv in V.REASON_TEXT.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.coalesce(reason, F.lit(""))), F.lit(V.REASON_TEXT_DEFAULT))


def graph_items(resources: DataFrame) -> DataFrame:
    """Registered graphs as browse items."""
    m = metrics(F.col("products"))
    status = F.coalesce("activity_status", F.lit(""))
    empty = F.array().cast("array<string>")
    return graphs(resources).select(
        F.lit("registry").alias("source"), F.lit("Graph project").alias("source_label"), "id", F.upper("id").alias("acr"), X.or_default(F.col("name"), F.col("id")).alias("name"),
        X.blurb(F.col("description")).alias("blurb"), m["nodes"].alias("nodes"), m["edges"].alias("edges"), formats(F.col("products")).alias("fmts"),
        F.coalesce("domains", empty).alias("domains"), X.or_default(status, "—").alias("status_label"), F.when(status == "active", "ok").otherwise("warn").alias("status_cls"),
        F.substring(F.coalesce("last_modified_date", F.lit("")), 1, 10).alias("updated"), F.concat(F.lit("resource/"), "id", F.lit("/")).alias("href"), F.lit("").alias("version"), "pos",
    )


def ontology_items(index: DataFrame, date: str = "", label: str = "Ontology", transformed: str = "Ontology transformed to a graph") -> DataFrame:
    """Index rows as browse items; counts only of those that are OK, licensed ones aren't called failed."""
    ok, licensed = F.col("status") == V.OK, F.coalesce(F.col("reason") == V.LICENSED, F.lit(False))
    reason = F.when(X.or_default(F.col("reason"), "") != "", F.concat(F.lit(" ("), F.col("reason"), F.lit(")"))).otherwise("")
    version = X.ws_strip(F.coalesce("version", F.lit("")))
    return index.select(
        F.lit("catalogue").alias("source"), F.lit(label).alias("source_label"), "id", F.upper("id").alias("acr"), X.or_default(F.col("name"), F.col("id")).alias("name"),
        F.when(ok, transformed).when(licensed, f"{label} — not available under our license")
        .otherwise(F.concat(F.lit(f"{label} — "), X.or_default(F.lower("status"), "not transformed"), reason)).alias("blurb"),
        F.when(ok, F.col("nodecount")).alias("nodes"), F.when(ok, F.col("edgecount")).alias("edges"), F.when(ok, F.array(F.lit("kgx"))).otherwise(F.array().cast("array<string>")).alias("fmts"),
        F.array().cast("array<string>").alias("domains"), F.when(licensed, "Licensed").otherwise(X.or_default(F.col("status"), "—")).alias("status_label"),
        F.when(ok, "ok").otherwise("warn").alias("status_cls"), F.lit(date).alias("updated"), F.concat(F.lit("resource/"), "id", F.lit("/")).alias("href"),
        F.when(version == "NA", "").otherwise(version).alias("version"), "pos", F.coalesce("download_url", F.lit("")).alias("download_url"),
        F.coalesce("submission_id", F.lit("NA")).alias("submission_id"), F.coalesce("reason", F.lit("")).alias("reason"), ok.alias("ok"),
    )


def card(items_: DataFrame) -> DataFrame:
    """What a browse card shows of an item's lists: three formats, three domains."""
    return items_.withColumns({"fmts": F.slice("fmts", 1, 3), "domains": F.slice("domains", 1, 3)})


def details(fmts: Column, taxa: Column) -> Column:
    """What a page shows of a resource's lists: four formats, four taxa."""
    return F.struct(F.slice(fmts, 1, 4).alias("fmts"), F.slice(taxa, 1, 4).alias("taxa"))


def items(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def browse_order(items_: DataFrame) -> DataFrame:
    return items_.orderBy(F.lower("name"), "source", "pos")


def facet_counts(items_: DataFrame) -> DataFrame:
    """(facet, value, n) of sources and domains."""
    s = items_.groupBy(F.col("source").alias("value")).agg(F.count(F.lit(1)).alias("n")).select(F.lit("source").alias("facet"), "value", "n")
    d = items_.select(F.explode("domains").alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("n")).select(F.lit("domain").alias("facet"), "value", "n")
    return s.unionByName(d)


def top_values(items_: DataFrame, col: str, k: int = 12) -> DataFrame:
    """The k most frequent values of a list column, ties by first occurrence."""
    each = items_.select("pos", F.posexplode(col).alias("at", "value"))
    n = each.groupBy("value").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("pos", "at")).alias("first"))
    return n.orderBy(F.desc("n"), "first").limit(k).select("value", "n")


def top_by(items_: DataFrame, col: str, k: int = 10) -> DataFrame:
    """The k OK items with most nodes or edges, ties by position."""
    return items_.where(F.col("ok") & F.col(col).isNotNull()).orderBy(F.desc(col), "pos").limit(k)


def search_index(items_: DataFrame) -> DataFrame:
    return items_.select(F.col("acr").alias("a"), F.col("name").alias("n"), F.col("href").alias("h"), F.col("source_label").alias("s"))


def browse_filter(items_: DataFrame, query: str = "", domain: str = "", source: str = "") -> DataFrame:
    """Substring of the search blob, whole domain and source, each if given."""
    blob = X.search_blob(F.col("name"), F.col("acr"), F.col("id"), F.col("source_label"), F.array_join("domains", " "), F.array_join("fmts", " "))
    out = items_.where(blob.contains(query.lower().strip())) if query.strip() else items_
    out = out.where(F.array_contains("domains", domain)) if domain else out
    return out.where(F.col("source") == source) if source else out


def suggest(items_: DataFrame, query: str, k: int = 10, order: str = "pos") -> DataFrame:
    """Names or acronyms that start with the query, then those that hold it, in their order; nothing for a blank query."""
    q = query.strip().lower()
    if not q:
        return items_.limit(0)
    a, n = F.lower("acr"), F.lower("name")
    prefix = F.startswith(a, F.lit(q)) | F.startswith(n, F.lit(q))
    hit = items_.where(prefix | F.contains(F.concat_ws(" ", a, n), F.lit(q)))
    return hit.orderBy(F.when(prefix, 0).otherwise(1), order).limit(k)


def reverse_index(resources: DataFrame) -> DataFrame:
    """(source, resource, pos): which other resources draw on each registered graph, in first-seen order."""
    used = resources.select(F.col("id").alias("resource"), "pos", F.posexplode("products").alias("i", "p")).select("resource", "pos", "i", F.posexplode("p.original_source").alias("j", "o"))
    used = used.select(F.col("o.source").alias("source"), "resource", F.struct("pos", "i", "j").alias("at")).where("source is not null and source <> resource")
    known = graphs(resources).select(F.col("id").alias("source")).distinct()
    return used.join(known, "source", "left_semi").groupBy("source", "resource").agg(F.min("at").alias("at"))


def used_by(reverse: DataFrame, k: int = 8) -> DataFrame:
    """(source, users): the first k users of each graph."""
    ranked = reverse.withColumn("r", F.row_number().over(Window.partitionBy("source").orderBy("at"))).where(F.col("r") <= k)
    return ranked.groupBy("source").agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "resource"))), lambda s: s["resource"]).alias("users"))


def predicate_list(predicates: Column, k: int = 24) -> Column:
    """struct(shown, more): the first k in order, and how many are left out."""
    p = F.coalesce(predicates, F.array().cast("array<string>"))
    return F.struct(F.slice(F.array_sort(p), 1, k).alias("shown"), F.greatest(F.size(p) - k, F.lit(0)).alias("more"))


def summary(index_items: DataFrame, totals: DataFrame) -> DataFrame:
    """One row of headline figures; each total that is missing is computed again, failed and skipped together."""
    now = index_items.agg(
        F.count_if("ok").alias("ok"), F.count_if(~F.col("ok")).alias("not_ok"), F.sum(F.when(F.col("ok"), F.col("nodes"))).alias("n"), F.sum(F.when(F.col("ok"), F.col("edges"))).alias("e")
    )
    t = totals.agg(*[F.max(c).alias(c) for c in ("failedcount", "skippedcount", "licensedcount", "totalnodecount", "totaledgecount")])
    both = F.col("failedcount").isNotNull() & F.col("skippedcount").isNotNull()
    row = now.crossJoin(t)  # one row each
    row = row.select(
        "ok", F.when(both, F.col("failedcount")).otherwise(F.col("not_ok")).alias("failed"), F.when(both, F.col("skippedcount")).otherwise(F.lit(0)).alias("skipped"),
        F.coalesce("licensedcount", F.lit(0)).alias("licensed"), F.coalesce("totalnodecount", "n", F.lit(0)).alias("nodes"), F.coalesce("totaledgecount", "e", F.lit(0)).alias("edges"),
    )
    return row.withColumn("attempted", F.col("ok") + F.col("failed") + F.col("skipped") + F.col("licensed"))


def page_state(items_: DataFrame) -> DataFrame:
    """(id, state): download, unlocated (OK without a URL; none is ever guessed) or explained."""
    return items_.select("id", F.when(F.col("ok") & (F.col("download_url") != ""), "download").when(F.col("ok"), "unlocated").otherwise("explained").alias("state"), F.when(~F.col("ok"), reason_text(F.col("reason"))).alias("message"))
