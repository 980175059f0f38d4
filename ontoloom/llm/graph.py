"""Connected components of a link table, without any link reaching the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return r[0], r[1]


def _to_least(sym: DataFrame, name: str) -> DataFrame:
    """(u, v, m): m is the least of u and its neighbours.

    The minima are written first, so that the join has plain exchanges on
    both sides and a hot node's rows can be split at run time.
    """
    m = materialize(sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), name)
    return sym.join(m, "u")


def components(links: DataFrame) -> DataFrame:
    """links (u, v) of any orderable type -> (node, root), root the least node of the component.

    Alternates large-star and small-star steps (Kiveris et al. 2014) until the
    links are a forest of stars. Nodes without links don't appear; loops and
    repeated links are harmless; no links give an empty table.
    """
    e = links.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = materialize(e, "links")
    before = _state(e)
    while before[0]:
        sym = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _to_least(sym, "large").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large, "links")
        met = _to_least(large, "small")
        small = met.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(met.select("u", F.col("m").alias("v")))
        e = materialize(small.where("u != v").distinct(), "links")
        now = _state(e)
        if now == before:
            break
        before = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
