"""Chat formatting with cumulative-snapshot collapse.

Logs often hold a conversation several times, each time a few turns longer.
Every turn's role and text are hashed where they are; the running xor of the
hashes of turns with their positions names each prefix of a conversation (128
bits, its length beside). Equal conversations collapse to the smallest id
first, by counting groups, so that a conversation logged by a third of all rows
meets itself in partial aggregates only. Then an anti-join drops each
conversation whose name is that of a proper prefix of another one. What stays
is rendered: the only step for which texts shuffle, once.

Everything is SQL operators. A conversation's own turns meet in one task, as
its rendered text is one value; nothing else is gathered.

Defined cases: turns go by turn, then role, then text; a null turn comes
first; a null role or text counts as empty, and rows with both empty still are
turns; a row with a null conversation id is a conversation of its own, of one
turn, whose id is larger than all others; repeated rows are repeated turns. An
empty table gives no conversation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize


def _turns(turns: DataFrame) -> DataFrame:
    return turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, n, x, y): (pos, x, y) names the prefix that ends at the row.

    The text takes part in the order only where turn and role don't settle it.
    """
    hashed = lambda t: t.withColumns({"a": F.xxhash64("role", "text"), "b": F.xxhash64(F.lit("b"), "text", "role")})
    named = lambda pos: {"x": F.xxhash64(pos, "a"), "y": F.xxhash64(pos, F.lit("y"), "b")}
    t = hashed(_turns(turns))
    one = F.lit(1).cast("long")
    alone = t.where("conv_id is null").withColumns(named(one)).select("conv_id", one.alias("pos"), one.alias("n"), "x", "y")
    t = t.where("conv_id is not null")
    ties = t.groupBy("conv_id", "turn", "role").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    ties = materialize(ties.select(F.col("conv_id").alias("tc"), F.col("turn").alias("tt"), F.col("role").alias("tr")), "ties")
    t = t.join(ties, (F.col("conv_id") == F.col("tc")) & F.col("turn").eqNullSafe(F.col("tt")) & (F.col("role") == F.col("tr")), "left")
    t = t.select("conv_id", "turn", "role", F.when(F.col("tc").isNotNull(), F.col("text")).otherwise("").alias("tie"), "a", "b")
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "tie")
    t = t.withColumn("pos", F.row_number().over(order).cast("long")).withColumns(named(F.col("pos")))
    run = order.rowsBetween(Window.unboundedPreceding, 0)
    t = t.select("conv_id", "pos", F.count(F.lit(1)).over(Window.partitionBy("conv_id")).alias("n"), F.bit_xor("x").over(run).alias("x"), F.bit_xor("y").over(run).alias("y"))
    return t.unionByName(alone)


def maximal(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, copies, x, y): one conversation of each that is no proper prefix of another."""
    p = materialize(prefixes(turns), "prefixes")
    ends = p.where("pos = n").groupBy("n", "x", "y").agg(F.min(F.struct(F.col("conv_id").isNull().alias("last"), "conv_id")).alias("first"), F.count(F.lit(1)).alias("copies"))
    inner = p.where("pos < n").select("pos", "x", "y").distinct()
    left = ends.join(inner, (F.col("n") == inner.pos) & (ends.x == inner.x) & (ends.y == inner.y), "left_anti")
    return left.select(F.col("first.conv_id").alias("conv_id"), F.col("n").alias("n_turns"), "copies", "x", "y")


def render(turns: DataFrame, turn_format: str = "<|%s|>\n%s\n") -> DataFrame:
    """(conv_id, n_turns, copies, text) for each maximal conversation."""
    keep = materialize(maximal(turns).withColumnRenamed("conv_id", "kept_id"), "maximal")
    t = _turns(turns)
    shown = lambda role, text: F.format_string(turn_format, role, text)
    rows = t.join(keep.where("kept_id is not null"), F.col("conv_id") == F.col("kept_id"))
    parts = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    text = F.array_join(F.transform(parts, lambda s: shown(s["role"], s["text"])), "")
    several = rows.groupBy("conv_id", "n_turns", "copies").agg(text.alias("text"))
    # rows without an id, by what they hold
    one = F.lit(1).cast("long")
    single = t.where("conv_id is null").select(F.xxhash64(one, F.xxhash64("role", "text")).alias("x"), F.xxhash64(one, F.lit("y"), F.xxhash64(F.lit("b"), "text", "role")).alias("y"), "role", "text")
    single = keep.where("kept_id is null").join(single.dropDuplicates(["x", "y"]), ["x", "y"])
    return several.unionByName(single.select(F.col("kept_id").alias("conv_id"), "n_turns", "copies", shown(F.col("role"), F.col("text")).alias("text")))
