"""URL filtering: a blocked Bloom filter in front of an exact hash join.

A rule is a host and a path; it fits a URL whose host is the rule's or a
subdomain of it and whose path starts with the rule's. So the canonical strings
under which a URL could be listed are its host's suffixes at label bounds, each
with the prefixes of its path that are as long as some rule's path. Each of
them is hashed and tested against the blocked Bloom filter of the list;
possible hits meet the list itself in a hash join, which removes the false
ones; of a URL's rules the longest wins (host and path together; then the
longer host).

Everything is SQL operators. The filter is at most ``bloom.MAX_BLOCKS`` blocks,
whatever the list. The list is broadcast if it has at most ``BROADCAST_RULES``
rules, and shuffled otherwise.

Defined cases: host and path are empty for a null URL and one without
``://``; such a URL, and one that no rule fits, has a null rule and the
default verdict. Of repeated rules an allowing one counts. Repeated rows and
null ids each keep their row. Extra columns pass through whatever their names
are; columns named host, path, rule or verdict, in any case of letters, make
room for the results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bloom

BROADCAST_BYTES = 8 << 20
#: Bytes of a broadcast rule besides its strings.
_RULE_BYTES = 64
_OWN = ("host", "path", "rule", "verdict")
ALLOW, BLOCK = "allow", "block"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _parts(url: Column) -> tuple[Column, Column]:
    u = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, u.substr(at + 3, F.length(u))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def canonical(pages: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with the columns host and path."""
    host, path = _parts(F.col(url))
    return pages.withColumns({"host": host, "path": path})


def rules_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """(verdict, 'host/path') pairs as a table (key, host_len, verdict) of literals."""
    if not rules:
        return rules_table(spark, [(ALLOW, "/")]).where("false")
    rows = F.array(*[F.struct(F.lit(key).alias("key"), F.lit(verdict).alias("verdict")) for verdict, key in rules])
    return spark.range(1).select(F.explode(rows).alias("r")).select("r.key", (F.instr("r.key", "/") - 1).alias("host_len"), "r.verdict")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _one_each(rules: DataFrame) -> DataFrame:
    return rules.groupBy("key").agg(F.max("host_len").alias("host_len"), F.min("verdict").alias("verdict"))


def judge(pages: DataFrame, rules: DataFrame, default: str = ALLOW, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule and verdict.

    rules: (key, host_len, verdict), key being host and path in one string.
    """
    rules = _one_each(rules)
    total, size = rules.agg(F.count(F.lit(1)), F.sum(F.octet_length("key") + F.octet_length("verdict") + _RULE_BYTES)).first()
    blocks = bloom.blocks_for(total)
    filt = bloom.once_filter(rules.select(F.xxhash64("key").alias("h")), "h", blocks)
    # distinct path lengths: as many as the longest path of a rule has letters, at most
    lengths = sorted(r[0] for r in rules.select(F.length("key") - F.col("host_len")).distinct().collect())

    # a page's own columns stay in one struct, so no name of theirs can clash
    base = canonical(pages.select(F.struct("*").alias("row"), F.col(_quoted(page_id)).alias("id"), F.col(_quoted(url)).cast("string").alias("url")), "url")
    labels = F.split("host", r"\.")
    n = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), "."))
    rows = base.where("host <> ''").select("id", "url", "path", F.explode(suffixes).alias("suffix"))
    fits = F.filter(F.array(*[F.lit(x) for x in lengths]) if lengths else F.array().cast("array<int>"), lambda x: x <= F.length("path"))
    rows = rows.select("id", "url", "suffix", "path", F.explode(fits).alias("take"))
    rows = rows.select("id", "url", F.concat("suffix", F.expr("substring(path, 1, take)")).alias("cand")).withColumn("h", F.xxhash64("cand"))
    possible = bloom.hits(rows, "h", filt, blocks, "maybe").where("maybe").select(F.col("id").alias("hit_id"), F.col("url").alias("hit_url"), "cand")
    listed = F.broadcast(rules) if (size or 0) <= BROADCAST_BYTES else rules
    true = possible.join(listed, F.col("cand") == F.col("key"))
    best = true.groupBy("hit_id", "hit_url").agg(F.max(F.struct(F.length("key").alias("n"), "host_len", "key", "verdict")).alias("best"))
    out = base.join(best, F.col("id").eqNullSafe(F.col("hit_id")) & (F.col("url") == F.col("hit_url")), "left")
    keep = [F.col("row." + _quoted(c)).alias(c) for c in pages.columns if c.lower() not in _OWN]
    return out.select(*keep, "host", "path", F.col("best.key").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
