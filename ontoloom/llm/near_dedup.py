"""Near-duplicate detection by fast similarity sketching.

A document is the set of its distinct word shingles. A sketch has
``coordinates`` bins; in round i every shingle is thrown into a random bin
with a value in [i, i+1), and a bin keeps its least value, so later rounds only
fill bins that are still empty. After ``coordinates`` random rounds, round
``coordinates + b`` throws everything into bin b, so that every coordinate
fills. Two sets agree in a coordinate with the probability of their Jaccard
similarity, with concentration as of independent draws.

Bands of coordinates make buckets. How many of how many follows from the
similarity asked for (``banding``): the most coordinates a band for which
``MOST_BANDS`` bands at most lose a pair at the limit with a probability of
``LOSS`` or less. ``exact=True`` loses none: then all nodes go through the
exact filter below, not only those that buckets leave open.

Equal sets are one node from the start. In each bucket all nodes are compared
with one pivot, never with each other; pairs are settled on the full sets (of
64-bit shingle hashes). The nodes of buckets that still hold several
components then go through an exact filter: with all shingles in one order
from rare to frequent, similar sets must share a shingle that comes early in
both, and how early follows from their sizes (prefix and positional filters of
Xiao et al. 2008), and the parity maps of their hashes can't differ in more bits
than the sets do in shingles. Documents that share a frequent passage only, and copies of
one text that differ in too many places, hardly meet there. Nodes that do, are
of sizes that could be similar and lie in different components are compared.
So each pair that shares a bucket is settled, ruled out exactly, or already
connected, and no bucket is capped.

What shuffles. Band keys are counted first, eight bytes each; only keys that
occur twice go on, with their nodes, behind a Bloom filter of them. Texts never
shuffle: the rows that a Bloom filter of the wanted ids and text hashes lets
through become sets where they are, and the sets of wanted nodes shuffle.

Defined cases: a text of fewer words than a shingle is one shingle; a null,
empty or blank text has no shingle and links with nothing. A row with a null
id can be linked; its group takes the smallest id that isn't null. Rows that
repeat both id and text get the same answer. Extra columns don't matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bloom, graph
from .common import discard, give_back, materialize, scratch, whole

#: The probability to lose a pair at the limit of similarity, and how many bands it may take.
LOSS, MOST_BANDS = 1e-6, 35
_MAX = np.uint64(0xFFFFFFFFFFFFFFFF)
_LOW48 = np.uint64((1 << 48) - 1)


def _mix(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


@cache
def banding(percent: int) -> tuple[int, int]:
    """(bands, coordinates a band) for a limit of similarity."""
    share = min(max(percent, 1), 99) / 100
    need = lambda rows: math.ceil(math.log(LOSS) / math.log1p(-(share**rows)))
    rows = max([r for r in range(1, 65) if need(r) <= MOST_BANDS], default=1)
    return need(rows), rows


@cache
def _seeds(n: int) -> np.ndarray:
    return _mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingles(data: bytes, k: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the k-word shingles of a UTF-8 text.

    ``bytes.lower`` and ``bytes.split`` touch A-Z and the six ASCII white
    space characters only, which is exactly the rule asked for.
    """
    words = data.lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    width = min(k, n)
    s = np.full(n - width + 1, width, np.uint64)
    for i in range(width):
        s = _mix(s * np.uint64(0x9E3779B97F4A7C15) + h[i : n - width + 1 + i])
    return np.unique(s)


def sketch(s: np.ndarray, t: int) -> np.ndarray:
    """The t coordinates of a non-empty set: the round in the high 16 bits, the value in the low 48."""
    out, seeds, i = np.full(t, _MAX, np.uint64), _seeds(2 * t), 0
    while i < t:
        rounds = min(t - i, max(1, 4 * t // len(s)))
        z = _mix(s[None, :] ^ seeds[i : i + rounds, None])
        at = ((z >> np.uint64(48)) * np.uint64(t) >> np.uint64(16)).astype(np.int64)
        v = (z & _LOW48) | (np.arange(i, i + rounds, dtype=np.uint64)[:, None] << np.uint64(48))
        np.minimum.at(out, at.ravel(), v.ravel())
        i += rounds
        if out.max() != _MAX:
            return out
    for b in np.flatnonzero(out == _MAX):
        out[b] = (np.uint64(t + b) << np.uint64(48)) | (_mix(s ^ seeds[t + b]) & _LOW48).min()
    return out


def bands(coords: np.ndarray, rows: int) -> np.ndarray:
    c = coords.reshape(-1, rows)
    key = np.arange(1, len(c) + 1, dtype=np.uint64)
    for r in range(rows):
        key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + c[:, r])
    return key


def _texts(col: pa.Array) -> Iterator[bytes]:
    for v in col.cast(pa.binary()):
        yield v.as_py() or b""


def signatures(docs: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> DataFrame:
    """(id, th, n, node, keys): node names the shingle set (null if it is empty), th the text."""
    text = whole(F.col(text_col))
    n_bands, per_band = banding(percent)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, node, keys = [], [], []
            for data in _texts(batch.column(2)):
                s = shingles(data, k)
                n.append(len(s))
                node.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                keys.append(bands(sketch(s, n_bands * per_band), per_band).view(np.int64) if len(s) else np.empty(0, np.int64))
            offsets = np.cumsum([0, *map(len, keys)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(node, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(keys) if keys else np.empty(0, np.int64)))],
                ["id", "th", "n", "node", "keys"],
            )
        give_back()

    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))
    return rows.mapInArrow(work, f"id {rows.schema['id'].dataType.simpleString()}, th long, n long, node binary, keys array<long>")


def _sets(docs: DataFrame, id_col: str, text_col: str, k: int, wanted: DataFrame) -> DataFrame:
    """(node, items): the full sets of the wanted classes (node, id, th), a written table, from their first documents."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(data, k) for data in _texts(batch.column(0))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["node", "items"]
            )
        give_back()

    text = whole(F.col(text_col))
    blocks = bloom.blocks_for(wanted.count())
    filt = materialize(bloom.once_filter(wanted.select(F.xxhash64("id", "th").alias("h")), "h", blocks), "wanted-filter")
    rows = docs.select(F.xxhash64(F.col(id_col), F.xxhash64(text)).alias("h"), text.alias("text"))
    found = bloom.hits(rows, "h", filt, blocks, "maybe").where("maybe").select("text").mapInArrow(work, "node binary, items array<long>")
    found = found.join(wanted.select("node"), "node", "left_semi")
    return materialize(found.dropDuplicates(["node"]), "sets")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) with 100 * intersection >= percent * union. Only sets of their nodes shuffle."""

    def side(end: str, items: str) -> DataFrame:
        ends = pairs.select(F.col(end).alias("node")).distinct()
        return sets.join(ends, "node", "left_semi").select(F.col("node").alias(end), F.col("items").alias(items))

    met = pairs.join(side("u", "a"), "u").join(side("v", "b"), "v").withColumn("i", F.size(F.array_intersect("a", "b")).cast("long"))
    return met.where(100 * F.col("i") >= percent * (F.size("a") + F.size("b") - F.col("i"))).select("u", "v")


def _could(n: str, m: str, percent: int):
    """Sets of these sizes can be similar enough: exact, and drops no link."""
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80, exact: bool = False) -> DataFrame:
    """(id, th, n_shingles, component_id) for each row of ``docs``; th is xxhash64 of the text."""
    return _components(docs, id_col, text_col, words, percent, exact).select("id", "th", "n_shingles", "component_id")


def _components(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int, exact: bool = False) -> DataFrame:
    """components() with component_th: it and component_id are of the component's first row, null ids last."""
    with scratch() as kept:
        sig = materialize(signatures(docs, id_col, text_col, words, percent), "signatures")
        classes = sig.where("node is not null").groupBy("node").agg(
            F.min(F.struct(F.col("id").isNull().alias("last"), "id", "th")).alias("first"), F.max("n").alias("n"), F.first("keys").alias("keys"), F.count(F.lit(1)).alias("rows")
        )
        classes = materialize(classes.select("node", F.col("first.id").alias("id"), F.col("first.th").alias("th"), "n", "keys", "rows"), "classes")
        buckets = _buckets(classes)
        nodes = materialize(classes.select("node", "id", "th", "n").join(buckets.select("node").distinct(), "node", "left_semi"), "nodes")

        size = nodes.select(F.col("node").alias("pivot"), F.col("n").alias("pn"))
        star = buckets.where("node != pivot").select("node", "n", "pivot").distinct().join(size, "pivot").where(_could("n", "pn", percent))
        pairs = materialize(star.select(F.col("node").alias("u"), F.col("pivot").alias("v")), "pairs")
        sets = _sets(docs, id_col, text_col, words, classes.select("node", "id", "th") if exact else nodes)
        links = materialize(_verified(pairs, sets, percent), "verified")
        comp = materialize(graph.components(links), "components")

        stray = _everything(classes, comp) if exact else _unsettled(buckets, comp)
        discard(buckets)
        if not stray.isEmpty():
            more = _across(stray, sets, pairs, percent)
            links = links.unionByName(_verified(more, sets, percent))
            comp = materialize(graph.components(links), "components")

        # classes of several rows, and linked ones, take the first row of their component; the rest is its own
        first = F.struct(F.col("id").isNull().alias("last"), "id", "th").alias("first")
        own = classes.select("node", first, "rows")
        linked = materialize(comp.join(own.select("node", "first"), "node"), "linked")
        least = materialize(linked.groupBy("root").agg(F.min("first").alias("least")), "least")
        linked = linked.join(least, "root").select("node", F.col("least").alias("component"))
        copies = own.where("rows > 1").select("node", "first").join(linked.select("node"), "node", "left_anti")
        label = materialize(linked.unionByName(copies.withColumnRenamed("first", "component")), "labels")
        sig = materialize(sig.select("id", "th", "n", "node"), "rows")
        kept += [sig, label]
    out = sig.join(label, "node", "left")
    alone = F.col("component").isNull()
    return out.select(
        "id", "th", F.col("n").alias("n_shingles"), F.when(alone, F.col("id")).otherwise(F.col("component.id")).alias("component_id"), F.when(alone, F.col("th")).otherwise(F.col("component.th")).alias("component_th")
    )


def _buckets(classes: DataFrame) -> DataFrame:
    """(key, node, n, pivot): the nodes of the band keys that several nodes have; the pivot is the least of them."""
    rows = classes.select("node", "n", F.explode("keys").alias("key"))
    twice = materialize(rows.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("key"), "repeated")
    blocks = bloom.blocks_for(twice.count())
    filt = materialize(bloom.once_filter(twice, "key", blocks), "repeated-filter")
    rows = materialize(bloom.hits(rows, "key", filt, blocks, "maybe").where("maybe").drop("maybe"), "possible")
    pivots = materialize(rows.groupBy("key").agg(F.min("node").alias("pivot"), F.count(F.lit(1)).alias("m")).where("m > 1").select("key", "pivot"), "pivots")
    buckets = materialize(rows.join(pivots, "key").select("key", "node", "n", "pivot"), "buckets")
    discard(twice, filt, rows, pivots)
    return buckets


def _everything(classes: DataFrame, comp: DataFrame) -> DataFrame:
    """(node, c): all nodes with their components."""
    c = comp.select("node", F.col("root").alias("c"))
    return materialize(classes.select("node").join(c, "node", "left").withColumn("c", F.coalesce("c", "node")), "unsettled")


def _unsettled(buckets: DataFrame, comp: DataFrame) -> DataFrame:
    """(node, c): the nodes, with their components, of buckets that hold several components."""
    c = comp.select("node", F.col("root").alias("c"))
    rows = materialize(buckets.select("key", "node").join(c, "node", "left").withColumn("c", F.coalesce("c", "node")), "settled")
    still = materialize(rows.groupBy("key").agg(F.min("c").alias("a"), F.max("c").alias("b")).where("a <> b").select("key"), "open")
    out = materialize(rows.join(still, "key", "left_semi").select("node", "c").distinct(), "unsettled")
    discard(rows, still)
    return out


#: Counters of shingles; two shingles in one counter only look more frequent.
_COUNTERS = 1 << 20
#: Bits of a set's parity map: each shingle flips the bit that its hash names.
_PARITY = 1024


def _frequencies(sets: DataFrame) -> np.ndarray:
    """How often shingles occur, by the low bits of their hashes. The size is fixed."""
    low = np.uint64(_COUNTERS - 1)
    step = 1 << 14

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_COUNTERS, np.int64)
        for b in batches:
            total += np.bincount((b.column(0).flatten().to_numpy().view(np.uint64) & low).astype(np.int64), minlength=_COUNTERS)
        yield pa.RecordBatch.from_arrays([pa.array(range(0, _COUNTERS, step), pa.int64()), pa.array([total[i : i + step].tobytes() for i in range(0, _COUNTERS, step)], pa.binary())], ["at", "n"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for at, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                total[at] = total.get(at, 0) + np.frombuffer(n, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array([x.tobytes() for x in total.values()], pa.binary())], ["at", "n"])

    rows = sets.select("items").mapInArrow(local, "at long, n binary").repartition("at").mapInArrow(meet, "at long, n binary").collect()
    out = np.zeros(_COUNTERS, np.int64)
    for r in rows:
        out[r.at : r.at + step] = np.frombuffer(r.n, np.int64)
    return out


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """(node, n, first, parity): the rarest n - ceil(percent n / 100) + 1 shingles of each set, and its parity map."""
    shared = sets.sparkSession.sparkContext.broadcast(_frequencies(sets))
    low = np.uint64(_COUNTERS - 1)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = shared.value
        for b in batches:
            first, parity = [], []
            for items in b.column(1):
                s = items.values.to_numpy()
                order = np.lexsort((s, count[(s.view(np.uint64) & low).astype(np.int64)]))
                first.append(s[order[: len(s) - -(-percent * len(s) // 100) + 1]])
                flips = np.bincount((s.view(np.uint64) >> np.uint64(54)).astype(np.int64), minlength=_PARITY) & 1
                parity.append(np.packbits(flips.astype(np.uint8)).view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(x) for x in b.column(1)], pa.int64()), pa.array(first, pa.list_(pa.int64())), pa.array(parity, pa.list_(pa.int64()))], ["node", "n", "first", "parity"])

    return sets.select("node", "items").mapInArrow(work, "node binary, n long, first array<long>, parity array<long>")


def _across(stray: DataFrame, sets: DataFrame, done: DataFrame, percent: int) -> DataFrame:
    """The pairs of unsettled nodes in different components that could be similar and weren't compared.

    Of the components that meet at a shingle all but the largest are compared
    with the others there.
    """
    pre = materialize(_prefixes(sets, percent).join(stray, "node"), "prefixes")
    blocks = bloom.blocks_for(pre.agg(F.sum(F.size("first"))).first()[0] or 0)
    twice = materialize(bloom.twice_filter(pre, "first", blocks), "repeats")
    rows = pre.select("node", "n", "c", "parity", F.posexplode("first").alias("at", "key"))
    rows = materialize(bloom.hits(rows, "key", twice, blocks, "maybe").where("maybe").select("key", "node", "n", "at", "c", "parity"), "rare")
    sizes = rows.groupBy("key", "c").agg(F.count(F.lit(1)).alias("m"))
    largest = sizes.groupBy("key").agg(F.max(F.struct("m", "c")).alias("top"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    largest = materialize(largest.select("key", F.col("top.c").alias("largest")), "largest")
    # similar sizes have logarithms, to the base of the limit's inverse, that are at most 1 apart: ranges of 2, a pivot is in the one or two it reaches
    log = F.log("n") / (math.log(100 / min(max(percent, 1), 99)) * (1 + 1e-9))
    still = materialize(rows.join(largest, "key").withColumn("scale", F.floor(log / 2)), "still")
    pivots = still.where("c != largest").select(
        "key", F.col("node").alias("v"), F.col("n").alias("vn"), F.col("at").alias("vat"), F.col("parity").alias("vparity"), F.col("c").alias("vc"),
        F.explode(F.array_distinct(F.array(F.floor((log - 1) / 2), F.floor((log + 1) / 2)))).alias("scale"),
    )
    met = still.select("key", F.col("node").alias("u"), "n", "at", "c", "parity", "largest", "scale").join(pivots, ["key", "scale"]).where(F.col("c") != F.col("vc"))
    # two pivots meet in both orders
    met = met.where((F.col("c") == F.col("largest")) | (F.col("u") > F.col("v"))).where(_could("n", "vn", percent))
    # the first shingle that two similar sets share leaves enough behind it in both: intersection >= s / (1 + s) of the sizes' sum
    behind = F.least(F.col("n") - F.col("at"), F.col("vn") - F.col("vat"))
    # each shingle that only one of them has flips one bit, so they differ in as many shingles as their maps do in bits, or more
    apart = F.aggregate(F.zip_with("parity", "vparity", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    both = F.col("n") + F.col("vn")
    met = met.where(((100 + percent) * behind >= percent * both) & ((100 + percent) * apart <= (100 - percent) * both))
    met = met.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    seen = done.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    return materialize(met.join(seen, ["u", "v"], "left_anti"), "across")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """The documents that stay, one of each group of near copies, with all their columns.

    The one is the first by (id, text hash), null ids last. Rows that repeat both id and text stay or go together; exact
    deduplication before this operator leaves none.
    """
    found = _components(docs, id_col, text_col, words, percent)
    stays = F.col("id").eqNullSafe(F.col("component_id")) & (F.col("th") == F.col("component_th"))
    lost = materialize(found.where(~stays).select(F.col("id").alias("lid"), F.col("th").alias("lth")).distinct(), "lost")
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.xxhash64(whole(F.col(text_col))).alias("th"))
    # only rows that a Bloom filter of the lost ones lets through shuffle with their texts
    blocks = bloom.blocks_for(lost.count())
    filt = materialize(bloom.once_filter(lost.select("lth"), "lth", blocks), "lost-filter")
    tested = bloom.hits(rows, "th", filt, blocks, "maybe")
    met = tested.where("maybe").join(lost, F.col("id").eqNullSafe(F.col("lid")) & (F.col("th") == F.col("lth")), "left_anti")
    return tested.where("not maybe").select("row").unionByName(met.select("row")).select("row.*")
