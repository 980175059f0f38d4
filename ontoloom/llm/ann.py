"""Approximate nearest neighbours: inverted lists, product-quantised residuals, exact reranking.

Index. Coarse centroids (about the square root of the rows, ``MAX_LISTS`` at
most) and the codebooks of the residuals are trained on at most ``SAMPLE``
vectors, the first in the order of a hash. Every vector is then indexed: its
list, its code, and the part of its distance that no query changes. The index
is dealt by range of (list, row), so that a list with a third of all vectors
is spread, and written as blocks of at most ``INDEX_BLOCK`` vectors.

Search. One job for all queries: queries come in blocks of ``QUERY_BLOCK``,
index blocks in shards of about ``SHARD_BLOCKS``, and each pair of them is one
group of bounded size. It makes the queries' tables of inner products with all
codewords, walks the shard's lists, adds up table entries for the queries that
probe a list, and keeps the best ``RERANK`` candidates of each query. The best
``RERANK`` of all shards are measured exactly, in double precision, on original
vectors.

How many lists a query probes is measured, not set: the exact neighbours of
``TUNING`` vectors of the sample are found among all vectors, and the least
number of lists, nearest first, that holds a share of ``COVERED`` of them is
taken for all queries. Vectors in clusters need a few lists; vectors without
any structure (as those of the test tables, whose components are independent)
need most of them, whatever the index. ``lists`` sets a number by hand.

Defined cases: a vector that is null, zero or has null or non-finite
components, and one with a null id, takes no part. Vectors are compared with
those of their own length. Rows that share an id are rows of their own: each is
a candidate of the others, and each that is a query has its own ranks. Ties go
to the smaller id. A query with fewer candidates than asked for gets them all;
an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

SAMPLE = 16_384
MAX_LISTS = 4_096
CODEWORDS = 256
SUB_DIM = 2
RERANK = 256
TUNING, COVERED = 256, 0.985
INDEX_BLOCK, QUERY_BLOCK, SHARD_BLOCKS = 4_096, 1_024, 8
#: Lists of candidates that become one at a time.
MERGED = 64
STEPS = 8
_FOUND = "query_id long, rank int, id long, score double"


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), np.int64)
    norm = (c * c).sum(1)
    for i in range(0, len(x), 4096):
        out[i : i + 4096] = (norm - 2 * x[i : i + 4096] @ c.T).argmin(1)
    return out


def kmeans(x: np.ndarray, k: int, steps: int = STEPS) -> np.ndarray:
    """Lloyd's algorithm from distinct rows in their given order; an empty cell keeps its centroid."""
    _, first = np.unique(x, axis=0, return_index=True)
    c = x[np.sort(first)[:k]].copy()
    for _ in range(steps):
        a = _nearest(x, c)
        n = np.bincount(a, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, a, x)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return c


@dataclass(frozen=True)
class Quantiser:
    centroids: np.ndarray  # lists x dim
    books: np.ndarray  # subspaces x codewords x SUB_DIM

    def split(self, x: np.ndarray) -> np.ndarray:
        """rows x subspaces x SUB_DIM, padded with zeros."""
        m = self.books.shape[0]
        pad = np.zeros((len(x), m * SUB_DIM))
        pad[:, : x.shape[1]] = x
        return pad.reshape(len(x), m, SUB_DIM)

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Lists, codes, and 2 c.r + r.r of the decoded residuals r."""
        cell = _nearest(x, self.centroids)
        r = self.split(x - self.centroids[cell])
        code = np.stack([_nearest(r[:, m], self.books[m]) for m in range(r.shape[1])], 1)
        back = self.books[np.arange(r.shape[1]), code]
        bias = (back * (2 * self.split(self.centroids[cell]) + back)).sum((1, 2))
        return cell, code.astype(np.uint8), bias

    def tables(self, q: np.ndarray) -> np.ndarray:
        """subspaces x codewords x queries: the inner products of queries and codewords, 32 MiB at most for 64 components."""
        return np.einsum("mcd,qmd->mcq", self.books, self.split(q)).astype(np.float32)


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v array<double>, at): the usable vectors, numbered."""
    v = F.col(vec_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where("id is not null and v is not null")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    return rows.where(fine).withColumn("at", F.monotonically_increasing_id())


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def sample(vectors: DataFrame) -> np.ndarray:
    """At most SAMPLE vectors, the first in the order of a hash."""
    got = vectors.orderBy(F.xxhash64("id"), "id", "at").limit(SAMPLE).select("v").toArrow()
    return np.array(got.column(0).to_pylist(), float)


def train(x: np.ndarray, rows: int) -> Quantiser:
    """From a sample of ``rows`` vectors."""
    lists = int(min(MAX_LISTS, max(1, rows**0.5), max(1, len(x) // 8)))
    c = kmeans(x, lists)
    r = x - c[_nearest(x, c)]
    m = -(-x.shape[1] // SUB_DIM)
    pad = np.zeros((len(x), m * SUB_DIM))
    pad[:, : x.shape[1]] = r
    books = np.zeros((m, CODEWORDS, SUB_DIM))
    for j in range(m):
        b = kmeans(pad[:, j * SUB_DIM : (j + 1) * SUB_DIM], CODEWORDS, 4)
        books[j] = np.concatenate([b, np.repeat(b[:1], CODEWORDS - len(b), 0)])
    return Quantiser(c, books)


def _squares(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    return (q * q).sum(1)[:, None] + (x * x).sum(1)[None] - 2 * q @ x.T


def lists_needed(vectors: DataFrame, quantiser: Quantiser, x: np.ndarray, k: int) -> int:
    """The least number of lists, nearest first, that holds a share of COVERED of the tuning vectors' exact neighbours."""
    q, dim, shared = x[:TUNING], x.shape[1], (x[:TUNING], quantiser.centroids)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, centroids = shared
        best = [(np.empty(0), np.empty(0, np.int64))] * len(own)
        for b in batches:
            for lo in range(0, b.num_rows, 4096):
                y = _matrix(b.column(0).slice(lo, 4096), dim)
                cell, d = _nearest(y, centroids), _squares(own, y)
                near = np.argpartition(d, min(k, d.shape[1] - 1), 1)[:, : k + 1]
                for j, at in enumerate(near):
                    dj, cj = np.concatenate([best[j][0], d[j, at]]), np.concatenate([best[j][1], cell[at]])
                    order = dj.argsort(kind="stable")[: k + 1]
                    best[j] = dj[order], cj[order]
        for j, (dj, cj) in enumerate(best):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(dj), j)), pa.array(dj), pa.array(cj)], ["q", "d", "cell"])

    rows = vectors.select("v").mapInArrow(work, "q long, d double, cell long")
    # the nearest of all is the vector itself
    rows = rows.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy("d", "cell"))).where((F.col("r") > 1) & (F.col("r") <= k + 1))
    got = rows.select("q", "cell").collect()  # TUNING * k rows
    turn = _squares(q, quantiser.centroids).argsort(1, kind="stable").argsort(1)
    need = sorted(int(turn[r.q, r.cell]) + 1 for r in got)
    return need[min(len(need) - 1, int(np.ceil(COVERED * len(need))) - 1)] if need else 1


def index(vectors: DataFrame, quantiser: Quantiser) -> DataFrame:
    """(block, cells, ats, codes, biases) of every vector (v, at), in the order of (cell, at), as written blocks."""
    dim = quantiser.centroids.shape[1]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cell, code, bias = quantiser.encode(_matrix(b.column(0), dim))
            yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int64()), b.column(1), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(bias)], ["cell", "at", "code", "bias"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, INDEX_BLOCK):
                part = b.slice(lo, INDEX_BLOCK)
                cell, at, bias = (part[n].to_numpy(zero_copy_only=False).tobytes() for n in ("cell", "at", "bias"))
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in (cell, at, b"".join(part["code"].to_pylist()), bias)], ["cells", "ats", "codes", "biases"])

    rows = vectors.select("v", "at").mapInArrow(encode, "cell long, at long, code binary, bias double")
    rows = materialize(rows, "codes").repartitionByRange("cell", "at").sortWithinPartitions("cell", "at")
    return materialize(rows.mapInArrow(pack, "cells binary, ats binary, codes binary, biases binary").withColumn("block", F.monotonically_increasing_id()), "index")


def _best(ids: list[np.ndarray], ds: list[np.ndarray], keep: int) -> tuple[np.ndarray, np.ndarray]:
    i, d = np.concatenate(ids), np.concatenate(ds)
    if len(i) > keep:
        bound = np.partition(d, keep - 1)[keep - 1]
        m = d <= bound
        i, d = i[m], d[m]
        o = np.lexsort((i, d))[:keep]
        i, d = i[o], d[o]
    return i, d


def _walk(quantiser: Quantiser, lists: int, keep: int, blocks: Iterator[tuple[bytes, bytes, bytes, bytes]], who: np.ndarray, q: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, rows, approximate squared distances): the ``keep`` best of each query among the vectors of some index blocks."""
    far = _squares(q, quantiser.centroids)
    on = np.zeros(far.shape, bool)
    np.put_along_axis(on, far.argsort(1, kind="stable")[:, :lists], True, 1)
    tables = quantiser.tables(q)
    ids: list[list[np.ndarray]] = [[] for _ in who]
    ds: list[list[np.ndarray]] = [[] for _ in who]
    held = np.zeros(len(who), np.int64)
    for cells, ats, codes, biases in blocks:
        cell, own, bias = np.frombuffer(cells, np.int64), np.frombuffer(ats, np.int64), np.frombuffer(biases)
        code = np.frombuffer(codes, np.uint8).reshape(len(own), -1)
        bounds = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1], [True]]))
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
            qs = np.flatnonzero(on[:, cell[lo]])
            if not len(qs):
                continue
            dot = np.zeros((hi - lo, len(qs)), np.float32)
            for m in range(code.shape[1]):
                dot += tables[m][code[lo:hi, m]][:, qs]
            d = far[qs, cell[lo]][None] + bias[lo:hi, None] - 2 * dot
            for k, j in enumerate(qs):
                ids[j].append(own[lo:hi])
                ds[j].append(d[:, k])
                held[j] += hi - lo
                if held[j] > 8 * keep:
                    i2, d2 = _best(ids[j], ds[j], keep + 1)
                    ids[j], ds[j], held[j] = [i2], [d2], len(i2)
    for j, query in enumerate(who):
        if ids[j]:
            i2, d2 = _best(ids[j], ds[j], keep + 1)
            other = i2 != query
            yield int(query), *_best([i2[other]], [d2[other]], keep)


_LISTS = "query long, shard long, ats array<long>, ds array<double>"


def _lists(rows: list[tuple[int, int, np.ndarray, np.ndarray]]) -> pa.Table:
    """(query, shard, rows, distances) as a table of _LISTS."""
    ends = pa.array(np.cumsum([0, *(len(at) for *_, at, _ in rows)]).astype(np.int32))
    joined = lambda k, t: pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.empty(0, t), *(r[k] for r in rows)]).astype(t)))
    return pa.table({"query": pa.array([r[0] for r in rows], pa.int64()), "shard": pa.array([r[1] for r in rows], pa.int64()), "ats": joined(2, np.int64), "ds": joined(3, float)})


def candidates(blocks: DataFrame, queries: DataFrame, quantiser: Quantiser, lists: int, keep: int) -> DataFrame:
    """(query, at): for each query (at, v) the ``keep`` best rows of the index by approximate distance.

    A pair of query and shard is one row, with a list of ``keep`` candidates at
    most; ``MERGED`` lists of a query become one until it has a single one.
    """
    dim, count, total = quantiser.centroids.shape[1], blocks.count(), queries.count()
    shards = max(1, min(count, max(64, count // SHARD_BLOCKS)))
    parts = -(-total // QUERY_BLOCK)
    left = blocks.withColumns({"shard": F.pmod(F.xxhash64("block"), F.lit(shards)), "part": F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))})
    right = queries.select(F.pmod(F.xxhash64("at"), F.lit(parts)).cast("int").alias("part"), "at", "v", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"))
    shared = blocks.sparkSession.sparkContext.broadcast(quantiser)  # MAX_LISTS centroids and fixed codebooks

    def work(key: tuple, a: pa.Table, b: pa.Table) -> pa.Table:
        rows = []
        if a.num_rows and b.num_rows:
            b = b.combine_chunks()
            each = zip(*[(x.as_py() for x in a[n]) for n in ("cells", "ats", "codes", "biases")], strict=True)
            found = _walk(shared.value, lists, keep, each, b["at"].to_numpy(), _matrix(b["v"].combine_chunks(), dim))
            rows = [(who, key[1].as_py(), at, d) for who, at, d in found]
        return _lists(rows)

    def merge(key: tuple, t: pa.Table) -> pa.Table:
        at, d = (t[n].combine_chunks().flatten().to_numpy(zero_copy_only=False) for n in ("ats", "ds"))
        at, d = _best([at], [d], keep)
        return _lists([(key[0].as_py(), key[1].as_py(), at, d)])

    got = left.groupBy("part", "shard").cogroup(right.groupBy("part", "shard")).applyInArrow(work, _LISTS)
    while shards > 1:
        got = got.withColumn("shard", F.floor(F.col("shard") / MERGED)).groupBy("query", "shard").applyInArrow(merge, _LISTS)
        shards = -(-shards // MERGED)
    return got.select("query", F.explode("ats").alias("at"))


def distance(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))


def search(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", lists: int | None = None, rerank: int = RERANK) -> DataFrame:
    """(query_id, rank, id, score): the k nearest found of each row for which ``is_query`` (of column id) holds."""
    every = materialize(usable(vectors, id_col, vec_col), "vectors")
    sizes = every.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n"), F.count_if(is_query).alias("q")).where("n > 1 and q > 0").collect()
    parts = [_search(every.where(F.size("v") == dim), is_query, k, n, lists, rerank) for dim, n, _ in sorted(sizes)]
    if not parts:
        return every.sparkSession.createDataFrame([], _FOUND)
    return reduce(DataFrame.unionByName, parts)


def _search(v: DataFrame, is_query: Column, k: int, total: int, lists: int | None, rerank: int) -> DataFrame:
    """search() among ``total`` vectors of one length."""
    x = sample(v)
    quantiser = train(x, total)
    lists = lists or lists_needed(v, quantiser, x, k)
    queries = materialize(v.where(is_query), "queries")
    found = materialize(candidates(index(v, quantiser), queries, quantiser, lists, rerank), "candidates")
    near = found.join(v.select("at", "id", "v"), "at").join(queries.select(F.col("at").alias("query"), F.col("id").alias("query_id"), F.col("v").alias("q")), "query")
    near = near.select("query", "query_id", "id", distance(F.col("q"), F.col("v")).alias("score"), "at")
    order = Window.partitionBy("query").orderBy("score", "id", "at")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
