"""Best-fit packing into bins of several permitted lengths.

Texts longer than the largest length are cut into pieces of that length and a
rest, so nothing is lost. Pieces are dealt to shards, a shard of about
``SHARD_PIECES`` pieces is packed by one task, and its pieces go in decreasing
length to the open bin with the least room that still holds them.

When no open bin has room, the opened size is the one of least expected cost
for each token that it will hold: ``cost(size)`` over the smaller of the size
and what is left to pack in the shard. All permitted sizes are optimised
jointly: a shard is packed under each bound on the size of opened bins, and
the plan of least total cost after downsizing stays. At last every bin shrinks
to the smallest permitted length that holds its contents.

``pack`` returns whole sequences: a row is a bin with its tokens and where
each part comes from. ``plan`` returns places only, for any column of lengths.

Rows are numbered by their place when their lengths are written, and shards
are dealt by a hash of that number and the piece. So rows that repeat id and
text spread like others, and a shard holds a bounded number of pieces, whatever
repeats. The numbers are written before they are used, so a lost executor
changes no shard; another split of the input gives another, equally good plan.

Defined cases: a null, empty or blank text has no tokens: no part of any
sequence, and one row without a bin in a plan. Ties go by id, piece and
number; a null id goes last and stays null; repeated rows are packed each on
its own; an empty table gives an empty result. Extra columns don't matter.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WS, give_back, materialize, whole

SIZES = (256, 512, 1024, 2048)
#: With the largest pieces a shard's tokens, of two bytes each, take 32 MiB.
SHARD_PIECES = 8_192
#: Tokens that a sequence costs besides its length (separators, its share of a step).
OVERHEAD = 16


def linear_cost(size: int) -> float:
    """Padding is paid in full; each bin has a fixed overhead."""
    return size + OVERHEAD


def words(text: Column) -> Column:
    """The number of words of a text."""
    t = F.regexp_replace(whole(text), f"^{WS}|{WS}$", "")
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, WS))).cast("long")


class _Open:
    """Open bins by their room; one big integer has a bit for each room that some bin has."""

    def __init__(self, most: int):
        self.at: list[list[int]] = [[] for _ in range(most + 1)]
        self.mask = 0

    def add(self, room: int, bin_: int) -> None:
        if room:
            self.at[room].append(bin_)
            self.mask |= 1 << room

    def best(self, need: int) -> tuple[int, int] | None:
        """The (room, bin) with the least room of at least ``need``, taken out."""
        fits = self.mask >> need
        if not fits:
            return None
        room = need + (fits & -fits).bit_length() - 1
        bin_ = self.at[room].pop()
        if not self.at[room]:
            self.mask &= ~(1 << room)
        return room, bin_


def _pack(lengths: list[int], sizes: list[int], cost: Callable[[int], float], bound: int) -> tuple[list[int], list[int], list[int], float]:
    """Bins and offsets of pieces in decreasing length, final bin sizes and total cost.

    Bins of at most ``bound`` are opened, larger ones only for pieces that need them.
    """
    open_, used, at, offset, left = _Open(sizes[-1]), [], [], [], sum(lengths)
    for n in lengths:
        got = open_.best(n)
        if got is None:
            fit = [s for s in sizes if s >= n]
            able = [s for s in fit if s <= bound] or fit[:1]
            size = min(able, key=lambda s: (cost(s) / min(s, left), -s))
            room, b = size, len(used)
            used.append(0)
        else:
            room, b = got
        at.append(b)
        offset.append(used[b])
        used[b] += n
        left -= n
        open_.add(room - n, b)
    final = [next(s for s in sizes if s >= u) for u in used]
    return at, offset, final, sum(map(cost, final))


def pack_shard(lengths: list[int], sizes: list[int], cost: Callable[[int], float] = linear_cost) -> tuple[list[int], list[int], list[int]]:
    """Bin, offset in the bin and final size of each bin for pieces in decreasing length."""
    plans = [_pack(lengths, sizes, cost, bound) for bound in sizes]
    best = min(plans, key=lambda p: p[3])
    return best[:3]


def _bins(rows: DataFrame, sizes: list[int], cost: Callable[[int], float], width: int = 0) -> DataFrame:
    """Written rows (id, n, at, and tokens if there are any) -> a row for each bin: (bin_id, bin_size, n_tokens, ids, pieces, starts, lengths, offsets, and tokens)."""
    largest, tokens = sizes[-1], "tokens" in rows.columns
    count = rows.agg(F.sum(F.ceil(F.col("n") / largest))).first()[0] or 0
    shards = max(1, -(-count // SHARD_PIECES))
    last = (F.ceil(F.col("n") / largest) - 1).cast("long")
    piece = lambda k: F.struct(
        k.alias("piece"), (k * largest).alias("start"), F.least(F.lit(largest), F.col("n") - k * largest).cast("long").alias("length"),
        *([F.col("tokens").substr((k * largest * width + 1).cast("int"), F.lit(largest * width)).alias("tokens")] if tokens else []),
    )
    pieces = rows.where("n > 0").select("id", "at", F.explode(F.transform(F.sequence(F.lit(0).cast("long"), last), piece)).alias("p")).select("id", "at", "p.*")
    pieces = pieces.withColumn("shard", F.pmod(F.xxhash64("at", "piece"), F.lit(shards)))

    def work(key: tuple, t: pa.Table) -> pa.Table:
        give_back()
        t = t.combine_chunks().sort_by([("length", "descending"), ("id", "ascending"), ("piece", "ascending"), ("at", "ascending")])
        length = t["length"].to_numpy()
        bins, offset, final = pack_shard(length.tolist(), sizes, cost)
        order = np.lexsort((offset, bins))
        t, bins, length = t.take(pa.array(order)), np.array(bins)[order], length[order]
        parts = np.bincount(bins, minlength=len(final))
        ends = pa.array(np.concatenate([[0], np.cumsum(parts)]).astype(np.int32))
        used = np.bincount(bins, weights=length, minlength=len(final)).astype(np.int64)
        lists = lambda name: pa.ListArray.from_arrays(ends, t[name].combine_chunks())
        out = {"bin_id": pa.array([f"{key[0]}-{b}" for b in range(len(final))], pa.string()), "bin_size": pa.array(final, pa.int64()), "n_tokens": pa.array(used)}
        out |= {"ids": lists("id"), "pieces": lists("piece"), "starts": lists("start"), "lengths": lists("length"), "offsets": pa.ListArray.from_arrays(ends, pa.array(np.array(offset, np.int64)[order]))}
        if tokens:
            ends = np.concatenate([[0], np.cumsum(used * width)]).astype(np.int32)  # the parts lie in order, so a bin is a range of them
            out["tokens"] = pa.Array.from_buffers(pa.binary(), len(final), [None, pa.py_buffer(ends.tobytes()), t["tokens"].combine_chunks().buffers()[2]])
        return pa.table(out)

    kind = rows.schema["id"].dataType.simpleString()
    schema = f"bin_id string, bin_size long, n_tokens long, ids array<{kind}>, pieces array<long>, starts array<long>, lengths array<long>, offsets array<long>" + (", tokens binary" if tokens else "")
    return pieces.groupBy("shard").applyInArrow(lambda key, t: work(tuple(k.as_py() for k in key), t), schema)


def pack(docs: DataFrame, tokens: Column, width: int, id_col: str = "doc_id", sizes: tuple[int, ...] = SIZES, cost: Callable[[int], float] = linear_cost) -> DataFrame:
    """Packed sequences: (bin_id, bin_size, n_tokens, ids, pieces, starts, lengths, offsets, tokens).

    ``tokens`` is a column of ``docs``, each text's tokens as integers of
    ``width`` bytes, one behind the other; a bin's tokens are the same. ids,
    pieces, starts, lengths and offsets are parallel lists, in the order of the
    bin: tokens ``start`` up to ``start + length`` of the row ``id`` lie at
    ``offset``. Tokens shuffle once.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(tokens, F.lit(b"")).alias("tokens"))
    rows = rows.select("id", "tokens", F.floor(F.octet_length("tokens") / width).cast("long").alias("n"), F.monotonically_increasing_id().alias("at"))
    return _bins(materialize(rows, "tokens"), sorted(set(sizes)), cost, width)


def plan(docs: DataFrame, length: Column | None = None, id_col: str = "doc_id", text_col: str = "text", sizes: tuple[int, ...] = SIZES, cost: Callable[[int], float] = linear_cost) -> DataFrame:
    """One row for each piece: (id, piece, start, length, bin_id, bin_size, bin_offset).

    ``length`` is the column of lengths, by default the number of words. A bin
    is named by its shard and its number there.
    """
    n = words(F.col(text_col)) if length is None else length.cast("long")
    rows = materialize(docs.select(F.col(id_col).alias("id"), F.coalesce(n, F.lit(0).cast("long")).alias("n"), F.monotonically_increasing_id().alias("at")), "lengths")
    bins = _bins(rows, sorted(set(sizes)), cost)
    zero, none = F.lit(0).cast("long"), F.lit(None)
    packed = bins.select("bin_id", "bin_size", F.explode(F.arrays_zip("ids", "pieces", "starts", "lengths", "offsets")).alias("p"))
    packed = packed.select(F.col("p.ids").alias("id"), F.col("p.pieces").alias("piece"), F.col("p.starts").alias("start"), F.col("p.lengths").alias("length"), "bin_id", "bin_size", F.col("p.offsets").alias("bin_offset"))
    empty = rows.where("n <= 0").select("id", zero.alias("piece"), zero.alias("start"), zero.alias("length"), none.cast("string").alias("bin_id"), none.cast("long").alias("bin_size"), none.cast("long").alias("bin_offset"))
    return packed.unionByName(empty).withColumnRenamed("id", id_col)


def render(docs: DataFrame, packed: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(bin_id, bin_size, text): each bin's pieces, joined by newlines in the order of their offsets.

    Ids have to be unique here. A bin holds at most ``bin_size`` words, so its
    group is bounded.
    """
    t = F.regexp_replace(whole(F.col(text_col)), f"^{WS}|{WS}$", "")
    rows = packed.where("bin_id is not null").join(docs.select(F.col(id_col), F.split(t, WS).alias("w")), id_col)
    part = F.array_join(F.slice("w", F.col("start").cast("int") + 1, F.col("length").cast("int")), " ")
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("bin_offset", part.alias("t")))), lambda x: x["t"]), "\n")
    return rows.groupBy("bin_id", "bin_size").agg(joined.alias("text"))
