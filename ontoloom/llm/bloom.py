"""Blocked Bloom filters as small tables.

A block holds 256 bits in four longs and is a row (block, w0..w3), so that a
test is a broadcast hash join on ``block`` and bit arithmetic, both inside
generated code. The number of blocks is at most ``MAX_BLOCKS`` whatever the
input: a filter that is too small for its keys passes more false hits, which
the exact step behind it removes, and never loses a key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: 2**20 blocks of 32 bytes: no filter is over 32 MiB.
MAX_BLOCKS = 1 << 20
MIN_BLOCKS = 1 << 6
BITS_A_KEY = 16
#: With fewer bits a key than these a filter passes more than an eighth of all keys falsely.
LEAST_BITS = 4
#: Tasks that fold keys into filters take so many at least, but for a few tasks: each sends a filter.
FOLD_KEYS, FOLD_TASKS = 1 << 22, 16
#: Where in the hash the bit positions of a key start; the block is in the low bits.
SHIFTS = (32, 40, 48, 56)
WORDS = 4


def blocks_for(keys: int) -> int:
    """A power of two that gives ``BITS_A_KEY`` bits to a key, within the bounds."""
    need = max(1, keys * BITS_A_KEY // 256)
    return int(min(MAX_BLOCKS, max(MIN_BLOCKS, 1 << (need - 1).bit_length())))


def _position(h: Column, shift: int) -> Column:
    return F.shiftrightunsigned(h, shift).bitwiseAND(F.lit(255))


def block_of(h: Column, blocks: int) -> Column:
    return h.bitwiseAND(F.lit(blocks - 1).cast("long"))


def once_filter(keys: DataFrame, h: str, blocks: int) -> DataFrame:
    """The filter of all keys whose 64-bit hashes are in column ``h``, built by SQL operators only."""
    words = []
    for w in range(WORDS):
        bits = F.lit(0).cast("long")
        for s in SHIFTS:
            p = _position(F.col(h), s)
            one = F.expr(f"shiftleft(1L, cast(shiftrightunsigned({h}, {s}) & 63 as int))")
            bits = bits.bitwiseOR(F.when(F.shiftright(p, 6) == w, one).otherwise(F.lit(0).cast("long")))
        words.append(F.bit_or(bits).alias(f"w{w}"))
    return keys.groupBy(block_of(F.col(h), blocks).alias("block")).agg(*words)


def hits(rows: DataFrame, h: str, filt: DataFrame, blocks: int, out: str) -> DataFrame:
    """``rows`` with a boolean column ``out``: may the key with hash ``h`` be in the filter?

    The broadcast side has at most ``blocks`` <= ``MAX_BLOCKS`` rows.
    """
    f = filt.select(F.col("block").alias("__b"), *[F.col(f"w{w}").alias(f"__w{w}") for w in range(WORDS)])
    joined = rows.join(F.broadcast(f), block_of(F.col(h), blocks) == F.col("__b"), "left")
    ok = F.col("__b").isNotNull()
    for s in SHIFTS:
        word = f"case shiftrightunsigned({h}, {s + 6}) & 3 when 0 then __w0 when 1 then __w1 when 2 then __w2 else __w3 end"
        ok = ok & (F.expr(f"shiftrightunsigned({word}, cast(shiftrightunsigned({h}, {s}) & 63 as int)) & 1L") == 1)
    return joined.select(*[F.col(c) for c in rows.columns], F.coalesce(ok, F.lit(False)).alias(out))


class _Seen:
    """The bits set at least once and at least twice so far."""

    def __init__(self, blocks: int):
        self.blocks = blocks
        self.once = np.zeros(blocks * WORDS, np.uint64)
        self.twice = np.zeros(blocks * WORDS, np.uint64)

    def _put(self, into: np.ndarray, at: np.ndarray, bits: np.ndarray) -> None:
        into[at] |= bits

    def keys(self, h: np.ndarray) -> None:
        if not len(h):
            return
        block = (h & np.uint64(self.blocks - 1)) << np.uint64(8)
        pos = np.stack([block | ((h >> np.uint64(s)) & np.uint64(255)) for s in SHIFTS], 1)
        pos.sort(axis=1)
        own = np.ones(pos.shape, bool)
        own[:, 1:] = pos[:, 1:] != pos[:, :-1]  # a key counts once for a bit
        uniq, n = np.unique(pos[own], return_counts=True)
        bit = np.uint64(1) << (uniq & np.uint64(63))
        word, first = np.unique(uniq >> np.uint64(6), return_index=True)
        word = word.astype(np.int64)
        new = np.bitwise_or.reduceat(bit, first)
        again = np.bitwise_or.reduceat(np.where(n > 1, bit, np.uint64(0)), first)
        self.twice[word] |= again | (self.once[word] & new)
        self.once[word] |= new

    def merge(self, block: np.ndarray, once: np.ndarray, twice: np.ndarray) -> None:
        """One row of each block at most in a call."""
        at = block[:, None] * WORDS + np.arange(WORDS)
        self.twice[at] |= twice | (self.once[at] & once)
        self.once[at] |= once

    def rows(self, repeated_only: bool) -> Iterator[pa.RecordBatch]:
        o, t = self.once.reshape(-1, WORDS), self.twice.reshape(-1, WORDS)
        full = np.flatnonzero((t if repeated_only else o).any(1))
        for i in range(0, len(full), 20_000):
            k = full[i : i + 20_000]
            cols = [k.astype(np.int64)] + ([] if repeated_only else [o[k, w].view(np.int64) for w in range(WORDS)]) + [np.ascontiguousarray(t[k, w]).view(np.int64) for w in range(WORDS)]
            names = ["block"] + ([] if repeated_only else [f"o{w}" for w in range(WORDS)]) + [f"w{w}" for w in range(WORDS)]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c).view(np.int64)) for c in cols], names)


def twice_filter(keys: DataFrame, h: str, blocks: int) -> DataFrame:
    """The filter of the bits that two or more rows set: a hash that occurs twice always passes it.

    ``h`` is a column of hashes, or of lists of hashes.

    First pass of the two: each task folds its rows into a filter, and the
    filters meet block by block, so a block needs as many rows as there are
    tasks and no task more than two filters of memory.
    """

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Seen(blocks)
        for b in batches:
            col = b.column(0)
            col = col.flatten() if pa.types.is_list(col.type) else col
            seen.keys(col.drop_null().to_numpy(zero_copy_only=False).view(np.uint64))
        yield from seen.rows(False)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Seen(blocks)
        for b in batches:
            block, *words = [c.to_numpy(zero_copy_only=False) for c in b.columns]
            words = [np.ascontiguousarray(w).view(np.uint64) for w in words]
            order = np.argsort(block, kind="stable")
            block, words = block[order], np.stack(words, 1)[order]
            turn = np.arange(len(block)) - np.searchsorted(block, block)  # which row of its block in this batch
            for k in range(int(turn.max(initial=-1)) + 1):
                m = turn == k
                seen.merge(block[m], words[m, :WORDS], words[m, WORDS:])
        yield from seen.rows(True)

    longs = ", ".join(f"w{w} long" for w in range(WORDS))
    parts = keys.select(h).mapInArrow(local, "block long, " + ", ".join(f"o{w} long" for w in range(WORDS)) + ", " + longs)
    return parts.repartition("block").mapInArrow(meet, "block long, " + longs)


def repeats(keys: DataFrame, h: str) -> tuple[DataFrame, int]:
    """A filter that every hash passes which occurs twice in column ``h`` of a written table, and its blocks.

    As long as a filter of all hashes has ``LEAST_BITS`` for each, it is folded
    in two passes. Beyond (some 67 million hashes) no filter that can be
    broadcast would tell them apart: there the hashes, eight bytes each, are
    counted in shards first, and the filter has only those that do repeat.
    """
    total = keys.count()
    if total * LEAST_BITS <= MAX_BLOCKS * 256:
        blocks = blocks_for(total)
        return materialize(twice_filter(keys.select(h).coalesce(max(FOLD_TASKS, total // FOLD_KEYS)), h, blocks), "repeats"), blocks
    again = materialize(keys.groupBy(h).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(h), "repeated")
    blocks = blocks_for(again.count())
    return materialize(once_filter(again, h, blocks), "repeats"), blocks
