"""Byte-level BPE in two tiers.

A text is cut into pre-tokens by the pattern. Tier one: a minimal perfect hash
over the vocabulary, built by hash and displace, gives the one slot a
pre-token could be in; if the slot holds its bytes, its rank is the id. Tier
two, for the misses: the pre-token's bytes form a linked list, a heap holds the
ranks of its neighbouring pairs, and the least rank, leftmost first, is merged
until none is left. The pairs are looked up by the same hash. A pre-token of n
bytes takes O(n log n), so one long run of letters does no harm. Results of
both tiers are remembered, up to ``Encoder.KNOWN`` pre-tokens of ``SHORT`` letters,
so in running text most look-ups end there and each tier sees a pre-token once.

Defined cases: a null text counts as empty and has no ids; special tokens are
ordinary text; decoding is a plain concatenation and gives back the text's
UTF-8 bytes exactly; decoding null ids gives no bytes. An id outside the
vocabulary raises an error.
"""

from __future__ import annotations

import base64
import heapq
import re
import struct
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import give_back, whole


def load_ranks(path: str) -> list[bytes]:
    """The vocabulary of a rank file, in the order of ranks 0, 1, 2, ..."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    out = [b""] * len(pairs)
    for token, rank in pairs:
        out[int(rank)] = base64.b64decode(token)
    return out


class PerfectHash:
    """A minimal perfect hash over distinct byte strings.

    Keys fall into buckets of about two; bucket by bucket, the largest first,
    a displacement is sought that sends all its keys to free slots. Buckets of
    one key come last and name one of the slots left, as -1 - slot. A lookup
    costs one hash, one displacement and one comparison.
    """

    def __init__(self, keys: list[bytes]):
        self.n, self.buckets = len(keys), max(1, len(keys) // 2)
        self.shift = [0] * self.buckets
        self.keys: list[bytes] = [b""] * self.n
        self.ids = [-1] * self.n
        groups: list[list[tuple[int, int, int]]] = [[] for _ in range(self.buckets)]
        for i, key in enumerate(keys):
            h = xxhash.xxh3_64_intdigest(key)
            groups[h % self.buckets].append((h >> 20, h >> 11 | 1, i))
        taken = bytearray(self.n)
        free = iter(range(self.n))
        for b in sorted(range(self.buckets), key=lambda b: -len(groups[b])):
            group, d = groups[b], 0
            if not group:
                break
            if len(group) == 1:
                slots = [next(s for s in free if not taken[s])]
                d = -1 - slots[0]
            else:
                while True:
                    slots = [(x + d * y) % self.n for x, y, _ in group]
                    if not any(taken[s] for s in slots) and len({*slots}) == len(slots):
                        break
                    d += 1
            self.shift[b] = d
            for s, (_, _, i) in zip(slots, group, strict=True):
                taken[s], self.keys[s], self.ids[s] = 1, keys[i], i

    def get(self, key: bytes) -> int:
        """The rank of ``key``, or -1."""
        h = xxhash.xxh3_64_intdigest(key)
        d = self.shift[h % self.buckets]
        s = ((h >> 20) + d * (h >> 11 | 1)) % self.n if d >= 0 else -1 - d
        return self.ids[s] if self.keys[s] == key else -1


class Ranks(dict):
    """Ranks of byte strings as the perfect hash gives them (-1: none), remembered up to ``KNOWN`` strings."""

    KNOWN = 300_000

    def __init__(self, table: PerfectHash):
        self.get_rank = table.get

    def __missing__(self, part: bytes) -> int:
        found = self.get_rank(part)
        if len(part) <= 64:
            if len(self) >= self.KNOWN:
                self.clear()
            self[part] = found
        return found


def merge(piece: bytes, ranks: Ranks) -> list[int]:
    """The ids of a pre-token: a heap of pair ranks over linked bytes.

    A symbol is known by where it starts; ``end`` and ``prev`` link it to its
    neighbours, ``ids`` has its rank. An entry of the heap is (rank, start,
    middle, end) of a pair and is stale once either half has changed.
    """
    n = len(piece)
    rank = ranks.__getitem__
    end, prev = list(range(1, n + 1)), list(range(-1, n - 1))
    ids = [rank(piece[i : i + 1]) for i in range(n)]
    heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := rank(piece[i : i + 2])) >= 0]
    heapq.heapify(heap)
    pop, push = heapq.heappop, heapq.heappush
    while heap:
        r, i, j, k = pop(heap)
        if end[i] != j or end[j] != k:
            continue
        end[i], end[j], ids[i], ids[j] = k, 0, r, -1  # the right half is gone
        if k < n:
            prev[k] = i
            if (r := rank(piece[i : end[k]])) >= 0:
                push(heap, (r, i, k, end[k]))
        if (h := prev[i]) >= 0 and (r := rank(piece[h:k])) >= 0:
            push(heap, (r, h, i, k))
    return [x for x in ids if x >= 0]


_tables: dict[int, PerfectHash] = {}


def table_of(vocabulary: list[bytes]) -> PerfectHash:
    """The hash of a vocabulary, built once in a process; a worker keeps one."""
    name = xxhash.xxh3_64_intdigest(b"\0".join(vocabulary))
    if name not in _tables:
        _tables.clear()
        _tables[name] = PerfectHash(vocabulary)
    return _tables[name]


def latin_pattern(pattern: str) -> re.Pattern | None:
    """A pattern that finds the same as ``pattern`` in texts of Latin-1 letters only, for the standard library, which is faster.

    Classes of Unicode are written out as their members below U+0100. None if
    the pattern has anything besides the classes of letters, numbers and white
    space that could differ.
    """
    def of(kind):
        return "".join(re.escape(chr(c)) for c in range(256) if unicodedata.category(chr(c))[0] == kind)

    members = {r"\p{L}": of("L"), r"\p{N}": of("N"), r"\s": "\\t-\\r \\x85\\xa0"}
    out, inside, i = [], False, 0
    while i < len(pattern):
        found = next((m for m in (*members, r"\S") if pattern.startswith(m, i)), None)
        c = pattern[i]
        if found == r"\S":
            if inside:
                return None
            out.append("[^" + members[r"\s"] + "]")
        elif found:
            out.append(members[found] if inside else "[" + members[found] + "]")
        elif c == "\\" or pattern.startswith("(?i", i) or inside and (c == "[" or pattern[i : i + 2] in ("&&", "--", "||", "~~")):
            return None
        else:
            inside = c == "[" or inside and c != "]"
            out.append(c)
        i += len(found or c)
    return re.compile("".join(out))


class Known(dict):
    """The ids of pre-tokens, as the bytes of 32-bit integers, that are found on their first look-up."""

    def __init__(self, encoder: Encoder):
        self.encoder = encoder

    def __missing__(self, piece: str) -> bytes:
        e = self.encoder
        ids = e.piece(piece)
        if len(piece) <= e.SHORT:
            if len(self) >= e.KNOWN:
                self.clear()
            self[piece] = ids
        return ids


class Encoder:
    """Encodes texts one after the other and remembers, within bounds, what both tiers have found.

    The ids of a pre-token are kept as the bytes of 32-bit integers, so that a
    text's ids are one join of bytes.
    """

    KNOWN = 300_000
    SHORT = 64

    def __init__(self, vocabulary: list[bytes], pattern: str):
        self.find = regex.compile(pattern).findall
        latin = latin_pattern(pattern)
        self.find_latin = latin.findall if latin else self.find
        self.table = table_of(vocabulary)
        self.ranks = Ranks(self.table)
        self.known = Known(self)

    def piece(self, text: str) -> bytes:
        data = text.encode("utf-8", "surrogatepass")
        rank = self.table.get(data)
        ids = [rank] if rank >= 0 else merge(data, self.ranks)
        return struct.pack(f"={len(ids)}i", *ids)

    def pieces(self, text: str) -> list[str]:
        """The pre-tokens of a text."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.find(text)
        return self.find_latin(text)

    def packed(self, text: str) -> bytes:
        """The ids of a text as 32-bit integers."""
        return b"".join(map(self.known.__getitem__, self.pieces(text)))

    def ids(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), np.int32).tolist()


#: Texts whose results are in memory at a time.
_TEXTS = 1_000


def _few(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for b in batches:
        for lo in range(0, len(b), _TEXTS):
            yield b.slice(lo, _TEXTS)


def encode(text: Column, vocabulary: list[bytes], pattern: str) -> Column:
    """The ids of each text. The vocabulary travels with the tasks; its size is fixed."""

    @F.arrow_udf("array<int>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(vocabulary, pattern)
        for texts in _few(batches):
            ids = [encoder.packed(t.as_py() or "") for t in texts]
            offsets = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(ids), np.int32)))
        del encoder
        give_back()

    return of(whole(text))


def width_of(vocabulary: list[bytes]) -> int:
    """Bytes that an id takes."""
    return 2 if len(vocabulary) <= 1 << 16 else 4


def encode_by_library(text: Column, vocabulary: list[bytes], pattern: str) -> Column:
    """What ``encode`` gives, as bytes of ``width_of`` an id, by the tiktoken library, for callers that need ids only and have less time.

    A text on which the library's regular expressions run out of stack (a
    hundred thousand blanks, say) is left to ``Encoder``.
    """
    kind = np.uint16 if width_of(vocabulary) == 2 else np.uint32

    @F.arrow_udf("binary")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import tiktoken

        library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks={t: i for i, t in enumerate(vocabulary)}, special_tokens={})
        own: list[Encoder] = []

        def ids(t: str) -> bytes:
            try:
                return library.encode_to_numpy(t, disallowed_special=()).astype(kind).tobytes()
            except BaseException as e:
                if type(e).__name__ != "PanicException":  # the only one that is no Exception and no signal
                    raise
            if not own:
                own.append(Encoder(vocabulary, pattern))
            return np.frombuffer(own[0].packed(t), np.int32).astype(kind).tobytes()

        for texts in _few(batches):
            yield pa.array([ids(t.as_py()) for t in texts], pa.binary())
        del library
        give_back()

    return of(whole(text))


def decode(ids: Column, vocabulary: list[bytes]) -> Column:
    """The bytes of each list of ids."""

    @F.arrow_udf("binary")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        get = vocabulary.__getitem__
        for lists in _few(batches):
            flat, at = lists.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum([len(x) if x.is_valid else 0 for x in lists])])
            yield pa.array([b"".join(map(get, flat[a:b].tolist())) for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())

    return of(ids)
