"""Byte-level byte-pair encoding and decoding with two-tier lookup.

Texts are cut into pre-tokens by a pattern. A minimal perfect hash over the vocabulary resolves a
pre-token that is itself in the vocabulary; any other is encoded by a heap of candidate merges
over a linked list of its bytes, in O(n log n), so one enormous pre-token is no trouble. Nothing is
trained: ranks come from a vocabulary file, whose size bounds what is broadcast.

Null text counts as empty and gives no tokens. Rows never influence each other; the encoder's
memory of recent pre-tokens is bounded and only saves time.
"""

from __future__ import annotations

import base64
import functools
import heapq
import struct
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallybook.llm.frames import appended, once

# Pre-tokens that each of the two generations of an encoder's memory may hold, and the length
# (characters) up to which a pre-token is remembered.
REMEMBERED = 300_000
REMEMBERED_CHARS = 48
_MASK = (1 << 64) - 1


def _displaced(h: int, shift: int) -> int:
    """A hash of 32 bits for each displacement."""
    x = (h ^ (h >> 29)) + shift * 0x9E3779B97F4A7C15 & _MASK
    x = (x ^ (x >> 32)) * 0xD6E8FEB86659FD93 & _MASK
    return (x ^ (x >> 32)) * 0xD6E8FEB86659FD93 >> 32 & 0xFFFFFFFF


@dataclass(frozen=True)
class PerfectHash:
    """Minimal perfect hash by displacement: n keys on n slots, one displacement a bucket."""

    shifts: list[int]
    slots: list[tuple[bytes, int] | None]

    def get(self, key: bytes) -> int | None:
        n = len(self.slots)
        if not n:
            return None
        h = xxhash.xxh3_64_intdigest(key)
        shift = self.shifts[h % len(self.shifts)]
        slot = -shift - 1 if shift < 0 else _displaced(h, shift) % n
        held = self.slots[slot]
        return held[1] if held is not None and held[0] == key else None


def perfect_hash(ranks: dict[bytes, int]) -> PerfectHash:
    """Place buckets from the largest down; a bucket of one key names its slot outright."""
    keys = list(ranks)
    n = len(keys)
    if n == 0:
        return PerfectHash([], [])
    count = max(1, n // 2)
    hashes = [xxhash.xxh3_64_intdigest(k) for k in keys]
    buckets: list[list[int]] = [[] for _ in range(count)]
    for i, h in enumerate(hashes):
        buckets[h % count].append(i)
    taken = [False] * n
    slots: list[tuple[bytes, int] | None] = [None] * n
    shifts = [0] * count
    order = sorted(range(count), key=lambda b: -len(buckets[b]))
    for at, b in enumerate(order):
        ids = buckets[b]
        if len(ids) <= 1:
            break
        own = [hashes[i] for i in ids]
        if len(set(own)) < len(own):
            raise ValueError("two keys have the same hash")
        shift = 0
        while True:
            places = [_displaced(h, shift) % n for h in own]
            if len(set(places)) == len(places) and not any(taken[p] for p in places):
                break
            shift += 1
        shifts[b] = shift
        for i, slot in zip(ids, places, strict=True):
            taken[slot] = True
            slots[slot] = (keys[i], ranks[keys[i]])
    else:
        at = count
    rest = iter(i for i, t in enumerate(taken) if not t)
    for b in order[at:]:
        for i in buckets[b]:
            slot = next(rest)
            shifts[b] = -slot - 1
            slots[slot] = (keys[i], ranks[keys[i]])
    return PerfectHash(shifts, slots)


@dataclass(frozen=True)
class Vocabulary:
    """Ranks of a vocabulary file, its perfect hash, and the pattern of pre-tokens."""

    ranks: dict[bytes, int]
    table: PerfectHash
    pattern: str


@functools.lru_cache(maxsize=4)
def read_vocabulary(path: str, pattern: str) -> Vocabulary:
    """Lines of base64 bytes and a rank."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
    return Vocabulary(ranks, perfect_hash(ranks), pattern)


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merge the pair of lowest rank, the leftmost first, until no pair has a rank."""
    n = len(piece)
    if n == 1:
        return [ranks[piece]]
    parts: list[bytes | None] = [piece[i:i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        rank = ranks.get(piece[i:i + 2])
        if rank is not None:
            heap.append((rank, i, 2))
    heapq.heapify(heap)
    push, pop, get = heapq.heappush, heapq.heappop, ranks.get
    while heap:
        _, i, size = pop(heap)
        left = parts[i]
        if left is None:
            continue
        j = after[i]
        if j >= n:
            continue
        right = parts[j]
        if len(left) + len(right) != size:
            continue  # one of the two has grown since
        merged = left + right
        parts[i], parts[j] = merged, None
        j = after[i] = after[j]
        if j < n:
            before[j] = i
            rank = get(merged + parts[j])
            if rank is not None:
                push(heap, (rank, i, size + len(parts[j])))
        k = before[i]
        if k >= 0:
            rank = get(parts[k] + merged)
            if rank is not None:
                push(heap, (rank, k, size + len(parts[k])))
    return [ranks[p] for p in parts if p is not None]


class _Memory(dict):
    """Pre-token to packed ids; a missing one is resolved. Two generations bound its size."""

    def __init__(self, vocabulary: Vocabulary):
        self.old: dict[str, bytes] = {}
        self.ranks, self.table = vocabulary.ranks, vocabulary.table

    def __missing__(self, piece: str) -> bytes:
        packed = self.old.get(piece)
        if packed is None:
            raw = piece.encode()
            rank = self.table.get(raw)
            ids = [rank] if rank is not None else merge_bytes(raw, self.ranks)
            packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= REMEMBERED_CHARS:
            if len(self) >= REMEMBERED:
                self.old = dict(self)
                self.clear()
            self[piece] = packed
        return packed


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.cut = regex.compile(vocabulary.pattern).findall
        self.memory = _Memory(vocabulary)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.memory.__getitem__, self.cut(text)))


def encode(df: DataFrame, vocabulary: Vocabulary, text: str = "text",
           output: str = "token_ids", count: str = "n_tokens") -> DataFrame:
    """Add the ids of each whole text, packed as little-endian 32-bit integers, and their number."""
    shared, name = df.sparkSession.sparkContext.broadcast(vocabulary), uuid.uuid4().hex

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        one = once(name, lambda: Encoder(shared.value)).encode
        packed = [one(x) if x else b"" for x in batch.column(text).to_pylist()]
        return [pa.array(packed, pa.binary()),
                pa.array([len(p) // 4 for p in packed], pa.int64())]

    return appended(df, [T.StructField(output, T.BinaryType()), T.StructField(count, T.LongType())],
                    compute, name)


def _by_rank(ranks: dict[bytes, int]) -> list[bytes | None]:
    pieces: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece
    return pieces


def _decoded(pieces: list[bytes | None], ids: bytes | None) -> bytes:
    return b"".join(map(pieces.__getitem__, np.frombuffer(ids or b"", "<u4").tolist()))


def round_trip(df: DataFrame, vocabulary: Vocabulary, text: str = "text",
               output: str = "token_ids", count: str = "n_tokens", decoded: str = "decoded"
               ) -> DataFrame:
    """What ``encode`` and then ``decode`` add, by one worker process a task instead of two."""
    shared, name = df.sparkSession.sparkContext.broadcast(vocabulary), uuid.uuid4().hex

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        encoder, pieces = once(name, lambda: (Encoder(shared.value), _by_rank(shared.value.ranks)))
        packed = [encoder.encode(x) if x else b"" for x in batch.column(text).to_pylist()]
        return [pa.array(packed, pa.binary()),
                pa.array([len(p) // 4 for p in packed], pa.int64()),
                pa.array([_decoded(pieces, p) for p in packed], pa.binary())]

    return appended(df, [T.StructField(output, T.BinaryType()), T.StructField(count, T.LongType()),
                         T.StructField(decoded, T.BinaryType())], compute, name)


def decode(df: DataFrame, vocabulary: Vocabulary, ids: str = "token_ids",
           output: str = "decoded") -> DataFrame:
    """Add the bytes that packed ids stand for. Ids outside the vocabulary raise an error."""
    shared = df.sparkSession.sparkContext.broadcast(_by_rank(vocabulary.ranks))

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        pieces = shared.value
        return [pa.array([_decoded(pieces, v) for v in batch.column(ids).to_pylist()],
                         pa.binary())]

    return appended(df, [T.StructField(output, T.BinaryType())], compute)
