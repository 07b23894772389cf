"""Reproducible shuffle into shards: a Feistel permutation of global row numbers.

Rows are numbered 0 to n - 1 in a given order. A keyed Feistel network permutes the numbers below
the next power of four; a number that lands at n or beyond is encrypted again until it lands below n
(cycle walking), which makes it a permutation of 0 to n - 1. The row at place p goes to shard
p mod k, slot p div k: shards differ by one row at most, slots have no gaps, and where a row is can
be computed from its number, and its number from where it is, without any table.

Numbers come from a range exchange: pieces are sorted, and each adds the rows of earlier pieces, of
which there is one number a piece. Rows of equal order are ordered by a hash of all their columns;
rows that are equal in every column are interchangeable, and are spread by a salt, so that a row
that makes up a third of the table is in no single task.

Null order columns come first, null texts are like any other value, an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.llm.frames import appended, prepare, stored, without

U64 = np.uint64
ROUNDS = 8
_LOW = (1 << 64) - 1


def round_keys(seed: int) -> list[int]:
    """A 32-bit key for each round, from one seed."""
    keys = []
    for k in range(1, ROUNDS + 1):
        x = (seed + k * 0x9E3779B97F4A7C15) & _LOW
        x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & _LOW
        x = ((x ^ x >> 27) * 0x94D049BB133111EB) & _LOW
        keys.append((x ^ x >> 31) & 0xFFFFFFFF)
    return keys


def half_bits(n: int) -> int:
    """Bits of either half: the least h, at least 1, with 4^h >= n."""
    return max(1, ((max(n, 1) - 1).bit_length() + 1) // 2)


def _scrambled(half: np.ndarray, key: int) -> np.ndarray:
    """The round function: 32 bits mixed by two multiplications."""
    low = U64(0xFFFFFFFF)
    x = (half + U64(key)) & low
    x = ((x ^ (x >> U64(16))) * U64(0x85EBCA6B)) & low
    x = ((x ^ (x >> U64(13))) * U64(0xC2B2AE35)) & low
    return x ^ (x >> U64(16))


def _once(x: np.ndarray, bits: int, keys: list[int], back: bool) -> np.ndarray:
    mask, shift = U64((1 << bits) - 1), U64(bits)
    left, right = x >> shift, x & mask
    for key in reversed(keys) if back else keys:
        if back:
            left, right = right ^ (_scrambled(left, key) & mask), left
        else:
            left, right = right, left ^ (_scrambled(right, key) & mask)
    return (left << shift) | right


def permuted(numbers: np.ndarray, n: int, seed: int, back: bool = False) -> np.ndarray:
    """Places of row numbers 0 to n - 1, or with ``back`` the row numbers of places. n is at most
    2^64; a number of n or more has no place and raises ValueError."""
    x = np.asarray(numbers).astype(U64)
    if len(x) and int(x.max()) >= n:
        raise ValueError(f"numbers must be below {n}")
    bits, keys = half_bits(n), round_keys(seed)
    x = _once(x, bits, keys, back)
    out = np.flatnonzero(x >= U64(n)) if n <= _LOW else np.empty(0, np.int64)
    while len(out):
        x[out] = _once(x[out], bits, keys, back)
        out = out[x[out] >= U64(n)]
    return x


def locate(number: int, n: int, shards: int, seed: int) -> tuple[int, int]:
    """Shard and slot of one row number."""
    place = int(permuted(np.array([number], U64), n, seed)[0])
    return place % shards, place // shards


def number_at(shard: int, slot: int, n: int, shards: int, seed: int) -> int:
    """The row number that ``locate`` puts there."""
    return int(permuted(np.array([slot * shards + shard], U64), n, seed, back=True)[0])


def numbered(df: DataFrame, order: list[str], name: str = "row_number") -> tuple[DataFrame, int]:
    """Every row with its number in the order, from 0, and the number of rows. The rows are written
    twice to the shared folder: before they are dealt, so that a lost task deals them alike, and
    after."""
    prepare(df.sparkSession)
    df = without(df, [name, "_tie", "_salt", "_at", "_piece", "_base"])
    columns = [df[f"`{c}`"] for c in df.columns]
    rows = stored(df.withColumn("_tie", F.xxhash64(*columns)), "rows-to-number")
    salted = rows.withColumn("_salt", F.xxhash64(F.monotonically_increasing_id()))
    keys = [F.col(f"`{c}`").asc_nulls_first() for c in [*order, "_tie", "_salt"]]
    # In a sorted piece the id has the piece above 33 bits of the place in it.
    pieces = stored(salted.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(
        "_at", F.monotonically_increasing_id()).withColumn(
        "_piece", F.shiftright("_at", 33)).drop("_tie", "_salt"), "numbered-pieces")
    counts = sorted((r["_piece"], r["n"]) for r in pieces.groupBy("_piece").agg(
        F.count("*").alias("n")).collect())
    bases, n = [], 0
    for piece, rows_of_piece in counts:
        bases.append((piece, n - (piece << 33)))
        n += rows_of_piece
    base = df.sparkSession.createDataFrame(bases, "_piece long, _base long")
    return pieces.join(F.broadcast(base), "_piece").withColumn(
        name, F.col("_at") + F.col("_base")).drop("_piece", "_at", "_base"), n


def shuffled(df: DataFrame, order: list[str], shards: int, seed: int) -> DataFrame:
    """Every row with row_number, shard (int) and slot (long); columns of these names are replaced.

    The same rows, order, shard count and seed give the same result, however they are stored."""
    df, n = numbered(without(df, ["row_number", "shard", "slot"]), order)
    at = df.columns.index("row_number")

    def place(batch: pa.RecordBatch) -> list[pa.Array]:
        places = permuted(batch.column(at).to_numpy(zero_copy_only=False), n, seed)
        return [pa.array((places % U64(shards)).astype(np.int32)),
                pa.array((places // U64(shards)).astype(np.int64))]

    return appended(df, [T.StructField("shard", T.IntegerType()),
                         T.StructField("slot", T.LongType())], place)
