"""Words and n-grams of many texts at once, as numpy arrays over an Arrow batch's own bytes.

A text column arrives as one byte buffer and offsets. Words are found by a 256-entry byte table,
so no Python string is made per word. Hashes are polynomials modulo 2**64 over random byte values,
taken from running sums and mixed at the end; they depend on the words alone, not on the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
# Texts are taken in slices of about this many bytes (one text at least), which bounds the
# memory of all temporary arrays.
SLICE_BYTES = 1 << 19

_STEP = U64(0x9E3779B97F4A7C15)
_BASE_BYTES = U64(0x2545F4914F6CDD1D)
_BASE_WORDS = U64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit value over all bits."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _inverse(odd: int) -> U64:
    return U64(pow(odd, -1, 1 << 64))


class _Powers:
    """Powers of an odd number and of its inverse, modulo 2**64, grown on demand."""

    def __init__(self, base: U64):
        self.base, self.back = base, _inverse(int(base))
        self.up = self.down = np.ones(1, U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            steps = np.full(size, self.base, U64)
            steps[0] = 1
            self.up = np.cumprod(steps, dtype=U64)
            steps = np.full(size, self.back, U64)
            steps[0] = 1
            self.down = np.cumprod(steps, dtype=U64)
        return self.up[:n], self.down[:n]

    def forget(self) -> None:
        self.up = self.down = np.ones(1, U64)


_BYTE_POWERS, _WORD_POWERS = _Powers(_BASE_BYTES), _Powers(_BASE_WORDS)


def forget() -> None:
    """Let go of the powers; they are made again when they are needed."""
    _BYTE_POWERS.forget()
    _WORD_POWERS.forget()


@dataclass(frozen=True)
class Alphabet:
    """Which bytes belong to words, and the byte each counts as."""

    inside: np.ndarray
    folded: np.ndarray

    @property
    def values(self) -> np.ndarray:
        return mix((self.folded.astype(U64) + U64(1)) * _STEP)


def _alphabet(separators: set[int], fold: bool) -> Alphabet:
    inside = np.array([b not in separators for b in range(256)])
    folded = np.arange(256, dtype=np.uint8)
    if fold:
        folded[65:91] += 32
    return Alphabet(inside, folded)


# The byte classes that separate words.
BLANKS = {0x20, *range(0x09, 0x0E)}
PLAIN = _alphabet(BLANKS, fold=False)
FOLDED = _alphabet(BLANKS, fold=True)
ALNUM = _alphabet({*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)},
                  fold=True)


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    kind = np.int64 if str(column.type).startswith("large") else np.int32
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data if data is not None else b"", np.uint8)
    return data[offsets[0]:offsets[-1]], offsets.astype(np.int64) - int(offsets[0])


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES, most: int = 1 << 30
           ) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes each and ``most`` rows at most, one row at least."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        stop = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        stop = min(max(stop, row + 1), row + most, rows)
        yield row, stop
        row = stop


def sliced(column: pa.Array, limit: int = SLICE_BYTES, most: int = 1 << 30
           ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of each slice of a column."""
    data, offsets = texts(column)
    for i, j in slices(offsets, limit, most):
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]


@dataclass(frozen=True)
class Words:
    """Words of some texts: byte spans, hashes, and the first word of every text (and the end)."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def spans(data: np.ndarray, offsets: np.ndarray, alphabet: Alphabet
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte spans of all words, and the index of each text's first word."""
    n = len(data)
    padded = np.zeros(n + 2, bool)
    padded[1:n + 1] = alphabet.inside[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before, after = padded[:n + 1], padded[1:]
    starts = np.flatnonzero(after & (~before | edge))
    ends = np.flatnonzero(before & (~after | edge))
    return starts, ends, np.searchsorted(starts, offsets)


def tokenize(data: np.ndarray, offsets: np.ndarray, alphabet: Alphabet) -> Words:
    starts, ends, first = spans(data, offsets, alphabet)
    n = len(data)
    up, down = _BYTE_POWERS.upto(n + 1)
    sums = np.zeros(n + 1, U64)
    np.cumsum(alphabet.values[data] * up[:n], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * down[starts]
    return Words(starts, ends, first, mix(hashes + (ends - starts).astype(U64) * _STEP))


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive words; the last n - 1 positions have none."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.empty(0, U64)
    up, down = _WORD_POWERS.upto(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, U64)
    np.cumsum(hashes * up[:-1], out=sums[1:])
    return mix((sums[n:] - sums[:count]) * down[:count] + U64(n * int(_STEP) & (1 << 64) - 1))


def whole(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hash of each text's whole word sequence, whatever its length."""
    up, down = _WORD_POWERS.upto(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, U64)
    np.cumsum(hashes * up[:-1], out=sums[1:])
    length = np.diff(first).astype(U64)
    return mix((sums[first[1:]] - sums[first[:-1]]) * down[first[:-1]] + length * _STEP)


def inside_text(words: Words, n: int) -> np.ndarray:
    """Word positions at which n words of one text begin."""
    ends = np.repeat(words.first[1:], words.counts)
    return np.flatnonzero(np.arange(len(words.starts)) + n <= ends)


def distinct(sorted_values: np.ndarray) -> np.ndarray:
    """Positions in a sorted array at which a new value begins."""
    if len(sorted_values) == 0:
        return np.empty(0, np.int64)
    return np.concatenate(([0], np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1))


def counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and how often each occurs."""
    values = np.sort(values)
    at = distinct(values)
    return values[at], np.diff(np.append(at, len(values)))


def lookup(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Index of each wanted value in sorted keys, or -1."""
    if len(keys) == 0:
        return np.full(len(wanted), -1, np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)
