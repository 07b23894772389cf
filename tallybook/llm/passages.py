"""Substring dedup by repeated-phrase automata.

A window is ``size`` consecutive words. Each word of a later document that lies in a window which
also starts in a document of smaller id is removed; windows are judged on the input.

1. *Phrases.* From every run of ``size`` words at least one phrase, half as long, is selected by
   its hash alone (winnowing: the least of each stretch), so copies select the same ones. Blocks ask
   which of their phrases occur in several documents; counts are summed by phrase.
2. *Automata.* A block is told which of its phrases recur and compiles these into an Aho-Corasick
   automaton over word symbols, which streams over the documents of that block and locates every
   occurrence. Hashing has located what matters by then: every repeated window holds a phrase that
   was selected in it, so the automaton adds no window to those around the selected places.
3. *Windows.* Windows around located phrases are asked about by hash; a window's smallest document
   is the answer. A window's words lead to one phrase at least, so no repeated window is missed.
4. Words under a window that started in a smaller document go.

Every exchange holds one entry per distinct key and block, so a passage found in a third of all
documents costs no more in any task than another. Windows are compared by 64-bit hashes of their
words; two different ones among n candidates agree with a probability of about n^2 / 2^65.

Null text has no words; so has a text of blanks. Rows of the same id are one document to each other,
so they remove nothing from one another. Rows without an id count as the largest.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallybook.llm import words
from tallybook.llm.frames import (answered, bucket_slices, buckets_for, more_asks, pack, to_blocks,
                                  with_answers, without)

U64 = np.uint64
BLOCK_BYTES = 4 << 20
WINDOW = 50
_LAST = np.iinfo(np.int64).max


def _least_in(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def _greatest_in(values: np.ndarray, width: int) -> np.ndarray:
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.maximum(out[:-step], out[step:])
        have += step
    return out


def _phrase_words(size: int) -> int:
    return size // 2 + 1


def _phrases(found: words.Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the selected phrases: the least of any window that holds them."""
    starts = words.inside_text(found, size)
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, U64)
    phrase = _phrase_words(size)
    width = size - phrase + 1
    hashes = words.windows(found.hashes, phrase)
    least = np.zeros(len(hashes) + width - 1, U64)
    least[starts + width - 1] = _least_in(hashes, width)[starts]
    at = np.flatnonzero(_greatest_in(least, width) == hashes)
    return at, hashes[at]


def _ids(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(_LAST).to_numpy(zero_copy_only=False)


def _span(keys: np.ndarray, low: np.ndarray, high: np.ndarray
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, their least and greatest id, and the order that sorts the input."""
    order = np.argsort(keys, kind="stable")
    starts = words.distinct(keys[order])
    if not len(starts):
        return keys, low, high, order
    return (keys[order][starts], np.minimum.reduceat(low[order], starts),
            np.maximum.reduceat(high[order], starts), order)


def _asks(kind: str, keys: list[np.ndarray], ids: list[np.ndarray], n_buckets: int
          ) -> Iterator[tuple[str, int, bytes]]:
    """What a block asks: distinct keys with the least and greatest document that has them."""
    if not keys:
        return
    every, of = np.concatenate(keys), np.concatenate(ids)
    key, low, high, _ = _span(every, of, of)
    for bucket, part in bucket_slices(key, n_buckets):
        yield kind, bucket, pack(key[part], low[part], high[part] - low[part])


def _asked(batch: pa.RecordBatch, text: str, doc_id: str, size: int
           ) -> tuple[list[np.ndarray], list[np.ndarray]]:
    ids = _ids(batch.column(batch.schema.get_field_index(doc_id)))
    keys, owners = [], []
    for i, _, data, offsets in words.sliced(batch.column(batch.schema.get_field_index(text))):
        found = words.tokenize(data, offsets, words.PLAIN)
        at, hashes = _phrases(found, size)
        keys.append(hashes)
        owners.append(ids[i + found.text_of()[at]])
    return keys, owners


def _recurring(asks: list[list[np.ndarray]]) -> list[bytes]:
    """For each block's phrases of a bucket, whether several documents have them."""
    keys, low, more = (np.concatenate([a[k] for a in asks]) for k in range(3))
    key, least, most, order = _span(keys, low, low + more)
    flags = np.empty(len(keys), bool)
    counts = np.diff(np.append(words.distinct(keys[order]), len(keys)))
    flags[order] = np.repeat(least < most, counts)
    cuts = np.cumsum([len(a[0]) for a in asks])[:-1]
    return [pack(np.packbits(f)) for f in np.split(flags, cuts)]


def _earlier(asks: list[list[np.ndarray]]) -> list[bytes]:
    """For each block's windows of a bucket, those that start in a smaller document than one of
    its own, with the smallest."""
    keys, low, more = (np.concatenate([a[k] for a in asks]) for k in range(3))
    key, least, _, _ = _span(keys, low, low + more)
    out = []
    for own, first, span in asks:
        before = least[words.lookup(key, own)]
        some = before < first + span
        out.append(pack(own[some], before[some]))
    return out


def _characters(hashes: np.ndarray) -> str:
    """One character a word, of 6 bits of its hash: the automaton finds the next state among a
    node's children one by one, so they should be few. A phrase has over 150 bits that way, and
    one found by mistake only asks more."""
    return (hashes & U64(63)).astype(np.uint8).tobytes().decode("latin-1")


def _windows(batch: pa.RecordBatch, told: dict[int, list[np.ndarray]], text: str, doc_id: str,
             size: int, n_buckets: int) -> Iterator[tuple[str, int, bytes]]:
    """Locate the block's recurring phrases by an automaton and ask about the windows around."""
    keys, _ = _asked(batch, text, doc_id, size)
    every = np.sort(np.concatenate(keys)) if keys else np.empty(0, U64)
    every = every[words.distinct(every)]
    recurs = np.zeros(len(every), bool)
    for bucket, part in bucket_slices(every, n_buckets):
        if bucket in told:
            recurs[part] = np.unpackbits(told[bucket][0])[:part.stop - part.start]
    wanted = every[recurs]
    if not len(wanted):
        return
    ids = _ids(batch.column(batch.schema.get_field_index(doc_id)))
    phrase = _phrase_words(size)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    slices = [(i, words.tokenize(data, offsets, words.PLAIN)) for i, _, data, offsets in
              words.sliced(batch.column(batch.schema.get_field_index(text)))]
    symbols = [_characters(found.hashes) for _, found in slices]
    added = np.zeros(len(wanted), bool)
    for (_, found), symbol in zip(slices, symbols, strict=True):
        at, hashes = _phrases(found, size)
        place = words.lookup(wanted, hashes)
        for p, k in zip(at[place >= 0].tolist(), place[place >= 0].tolist(), strict=True):
            if not added[k]:
                added[k] = True
                automaton.add_word(symbol[p:p + phrase])
    automaton.make_automaton()
    keys, owners = [], []
    for (i, found), symbol in zip(slices, symbols, strict=True):
        starts = words.inside_text(found, size)
        if not len(starts):
            continue
        near = np.zeros(len(found.starts) + 1, np.int64)
        ends = np.fromiter((end for end, _ in automaton.iter(symbol)), np.int64)
        # A window holds the phrase if it starts up to size - phrase words before it.
        np.add.at(near, np.maximum(ends + 1 - size, 0), 1)
        np.add.at(near, ends + 2 - phrase, -1)
        around = starts[np.cumsum(near)[starts] > 0]
        keys.append(words.windows(found.hashes, size)[around])
        owners.append(ids[i + found.text_of()[around]])
    yield from _asks("window", keys, owners, n_buckets)


def _cut(batch: pa.RecordBatch, told: dict[int, list[np.ndarray]], text: str, doc_id: str,
         size: int) -> pa.Table:
    """Mark the words under repeated windows, and give what is left."""
    held = [told[b] for b in sorted(told)]
    key = np.concatenate([np.empty(0, U64), *[h[0] for h in held]])
    before = np.concatenate([np.empty(0, np.int64), *[h[1] for h in held]])
    column = batch.column(batch.schema.get_field_index(text))
    ids = _ids(batch.column(batch.schema.get_field_index(doc_id)))
    n_words, n_removed, spans, kept = [], [], [], []
    for i, j, data, offsets in words.sliced(column):
        if not len(key):
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                found = data[a:b].tobytes().split()
                n_words.append(len(found))
                n_removed.append(0)
                spans.append([])
                kept.append(b" ".join(found).decode())
            continue
        found = words.tokenize(data, offsets, words.PLAIN)
        starts = words.inside_text(found, size)
        place = words.lookup(key, words.windows(found.hashes, size)[starts])
        own = ids[i + found.text_of()[starts]]
        gone = starts[(place >= 0) & (before[place] < own)]
        cover = np.zeros(len(found.starts) + 1, np.int64)
        np.add.at(cover, gone, 1)
        np.add.at(cover, gone + size, -1)
        removed = np.cumsum(cover[:-1]) > 0
        for k in range(j - i):
            a, b = int(found.first[k]), int(found.first[k + 1])
            mask = removed[a:b]
            raw = data[offsets[k]:offsets[k + 1]].tobytes().split()
            n_words.append(b - a)
            n_removed.append(int(mask.sum()))
            if n_removed[-1]:
                edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
                spans.append([{"start": int(x), "end": int(y)}
                              for x, y in zip(edge[::2], edge[1::2], strict=True)])
                raw = [w for w, m in zip(raw, mask.tolist(), strict=True) if not m]
            else:
                spans.append([])
            kept.append(b" ".join(raw).decode())
    pair = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    table = pa.Table.from_batches([batch])
    for name, values, kind in (("n_words", n_words, pa.int64()),
                               ("n_removed", n_removed, pa.int64()),
                               ("removed", spans, pair), ("kept_text", kept, pa.string())):
        table = table.append_column(name, pa.array(values, kind))
    return table


FIELDS = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
          T.StructField("removed", T.ArrayType(T.StructType([
              T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
          T.StructField("kept_text", T.StringType())]


def remove_repeats(df: DataFrame, text: str = "text", doc_id: str = "doc_id",
                   size: int = WINDOW) -> DataFrame:
    """Add n_words, n_removed, removed (word spans) and kept_text (kept words, joined by a blank);
    input columns of these names are replaced."""
    df = without(df, [f.name for f in FIELDS])
    n_buckets = buckets_for(df)
    schema = T.StructType([*df.schema.fields, *FIELDS])

    def ask(batch: pa.RecordBatch) -> Iterable[tuple[str, int, bytes]]:
        keys, owners = _asked(batch, text, doc_id, size)
        return _asks("phrase", keys, owners, n_buckets)

    table = to_blocks(df, ask, "passages", BLOCK_BYTES)
    phrases = answered(table, "phrase", _recurring)
    asked = more_asks(table, phrases, lambda rows, told: _windows(
        rows, told, text, doc_id, size, n_buckets))
    windows = answered(asked, "window", _earlier)
    return with_answers(table, windows, schema, lambda _, rows, told: _cut(
        rows, told, text, doc_id, size))
