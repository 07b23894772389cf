"""Language-model scoring by a probabilistic suffix tree.

Texts become symbols: the bytes of their lower-case words, a blank after each word but the last, and
an end. A state of the tree is a context, the last 0 to ``DEPTH`` symbols. A longer context is kept
if it is frequent enough and its next symbols diverge from those of the context one symbol shorter
(count times Kullback-Leibler divergence), or if a kept one extends it. A symbol is scored by the
longest context that is a state: its share there, smoothed by the next shorter context's, in the
proportion of how many different symbols have followed; the empty context's by all bytes alike.

Learning counts every context of every training text, and a context needs the same count and the
same divergence to be kept however large the corpus is, so the tree grows with it and is nowhere
whole. Blocks ask about their distinct codes; buckets by code add up; buckets by the last ``_DEALT``
symbols get each code once, grow their part of the tree and score the codes. The values go back
the same way. Only the contexts of up to ``_ROOT`` symbols, which are few, are known to all.

Beside the model's score, each text gets a smoothed unigram score of its words. Word counts come
back to the blocks that hold the words, so the vocabulary is never in one place.

Null text is empty and has one token, its end. With nothing to learn from, every symbol has
probability 1/256. Repeated rows count and are scored as often as they occur.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.llm import words
from tallybook.llm.frames import (BLOCKS, bucket_slices, buckets_for, freed, once, pack, release,
                                  release_part, stored, to_blocks, unpack, with_answers, without,
                                  written)

U64 = np.uint64
DEPTH = 6
LEAST_COUNT = 16
DIVERGENCE = 12.0
BLOCK_BYTES = 8 << 20
# Entries that are gathered before they are added up.
GATHERED = 1 << 20
_BLANK, _END = 32, 10
# Contexts of this depth are always states; those of the other decide the bucket that grows them.
_ROOT, _DEALT = 2, 3
_ROOT_BUCKETS = 16
_MEMORY_BITS = 21


# -- symbols -------------------------------------------------------------------------------

@dataclass(frozen=True)
class Symbols:
    """Contexts and next symbols of some texts: codes, and the first code of each text."""

    codes: np.ndarray
    first: np.ndarray


def symbols(data: np.ndarray, offsets: np.ndarray, found: words.Words) -> Symbols:
    """A code holds the last ``DEPTH`` symbols, the latest first, and the next one."""
    n, sizes = len(offsets) - 1, found.ends - found.starts
    lengths = np.zeros(n, np.int64)
    owner = found.text_of()
    np.add.at(lengths, owner, sizes)
    lengths += np.maximum(found.counts, 1)
    # Every text is preceded by ends, so no context reaches into another text.
    starts = np.cumsum(lengths + DEPTH) - lengths
    stream = np.full(int((lengths + DEPTH).sum()), _END, np.uint8)
    begins = np.cumsum(sizes + 1) - (sizes + 1)
    if len(owner):
        within = begins - begins[np.minimum(found.first[:-1], len(begins) - 1)][owner]
        begins = starts[owner] + within
        at = np.repeat(begins - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        source = np.repeat(found.starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(
            int(sizes.sum()))
        stream[at] = words.FOLDED.folded[data[source]]
        inner = np.ones(len(owner), bool)
        inner[found.first[1:][found.counts > 0] - 1] = False
        stream[(begins + sizes)[inner]] = _BLANK
    codes = np.zeros(len(stream), U64)
    wide = stream.astype(U64)
    codes |= wide
    for back in range(1, DEPTH + 1):
        codes[back:] |= wide[:-back] << U64(8 * (DEPTH + 1 - back))
    own = np.ones(len(stream), bool)
    pads = (starts[:, None] - 1 - np.arange(DEPTH)[None, :]).ravel()
    own[pads] = False
    return Symbols(codes[own], np.concatenate(([0], np.cumsum(lengths))))


def _shorter(pairs: np.ndarray) -> np.ndarray:
    """(context, next) with the oldest symbol of the context left out."""
    return ((pairs >> U64(16)) << U64(8)) | (pairs & U64(255))


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    starts = words.distinct(keys[order])
    if not len(starts):
        return keys, counts
    return keys[order][starts], np.add.reduceat(counts[order], starts)


class _Sums:
    """Counts by key, added up as they come: what is held at a time is the distinct keys so far and
    ``GATHERED`` entries, or as many again as there are keys."""

    def __init__(self):
        self.keys, self.counts = np.empty(0, U64), np.empty(0, np.int64)
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((keys, counts))
        self.waiting += len(keys)
        if self.waiting > max(GATHERED, len(self.keys)):
            self.total()

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        parts, self.parts, self.waiting = [(self.keys, self.counts), *self.parts], [], 0
        self.keys = self.counts = None
        keys, counts = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
        del parts
        self.keys, self.counts = _summed(keys, counts)
        return self.keys, self.counts


# -- the tree ------------------------------------------------------------------------------

@dataclass(frozen=True)
class Level:
    """States of one depth: contexts, mass that escapes to the shorter context, all mass; listed
    next symbols and their counts."""

    contexts: np.ndarray
    escape: np.ndarray
    mass: np.ndarray
    pairs: np.ndarray
    counts: np.ndarray


def _level(pairs: np.ndarray, counts: np.ndarray, keep: np.ndarray | None, least: float) -> Level:
    contexts = pairs >> U64(8)
    starts = words.distinct(contexts)
    if not len(starts):
        none = np.empty(0)
        return Level(pairs, none, none, pairs, counts)
    sizes = np.diff(np.append(starts, len(pairs)))
    keep = np.ones(len(starts), bool) if keep is None else keep
    listed = (counts >= least) & np.repeat(keep, sizes)
    total = np.add.reduceat(counts, starts)
    known = np.add.reduceat(np.where(listed, counts, 0), starts)
    kinds = np.add.reduceat(listed.astype(np.int64), starts)
    escape = (total - known + np.maximum(kinds, 1)).astype(float)
    return Level(contexts[starts][keep], escape[keep], (known + escape)[keep],
                 pairs[listed], counts[listed])


def grown(pairs: np.ndarray, counts: np.ndarray, least: float,
          roots: tuple[np.ndarray, np.ndarray] | None = None) -> list[Level]:
    """States of depth ``_ROOT`` and more, from full contexts of one bucket; ``roots`` has (context,
    next) of depth ``_ROOT`` with their counts in all buckets, unless they are in this one."""
    by_depth = {DEPTH: (pairs, counts)}
    for depth in range(DEPTH - 1, _ROOT - 1, -1):
        pairs, counts = _summed(_shorter(pairs), counts)
        by_depth[depth] = (pairs, counts)
    if roots is not None:
        by_depth[_ROOT] = roots
    kept: dict[int, np.ndarray | None] = {_ROOT: None}
    wanted = np.empty(0, U64)
    for depth in range(DEPTH, _ROOT, -1):
        pairs, counts = by_depth[depth]
        contexts = pairs >> U64(8)
        starts = words.distinct(contexts)
        sizes = np.diff(np.append(starts, len(pairs)))
        total = np.add.reduceat(counts, starts)
        up, up_counts = by_depth[depth - 1]
        up_starts = words.distinct(up >> U64(8))
        up_total = np.add.reduceat(up_counts, up_starts)
        parent = up_counts[words.lookup(up, _shorter(pairs))]
        parent_total = up_total[words.lookup((up >> U64(8))[up_starts], contexts[starts] >> U64(8))]
        gain = counts * (np.log(counts) - np.log(np.repeat(total, sizes)) - np.log(parent)
                         + np.log(np.repeat(parent_total, sizes)))
        keep = (total >= least) & (np.add.reduceat(gain, starts) >= DIVERGENCE)
        keep |= words.lookup(wanted, contexts[starts]) >= 0
        kept[depth] = keep
        wanted = contexts[starts][keep] >> U64(8)
        wanted = wanted[words.distinct(wanted)]
    return [_level(*by_depth[d], kept[d], 0 if d == _ROOT else least / 16)
            for d in range(_ROOT, DEPTH + 1)]


@dataclass(frozen=True)
class Tree:
    levels: list[Level]

    def log10(self, codes: np.ndarray) -> np.ndarray:
        """log10 probability of each code's symbol in the longest context that is a state. States
        are found from the root up, as each one's smoothing takes the one before."""
        out = np.full(len(codes), 1 / 256)
        left = np.arange(len(codes))
        for depth, level in enumerate(self.levels):
            context = codes[left] >> U64(8 * (DEPTH + 1 - depth))
            at = words.lookup(level.contexts, context)
            hit = at >= 0
            left, at = left[hit], at[hit]
            pair = (context[hit] << U64(8)) | (codes[left] & U64(255))
            place = words.lookup(level.pairs, pair)
            count = np.zeros(len(left))
            count[place >= 0] = level.counts[place[place >= 0]]
            out[left] = (count + level.escape[at] * out[left]) / level.mass[at]
        return np.log10(out)


@dataclass(frozen=True)
class Told:
    """What the tree says of a block's codes, in order."""

    codes: np.ndarray
    values: np.ndarray

    def log10(self, codes: np.ndarray) -> np.ndarray:
        return self.values[words.lookup(self.codes, codes)]


class Scorer:
    """The tree with a memory of recent codes, of fixed size."""

    def __init__(self, tree: Tree | Told | None):
        self.tree = tree
        self.codes = np.full(1 << _MEMORY_BITS, ~U64(0), U64)
        self.values = np.zeros(1 << _MEMORY_BITS)

    def score(self, found: Symbols) -> np.ndarray:
        place = ((found.codes * U64(0x9E3779B97F4A7C15)) >> U64(64 - _MEMORY_BITS)).astype(np.int64)
        missed = np.flatnonzero(self.codes[place] != found.codes)
        value = self.values[place]
        if len(missed):
            wanted = np.sort(found.codes[missed])
            wanted = wanted[words.distinct(wanted)]
            known = self.tree.log10(wanted)
            value[missed] = known[words.lookup(wanted, found.codes[missed])]
            at = place[missed]
            self.codes[at] = found.codes[missed]
            # Of codes with one place, the last stays; its own value must stay with it.
            self.values[at] = value[missed]
        sums = np.concatenate(([0.0], np.cumsum(value)))
        return sums[found.first[1:]] - sums[found.first[:-1]]


# -- learning ------------------------------------------------------------------------------

def _asks(batch: pa.RecordBatch, text: str, learn: str, n_buckets: int
          ) -> Iterator[tuple[str, int, bytes]]:
    """A block's words and contexts with their training counts."""
    column = batch.column(batch.schema.get_field_index(text))
    learns = np.asarray(batch.column(batch.schema.get_field_index(learn)).fill_null(False))
    by_word, by_code, ends = _Sums(), _Sums(), 0
    for i, j, data, offsets in words.sliced(column):
        found = words.tokenize(data, offsets, words.FOLDED)
        some = learns[i:j]
        training = some[found.text_of()]
        by_word.add(*words.counted(found.hashes[training]))
        other, _ = words.counted(found.hashes[~training])
        by_word.add(other, np.zeros(len(other), np.int64))
        codes = symbols(data, offsets, found)
        used = np.repeat(some, np.diff(codes.first))
        by_code.add(*words.counted(codes.codes[used]))
        other, _ = words.counted(codes.codes[~used])
        by_code.add(other, np.zeros(len(other), np.int64))
        ends += int(some.sum())
    yield "ends", ends, b""
    key, count = by_word.total()
    for bucket, part in bucket_slices(key, n_buckets):
        yield "word", bucket, pack(key[part], count[part])
    del by_word
    key, count = by_code.total()
    for bucket, part in _dealt(key, n_buckets):
        yield "context", bucket, pack(key[part], count[part])
    some = count > 0
    pairs = ((key >> U64(8 * (DEPTH + 1 - _ROOT))) << U64(8)) | (key & U64(255))
    key, count = _summed(pairs[some], count[some])
    for bucket, part in _dealt(key, _ROOT_BUCKETS):
        yield "root", bucket, pack(key[part], count[part])


def _dealt(keys: np.ndarray, n_buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Positions of keys by bucket, in order, a bucket being a hash of the key."""
    of = (words.mix(keys) >> U64(40)).astype(np.int64) % n_buckets
    order = np.argsort(of, kind="stable")
    edges = np.searchsorted(of[order], np.arange(n_buckets + 1))
    for bucket in np.flatnonzero(np.diff(edges)).tolist():
        yield bucket, order[edges[bucket]:edges[bucket + 1]]


def _counts(group: pa.Table) -> pa.Table:
    """Training counts of a bucket's words for each block that asked, and the bucket's totals."""
    asks = [unpack(v.as_buffer()) for v in group["payload"]]
    keys, counts = (np.concatenate([a[k] for a in asks]) for k in (0, 1))
    key, total = _summed(keys, counts)
    payloads = [pack(total[words.lookup(key, a[0])]) for a in asks]
    n = len(asks)
    return pa.table({
        "kind": pa.array(["answer"] * n + ["tokens", "known"], pa.string()),
        "block": pa.array(group["block"].to_pylist() + ["", ""], pa.string()),
        "bucket": pa.array(group["bucket"].to_pylist()
                           + [int(total.sum()), int((total > 0).sum())], pa.int64()),
        "payload": pa.array([*payloads, b"", b""], pa.binary())})


def _gathered(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    asks = [unpack(v.as_buffer()) for v in group["payload"]]
    return _summed(*(np.concatenate([a[k] for a in asks]) for k in (0, 1)))


def _roots(table: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(context, next) of depth ``_ROOT`` and their counts; at most 2^24, whatever the corpus."""
    def add(group: pa.Table) -> pa.Table:
        return pa.table({"payload": pa.array([pack(*_gathered(group))], pa.binary())})

    found = [unpack(r["payload"]) for r in table.filter("kind = 'root'").groupBy(
        "bucket").applyInArrow(freed(add), "payload binary").collect()]
    return _summed(np.concatenate([np.empty(0, U64), *[f[0] for f in found]]),
                   np.concatenate([np.empty(0, np.int64), *[f[1] for f in found]]))


def _valued(table: DataFrame, n_buckets: int) -> DataFrame:
    """Answers to the blocks' contexts: the log10 probabilities that the tree gives their codes, to
    seven digits."""
    pairs, counts = roots = _roots(table)
    low = [_level(pairs, counts, None, 0)]
    for _ in range(_ROOT):
        pairs, counts = _summed(_shorter(pairs), counts)
        low.insert(0, _level(pairs, counts, None, 0))
    shared = table.sparkSession.sparkContext.broadcast((low, roots))

    def add(group: pa.Table) -> pa.Table:
        key, total = _gathered(group)
        parts = list(_dealt(key >> U64(8 * (DEPTH + 1 - _DEALT)), n_buckets))
        return pa.table({"root": pa.array([r for r, _ in parts], pa.int64()),
                         "bucket": pa.array([group["bucket"][0].as_py()] * len(parts), pa.int64()),
                         "payload": pa.array([pack(key[p], total[p]) for _, p in parts],
                                             pa.binary())})

    def grow(group: pa.Table) -> pa.Table:
        low, roots = shared.value
        asks = [unpack(v.as_buffer()) for v in group["payload"]]
        key, count = _summed(*(np.concatenate([a[k] for a in asks]) for k in (0, 1)))
        some = count > 0
        high = grown(key[some], count[some], LEAST_COUNT, roots)[1:] if some.any() else []
        tree = Tree([*low, *high])
        return pa.table({"bucket": group["bucket"], "root": group["root"],
                         "payload": pa.array([pack(tree.log10(a[0]).astype(np.float32))
                                              for a in asks], pa.binary())})

    def answer(asked: pa.Table, told: pa.Table) -> pa.Table:
        own = [unpack(v.as_buffer())[0] for v in asked["payload"]]
        # The bucket's codes were dealt in this order, so values need no codes beside them.
        key = words.counted(np.concatenate(own))[0]
        found = {r.as_py(): unpack(v.as_buffer())[0]
                 for r, v in zip(told["root"], told["payload"], strict=True)}
        value = np.zeros(len(key), np.float32)
        for root, part in _dealt(key >> U64(8 * (DEPTH + 1 - _DEALT)), n_buckets):
            value[part] = found[root]
        n = len(own)
        # Buckets of words are 0 and more.
        return pa.table({"kind": pa.array(["answer"] * n, pa.string()), "block": asked["block"],
                         "bucket": pa.array([-1 - b for b in asked["bucket"].to_pylist()],
                                            pa.int64()),
                         "payload": pa.array([pack(value[words.lookup(key, k)]) for k in own],
                                             pa.binary())})

    # Each step is written, and what it was made of deleted, so that no two of them take up disk
    # and workers at a time.
    spark, start = table.sparkSession, written()
    asked = table.filter("kind = 'context'")
    sums = stored(asked.groupBy("bucket").applyInArrow(
        freed(add), "root long, bucket long, payload binary"), "context-sums")
    values = stored(sums.groupBy("root").applyInArrow(
        freed(grow), "bucket long, root long, payload binary"), "context-values")
    release(spark, start, keep=values)
    answers = stored(asked.groupBy("bucket").cogroup(values.groupBy("bucket")).applyInArrow(
        freed(answer), BLOCKS), "context-answers")
    release(spark, start, keep=answers)
    release_part(table, "kind", "context")
    return answers


def score(df: DataFrame, learn: str, text: str = "text", prior: float = 0.1) -> DataFrame:
    """Learn from the rows whose boolean column ``learn`` is true and score all rows.

    Returns all columns but the text, and n_tokens, n_known, train_tokens, base_score and score."""
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
              T.StructField("train_tokens", T.LongType()),
              T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())]
    df = without(df, [f.name for f in fields])
    n_buckets = buckets_for(df)
    schema = T.StructType([f for f in df.schema.fields if f.name != text] + fields)

    def ask(batch: pa.RecordBatch) -> Iterable[tuple[str, int, bytes]]:
        return _asks(batch, text, learn, n_buckets)

    table = to_blocks(df, ask, "scoring", BLOCK_BYTES, "kind")
    answers = stored(table.filter("kind = 'word'").groupBy("bucket").applyInArrow(
        freed(_counts), BLOCKS), "word-counts")
    sums = {r["kind"]: r["n"] for r in answers.filter("kind <> 'answer'").unionByName(
        table.filter("kind = 'ends'")).groupBy("kind").agg(F.sum("bucket").alias("n")).collect()}
    release_part(table, "kind", "word")
    ends = sums.get("ends") or 0
    total = (sums.get("tokens") or 0) + ends
    distinct = (sums.get("known") or 0) + (ends > 0)
    tree_name = uuid.uuid4().hex

    def base(count: np.ndarray | int) -> np.ndarray:
        return np.log10((count + prior) / (total + prior * (distinct + 1)))

    def work(_: str, batch: pa.RecordBatch, told: dict[int, list[np.ndarray]]) -> pa.Table:
        column = batch.column(batch.schema.get_field_index(text))
        found, every, seen = [], _Sums(), _Sums()
        for _, _, data, offsets in words.sliced(column):
            own = words.tokenize(data, offsets, words.FOLDED)
            found.append((data, offsets, own))
            every.add(*words.counted(own.hashes))
            seen.add(*words.counted(symbols(data, offsets, own).codes))
        keys = every.total()[0]
        counts = np.zeros(len(keys), np.int64)
        for bucket, part in bucket_slices(keys, n_buckets):
            counts[part] = told[bucket][0]
        codes = seen.total()[0]
        del every, seen
        values = np.zeros(len(codes))
        for bucket, part in _dealt(codes, n_buckets):
            values[part] = told[-1 - bucket][0]
        scorer = once(tree_name, lambda: Scorer(None))
        scorer.tree = Told(codes, values)
        parts = [[], [], [], []]
        for data, offsets, own in found:
            count = counts[words.lookup(keys, own.hashes)]
            sums_ = np.concatenate(([0.0], np.cumsum(base(count))))
            known = np.concatenate(([0], np.cumsum(count > 0)))
            parts[0].append(own.counts + 1)
            parts[1].append(known[own.first[1:]] - known[own.first[:-1]] + (ends > 0))
            parts[2].append(sums_[own.first[1:]] - sums_[own.first[:-1]] + base(ends))
            parts[3].append(scorer.score(symbols(data, offsets, own)))
        n_tokens, n_known, bases, scores = (np.concatenate([np.empty(0), *p]) for p in parts)
        out = pa.Table.from_batches([batch]).drop_columns([text])
        for name, values in (("n_tokens", n_tokens.astype(np.int64)),
                             ("n_known", n_known.astype(np.int64)),
                             ("train_tokens", np.full(len(scores), total)),
                             ("base_score", bases), ("score", scores)):
            out = out.append_column(name, pa.array(values))
        return out

    told = answers.filter("kind = 'answer'").unionByName(_valued(table, n_buckets))
    return with_answers(table, told, schema, work)
