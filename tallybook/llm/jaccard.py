"""N-gram Jaccard join by grouped prefixes, and the components of its links.

A text's set holds its distinct word shingles. Sets are ordered by a rough count of each shingle,
the rarest first, and only a prefix is indexed: two sets that are similar enough share at least
``SHARED`` shingles of their prefixes. Texts whose prefix and size agree are one *group*; groups
meet by shingle, as packed arrays, and the sets behind them are compared only at the end:

1. a sketch counts all shingles, so that common ones come last in every set;
2. prefixes go to buckets by shingle; a bucket gives its *runs*, the groups that share a shingle.
   How far a shingle is from the start of a set limits the size of a partner that it can lead to,
   and a run keeps only groups that the shingle can lead to one another; shingles with the very
   same run count as one run of that weight;
3. star round: each group is compared with one leader, the most widely shared group of the runs it
   shares most with; verified links give components;
4. rest round: members of different components that share enough in their runs are compared pair by
   pair, unless the parity bits of their sets already differ in more places than similar sets can.
   What is already connected needs no further link to make the components, and still no link
   between components is lost;
5. on request, all links being within components by now, each component's sets of near sizes are
   compared with one another, chunk by chunk and each pair once, and every set's links are counted.

Comparisons bring a leader's set and a bounded number of members together; sets travel only for
texts that have a candidate (a filter of fixed size tells most others apart, an exact join the
rest). Equal sets are one *node* from the start.

Shingles are compared by 48 bits of their hashes, nodes by 64 bits. Null text has no words; a text
without words has an empty set and is linked with nothing. Rows that share an id and a text are
one node; a row without an id belongs to a component but never names it, unless nobody else does.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm import words
from tallybook.llm.frames import (bucket_slices, buckets_for, freed, pack, prepare, stored, trimmed,
                                  unpack)
from tallybook.llm.graph import components

U64 = np.uint64
# Fixed values of a near duplicate: words of a shingle, and the similarity in hundredths.
WORDS, PERCENT = 5, 75
# Shingles that prefixes of similar sets share at least (as far as the sets have so many).
SHARED = 4
SKETCH_BITS = 22
FILTER_BITS = 25
# Members compared with one copy of a leader's set.
MEMBERS = 500
_HASH = U64((1 << 56) - 1)
# Parity bits of a set; members of a run that are held against each other at once; rows of a task.
PARITY = 2048
CHUNK = 1000
SLOT_ROWS = 50_000
# Counting links: shingles of a task; columns of a matrix; pairs listed at once; how much dearer a
# listed pair is than a cell of the product.
SLOT_SHINGLES = 1 << 20
COLUMNS = 2048
LISTED = 1 << 21
SPARSE = 32
# Classes of size that sets which are similar may be apart; keys that are broadcast at most.
NEAR_CLASSES = 4
LARGE_LABELS = 100_000


# -- sets ----------------------------------------------------------------------------------

def _shingles(data: np.ndarray, offsets: np.ndarray, size: int
              ) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of some texts, and where each text's begin."""
    found = words.tokenize(data, offsets, words.FOLDED)
    at = words.inside_text(found, size)
    hashes = words.windows(found.hashes, size)[at]
    first = np.searchsorted(at, found.first)
    short = np.flatnonzero((found.counts > 0) & (found.counts < size))
    if len(short):
        one = words.whole(found.hashes, found.first)[short]
        hashes = np.insert(hashes, first[short], one)
        first = first + np.searchsorted(short, np.arange(len(first)))
    return hashes, first


def _keys(hashes: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Shingles as numbers in the common order: level, then 56 bits of hash."""
    level = levels[(hashes >> U64(64 - SKETCH_BITS)).astype(np.int64)]
    return (level.astype(U64) << U64(56)) | (hashes >> U64(8))


def _needed(n: int, percent: int) -> int:
    """The least overlap that a set of this size can be similar with."""
    return -(-percent * n // 100)


@dataclass(frozen=True)
class _Sets:
    """Distinct ordered shingles of each text of a slice."""

    keys: list[np.ndarray]

    def parity(self) -> np.ndarray:
        """A bit for each of ``PARITY`` classes of shingles: whether the set has an odd number of
        them. Two sets differ in at least as many shingles as bits."""
        out = np.zeros((len(self.keys), PARITY // 8), np.uint8)
        for k, keys in enumerate(self.keys):
            counts = np.bincount((keys & U64(PARITY - 1)).astype(np.int64), minlength=PARITY)
            out[k] = np.packbits((counts & 1).astype(np.uint8))
        return out

    def nodes(self) -> np.ndarray:
        return np.array([words.mix(np.array([words.mix(k & _HASH).sum(dtype=U64) + U64(len(k))]))[0]
                         if len(k) else 0 for k in self.keys], U64)


def _sets(data: np.ndarray, offsets: np.ndarray, levels: np.ndarray, size: int) -> _Sets:
    hashes, first = _shingles(data, offsets, size)
    keys = _keys(hashes, levels)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        part = np.sort(keys[a:b])
        out.append(part[words.distinct(part)])
    return _Sets(out)


def _as_long(a: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(a).view(np.int64))


# -- summed or joined arrays of fixed size -------------------------------------------------

def _merged(df: DataFrame, make, merge, length: int, dtype) -> np.ndarray:
    """An array of fixed size that every task makes of its rows, merged over all tasks by parts."""
    schema = "part int, bits binary"
    step = length // 64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = make(batches)
        for k in range(64):
            piece = whole[k * step:(k + 1) * step]
            if piece.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int32()), pa.array([pack(piece)], pa.binary())],
                    names=["part", "bits"])

    def join(group: pa.Table) -> pa.Table:
        total = None
        for value in group["bits"]:
            piece = unpack(value.as_buffer())[0]
            total = piece if total is None else merge(total, piece)
        return pa.table({"part": group["part"].slice(0, 1),
                         "bits": pa.array([pack(total)], pa.binary())})

    out = np.zeros(length, dtype)
    for r in df.mapInArrow(trimmed(run), schema).groupBy("part").applyInArrow(
            freed(join), schema).collect():
        out[r["part"] * step:(r["part"] + 1) * step] = unpack(r["bits"])[0]
    return out


def shingle_levels(texts: DataFrame, size: int) -> np.ndarray:
    """A level for each cell of shingle hashes: 0 if few shingles of all texts fall there, else the
    logarithm of their number. It sets the order, so it may be rough, but it is the same for all."""
    def make(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        cells = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            for _, _, data, offsets in words.sliced(batch.column(0)):
                hashes, _ = _shingles(data, offsets, size)
                at, n = words.counted(hashes >> U64(64 - SKETCH_BITS))
                cells[at.astype(np.int64)] += n
        return cells

    cells = _merged(texts, make, np.add, 1 << SKETCH_BITS, np.int64)
    usual = 4 * cells.mean() + 16
    return np.where(cells > usual, np.log2(np.maximum(cells, 1)), 0).astype(np.uint8)


def _bit(node: pa.Array, doc: pa.Array) -> np.ndarray:
    a, b = (np.ascontiguousarray(c.fill_null(0).to_numpy(zero_copy_only=False)).view(U64)
            for c in (node, doc))
    return (words.mix(a ^ words.mix(b)) >> U64(64 - FILTER_BITS)).astype(np.int64)


def _filter_of(keys: DataFrame) -> np.ndarray:
    """A bit array of fixed size in which the bits of all (node, doc) are set."""
    def make(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        bits = np.zeros(1 << FILTER_BITS, bool)
        for batch in batches:
            bits[_bit(batch.column(0), batch.column(1))] = True
        return np.packbits(bits)

    return _merged(keys, make, np.bitwise_or, 1 << (FILTER_BITS - 3), np.uint8)


# -- prefixes and runs ---------------------------------------------------------------------

RUNS = ("kind int, run long, grp long, size int, cap int, weight int, doc_id long, node long, "
        "bits binary")
# Partner sizes are kept as sixteenths of the own size, rounded up.
STEPS = 16


def _prefix(n: int, percent: int) -> tuple[int, np.ndarray]:
    """Length of the prefix, and for each place the largest partner it can lead to.

    Sets of n and m shingles that are similar share a >= percent (n + m) / (100 + percent) of them,
    hence ``SHARED`` (or all a) among the first n - a + SHARED of the one and m - a + SHARED of the
    other. So a shingle at a place serves partners up to some m, and places beyond the prefix none
    that is large enough."""
    length = min(n, n - _needed(n, percent) + SHARED)
    most = (100 + percent) * (n - 1 + SHARED - np.arange(length)) // percent - n
    return length, np.clip(-(-STEPS * most // n), 0, 255).astype(np.uint8)


def _turned(keys: np.ndarray) -> np.ndarray:
    """Keys with their level moved to the end, so that the top bits spread evenly."""
    return (keys << U64(16)) | (keys >> U64(48))


def _runs(asks: list[list[np.ndarray]], percent: int) -> pa.Table:
    token, group, size, step = (np.concatenate([a[k] for a in asks]) for k in range(4))
    order = np.lexsort((group, token))
    token, group, size, step = token[order], group[order], size[order], step[order]
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (group[1:] != group[:-1])
    token, group, size = token[new], group[new], size[new].astype(np.int64)
    cap = step[new].astype(np.int64) * size // STEPS
    for last in (False, True):
        starts = words.distinct(token)
        lengths = np.diff(np.append(starts, len(token)))
        keep = np.repeat(lengths > 1, lengths)
        if not last and len(starts):
            # Too small a partner size for the smallest of the run, or too large for the farthest.
            keep &= cap >= np.repeat(np.minimum.reduceat(size, starts), lengths)
            keep &= size <= np.repeat(np.maximum.reduceat(cap, starts), lengths)
        token, group, size, cap = token[keep], group[keep], size[keep], cap[keep]
    starts = words.distinct(token)
    lengths = np.diff(np.append(starts, len(token)))
    if not len(starts):
        return _run_table(np.empty(0, U64), group, size, cap, np.empty(0, np.int64))
    member = words.mix(group ^ words.mix(cap.astype(U64)))
    name = words.mix(np.add.reduceat(member, starts) + lengths.astype(U64))
    order = np.argsort(name, kind="stable")
    first = words.distinct(name[order])
    weight = np.diff(np.append(first, len(order)))
    chosen = order[first]
    lengths = lengths[chosen]
    take = np.repeat(starts[chosen] - (np.cumsum(lengths) - lengths), lengths) + np.arange(
        lengths.sum())
    return _run_table(np.repeat(name[chosen], lengths), group[take], size[take], cap[take],
                      np.repeat(weight, lengths))


def _run_table(run, group, size, cap, weight) -> pa.Table:
    n = len(run)
    none = pa.nulls(n, pa.int64())
    return pa.table({"kind": pa.array(np.ones(n, np.int32)), "run": _as_long(run),
                     "grp": _as_long(group), "size": pa.array(size.astype(np.int32)),
                     "cap": pa.array(cap.astype(np.int32)),
                     "weight": pa.array(weight.astype(np.int32)), "doc_id": none, "node": none,
                     "bits": pa.nulls(n, pa.binary())})


def _doc_table(asks: list[list[np.ndarray]]) -> pa.Table:
    doc, known, node, group, size, bits = (np.concatenate([a[k] for a in asks]) for k in range(6))
    n = len(doc)
    bits = bits.reshape(n, PARITY // 8)
    none = pa.nulls(n, pa.int64())
    return pa.table({"kind": pa.array(np.zeros(n, np.int32)), "run": none, "grp": _as_long(group),
                     "size": pa.array(size.astype(np.int32)), "cap": pa.nulls(n, pa.int32()),
                     "weight": pa.nulls(n, pa.int32()), "doc_id": pa.array(doc, mask=known == 0),
                     "node": _as_long(node),
                     "bits": pa.array([b.tobytes() for b in bits], pa.binary())})


def _indexed(texts: DataFrame, levels, n_buckets: int, size: int, percent: int) -> DataFrame:
    """Runs (kind 1) and a row for each text (kind 0), from rows (text, doc_id)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = levels.value
        number = 0
        for batch in batches:
            ids = batch.column(1)
            known = np.asarray(ids.is_valid())
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
            rows: list[tuple[np.ndarray, ...]] = []
            prefixes: dict[int, tuple[np.ndarray, int, np.ndarray]] = {}
            for i, j, data, offsets in words.sliced(batch.column(0)):
                sets = _sets(data, offsets, order, size)
                nodes = sets.nodes()
                groups, sizes = np.zeros(j - i, U64), np.zeros(j - i, np.uint32)
                for k, keys in enumerate(sets.keys):
                    n = len(keys)
                    if n:
                        length, steps = _prefix(n, percent)
                        prefix = keys[:length]
                        name = words.mix(np.array(
                            [words.mix(prefix).sum(dtype=U64) + U64(n)], U64))[0]
                        groups[k], sizes[k] = name, n
                        prefixes[int(name)] = (prefix, n, steps)
                rows.append((ids[i:j], known[i:j].astype(np.uint8), nodes, groups, sizes,
                             sets.parity().ravel()))
            if rows:
                number += 1
                yield _ask(-1 - (number + int(rows[0][2][0])) % n_buckets,
                           pack(*[np.concatenate([r[k] for r in rows]) for k in range(6)]))
            if prefixes:
                prefix, count, steps = zip(*prefixes.values(), strict=True)
                lengths = [len(p) for p in prefix]
                token, steps = _turned(np.concatenate(prefix)), np.concatenate(steps)
                group = np.repeat(np.array(list(prefixes), U64), lengths)
                count = np.repeat(np.array(count, np.uint32), lengths)
                at = np.argsort(token)
                for bucket, part in bucket_slices(token[at], n_buckets):
                    some = at[part]
                    yield _ask(bucket, pack(token[some], group[some], count[some], steps[some]))

    def gather(group: pa.Table) -> pa.Table:
        asks = [unpack(v.as_buffer()) for v in group["payload"]]
        return _doc_table(asks) if group["bucket"][0].as_py() < 0 else _runs(asks, percent)

    asked = texts.mapInArrow(trimmed(run), "bucket long, payload binary")
    return asked.groupBy("bucket").applyInArrow(freed(gather), RUNS)


def _ask(bucket: int, payload: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([bucket], pa.int64()), pa.array([payload], pa.binary())],
        names=["bucket", "payload"])


# -- comparing -----------------------------------------------------------------------------

def _six(keys: np.ndarray) -> bytes:
    """48 bits of each shingle's hash."""
    return np.sort((keys & _HASH) >> U64(8)).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _of_six(raw: memoryview | bytes) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    out = np.zeros((len(planes), 8), np.uint8)
    out[:, :6] = planes
    return out.view(U64).ravel()


def _carried(texts: DataFrame, routes: DataFrame, levels, size: int) -> DataFrame:
    """Rows (node, doc, ...) with the node's set, as the text of that document gives it."""
    shared = texts.sparkSession.sparkContext.broadcast(_filter_of(routes.select("node", "doc")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, bits = levels.value, shared.value
        for batch in batches:
            for i, j, data, offsets in words.sliced(batch.column(0)):
                sets = _sets(data, offsets, order, size)
                node, doc = _as_long(sets.nodes()), batch.column(1).slice(i, j - i)
                at = _bit(node, doc)
                some = np.flatnonzero((bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1)
                if len(some):
                    yield pa.RecordBatch.from_arrays(
                        [node.take(pa.array(some)), doc.take(pa.array(some)),
                         pa.array([_six(sets.keys[k]) for k in some], pa.binary())],
                        names=["node", "doc", "shingles"])

    found = texts.mapInArrow(trimmed(run), "node long, doc long, shingles binary")
    there = found.join(routes.hint("shuffle_hash"),
                       (found["node"] == routes["node"]) & found["doc"].eqNullSafe(routes["doc"]))
    return there.select(*[routes[c] for c in routes.columns if c != "doc"], "shingles")


def _verified(texts: DataFrame, nodes: DataFrame, pairs: DataFrame, levels, size: int,
              percent: int) -> DataFrame:
    """Those of the pairs (a, b) of nodes whose sets are similar enough, written."""
    pairs = stored(pairs.select("a", "b"), "pairs")
    hubs = pairs.groupBy("b").agg(F.ceil(F.count("*") / MEMBERS).alias("copies"))
    salted = pairs.join(stored(hubs, "hubs"), "b").select(
        "a", "b", F.pmod(F.xxhash64("a"), "copies").cast("int").alias("salt"))
    routes = salted.select(F.col("a").alias("node"), "b", "salt", F.lit(False).alias("leads"))
    routes = routes.unionByName(salted.select(
        F.col("b").alias("node"), "b", "salt", F.lit(True).alias("leads")).distinct())
    there = _carried(texts, stored(routes.join(nodes.select("node", "doc"), "node"), "routes"),
                     levels, size)

    def compare(group: pa.Table) -> pa.Table:
        leads = group["leads"].to_pylist()
        nodes_, raw = group["node"].to_pylist(), group["shingles"]
        lead = next((k for k, x in enumerate(leads) if x), None)
        out = set()
        if lead is not None:
            base = _of_six(raw[lead].as_buffer())
            for k, one in enumerate(nodes_):
                if not leads[k] and one not in out:
                    other = _of_six(raw[k].as_buffer())
                    common = int((words.lookup(base, other) >= 0).sum())
                    if 100 * common >= percent * (len(base) + len(other) - common):
                        out.add(one)
        b = group["b"][0].as_py()
        return pa.table({"a": pa.array(sorted(out), pa.int64()),
                         "b": pa.array([b] * len(out), pa.int64())})

    return stored(there.groupBy("b", "salt").applyInArrow(compare, "a long, b long"), "links")


# -- links ---------------------------------------------------------------------------------

def _common(one: list[np.ndarray], two: list[np.ndarray]) -> np.ndarray:
    """How many shingles each set of ``one`` shares with each of ``two``. Shingles that many of them
    have are counted by a product of 0/1 matrices, the others by listing who shares them."""
    na, nb = len(one), len(two)
    (ka, oa), (kb, ob) = ((np.concatenate(x), np.repeat(np.arange(len(x)), [len(k) for k in x]))
                          for x in (one, two))
    both = np.intersect1d(ka, kb)
    pa_, pb = words.lookup(both, ka), words.lookup(both, kb)
    (pa_, oa), (pb, ob) = ((p[p >= 0], o[p >= 0]) for p, o in ((pa_, oa), (pb, ob)))
    ha, hb = np.bincount(pa_, minlength=len(both)), np.bincount(pb, minlength=len(both))
    out = np.zeros((na, nb))
    many = ha * hb * SPARSE > na * nb
    column = np.cumsum(many) - 1
    da, db = many[pa_], many[pb]
    ca, cb, ra, rb = column[pa_[da]], column[pb[db]], oa[da], ob[db]
    for first in range(0, int(many.sum()), COLUMNS):
        left, right = np.zeros((na, COLUMNS), np.float32), np.zeros((nb, COLUMNS), np.float32)
        for full, c, r in ((left, ca, ra), (right, cb, rb)):
            some = (c >= first) & (c < first + COLUMNS)
            full[r[some], c[some] - first] = 1
        out += left @ right.T
    pa_, oa, pb, ob = pa_[~da], oa[~da], pb[~db], ob[~db]
    ob = ob[np.argsort(pb, kind="stable")]
    begins = np.cumsum(np.where(many, 0, hb)) - np.where(many, 0, hb)
    sizes = hb[pa_]
    ends = np.cumsum(sizes)
    a = 0
    while a < len(pa_):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + LISTED, "right")))
        n = sizes[a:b]
        partner = ob[np.repeat(begins[pa_[a:b]] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
        out += np.bincount(np.repeat(oa[a:b], n) * nb + partner, minlength=na * nb).reshape(na, nb)
        a = b
    return out


def _alike(one: list[np.ndarray], two: list[np.ndarray], percent: int) -> np.ndarray:
    """Whether each set of ``one`` is similar enough to each of ``two``."""
    common = _common(one, two)
    total = np.add.outer([float(len(k)) for k in one], [float(len(k)) for k in two])
    return 100 * common >= percent * (total - common)


def _size_class(size: Column, percent: int) -> Column:
    """Sizes by a common factor: sets that are more than ``NEAR_CLASSES`` classes apart differ too
    much in size to be similar."""
    step = (100 / percent) ** (1 / (NEAR_CLASSES - 1)) if percent < 100 else 1.5
    return F.floor(F.log(F.greatest(size, F.lit(1)).cast("double")) / F.log(F.lit(step))).cast("long")


def _linked(texts: DataFrame, nodes: DataFrame, labels: DataFrame, levels, size: int, percent: int
            ) -> DataFrame:
    """(node, linked): rows of other sets that the node's set is similar enough to.

    All links are within components. A small component's sets are compared with one another in one
    go; a large one is cut into chunks by size class and hash, and only chunks of near classes meet,
    a task taking chunk pairs of about ``SLOT_SHINGLES``. What leaves a task is a count for each set,
    however many links there are."""
    members = stored(nodes.select("node", "doc", "size", "copies").join(labels, "node"), "members")
    whole = stored(members.groupBy("label").agg(
        F.count("*").alias("n"), F.sum("size").alias("shingles"),
        F.min(F.struct("node", "copies")).alias("one"),
        F.max(F.struct("node", "copies")).alias("two")), "wholes")
    # The link of a component of two is what made it; both are here, so nothing is joined.
    couples = whole.filter("n = 2")
    two = couples.select("one.node", F.col("two.copies").alias("linked")).unionByName(
        couples.select("two.node", F.col("one.copies").alias("linked")))
    others = members.join(two.select("node"), "node", "left_anti")
    large = whole.filter((F.col("n") > CHUNK) | (F.col("shingles") > SLOT_SHINGLES)).select("label")
    if large.count() <= LARGE_LABELS:
        large = F.broadcast(large)
    others = stored(others.join(large.withColumn("is_large", F.lit(True)), "label", "left").select(
        "node", "doc", "size", "copies", "label", F.when(
            F.col("is_large"), _size_class(F.col("size"), percent)).alias("class")), "classed")
    chunks = stored(others.filter("class is not null").groupBy("label", "class").agg(
        F.count("*").alias("n"), F.sum("size").alias("shingles")).withColumn(
        "parts", F.ceil(F.greatest(F.col("n") / CHUNK, F.col("shingles") / SLOT_SHINGLES)).cast(
            "long")), "link-chunks")
    other = chunks.select(F.col("label").alias("l"), F.col("class").alias("c"),
                          F.col("parts").alias("p"))
    near = stored(chunks.join(other, (F.col("label") == F.col("l")) & (
        F.abs(F.col("class") - F.col("c")) <= NEAR_CLASSES)).groupBy(
        "label", "class", "parts", "shingles").agg(
        F.sort_array(F.collect_list(F.struct("c", "p"))).alias("near"), F.sum("p").alias("met")),
        "near-chunks")
    chunk_shingles = near.agg(F.sum(F.col("shingles") * F.col("met"))).first()[0] or 0
    whole_shingles = whole.filter("n > 2").agg(F.sum("shingles")).first()[0] or 0
    slots = F.lit(-(-(chunk_shingles + whole_shingles) // SLOT_SHINGLES) or 1)
    # A chunk is known by its class and part; a small component is one chunk.
    classes = F.broadcast(near) if near.count() <= LARGE_LABELS else near
    mine = F.col("class") * (1 << 32) + F.pmod(F.xxhash64("node"), "parts")
    theirs = F.flatten(F.transform("near", lambda x: F.transform(
        F.sequence(F.lit(0).cast("long"), x["p"] - 1), lambda k: x["c"] * (1 << 32) + k)))
    split = others.filter("class is not null").join(classes, ["label", "class"]).select(
        "node", "doc", "copies", "label", mine.alias("part"), F.explode(theirs).alias("other"))
    none = F.lit(0).cast("long")
    undivided = others.filter("class is null").select(
        "node", "doc", "copies", "label", none.alias("part"), none.alias("other"))
    i, j = F.least("part", "other"), F.greatest("part", "other")
    routes = split.unionByName(undivided).select(
        "node", "doc", "copies", "label", "part", i.alias("i"), j.alias("j"),
        F.pmod(F.xxhash64("label", i, j), slots).alias("slot"))
    there = _carried(texts, stored(routes, "link-routes"), levels, size)

    def count(group: pa.Table) -> pa.Table:
        node, copies, label, part, i, j = (
            group[c].to_numpy() for c in ("node", "copies", "label", "part", "i", "j"))
        raw = group["shingles"]
        order = np.lexsort((node, part, j, i, label))
        # A document that occurs several times brings its set each time.
        same = np.zeros(len(order), bool)
        same[1:] = np.all([c[order][1:] == c[order][:-1] for c in (node, part, j, i, label)], axis=0)
        order = order[~same]
        new = np.ones(len(order), bool)
        new[1:] = np.any([c[order][1:] != c[order][:-1] for c in (label, i, j)], axis=0)
        starts = np.append(np.flatnonzero(new), len(order)).tolist()
        out: list[tuple[np.ndarray, np.ndarray]] = []
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            some = order[a:b]
            sets = [_of_six(raw[int(k)].as_buffer()) for k in some]
            own = i[some[0]] == j[some[0]]
            cut = len(some) if own else int((part[some] == i[some[0]]).sum())
            if own:
                alike = _alike(sets, sets, percent)
                np.fill_diagonal(alike, False)
                out.append((node[some], alike @ copies[some]))
            elif 0 < cut < len(some):
                alike = _alike(sets[:cut], sets[cut:], percent)
                out.append((node[some[:cut]], alike @ copies[some[cut:]]))
                out.append((node[some[cut:]], copies[some[:cut]] @ alike))
        nodes_, linked = (np.concatenate([np.empty(0, np.int64), *[o[k] for o in out]])
                          for k in (0, 1))
        return pa.table({"node": pa.array(nodes_), "linked": pa.array(linked)})

    return there.groupBy("slot").applyInArrow(freed(count), "node long, linked long").unionByName(
        two).groupBy("node").agg(F.sum("linked").alias("linked"))


# -- the join ------------------------------------------------------------------------------

def _leads(x: str, y: str) -> Column:
    """Whether the shingles of a run lead these two groups to each other."""
    return (F.col(f"{x}.size") <= F.col(f"{y}.cap")) & (F.col(f"{y}.size") <= F.col(f"{x}.cap"))


def _enough(percent: int) -> Column:
    """Whether a pair shares as much of its prefixes (weight) as its larger size asks for."""
    return F.col("weight") >= F.least(F.lit(SHARED), F.ceil(F.col("size") * percent / 100))


def _leaders(runs: DataFrame, percent: int) -> DataFrame:
    """(grp, leader): of the leaders of a group's runs, the one it shares most with. A run's leader
    is the member that shares most with all others of all runs."""
    lengths = runs.groupBy("run").agg(F.count("*").alias("length"))
    wide = runs.join(stored(lengths, "run-lengths"), "run").groupBy("grp").agg(
        F.sum(F.col("weight") * (F.col("length") - 1)).alias("shared"))
    ranked = stored(runs.join(stored(wide, "shared"), "grp"), "ranked-runs")
    leaders = ranked.groupBy("run").agg(F.max(F.struct("shared", "grp", "size", "cap")).alias("y"))
    met = ranked.alias("x").join(stored(leaders.select("run", "y.*"), "leaders").alias("y"), "run")
    return met.filter((F.col("x.grp") != F.col("y.grp")) & _leads("x", "y")).groupBy(
        F.col("x.grp").alias("grp"), F.col("y.grp").alias("leader")).agg(
        F.sum("x.weight").alias("weight"), F.max(F.greatest("x.size", "y.size")).alias("size")
    ).filter(_enough(percent)).groupBy("grp").agg(
        F.max(F.struct("weight", "leader"))["leader"].alias("leader"))


def _open(runs: DataFrame, nodes: DataFrame, labels: DataFrame) -> tuple[DataFrame, int]:
    """Runs whose members lie in several components, and groups of several members, by member; and
    how many rows they make when each chunk meets each."""
    members = nodes.join(labels, "node", "left").select(
        "node", "grp", "size", F.coalesce("label", "node").alias("label"))
    together = runs.select("run", "grp", "cap", "weight").join(members, "grp").unionByName(
        members.select(F.col("grp").alias("run"), "grp", F.col("size").alias("cap"),
                       F.lit(SHARED).alias("weight"), "node", "size", "label"))
    mixed = together.groupBy("run").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("length")
    ).filter("low <> high").select(
        "run", "length", F.ceil(F.col("length") / CHUNK).cast("int").alias("parts"))
    mixed = stored(mixed, "mixed-runs")
    n_rows = mixed.agg(F.sum(F.col("length") * F.col("parts"))).first()[0] or 0
    return stored(together.join(mixed, "run").select(
        "run", "parts", "weight", "node", "size", "cap", "label"), "open-runs"), n_rows


def _slots(n_rows: int) -> int:
    """Tasks for so many rows, each getting about ``SLOT_ROWS``."""
    return max(1, -(-n_rows // SLOT_ROWS))


def _met(open_runs: DataFrame, n_rows: int, bits: DataFrame, percent: int) -> DataFrame:
    """(a, b, weight, size) of members of different components that a run leads to one another and
    whose parity bits allow it. Chunks of a run meet each other, so none is large; ``n_rows`` counts
    a member once for each chunk that its own meets."""
    part = F.pmod(F.xxhash64("node"), "parts").cast("int")
    columns = ["run", "weight", "node", "size", "cap", "label", "bits", "part"]
    rows = open_runs.join(bits, "node").withColumn("part", part).select(
        *columns, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    slots = _slots(n_rows)
    i, j = F.least("part", "other"), F.greatest("part", "other")
    rows = rows.select(*columns, i.alias("i"), j.alias("j"),
                       F.pmod(F.xxhash64("run", i, j), F.lit(slots)).alias("slot"))

    def meet(group: pa.Table) -> pa.Table:
        run, weight, node, size, cap, label, part, i, j = (
            group[c].to_numpy() for c in ("run", "weight", "node", "size", "cap", "label", "part",
                                          "i", "j"))
        data, _ = words.texts(group["bits"])
        parity = np.ascontiguousarray(data).view(U64).reshape(len(run), PARITY // 64)
        order = np.lexsort((j, i, run))
        new = np.ones(len(order), bool)
        new[1:] = np.any([c[order][1:] != c[order][:-1] for c in (run, i, j)], axis=0)
        starts = np.append(np.flatnonzero(new), len(order)).tolist()
        out: list[tuple] = []
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            some = order[a:b]
            own = i[some[0]] == j[some[0]]
            one = some if own else some[part[some] == i[some[0]]]
            for x in one.tolist():
                # Within a chunk a pair is met from its larger label only.
                two = some if own else some[part[some] != part[x]]
                y = two[label[two] < label[x] if own else label[two] != label[x]]
                y = y[(size[y] <= cap[x]) & (size[x] <= cap[y])]
                if not len(y):
                    continue
                apart = np.bitwise_count(parity[y] ^ parity[x]).sum(axis=1).astype(np.int64)
                both = (size[y] + size[x]).astype(np.int64)
                y = y[(100 + percent) * apart <= (100 - percent) * both]
                if len(y):
                    down = label[y] < label[x]
                    out.append((np.where(down, node[x], node[y]), np.where(down, node[y], node[x]),
                                weight[y], np.maximum(size[y], size[x])))
        high, low, shared, most = (
            np.concatenate([np.empty(0, np.int64), *[o[k] for o in out]]) for k in range(4))
        # A pair meets in many runs; a slot tells of it once.
        order = np.lexsort((low, high))
        high, low, shared, most = (c[order] for c in (high, low, shared, most))
        starts = words.distinct(words.mix(high.view(U64) ^ words.mix(low.view(U64))))
        if len(starts):
            shared = np.add.reduceat(shared, starts)
        return pa.table({"a": pa.array(high[starts]), "b": pa.array(low[starts]),
                         "weight": pa.array(shared.astype(np.int32)),
                         "size": pa.array(most[starts].astype(np.int32))})

    return rows.groupBy("slot").applyInArrow(freed(meet), "a long, b long, weight int, size int")


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = WORDS,
                    percent: int = PERCENT, links: bool = True) -> DataFrame:
    """One row for each row of ``df``: doc_id, n_shingles, component_id (the smallest doc_id
    reachable by links, the row's own included) and, with ``links``, n_verified (its links: all other
    rows whose sets are equal or similar enough), which need every pair of near sizes within a
    component to be compared; components alone don't."""
    spark = prepare(df.sparkSession)
    texts = df.select(F.col(text).cast("string").alias("text"),
                      F.col(doc_id).cast("long").alias("doc_id"))
    levels = spark.sparkContext.broadcast(shingle_levels(texts.select("text"), size))
    index = stored(_indexed(texts, levels, buckets_for(texts), size, percent), "runs")
    docs, runs = index.filter("kind = 0"), index.filter("kind = 1")
    nodes = stored(docs.filter("size > 0").groupBy("node").agg(
        F.min("doc_id").alias("doc"), F.first("grp").alias("grp"), F.first("size").alias("size"),
        F.first("bits").alias("bits"), F.count("*").alias("copies")), "nodes")
    docs = docs.select("doc_id", "size", "node")

    # Star round: a member of a group meets the group's first member, and that the first member of
    # the leading group.
    firsts = nodes.groupBy("grp").agg(F.min("node").alias("first"))
    best = _leaders(runs, percent)
    named = firsts.select(F.col("grp").alias("leader"), F.col("first").alias("b"))
    star = firsts.join(best, "grp").join(named, "leader").select(F.col("first").alias("a"), "b")
    inner = nodes.join(firsts, "grp").filter(F.col("node") != F.col("first")).select(
        F.col("node").alias("a"), F.col("first").alias("b"))
    edges = _verified(texts, nodes, star.unionByName(inner), levels, size, percent)
    labels = stored(components(edges), "labels")

    # Rest round.
    rest = _met(*_open(runs, nodes, labels), nodes.select("node", "bits"), percent).groupBy(
        "a", "b").agg(F.sum("weight").alias("weight"), F.max("size").alias("size")).filter(
        _enough(percent))
    more = _verified(texts, nodes, rest, levels, size, percent)
    if more.limit(1).count():
        edges = edges.unionByName(more)
        labels = stored(components(edges), "labels")

    ids = nodes.join(labels, "node").groupBy("label").agg(F.min("doc").alias("least"))
    known = nodes.join(labels, "node", "left").join(ids, "label", "left").select(
        "node", "copies", F.coalesce("least", "doc").alias("component_id"))
    columns = ["doc_id", F.col("size").cast("long").alias("n_shingles"),
               F.coalesce("component_id", "doc_id").alias("component_id")]
    if links:
        linked = _linked(texts, nodes, labels, levels, size, percent)
        known = known.join(linked, "node", "left").withColumn(
            "n_verified", F.coalesce("linked", F.lit(0)) + F.col("copies") - 1)
        columns.append(F.coalesce("n_verified", F.lit(0)).cast("long").alias("n_verified"))
    return docs.join(stored(known, "components"), "node", "left").select(*columns)
