"""DataFrame helpers: appended columns, written intermediate tables, and blocks of rows.

A *block* is a few megabytes of whole rows, kept as compressed Arrow bytes in a table in the
shared folder. While blocks are written, each may *ask* about keys of its texts: asks go to
buckets by key, a bucket gathers what all blocks said about a key, and its *answers* return to the
blocks that asked. So every text can be told something about the whole corpus, while what moves is
one entry per key and block, and neither a hot key nor the corpus ever meets in one place.
"""

from __future__ import annotations

import contextlib
import ctypes
import functools
import inspect
import os
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallybook.llm import words
from tallybook.session import remove_path, shared_dir, ship_package

# Bytes of an Arrow batch between Spark and Python, and of text in a block.
BATCH_BYTES = 4 << 20
BLOCK_BYTES = 8 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Bound Arrow batches by bytes, so that long texts don't pile up in a worker, and let the
    workers import this package."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


# Arrays of more bytes are returned to the system as soon as they are freed. The C library would
# raise this bound by itself and then keep up to 32 MB holes between arrays that are in use. What
# smaller ones leave stays at hand for the next, until the end of the task.
_MAPPED_BYTES, _KEPT_BYTES = 8 << 20, 16 << 20
_M_MMAP_THRESHOLD, _M_TRIM_THRESHOLD = -3, -1


@functools.cache
def _lean() -> None:
    with contextlib.suppress(OSError, AttributeError):
        library = ctypes.CDLL(None)
        library.mallopt(_M_MMAP_THRESHOLD, _MAPPED_BYTES)
        library.mallopt(_M_TRIM_THRESHOLD, _KEPT_BYTES)


def trim() -> None:
    """Give freed memory back to the system: a worker process that waits for its next task should
    not hold what the last one needed."""
    words.forget()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def freed(run: Callable[..., pa.Table]) -> Callable[..., pa.Table]:
    """A function over one group, or two that belong together, that trims behind every group."""
    def one(group: pa.Table) -> pa.Table:
        _lean()
        found = run(group)
        del group
        trim()
        return found

    def two(left: pa.Table, right: pa.Table) -> pa.Table:
        _lean()
        found = run(left, right)
        del left, right
        trim()
        return found

    return one if len(inspect.signature(run).parameters) == 1 else two


def trimmed(run: Callable, name: str | None = None) -> Callable:
    """A function over batches that trims at its end, and at its beginning lets go of what other
    operators have kept by ``once`` in this process; ``name`` is its own."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _lean()
        for other in [k for k in _KEPT if k != name]:
            del _KEPT[other]
        yield from run(batches)
        trim()

    return wrapped


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Writers a task may have open, so that rows need no sort by the column that keeps them apart.
_WRITERS, _OPEN = "spark.sql.maxConcurrentOutputFileWriters", 16


@contextlib.contextmanager
def _configured(spark: SparkSession, **values: str) -> Iterator[None]:
    """Settings of the session for a while."""
    names = {"cleanup": _CLEANUP, "writers": _WRITERS}
    before = {names[k]: spark.conf.get(names[k], None) for k in values}
    for key, value in values.items():
        spark.conf.set(names[key], value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def stored(df: DataFrame, name: str, apart: str | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the lineage, outlives executors.
    Spark removes the shuffle files of the write at its end, as nothing reads them again. Values of
    the column ``apart``, a few, get folders of their own, which ``release_part`` can delete."""
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")
    with _configured(spark, cleanup="true", writers=str(_OPEN if apart else 0)):
        (df.write.partitionBy(apart) if apart else df.write).parquet(path)
    _WRITTEN.append(path)
    found = spark.read.schema(df.schema).parquet(path)
    return found.select(*df.columns) if apart else found


def release_part(df: DataFrame, column: str, value: str) -> None:
    """Delete the rows of one value from a table that was ``stored`` apart by a column, once
    nothing reads them any more."""
    for path in _WRITTEN:
        if any(f"/{os.path.basename(path)}/" in f for f in df.inputFiles()[:1]):
            remove_path(df.sparkSession, os.path.join(path, f"{column}={value}"))


# Tables that ``stored`` has written, oldest first.
_WRITTEN: list[str] = []


def written() -> int:
    """A mark for ``release``: how many tables have been written so far."""
    return len(_WRITTEN)


def release(spark: SparkSession, since: int, keep: DataFrame | None = None) -> None:
    """Delete the tables written since a mark, once what was made of them is written too. ``keep``
    is a table that ``stored`` gave, which stays."""
    kept = keep.inputFiles()[:1] if keep else []
    for path in _WRITTEN[since:]:
        if not any(f"/{os.path.basename(path)}/" in f for f in kept):
            remove_path(spark, path)
            _WRITTEN.remove(path)


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop columns whose names would clash with new ones, whatever their case."""
    clash = {n.lower() for n in names}
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in clash])


def appended(df: DataFrame, fields: list[T.StructField],
             compute: Callable[[pa.RecordBatch], list[pa.Array]],
             name: str | None = None) -> DataFrame:
    """Add columns computed per Arrow batch; input columns of the same names are replaced. ``name``
    is that of what ``compute`` keeps by ``once``."""
    prepare(df.sparkSession)
    df = without(df, [f.name for f in fields])
    schema = T.StructType([*df.schema.fields, *fields])
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, *compute(batch)], names=names)

    return df.mapInArrow(trimmed(run, name), schema)


_KEPT: dict[str, object] = {}


def once(name: str, make: Callable[[], object]) -> object:
    """What ``make`` gives, made once a worker process and name; only the last is kept."""
    if name not in _KEPT:
        _KEPT.clear()
        _KEPT[name] = make()
    return _KEPT[name]


def partitions(df: DataFrame) -> int:
    """How many tasks read a table: a measure of its size that needs no job."""
    return df.rdd.getNumPartitions()


def buckets_for(df: DataFrame) -> int:
    """Buckets for keys of a table: two a task that reads it, a power of two."""
    return max(16, 1 << (2 * partitions(df) - 1).bit_length())


# -- packed arrays -------------------------------------------------------------------------

def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value. Sorted 64-bit keys shrink, being stored as differences."""
    parts, names = [], []
    for k, a in enumerate(arrays):
        if a.dtype == np.uint64 and len(a) and bool(np.all(a[1:] >= a[:-1])):
            a, name = np.diff(a, prepend=np.uint64(0)), f"d{k}"
        else:
            name = f"p{k}"
        # Bytes of equal weight side by side: high bytes of small numbers are zeros.
        planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize)
        parts.append(pa.array([np.ascontiguousarray(planes.T).tobytes()], pa.binary()))
        names.append(f"{name}:{a.dtype.str}")
    batch = pa.RecordBatch.from_arrays(parts, names=names)
    return ipc_bytes(batch, "zstd")


def unpack(value: bytes) -> list[np.ndarray]:
    batch = ipc_batch(value)
    out = []
    for name, column in zip(batch.schema.names, batch.columns, strict=True):
        kind, dtype = name.split(":", 1)
        raw = np.frombuffer(column[0].as_buffer(), np.uint8)
        size = np.dtype(dtype).itemsize
        a = np.ascontiguousarray(raw.reshape(size, len(raw) // size).T).view(dtype).ravel()
        out.append(np.cumsum(a, dtype=np.uint64) if kind[0] == "d" else a)
    return out


def ipc_bytes(batch: pa.RecordBatch, codec: str | None = "zstd") -> bytes:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=codec and pa.Codec(codec, compression_level=3),
                                      use_threads=False)
    with pa.ipc.new_stream(sink, batch.schema, options=options) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def ipc_batch(value: bytes) -> pa.RecordBatch:
    options = pa.ipc.IpcReadOptions(use_threads=False)
    table = pa.ipc.open_stream(pa.py_buffer(value), options=options).read_all()
    if table.num_rows == 0:
        return pa.RecordBatch.from_pylist([], schema=table.schema)
    return table.combine_chunks().to_batches()[0]


# -- blocks --------------------------------------------------------------------------------

Ask = Callable[[pa.RecordBatch], Iterable[tuple[str, int, bytes]]]
BLOCKS = "kind string, block string, bucket long, payload binary"
_ROWS = pa.schema([("kind", pa.string()), ("block", pa.string()), ("bucket", pa.int64()),
                   ("payload", pa.binary())])


def _gathered(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        row = 0
        while row < batch.num_rows:
            each = max(1, batch.nbytes // max(1, batch.num_rows))
            part = batch.slice(row, max(1, (limit - size) // each))
            held.append(part)
            size += part.num_rows * each
            row += part.num_rows
            if size >= limit:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
    if held:
        whole = pa.Table.from_batches(held).combine_chunks().to_batches()
        if whole:
            yield whole[0]


def to_blocks(df: DataFrame, ask: Ask, name: str, block_bytes: int = BLOCK_BYTES,
              apart: str | None = None) -> DataFrame:
    """Rows of ``df`` as blocks in a written table, with what ``ask`` wants to know.

    ``ask(batch)`` yields (kind, bucket, payload). Result: kind, block, bucket, payload; kind
    ``block`` has the rows themselves. ``apart`` is that of ``stored``."""
    prepare(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches, block_bytes):
            block = uuid.uuid4().hex  # the table is written once, so the name stays
            yield rows([("block", block, None, ipc_bytes(batch))])
            asked = [(kind, block, bucket, payload) for kind, bucket, payload in ask(batch)]
            if asked:
                yield rows(asked)

    return stored(df.mapInArrow(trimmed(run), BLOCKS), name, apart)


def rows(values: list[tuple[str, str, int | None, bytes]]) -> pa.RecordBatch:
    kinds, blocks, buckets, payloads = zip(*values, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(kinds, pa.string()), pa.array(blocks, pa.string()),
         pa.array(buckets, pa.int64()), pa.array(payloads, pa.binary())], schema=_ROWS)


def bucket_slices(keys: np.ndarray, n_buckets: int) -> Iterator[tuple[int, slice]]:
    """Ranges of sorted 64-bit keys by bucket; a bucket is a range of the key's top bits."""
    shift = np.uint64(64 - (n_buckets.bit_length() - 1))
    of = (keys >> shift).astype(np.int64) if n_buckets > 1 else np.zeros(len(keys), np.int64)
    cuts = np.flatnonzero(of[1:] != of[:-1]) + 1 if len(of) else np.empty(0, np.int64)
    edges = [0, *cuts.tolist(), len(keys)]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        if b > a:
            yield int(of[a]), slice(a, b)


def answered(table: DataFrame, kind: str,
             answer: Callable[[list[list[np.ndarray]]], list[bytes]]) -> DataFrame:
    """Gather the asks of one kind by bucket and answer each: (block, bucket, payload)."""

    def run(group: pa.Table) -> pa.Table:
        asks = [unpack(v.as_buffer()) for v in group["payload"]]
        return pa.table({"kind": pa.array(["answer"] * len(asks), pa.string()),
                         "block": group["block"], "bucket": group["bucket"],
                         "payload": pa.array(answer(asks), pa.binary())})

    asked = table.filter(table["kind"] == kind)
    return asked.groupBy("bucket").applyInArrow(freed(run), BLOCKS)


def with_answers(table: DataFrame, answers: DataFrame, schema: T.StructType | str,
                 work: Callable[[str, pa.RecordBatch, dict[int, list[np.ndarray]]], pa.Table]
                 ) -> DataFrame:
    """Bring each block and its answers together: ``work(block, its rows, answers by bucket)``."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        told = {int(b.as_py()): unpack(v.as_buffer())
                for b, v in zip(right["bucket"], right["payload"], strict=True)}
        return pa.concat_tables([work(b.as_py(), ipc_batch(v.as_buffer()), told)
                                 for b, v in zip(left["block"], left["payload"], strict=True)])

    blocks = table.filter(table["kind"] == "block")
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        freed(run), schema)


def more_asks(table: DataFrame, answers: DataFrame,
              ask: Callable[[pa.RecordBatch, dict[int, list[np.ndarray]]],
                            Iterable[tuple[str, int, bytes]]]) -> DataFrame:
    """What each block asks, now that it has its answers."""

    def work(block: str, batch: pa.RecordBatch, told: dict[int, list[np.ndarray]]) -> pa.Table:
        asked = [(kind, block, bucket, payload) for kind, bucket, payload in ask(batch, told)]
        return pa.Table.from_batches([rows(asked)] if asked else [], schema=_ROWS)

    return with_answers(table, answers, BLOCKS, work)
