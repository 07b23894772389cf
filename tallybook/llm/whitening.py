"""Embedding whitening by Jacobi-Davidson, without ever forming the covariance matrix.

Vectors become whole numbers, floor(256 c) of every entry. The *fit list* holds each distinct vector
once, as packed bytes, so a vector that a third of all rows repeat is collapsed before anything is
moved. The covariance V of the fit list is only ever applied: each task centres its vectors,
multiplies them with a few columns W and sends back its share of V W, a d x m array.

The leading eigenvectors come from a small search space on the driver (d x ``SPACE`` numbers):

* Rayleigh-Ritz in the search space gives Ritz vectors and their residuals;
* the leading one is *locked* once its residual is as small as double precision allows;
* each other vector of the block gets a correction from the projected equation
  (I - QQ')(V - theta I)(I - QQ') t = -r, Q being the locked and the current vectors, by a few steps
  of MINRES. All equations step together, so a step is one distributed product;
* corrections join the search space; a full one restarts from its leading Ritz vectors.

Rows whose vector is null, has null or non-finite entries, or entries of 2^44 or more, are
dropped; so are vectors of another length than most of the distinct ones have (the larger length of
two equally frequent ones). Repeated rows count once in the fit and are all transformed. Components
of eigenvalue zero (up to rounding) can't be whitened and are left out, so equal vectors, one
vector or none give a model without components; ``transform`` then gives empty arrays.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallybook.llm.frames import partitions, prepare, stored, trimmed, without

SCALE = 256
# Vectors beyond the wanted ones that are improved along with them; columns of the search space.
GUARD, SPACE = 4, 48
# MINRES steps of one correction, and corrections at most.
STEPS, ROUNDS = 4, 300
# Partial sums that are added up in one place.
FAN = 64
_LARGEST = float(1 << 44)
_EPS = float(np.finfo(np.float64).eps)


# -- vectors as whole numbers ----------------------------------------------------------------

def _whole(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, their vectors as whole numbers), one matrix for each length of vectors."""
    rows = np.flatnonzero(np.asarray(column.is_valid()))
    column = column.drop_null()
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    entries = column.flatten()
    missing = np.asarray(entries.is_null())
    values = pc.cast(entries, pa.float64(), safe=False).fill_null(0.0).to_numpy(
        zero_copy_only=False)
    bad = missing | ~(np.abs(values) < _LARGEST)
    starts = np.cumsum(lengths) - lengths
    sums = np.concatenate(([0], np.cumsum(bad)))
    good = sums[starts + lengths] == sums[starts]
    for length in np.unique(lengths[good & (lengths > 0)]).tolist():
        some = np.flatnonzero(good & (lengths == length))
        chosen = values[starts[some][:, None] + np.arange(length)]
        yield rows[some], np.floor(SCALE * chosen).astype(np.int64)


def _packed(vectors: np.ndarray) -> pa.Array:
    """Vectors as bytes: an entry's size, then the entries. Equal vectors have equal bytes."""
    least, most = vectors.min(axis=1), vectors.max(axis=1)
    parts, order = [], []
    left = np.ones(len(vectors), bool)
    for size in (1, 2, 4, 8):
        edge = 1 << (8 * size - 1)
        some = np.flatnonzero(left & (least >= -edge) & (most <= edge - 1))
        left[some] = False
        if len(some):
            raw = np.full((len(some), 1 + size * vectors.shape[1]), size, np.uint8)
            raw[:, 1:] = vectors[some].astype(f"<i{size}").view(np.uint8).reshape(len(some), -1)
            parts.append(pa.FixedSizeBinaryArray.from_buffers(
                pa.binary(raw.shape[1]), len(some), [None, pa.py_buffer(raw)]).cast(pa.binary()))
            order.append(some)
    at = np.argsort(np.concatenate(order), kind="stable")
    return pa.concat_arrays(parts).take(pa.array(at))


def _unpacked(column: pa.Array, length: int) -> np.ndarray:
    """Vectors of one length from their bytes, as doubles. Their order is not kept."""
    size = (pc.binary_length(column).to_numpy(zero_copy_only=False) - 1) // length
    out = []
    for one in np.unique(size).tolist():
        some = column.filter(pa.array(size == one))
        raw = np.frombuffer(b"".join(some.to_pylist()), np.uint8).reshape(len(some), -1)
        entries = np.ascontiguousarray(raw[:, 1:]).view(f"<i{one}")
        out.append(entries.astype(np.float64))
    return np.concatenate([np.empty((0, length)), *out])


def fit_list(df: DataFrame, vector: str) -> tuple[DataFrame, int]:
    """Each distinct vector once, packed, in a written table; and the vectors' length (0: none)."""
    prepare(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, vectors in _whole(batch.column(0)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(vectors), vectors.shape[1], np.int32)),
                     _packed(vectors)], names=["length", "packed"])

    found = df.select(df[f"`{vector}`"]).mapInArrow(
        trimmed(run), "length int, packed binary").distinct()
    table = stored(found, "fit-list")
    lengths = table.groupBy("length").count().collect()
    length = max(((r["count"], r["length"]) for r in lengths), default=(0, 0))[1]
    return table.filter(table["length"] == length).select("packed"), length


# -- sums over the fit list --------------------------------------------------------------------

def _total(table: DataFrame, length: int, share: Callable[[np.ndarray], np.ndarray],
           shape: tuple[int, ...]) -> np.ndarray:
    """The sum of ``share(vectors)`` over all vectors. Tasks add up their own; ``FAN`` of these
    meet in a task at a time, and no more than that many come to the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            total += share(_unpacked(batch.column(0), length))
        yield _sent(total)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            for value in batch.column(0):
                total += np.frombuffer(value.as_buffer()).reshape(shape)
        yield _sent(total)

    tasks = partitions(table)
    parts = table.mapInArrow(trimmed(run), "share binary")
    while tasks > FAN:
        tasks = -(-tasks // FAN)
        parts = parts.repartition(tasks).mapInArrow(add, "share binary")
    shares = [np.frombuffer(bytes(r["share"])).reshape(shape) for r in parts.collect()]
    return np.sum(shares, axis=0) if shares else np.zeros(shape)


def _sent(total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["share"])


# -- eigenvectors ------------------------------------------------------------------------------

Product = Callable[[np.ndarray], np.ndarray]


def _against(basis: np.ndarray, block: np.ndarray) -> np.ndarray:
    """An orthonormal block for what of ``block`` is orthogonal to the orthonormal basis. Columns
    that leave nothing go."""
    out = basis[:, :0]
    for column in block.T:
        size = np.linalg.norm(column)
        if not np.isfinite(size) or size == 0:
            continue
        column = column / size
        for _ in range(3):
            column = column - basis @ (basis.T @ column) - out @ (out.T @ column)
            left = np.linalg.norm(column)
            if left < 1e-10:
                break
            column = column / left
        else:
            out = np.column_stack([out, column])
    return out


def minres(product: Product, shifts: np.ndarray, basis: np.ndarray, right: np.ndarray,
           tolerance: float, steps: int = STEPS) -> np.ndarray:
    """Approximate solutions t of (I - QQ')(V - shift I)(I - QQ') t = right, one for each column;
    Q is the orthonormal ``basis``. A step applies V once to the columns that are not yet good."""
    def projected(block: np.ndarray) -> np.ndarray:
        return block - basis @ (basis.T @ block)

    m = right.shape[1]
    out = np.zeros_like(right)
    old = last = projected(right)
    beta = first = np.linalg.norm(last, axis=0)
    before = np.ones(m)
    dbar, epsilon, sine = np.zeros(m), np.zeros(m), np.zeros(m)
    cosine, phi_bar = -np.ones(m), beta.copy()
    w = w_last = np.zeros_like(right)
    going = first > 0
    for step in range(steps):
        if not going.any():
            break
        v = np.where(going, last / np.where(beta > 0, beta, 1), 0.0)
        y = np.zeros_like(v)
        y[:, going] = projected(product(v[:, going]) - v[:, going] * shifts[going])
        if step:
            y = y - old * (beta / before)
        alpha = np.sum(v * y, axis=0)
        y = projected(y - last * np.where(beta > 0, alpha / np.where(beta > 0, beta, 1), 0.0))
        old, last = last, y
        before, beta = np.where(beta > 0, beta, 1), np.linalg.norm(y, axis=0)
        old_epsilon, delta = epsilon, cosine * dbar + sine * alpha
        gamma_bar = sine * dbar - cosine * alpha
        epsilon, dbar = sine * beta, -cosine * beta
        gamma = np.maximum(np.hypot(gamma_bar, beta), _EPS * np.maximum(np.abs(shifts), 1e-300))
        cosine, sine = gamma_bar / gamma, beta / gamma
        phi, phi_bar = cosine * phi_bar, sine * phi_bar
        w, w_last = np.where(going, (v - w_last * old_epsilon - w * delta) / gamma, 0.0), w
        out = out + w * np.where(going, phi, 0.0)
        going = going & (phi_bar > tolerance * first) & (beta > _EPS * np.abs(shifts))
    return out


def leading(product: Product, length: int, wanted: int, trace: float, seed: int = 1
            ) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit eigenvectors, of a positive semidefinite
    matrix of this order that is known by its products only."""
    wanted = min(wanted, length)
    block = min(length, wanted + GUARD)
    space = max(SPACE, 3 * block)
    goal = max(length, 64) * _EPS
    drawn = np.random.default_rng(seed).standard_normal((length, block))
    basis = _against(np.empty((length, 0)), drawn)
    image = product(basis)
    locked, values = np.empty((length, 0)), []
    smallest, stalled = np.inf, 0
    for turn in range(ROUNDS):
        inner = basis.T @ image
        theta, turned = np.linalg.eigh((inner + inner.T) / 2)
        theta, turned = theta[::-1], turned[:, ::-1]
        basis, image = basis @ turned, image @ turned
        size = max([theta[0], *values, trace * _EPS])
        residual = image - basis * theta
        residual -= locked @ (locked.T @ residual)
        sizes = np.linalg.norm(residual, axis=0)
        whole = basis.shape[1] + locked.shape[1] == length
        stalled = 0 if sizes[0] < smallest / 2 else stalled + 1
        smallest = min(smallest, sizes[0])
        # Rounding may not let a residual get any smaller.
        near = goal * size if stalled < 4 and not whole else max(goal, 1e-12) * size
        while len(values) < wanted and basis.shape[1] and sizes[0] <= near:
            locked = np.column_stack([locked, _against(locked, basis[:, :1])])
            values.append(float(theta[0]))
            basis, image, theta = basis[:, 1:], image[:, 1:], theta[1:]
            residual, sizes = residual[:, 1:], sizes[1:]
            smallest, stalled = np.inf, 0
        if len(values) == wanted:
            order = np.argsort(values)[::-1]
            return np.array(values)[order], locked[:, order]
        if basis.shape[1] > space - block:
            basis, image = basis[:, :2 * block], image[:, :2 * block]
        active = slice(0, min(block - len(values), basis.shape[1]))
        known = np.column_stack([locked, basis[:, active]])
        found = minres(product, theta[active], known, -residual[:, active], 2.0 ** -(turn + 1))
        everything = np.column_stack([locked, basis])
        fresh = _against(everything, found)
        if not fresh.shape[1] and everything.shape[1] < length:
            fresh = _against(everything, np.random.default_rng(seed + turn + 1).standard_normal(
                (length, 1)))
        if fresh.shape[1]:
            basis, image = (np.column_stack([basis, fresh]),
                            np.column_stack([image, product(fresh)]))
    raise RuntimeError(f"residual {smallest:.2e} after {ROUNDS} rounds")


# -- the model -----------------------------------------------------------------------------------

@dataclass(frozen=True)
class Whitening:
    """What ``fit`` learns: distinct vectors, their sums per dimension, components in columns with
    their eigenvalues, the trace of V, and how far the whitened covariance is from the identity."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float

    @property
    def explained(self) -> list[float]:
        return [float(e) / self.trace for e in self.eigenvalues]


def fit(df: DataFrame, vector: str = "embedding", components: int = 4) -> Whitening:
    """Learn up to so many components from the distinct vectors of a column."""
    table, length = fit_list(df, vector)
    n = table.count()
    if not n:
        return Whitening(0, np.zeros(0, np.int64), np.zeros((0, 0)), np.zeros(0), 0.0, 0.0)
    sums = _exact_sums(table, length)
    mean = np.array([int(s) / n for s in sums])

    def squares(vectors: np.ndarray) -> np.ndarray:
        return np.square(vectors - mean).sum(axis=0)

    trace = float(_total(table, length, squares, (length,)).sum() / n)

    def product(block: np.ndarray) -> np.ndarray:
        def share(vectors: np.ndarray) -> np.ndarray:
            centred = vectors - mean
            return centred.T @ (centred @ block)

        return _total(table, length, share, block.shape) / n

    values, found = np.zeros(0), np.zeros((length, 0))
    if trace > 0:
        values, found = leading(product, length, components, trace)
        some = values > max(length, 64) * _EPS * trace
        values, found = values[some], found[:, some]
        # Either sign will do; the largest entry is positive.
        top = np.abs(found).argmax(axis=0)
        found = found * np.where(found[top, np.arange(found.shape[1])] < 0, -1.0, 1.0)
    k = len(values)

    def spread(vectors: np.ndarray) -> np.ndarray:
        white = ((vectors - mean) @ found) / np.sqrt(values)
        return np.vstack([white.T @ white, white.sum(axis=0)])

    error = 0.0
    if k:
        sums_of = _total(table, length, spread, (k + 1, k)) / n
        covariance = sums_of[:k] - np.outer(sums_of[k], sums_of[k])
        error = float(np.abs(covariance - np.eye(k)).max())
    return Whitening(n, sums, found, values, trace, error)


def _exact_sums(table: DataFrame, length: int) -> np.ndarray:
    """Sums per dimension: of high and low parts, each a double that is exact up to 2^33 vectors."""
    def share(vectors: np.ndarray) -> np.ndarray:
        high = np.floor(vectors / (1 << 20))
        return np.vstack([high.sum(axis=0), (vectors - high * (1 << 20)).sum(axis=0)])

    high, low = _total(table, length, share, (2, length))
    return np.array([int(h) * (1 << 20) + int(b) for h, b in zip(high, low, strict=True)], object)


def transform(df: DataFrame, model: Whitening, vector: str = "embedding",
              whitened: str = "whitened", deviation: str = "deviation") -> DataFrame:
    """The rows that have a vector of the model's length, with their whitened components
    (array<double>) and their deviation: the sum over dimensions of (n x - S)^2, exact; null if it
    is no long. Columns of these names are replaced."""
    prepare(df.sparkSession)
    df = without(df, [whitened, deviation])
    schema = T.StructType([*df.schema.fields,
                           T.StructField(whitened, T.ArrayType(T.DoubleType(), False), False),
                           T.StructField(deviation, T.LongType())])
    at, names = df.columns.index(vector), schema.fieldNames()
    n, length = model.n, len(model.sums)
    mean = np.array([int(s) / n for s in model.sums])
    # Sums of products are right modulo 2^64, hence right wherever the result is a long.
    low = np.array([(int(s) + (1 << 63)) % (1 << 64) - (1 << 63) for s in model.sums], np.int64)
    scale = np.sqrt(model.eigenvalues)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, vectors in _whole(batch.column(at)):
                if vectors.shape[1] != length:
                    continue
                centred = vectors - mean
                white = (centred @ model.components) / scale
                with np.errstate(over="ignore"):
                    off = np.int64(n) * vectors - low
                    exact = (off * off).sum(axis=1)
                far = np.square(n * centred).sum(axis=1) >= float(1 << 63) * (1 - 1e-9)
                offsets = np.arange(len(rows) + 1, dtype=np.int32) * white.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [*batch.take(pa.array(rows)).columns,
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(white.ravel())),
                     pa.array(exact, mask=far)], names=names)

    return df.mapInArrow(trimmed(run), schema)
