"""Language identification by error-correcting output codes.

Every language gets a codeword. For each bit, a binary n-gram classifier tells the languages whose
codeword has a one from the others: naive Bayes over hashed byte n-grams, its weights being log
ratios of the two sides' n-gram shares, each language counting alike whatever its number of texts.
Loss-weighted decoding sums, for each codeword, the logistic loss of all bits' margins, bits
weighted by how well they separate the training languages, and takes the codeword of least loss.
A text whose two best codewords are nearly as good as each other is flagged as ambiguous.

Training is one aggregation: n-gram counts by language, summed on the map side over all rows.
What comes to the driver is one array a language and hash size, whatever the number of texts.

Null text, or text without a letter: language ``und``, score 0, not ambiguous. Training rows with
null language or text are passed over; with no training language at all every text is ``und``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.llm import words
from tallybook.llm.frames import appended, prepare, trimmed

UNKNOWN = "und"
HASH_BITS = 13
SIZES = (1, 2, 3)
SLICE_BYTES = 1 << 18
# Texts whose n-gram counts are held at once, however short they are.
SLICE_ROWS = 64
# Margins are mean log ratios per n-gram; this many n-grams' worth is the most a text counts for.
EVIDENCE = 40.0
AMBIGUOUS_BELOW = 0.6
_LETTER = regex.compile(r"\p{L}")

# Bytes as n-grams see them: letters in lower case, everything else one blank.
_FOLD = np.full(256, 32, np.uint32)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def _features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of hashed n-grams, a row for each text. N-grams don't cross texts."""
    n, d = len(offsets) - 1, 1 << HASH_BITS
    total = np.zeros(n * d)
    folded = _FOLD[data]
    row = np.repeat(np.arange(n, dtype=np.int64) * d, np.diff(offsets))
    code = folded.copy()
    for size in range(1, max(SIZES) + 1):
        if size > 1:
            if len(code) < 2:
                break
            code = (code[:-1] << np.uint32(8)) | folded[size - 1:]
        if size not in SIZES:
            continue
        at = (code * np.uint32(0x9E3779B1) + np.uint32(size * 0x05EBCA6B)) >> np.uint32(
            32 - HASH_BITS)
        flat = row[:len(code)] + at
        if size > 1:
            flat = flat[row[:len(code)] == row[size - 1:]]
        total += np.bincount(flat, minlength=n * d)
    return total.reshape(n, d)


def _slices(batch: pa.RecordBatch, text: str):
    return words.sliced(batch.column(batch.schema.get_field_index(text)), SLICE_BYTES,
                        SLICE_ROWS)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    codes: np.ndarray       # language x bit, +1 or -1
    weights: np.ndarray     # n-gram x bit
    importance: np.ndarray  # bit


def codewords(count: int) -> np.ndarray:
    """All splits of few languages, or a fixed random code of 8 log2(count) bits for many."""
    if count < 2:
        return np.ones((count, 0))
    if count <= 6:
        splits = range(1, 1 << (count - 1))
        return np.array([[1.0 if s >> k & 1 else -1.0 for s in splits] for k in range(count)])
    draw = np.random.default_rng(count)
    bits = math.ceil(8 * math.log2(count))
    best, best_gap = np.empty(0), -1
    for _ in range(50):
        code = draw.choice([-1.0, 1.0], (count, bits))
        mixed = bool((np.abs(code.sum(axis=0)) < count).all())
        agree = code @ code.T - 2 * bits * np.eye(count)
        gap = int((bits - agree.max()) // 2) if mixed else -1
        if gap > best_gap:
            best, best_gap = code, gap
    return best


def fit(df: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Learn from every row that has a text and a language."""
    prepare(df.sparkSession)
    labelled = df.select(F.col(lang).alias("lang"), F.col(text).alias("text")).filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            names = np.array(batch.column(0).to_pylist(), object)
            for i, j, data, offsets in _slices(batch, "text"):
                counts = _features(data, offsets)
                for name in set(names[i:j]):
                    add = counts[names[i:j] == name].sum(axis=0)
                    sums[name] = sums[name] + add if name in sums else add
        if sums:
            at = np.arange(1 << HASH_BITS, dtype=np.int32)
            for name, counts in sums.items():
                some = counts > 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * int(some.sum()), pa.string()), pa.array(at[some]),
                     pa.array(counts[some])], names=["lang", "feature", "n"])

    totals = (labelled.mapInArrow(trimmed(count), "lang string, feature int, n double")
              .groupBy("lang", "feature").agg(F.sum("n").alias("n"))
              .groupBy("lang").agg(F.collect_list(F.struct("feature", "n")).alias("counts")))
    found = sorted(totals.collect(), key=lambda r: r["lang"])
    languages = [r["lang"] for r in found]
    d = 1 << HASH_BITS
    shares = np.zeros((len(found), d))
    for k, r in enumerate(found):
        for feature, n in r["counts"]:
            shares[k, feature] = n
    shares = (shares + 0.5) / (shares.sum(axis=1, keepdims=True) + 0.5 * d)
    codes = codewords(len(languages))
    bits = codes.shape[1]
    weights, importance = np.zeros((d, bits)), np.zeros(bits)
    for b in range(bits):
        one, other = codes[:, b] > 0, codes[:, b] < 0
        weights[:, b] = np.log(shares[one].mean(axis=0)) - np.log(shares[other].mean(axis=0))
        # What a text of each language is expected to say for its own side; the weakest counts.
        importance[b] = max(1e-3, float((shares @ weights[:, b] * codes[:, b]).min()))
    return Model(languages, codes, weights, importance / importance.sum() if bits else importance)


def _decode(model: Model, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest codeword, and its share against the others."""
    if len(model.languages) == 1:
        return np.zeros(len(counts), np.int64), np.ones(len(counts))
    n = counts.sum(axis=1, keepdims=True)
    margins = counts @ model.weights / np.maximum(n, 1) * np.minimum(n, EVIDENCE)
    loss = np.logaddexp(0, -margins[:, None, :] * model.codes[None]) @ model.importance
    share = np.exp(-len(model.importance) * (loss - loss.min(axis=1, keepdims=True)))
    share /= share.sum(axis=1, keepdims=True)
    best = loss.argmin(axis=1)
    return best, share[np.arange(len(best)), best]


def predict(df: DataFrame, model: Model, text: str = "text", output: str = "lang_pred",
            score: str = "score", flag: str = "ambiguous") -> DataFrame:
    """Add language, score (0 to 1) and ambiguity of each whole text."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        fitted = shared.value
        values = batch.column(batch.schema.get_field_index(text))
        lettered = np.array([bool(v) and _LETTER.search(v) is not None
                             for v in values.to_pylist()], bool)
        names, scores = np.full(batch.num_rows, UNKNOWN, object), np.zeros(batch.num_rows)
        if fitted.languages:
            for i, j, data, offsets in _slices(batch, text):
                best, share = _decode(fitted, _features(data, offsets))
                some = lettered[i:j]
                names[i:j][some] = np.array(fitted.languages, object)[best[some]]
                scores[i:j][some] = share[some]
        unsure = (names != UNKNOWN) & (scores < AMBIGUOUS_BELOW)
        return [pa.array(names, pa.string()), pa.array(scores), pa.array(unsure)]

    return appended(df, [T.StructField(output, T.StringType()),
                         T.StructField(score, T.DoubleType()),
                         T.StructField(flag, T.BooleanType())], compute)
