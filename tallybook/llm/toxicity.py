"""Toxicity: a linear classifier on character n-grams, scaled by naive Bayes log-count ratios.

A text's features are the distinct hashed n-grams of its folded characters. A feature's scale is
the log ratio of its smoothed share of toxic and of clean training texts; logistic regression on
the scaled features gives their weights. Only the features that tell the classes apart best are
kept, so scoring is a table look-up per n-gram and a sum over the distinct ones that are left.

Learning takes a bounded sample of labelled documents, ``SAMPLE`` a class by hash, balanced so that
the rare class is seen well; the intercept then puts the true share of toxic labels back. Sampled
are distinct ids that a document has, so a label that is repeated, however often, counts once, and
one without a document takes no place; an id labelled both ways counts in both classes. The ids
are few, so they are broadcast, and only sampled texts are shuffled. Documents that share an id
are seen once, by the smallest of their texts.

Null and empty texts have no features and get the score of the intercept. Labels other than 0 and
1, null labels and labels of missing documents are passed over. With only one class labelled, every
score is that class's; with no labels, 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.llm import words
from tallybook.llm.frames import appended, prepare, stored, trimmed

# The most labelled documents of a class that the classifier is fitted on.
SAMPLE = 4000
# Tasks that count its features; the sample being bounded, so is their work.
SAMPLE_TASKS = 8
HASH_BITS = 18
SIZES = (3, 4, 5, 6)
KEPT = 4096
LEAST_GAP = 3.5
SMOOTHING = 1.0
RIDGE = 1e-3
ROUNDS = 300

_FOLD = np.full(256, 32, np.uint64)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[48:58] = np.arange(48, 58)
_FOLD[128:] = np.arange(128, 256)


def _grams(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, feature) of all n-grams of each size, texts being padded by a blank at both ends."""
    n = len(offsets) - 1
    padded = np.full(len(data) + 2 * n, 32, np.uint64)
    row = np.repeat(np.arange(n, dtype=np.int64), np.diff(offsets) + 2)
    inner = np.arange(len(data)) + 1 + 2 * np.repeat(np.arange(n), np.diff(offsets))
    padded[inner] = _FOLD[data]
    code = padded.copy()
    for size in range(2, max(SIZES) + 1):
        if len(code) < 2:
            return
        code = (code[:-1] << np.uint64(8)) | padded[size - 1:]
        if size in SIZES:
            at = (code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - HASH_BITS)
            same = row[:len(code)] == row[size - 1:]
            yield row[:len(code)][same], at[same].astype(np.int64)


def _present(data: np.ndarray, offsets: np.ndarray, wanted: np.ndarray | None
             ) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, feature), in order; only features marked in ``wanted``, if given."""
    keys = [np.empty(0, np.uint64)]
    for row, at in _grams(data, offsets):
        if wanted is not None:
            some = wanted[at]
            row, at = row[some], at[some]
        keys.append((row.astype(np.uint64) << np.uint64(HASH_BITS)) | at.astype(np.uint64))
    found = np.sort(np.concatenate(keys))
    found = found[words.distinct(found)]
    return ((found >> np.uint64(HASH_BITS)).astype(np.int64),
            (found & np.uint64((1 << HASH_BITS) - 1)).astype(np.int64))


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # by feature; 0 if it isn't kept
    intercept: float

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        row, at = _present(data, offsets, self.weights != 0)
        total = np.bincount(row, self.weights[at], minlength=len(offsets) - 1)
        return 1 / (1 + np.exp(-np.clip(total + self.intercept, -30, 30)))


def _labelled(docs: DataFrame, labels: DataFrame, doc_id: str, label: str) -> DataFrame:
    """(id, label), each once, of the labels 0 and 1 whose id a document has. An id that is labelled
    both ways is there twice."""
    ids = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label")).filter(
        F.col("id").isNotNull() & F.col("label").isin(0, 1)).distinct()
    return stored(ids.join(docs.select(F.col(doc_id).alias("id")).distinct(), "id", "left_semi"),
                  "labelled-ids")


def _sample(ids: DataFrame, size: int) -> DataFrame:
    """At most ``size`` labelled ids of each class, spread by hash."""
    picked = [ids.filter(F.col("label") == k).orderBy(F.xxhash64("id"), "id").limit(size)
              for k in (0, 1)]
    return picked[0].unionByName(picked[1])


def _fit_logistic(rows: np.ndarray, features: np.ndarray, scale: np.ndarray, labels: np.ndarray
                  ) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by accelerated gradient steps on scaled presence features."""
    n, d = len(labels), len(scale)
    value = scale[features]
    # The largest curvature of the loss, by power iteration, gives the step.
    probe, size = np.ones(d + 1), 1.0
    for _ in range(30):
        probe /= np.linalg.norm(probe)
        image = np.bincount(rows, probe[:d][features] * value, minlength=n) + probe[d]
        probe = np.append(np.bincount(features, image[rows] * value, minlength=d), image.sum())
        size = float(np.linalg.norm(probe))
    step = 1 / (0.3 * size / n + RIDGE)
    w, b, vw, vb = np.zeros(d), 0.0, np.zeros(d), 0.0
    for k in range(ROUNDS):
        momentum = k / (k + 3)
        tw, tb = w + momentum * vw, b + momentum * vb
        z = np.bincount(rows, tw[features] * value, minlength=n) + tb
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels) / n
        gw = np.bincount(features, error[rows] * value, minlength=d) + RIDGE * tw
        nw, nb = tw - step * gw, tb - step * error.sum()
        vw, vb, w, b = nw - w, nb - b, nw, nb
    return w, b


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id",
        label: str = "toxic", sample: int = SAMPLE) -> Model:
    spark = prepare(docs.sparkSession)
    d = 1 << HASH_BITS
    labelled = _labelled(docs, labels, doc_id, label)
    shares = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(
        F.count("*").alias("n")).collect()}
    if len(shares) < 2:
        return Model(np.zeros(d), 30.0 if 1 in shares else -30.0)
    picked = sorted((r["id"], r["label"]) for r in _sample(labelled, sample).collect())
    ids = spark.createDataFrame(picked, "id long, label int")
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(
        F.broadcast(ids), "id")
    # One row an id and label, however many rows of documents share the id.
    rows = rows.groupBy("id", "label").agg(F.min("text").alias("text")).select(
        "label", "text").repartition(SAMPLE_TASKS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, d), np.int32)
        for batch in batches:
            truth = batch.column(0).to_numpy()
            for i, j, data, offsets in words.sliced(batch.column(1)):
                row, at = _present(data, offsets, None)
                for k in (0, 1):
                    sums[k] += np.bincount(at[truth[i:j][row] == k], minlength=d).astype(np.int32)
        # A feature seen once in a task and nowhere else can't be among those kept.
        some = np.flatnonzero(sums.sum(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(sums[0, some]), pa.array(sums[1, some])],
            names=["feature", "clean", "toxic"])

    # Features that too few texts have say nothing; the rest is bounded by the hash size.
    total = rows.mapInArrow(trimmed(count), "feature int, clean int, toxic int").groupBy("feature").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    n0, n1 = (max(1, sum(k == c for _, k in picked)) for c in (0, 1))
    p = (F.col("toxic") + F.lit(SMOOTHING)) / F.lit(n1 + 2 * SMOOTHING)
    q = (F.col("clean") + F.lit(SMOOTHING)) / F.lit(n0 + 2 * SMOOTHING)
    ratio = F.log(p) - F.log(q)
    # Told apart by how unlikely the difference is by chance.
    spread = F.sqrt((p + q) / 2 * (1 - (p + q) / 2) * F.lit(1 / n0 + 1 / n1))
    best = (total.filter(F.col("clean") + F.col("toxic") >= 5)
            .select("feature", ratio.alias("ratio"), F.abs((p - q) / spread).alias("gap"))
            .filter(F.col("gap") >= LEAST_GAP)
            .orderBy(F.col("gap").desc(), "feature").limit(KEPT).collect())
    prior = float(np.log(shares[1] / shares[0]) - np.log(n1 / n0))
    if not best:
        return Model(np.zeros(d), float(np.clip(np.log(shares[1] / shares[0]), -30, 30)))
    features = np.array(sorted(r["feature"] for r in best))
    ratios = {r["feature"]: r["ratio"] for r in best}
    scale = np.array([ratios[f] for f in features.tolist()])
    wanted = np.zeros(d, bool)
    wanted[features] = True
    packed = spark.sparkContext.broadcast(np.packbits(wanted))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = np.unpackbits(packed.value).astype(bool)
        for batch in batches:
            for i, j, data, offsets in words.sliced(batch.column(1)):
                row, at = _present(data, offsets, keep)
                cuts = np.searchsorted(row, np.arange(j - i + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i),
                     pa.array([at[a:b].astype(np.int32).tobytes()
                               for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())],
                    names=["label", "features"])

    examples = rows.mapInArrow(trimmed(extract), "label int, features binary").collect()
    truth = np.array([r["label"] for r in examples], float)
    found = [np.frombuffer(r["features"], np.int32) for r in examples]
    owner = np.repeat(np.arange(len(found)), [len(f) for f in found])
    column = np.searchsorted(features, np.concatenate([np.empty(0, np.int32), *found]))
    weights, intercept = _fit_logistic(owner, column, scale, truth)
    full = np.zeros(d)
    full[features] = weights * scale
    return Model(full, intercept + prior)


def score(df: DataFrame, model: Model, text: str = "text", output: str = "score") -> DataFrame:
    """Add the probability (0 to 1) that each whole text is toxic."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        column = batch.column(batch.schema.get_field_index(text))
        parts = [shared.value.score(data, offsets)
                 for _, _, data, offsets in words.sliced(column)]
        return [pa.array(np.concatenate([np.empty(0), *parts]))]

    return appended(df, [T.StructField(output, T.DoubleType())], compute)
