"""Fingerprints and toxicity scores against plain versions that share no code with the operators."""

import math
from collections import Counter

import numpy as np
import pytest
import xxhash

from tallybook.llm import imatch, toxicity
from tests.llm import plain
from tests.llm.test_operators import prose

MASK = (1 << 64) - 1


def signed(n):
    return n - (1 << 64) if n >> 63 else n


def hashed(data, seed=42):
    return signed(xxhash.xxh64(data, seed=seed & MASK).intdigest())


def long_hash(value, seed=42):
    return hashed((value & MASK).to_bytes(8, "little"), seed)


# -- I-Match -------------------------------------------------------------------------------

def terms(text):
    """The operator lower-cases all letters, not just A to Z."""
    return {hashed(w) for w in plain.words((text or "").lower(), lower=False)}


def subsets_of(term):
    """The numbers of the subsets that a term was dealt into: of density d, 2 ** (d + 1) are drawn
    from, and the first six are used."""
    out, first = set(), 0
    for d in range(8):
        drawn = hashed(d.to_bytes(4, "little"), long_hash(term)) % (2 << d)
        if drawn < 6:
            out.add(first + drawn)
        first += min(6, 2 << d)
    return out, first


def hashes(text, lexicon):
    found, own = {}, terms(text)
    for t in own & lexicon:
        for k in subsets_of(t)[0]:
            found[k] = found.get(k, 0) ^ long_hash(t)
    if found:
        return [found.get(k) for k in range(subsets_of(0)[1])]
    everything = 42
    for t in sorted(own):
        everything = long_hash(t, everything)
    return [everything]


def shown(values):
    return "".join("-" if v is None else f"{v & 0xFFFFFFFF:08x}" for v in values)


def alike(a, b):
    if a == b:
        return 1.0
    if len(a) != len(b):
        return 0.0
    some = [(x, y) for x, y in zip(a, b, strict=True) if x is not None or y is not None]
    return sum(x == y for x, y in some) / len(some)


def test_fingerprints_and_likeness(spark):
    """Rows of the table, and odd ones: empty, null, long, repeated, without a lexicon's term."""
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in table.select("doc_id", "text").limit(300).collect()
                  if r["text"] is not None)
    top = rows[-1][0]
    odd = [None, "", "  \t", "unheard of", rows[0][1], rows[0][1], " ".join(t for _, t in rows[:40])]
    rows += [(top + 1 + k, t) for k, t in enumerate(odd)]
    counts = Counter(t for _, text in rows for t in terms(text))
    lexicon = {t for t, n in counts.items() if 0.002 * len(rows) <= n <= 0.1 * len(rows)}
    got = {r["doc_id"]: r for r in imatch.edited_fingerprints(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got) == len(rows)
    for k, (d, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        cut = len(text) // 4
        own, new, following = (hashes(t, lexicon) for t in (
            text, text[:len(text) - cut] + after[:cut], after))
        assert got[d]["fingerprint"] == shown(own), d
        assert got[d]["edited_fingerprint"] == shown(new), d
        assert got[d]["near_edited"] == pytest.approx(alike(own, new)), d
        assert got[d]["near_next"] == pytest.approx(alike(own, following)), d


# -- toxicity ------------------------------------------------------------------------------

def features(text):
    """Distinct hashed n-grams of 3 to 6 bytes of the folded, padded text."""
    folded = bytes(c if c >= 128 or chr(c).isalnum() else 32
                   for c in (text or "").encode().translate(plain.LOWER))
    padded = b" " + folded + b" "
    return {(int.from_bytes(padded[i:i + n], "big") * 0x9E3779B97F4A7C15 & MASK) >> 46
            for n in (3, 4, 5, 6) for i in range(len(padded) - n + 1)}


def test_ratios_and_scores(spark):
    words = (("vile", "rotten", "scum"), ("calm", "kind", "friend"))
    rows = [(k, " ".join(words[k % 3 != 0]) + " " + prose(k % 11, 15)) for k in range(120)]
    labels = [(k, int(k % 3 == 0)) for k in range(120)]
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string"),
                         spark.createDataFrame(labels, "doc_id long, toxic int"))
    sets, truth = [features(t) for _, t in rows], [y for _, y in labels]
    sums = [Counter(f for s, y in zip(sets, truth, strict=True) if y == k for f in s)
            for k in (0, 1)]
    n0, n1 = truth.count(0), truth.count(1)
    ratio = {}
    for f in sums[0].keys() | sums[1].keys():
        p, q = (sums[1][f] + 1) / (n1 + 2), (sums[0][f] + 1) / (n0 + 2)
        mean = (p + q) / 2
        gap = abs(p - q) / math.sqrt(mean * (1 - mean) * (1 / n0 + 1 / n1))
        if sums[0][f] + sums[1][f] >= 5 and gap >= 3.5:
            ratio[f] = math.log(p) - math.log(q)
    assert 0 < len(ratio) < 4096 and set(np.flatnonzero(model.weights)) == set(ratio)

    # Where the ridge regression on the scaled features ends, its slope is nearly level.
    kept = sorted(ratio)
    x = np.array([[ratio[f] * (f in s) for f in kept] for s in sets])
    w = np.array([model.weights[f] / ratio[f] for f in kept])
    error = 1 / (1 + np.exp(-(x @ w + model.intercept))) - truth
    start = x.T @ (0.5 - np.array(truth)) / len(rows)
    slope = x.T @ error / len(rows) + 1e-3 * w
    assert np.abs(slope).max() < 0.01 * np.abs(start).max()

    odd = [None, "", "VILE!", "kind friend", "café scum " * 500]
    asked = spark.createDataFrame(list(enumerate([*odd, *[t for _, t in rows[:20]]])),
                                  "doc_id long, text string")
    for r in toxicity.score(asked, model).collect():
        total = model.intercept + sum(model.weights[f] for f in features(r["text"]))
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-9)
