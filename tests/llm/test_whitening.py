"""Jacobi-Davidson whitening against a dense eigensolver, and on odd vectors."""

import math

import numpy as np
import pytest

from tallybook.llm import catalog, whitening

VECTORS = "vec_id long, embedding array<float>, Whitened string, label int"


def plain_fit(vectors, components):
    """Distinct whole vectors, their dense covariance and its leading eigenvectors."""
    x = np.array(sorted({tuple(math.floor(256 * c) for c in v) for v in vectors}), float)
    covariance = np.cov(x.T, bias=True).reshape(x.shape[1], x.shape[1])
    values, found = np.linalg.eigh(covariance)
    return len(x), x, values[::-1][:components], found[:, ::-1][:, :components], np.trace(covariance)


def compare_with_plain(spark, rows, model_of, tolerance):
    df = spark.createDataFrame([(i, v, "clash", 0) for i, v in rows], VECTORS).repartition(3)
    model = whitening.fit(df, components=model_of)
    length = len(model.sums)
    good = [(i, v) for i, v in rows if v is not None and len(v) == length
            and all(c is not None and math.isfinite(c) for c in v)]
    n, x, values, found, trace = plain_fit([v for _, v in good], model_of)
    assert model.n == n and [int(s) for s in model.sums] == x.sum(axis=0).tolist()
    assert model.eigenvalues == pytest.approx(values, rel=1e-12)
    assert model.explained == pytest.approx(values / trace, rel=1e-12)
    assert model.identity_error < 1e-10
    out = whitening.transform(df, model).collect()
    assert sorted(r["vec_id"] for r in out) == sorted(i for i, _ in good)
    by_id = dict(good)
    sums = x.sum(axis=0)
    signs = np.sign((found * model.components).sum(axis=0))
    for r in out:
        own = np.array([math.floor(256 * c) for c in by_id[r["vec_id"]]])
        exact = sum((n * int(a) - int(s)) ** 2 for a, s in zip(own, sums, strict=True))
        assert r["deviation"] == (exact if exact < 1 << 63 else None)
        white = ((own - sums / n) @ found) * signs / np.sqrt(values)
        assert r["whitened"] == pytest.approx(white, abs=tolerance)


def test_against_a_dense_solver(spark):
    draw = np.random.default_rng(3)
    scale = np.linspace(0.5, 0.05, 24)
    rows = [(k, [float(c) for c in (draw.standard_normal(24) * scale).astype(np.float32)])
            for k in range(400)]
    rows += [(1000 + k, rows[7][1]) for k in range(300)]  # a hot vector
    rows += [(2000, None), (2001, [None] * 24), (2002, [float("nan")] * 24),
             (2003, [float("inf")] + [0.0] * 23), (2004, []), (2005, [0.1, 0.2]),
             (2006, [-0.0] * 24)]
    compare_with_plain(spark, rows, 4, 1e-8)


def test_large_entries_and_few_dimensions(spark):
    rows = [(k, [float(np.float32(c)) for c in (3e6 * k * k, 1e9 * (k % 5), 3e8 * (k * 7 % 11))])
            for k in range(20)]
    compare_with_plain(spark, rows, 4, 1e-8)
    huge = spark.createDataFrame([(1, [1e30]), (2, [1.0]), (3, [2.0])],
                                 "vec_id long, embedding array<double>")
    assert whitening.fit(huge).n == 2


@pytest.mark.parametrize("rows", [
    [], [(1, None)], [(1, [])], [(1, [0.5, 0.25])], [(1, [0.5, 0.25]), (2, [0.5, 0.25])]])
def test_nothing_to_whiten(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    model = whitening.fit(df)
    assert model.components.shape[1] == 0
    out = whitening.transform(df, model).collect()
    assert len(out) == sum(v is not None and len(v) == 2 for _, v in rows)
    assert all(r["whitened"] == [] for r in out)


def test_zero_eigenvalues_are_left_out(spark):
    rows = [(k, [k / 8, k / 4, 1.0, 0.0]) for k in range(10)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert whitening.fit(df).components.shape == (4, 1)


@pytest.mark.parametrize("spread", ["flat", "steep", "equal", "pairs"])
def test_eigenvectors_of_hard_spectra(spread):
    d = 90
    values = {"flat": 1 + np.linspace(0, 1e-3, d), "steep": 10.0 ** np.linspace(-9, 3, d),
              "equal": np.full(d, 2.5), "pairs": np.repeat(np.arange(1, d // 2 + 1), 2)}[spread]
    turn = np.linalg.qr(np.random.default_rng(8).standard_normal((d, d)))[0]
    matrix = (turn * values) @ turn.T
    found, vectors = whitening.leading(lambda b: matrix @ b, d, 4, float(values.sum()))
    assert found == pytest.approx(np.sort(values)[::-1][:4], rel=1e-12)
    assert np.linalg.norm(matrix @ vectors - vectors * found, axis=0).max() < 1e-12 * found[0]
    assert vectors.T @ vectors == pytest.approx(np.eye(4), abs=1e-13)


def test_minres_solves_the_projected_equation():
    draw = np.random.default_rng(1)
    matrix = draw.standard_normal((30, 30))
    matrix = matrix + matrix.T
    basis = np.linalg.qr(draw.standard_normal((30, 3)))[0]
    right = draw.standard_normal((30, 2))
    right -= basis @ (basis.T @ right)
    shifts = np.array([0.3, -1.1])
    found = whitening.minres(lambda b: matrix @ b, shifts, basis, right, 1e-13, 200)
    flat = np.eye(30) - basis @ basis.T
    for k in range(2):
        system = flat @ (matrix - shifts[k] * np.eye(30)) @ flat
        assert system @ found[:, k] == pytest.approx(right[:, k], abs=1e-9)


def test_query_against_a_dense_solver(spark):
    path = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{path}/embeddings.parquet").collect()
    out = catalog.op11_whitening(spark, path).collect()
    n, x, values, found, trace = plain_fit([r["embedding"] for r in rows], 4)
    assert len(out) == 4 * len(rows) and {r["n"] for r in out} == {n}
    white = {r["vec_id"]: np.array([math.floor(256 * c) for c in r["embedding"]]) - x.mean(axis=0)
             for r in rows}
    sign = {}
    for r in out:
        k = r["component"] - 1
        expected = float(white[r["vec_id"]] @ found[:, k] / math.sqrt(values[k]))
        if abs(expected) > 1e-3:
            sign.setdefault(k, math.copysign(1, expected * r["whitened"]))
            assert r["whitened"] * sign[k] == pytest.approx(expected, rel=1e-6)
        assert r["explained"] == pytest.approx(values[k] / trace, rel=1e-10)
        assert 0 <= r["identity_error"] < 1e-9
