"""Whitening against exact fractions; eigenvectors of matrices with clustered and equal eigenvalues."""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from affinia.llm import whitening

SCHEMA = "vec_id bigint, embedding array<double>, n string, deviation int, w int, v int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, 2, 3) for i, v in rows], SCHEMA)


def exact(rows, scale=1024, shift=100_000):
    """n, integer rows and covariance as fractions."""
    xs = [[int(np.floor(scale * c)) + shift for c in v] for v in rows]
    n, d = len(xs), len(xs[0])
    sums = [sum(x[i] for x in xs) for i in range(d)]
    off = [[n * x[i] - sums[i] for i in range(d)] for x in xs]
    cov = [[Fraction(sum(o[i] * o[j] for o in off), n**3) for j in range(d)] for i in range(d)]
    return off, cov


def check(spark, rows, components=8):
    """Compare with exact sums; eigenvectors are judged by what they must satisfy."""
    got = whitening.whiten(table(spark, rows), components).orderBy("vec_id", "component").collect()
    good = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    off, cov = exact([v for _, v in good])
    keep = len(got) // len(good)
    w = np.array([r["whitened"] for r in got]).reshape(len(good), keep)
    order = np.argsort([i for i, _ in good], kind="stable")
    assert [int(r["deviation"]) for r in got[::keep]] == [sum(o * o for o in off[i]) for i in order]
    assert {r["n"] for r in got} == {len(good)}
    # Each component is the rows' offsets on one eigenvector: V p = e p for the p that the offsets and w determine.
    a, v = np.array(off, float)[order] / len(good), np.array([[float(c) for c in row] for row in cov])
    loads = a.T @ w / len(good)
    values = (loads * loads).sum(0)
    assert np.abs(v @ loads - loads * values).max() < 1e-9 * np.abs(v).max() * np.sqrt(values.max())
    assert np.allclose(np.sort(np.linalg.eigvalsh(v))[::-1][:keep], values, rtol=1e-9)
    assert np.allclose([r["explained"] for r in got[:keep]], values / np.trace(v), rtol=1e-9)
    assert got[0]["identity_error"] < 1e-9
    assert np.abs(w.T @ w / len(good) - np.eye(keep)).max() < 1e-9
    return keep


def test_whitens_every_usable_row(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.standard_normal(10) * np.arange(1, 11)).tolist()) for i in range(300)]
    rows += [(400, rows[5][1]), (401, rows[5][1])]
    rows += [(900, None), (901, []), (902, [None] * 10), (903, [float("nan")] * 10), (904, [1.0] * 9 + [float("inf")])]
    assert check(spark, rows) == 8
    # Repeated rows and ids are rows of their own.
    ids = whitening.whiten(table(spark, [*rows[:300], (5, rows[5][1]), (6, rows[7][1])])).groupBy("vec_id").count()
    assert {r[0]: r[1] for r in ids.collect()} == {i: 16 if i in (5, 6) else 8 for i in range(300)}


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.standard_normal(4) * [1e9, 1e6, 1.0, 1e-3]).tolist()) for i in range(50)]
    assert check(spark, rows) >= 2


def test_less_than_full_rank(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(a), float(2 * a), float(b), 7.0]) for i, (a, b) in enumerate(rng.integers(-9, 9, (40, 2)))]
    assert check(spark, rows) == 2
    same = [(i, [1.0, 2.0]) for i in range(5)]
    assert whitening.whiten(table(spark, same)).count() == 0
    assert whitening.whiten(table(spark, same[:1])).count() == 0
    assert whitening.whiten(table(spark, [])).count() == 0
    assert whitening.whiten(table(spark, [(1, None)])).columns == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"
    ]


def test_null_ids_and_equal_eigenvalues(spark):
    axes = [[5.0, 0.0, 0.0], [-5.0, 0.0, 0.0], [0.0, 5.0, 0.0], [0.0, -5.0, 0.0], [0.0, 0.0, 5.0], [0.0, 0.0, -5.0]]
    rows = [(None if i == 2 else i, v) for i, v in enumerate(axes)]
    got = whitening.whiten(table(spark, rows)).collect()
    assert len(got) == 18 and sum(r["vec_id"] is None for r in got) == 3
    assert all(abs(r["explained"] - 1 / 3) < 1e-12 for r in got) and got[0]["identity_error"] < 1e-12


def test_different_sizes_are_an_error(spark):
    with pytest.raises(ValueError, match="different sizes"):
        whitening.whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0])]))


def orthogonal(size, seed):
    x = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))[0].astype(np.longdouble)
    for _ in range(3):
        x = x @ (1.5 * np.eye(size) - 0.5 * (x.T @ x))
    return x


@pytest.mark.parametrize(
    "values",
    [
        np.arange(1, 40), 1 + np.arange(30) * 1e-9, [1] * 5 + [1 + 1e-10] * 3 + [2, 3], [1, 1, 1], [0, 0, 1], [0, 0],
        np.r_[1, 1 + 1e-12, 1 + 2e-12, 3, 3 + 1e-8, 5], 10.0 ** -np.arange(16), [4], [-3, 2, 2 + 1e-7],
    ],
)
def test_eigen_resolves_clusters(values):
    values = np.array(values, np.longdouble)
    q = orthogonal(len(values), 1)
    a = (q * values) @ q.T
    found, x = whitening.eigen(a)
    largest = max(np.abs(values).max(), 1)
    assert np.abs(found - np.sort(values)[::-1]).max() < 1e-17 * largest * len(values)
    assert np.abs(x.T @ x - np.eye(len(values))).max() < 1e-17 * len(values)
    assert np.abs(a @ x - x * found).max() < 1e-17 * largest * len(values)


def test_float32_alone_would_not_do():
    values = 1 + np.arange(20) * 1e-8
    q = orthogonal(20, 2)
    a = (q * values.astype(np.longdouble)) @ q.T
    plain = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    turned, x = np.abs(q.T @ plain).max(0), whitening.eigen(a)[1]
    assert turned.min() < 0.99  # float32 cannot tell these apart
    assert np.abs(np.abs(q[:, ::-1].T @ x) - np.eye(20)).max() < 1e-10


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from([0.0, 1.0, 1 + 1e-9, 1 + 2e-13, 2.0, 1e-6]), min_size=1, max_size=9), st.integers(0, 99))
def test_eigen_of_any_spectrum(values, seed):
    q = orthogonal(len(values), seed)
    a = (q * np.array(values, np.longdouble)) @ q.T
    found, x = whitening.eigen(a)
    assert np.abs(x.T @ x - np.eye(len(values))).max() < 1e-16
    assert np.abs(a @ x - x * found).max() < 1e-16
