"""Whitening against numpy's eigenvectors of the covariance, and its parts on hard matrices."""

from __future__ import annotations

import math

import numpy as np
import pytest

from segmentry.llm import queries, whitening as wh

SCHEMA = "vec_id bigint, embedding array<float>, n int, component string, _v string, part int"


def bidiagonal(a, b):
    return np.diag(np.asarray(a, float)) + np.diag(np.asarray(b, float), 1)


def hard_cases():
    rng = np.random.default_rng(1)
    yield rng.normal(size=40), rng.normal(size=39)
    yield 10.0 ** np.linspace(0, -12, 30), 10.0 ** np.linspace(-1, -13, 29)  # graded
    yield 10.0 ** np.linspace(-12, 0, 30), 10.0 ** np.linspace(-13, -1, 29)
    yield np.ones(20), np.zeros(19)  # all equal
    yield np.ones(20), np.full(19, 1e-9)  # nearly equal
    yield np.array([3.0, 0.0, 2.0, 1.0]), np.array([1.0, 1.0, 1.0])  # a zero in the middle
    yield np.array([2.0]), np.array([])
    yield np.zeros(5), np.zeros(4)
    yield np.tile([1.0, 2.0], 15), np.tile([1e-8, 1.0], 15)[:29]
    yield rng.normal(size=200), 1e-3 * rng.normal(size=199)


@pytest.mark.parametrize("case", range(10))
def test_values_and_vectors_of_bidiagonal_matrices(case):
    a, b = list(hard_cases())[case]
    full = bidiagonal(a, b)
    squares = wh.singular_squares(a, b)
    exact = np.linalg.svd(full, compute_uv=False)
    assert np.sqrt(squares) == pytest.approx(exact, rel=1e-9, abs=1e-13 * max(exact.max(), 1e-300))
    top = squares[:8]
    top = top[top > len(a) * wh.EPS * max(squares[0], 1e-300)]
    if len(top):
        z = wh.right_vectors(a, b, top)
        assert np.abs(z @ z.T - np.eye(len(top))).max() < 1e-12
        assert np.abs(full.T @ (full @ z.T) - z.T * top).max() < 1e-12 * squares[0]


def test_small_values_keep_their_digits():
    """A graded matrix whose least singular value a covariance matrix would lose."""
    a, b = np.array([1.0, 1e-6, 1e-12, 1e-18]), np.array([0.5, 5e-7, 5e-13])
    squares = wh.singular_squares(a, b)
    assert math.prod(squares) == pytest.approx(math.prod(x * x for x in a), rel=1e-12)
    assert squares[-1] < 1e-35


def test_reflections_rebuild_the_triangle():
    r = np.triu(np.random.default_rng(2).normal(size=(12, 12)))
    a, b, right = wh.bidiagonalised(r)
    v = np.eye(12)
    for start, u, beta in reversed(right):
        v[start:] -= beta * np.outer(u, u @ v[start:])
    left = bidiagonal(a, b)
    assert np.allclose(v @ (left.T @ left) @ v.T, r.T @ r, atol=1e-12)


def vectors(seed=3, n=700, d=11):
    rng = np.random.default_rng(seed)
    mix = rng.normal(size=(d, d)) * np.linspace(2, 0.05, d)
    x = rng.normal(size=(n, d)) @ mix + rng.normal(size=d) * 5
    return [(i, [float(v) for v in np.float32(row)], 1, "clash", "clash", 2) for i, row in enumerate(x)]


def odd():
    return [
        (-1, None, 1, "", "", 1), (-2, [], 1, "", "", 1), (-3, [None] + [0.5] * 10, 1, "", "", 1), (-4, [float("nan")] + [0.5] * 10, 1, "", "", 1),
        (-5, [float("inf")] + [0.5] * 10, 1, "", "", 1), (-6, [1.0, 2.0], 1, "", "", 1), (-7, [3e38] + [0.5] * 10, 1, "", "", 1),
    ]


def check(rows, got, components=8):
    """Every figure of the result against exact arithmetic and numpy."""
    rows = [r for r in rows if r[1] is not None]
    x = np.array([[int(math.floor(1024 * np.float64(v))) + 100_000 for v in r[1]] for r in rows])
    n, sums = len(x), x.sum(axis=0)
    centred = (n * x.astype(object) - sums).astype(np.float64) / n
    cov = centred.T @ centred / n
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    assert len(got) == n * components
    by = {}
    for r in got:
        by.setdefault(r["component"], {}).setdefault(r["vec_id"], []).append(r)
    for c in range(1, components + 1):
        want = centred @ axes[:, c - 1] / np.sqrt(values[c - 1])
        have = np.array([by[c][r[0]][0]["whitened"] for r in rows])
        sign = np.sign(want @ have)
        assert np.abs(sign * have - want).max() < 1e-8
        some = by[c][rows[0][0]][0]
        assert some["n"] == n and some["explained"] == pytest.approx(values[c - 1] / values.sum(), rel=1e-9)
        assert some["identity_error"] < 1e-9
    whole = {r["vec_id"]: r["deviation"] for r in got}
    for r, row in zip(rows, x):
        assert whole[r[0]] == sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums))


@pytest.mark.parametrize("parts", [1, 40])
def test_whitening_equals_numpy(spark, parts):
    df = spark.createDataFrame(vectors() + odd(), SCHEMA).repartition(parts)
    check(vectors(), wh.whiten(df).collect())


def test_repeated_rows_null_ids_and_few_dimensions(spark):
    rows = [(1, [1.0, 2.0, 3.0], 1, "", "", 1)] * 5 + [(2, [2.0, 1.0, 0.0], 1, "", "", 1), (3, [0.0, 1.0, 5.0], 1, "", "", 1), (None, [4.0, 4.0, 1.0], 1, "", "", 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    check(rows, wh.whiten(df).collect(), 3)


def test_without_rank_or_rows(spark):
    assert wh.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert wh.whiten(spark.createDataFrame([(1, [1.0, 2.0], 1, "", "", 1)] * 4, SCHEMA)).count() == 0
    line = [(i, [float(i), 2.0 * i, 7.0], 1, "", "", 1) for i in range(20)]
    assert {r["component"] for r in wh.whiten(spark.createDataFrame(line, SCHEMA)).collect()} == {1}


def test_deviation_beyond_64_bits():
    assert wh.deviations(np.array([[10**14, 0], [5, 3]]), 10**6, [0, 0]) == [None, 34 * 10**12]


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(rows, queries.QUERIES["op11_whitening"](spark, sf).collect())
