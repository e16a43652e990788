"""Whitening against exact covariances and numpy's eigenvectors."""

import math
from fractions import Fraction

import numpy as np
import pytest

from clinlake.llm import whitening
from clinlake.llm.queries.whitening import op12_embedding_whitening

SF_DIR = "/root/testdata/sf0.01"
COLUMNS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def integers(vector):
    return tuple(math.floor(64 * float(c)) + 1_000_000 for c in vector)


def plain(vectors):
    """n, exact sums, eigenvalues and eigenvectors of the exact covariance of the distinct vectors."""
    fit = sorted({integers(v) for v in vectors})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[i] for x in fit) for i in range(d)]
    apart = [[n * x[i] - sums[i] for i in range(d)] for x in fit]
    v = np.array([[float(Fraction(sum(a[i] * a[j] for a in apart), n**3)) for j in range(d)] for i in range(d)])
    values, vectors = np.linalg.eigh(v)
    return n, sums, values[::-1], vectors[:, ::-1]


def check(rows, found, k=16):
    n, sums, values, vectors = plain([v for _, v in rows])
    rank = int((values > values[0] * 1e-9).sum())
    size = min(k, rank)
    by_component = {}
    for r in found:
        by_component.setdefault(r.component, []).append(r)
    assert sorted(by_component) == list(range(1, size + 1))
    expected = {i: integers(v) for i, v in rows}
    for c, own in by_component.items():
        assert sorted((r.vec_id for r in own), key=str) == sorted((i for i, _ in rows), key=str)
        projected = {i: sum((Fraction(a) - Fraction(s, n)) * Fraction(float(w)) for a, s, w in zip(x, sums, vectors[:, c - 1], strict=True)) for i, x in expected.items()}
        want = np.array([float(projected[r.vec_id]) / math.sqrt(values[c - 1]) for r in own])
        got = np.array([r.whitened for r in own])
        assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-7
        for r in own:
            assert r.n == n and r.identity_error <= 1e-9
            assert r.deviation == sum((n * a - s) ** 2 for a, s in zip(expected[r.vec_id], sums, strict=True))
            assert r.explained == pytest.approx(values[c - 1] / values.sum(), rel=1e-9)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1.0, "x") for i, v in rows], "vec_id long, embedding array<float>, n double, _x string")


def test_spread_rows(spark):
    rng = np.random.default_rng(3)
    scales = np.array([9, 7, 5, 4, 3, 2.5, 2, 1.5, 1.2, 1, 0.8, 0.6, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1])
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(rng.normal(size=(300, 18)) * scales + 40)]
    check(rows, whitening.whitened(frame(spark, rows)).collect())


def test_dependent_and_constant_dimensions(spark):
    rng = np.random.default_rng(4)
    x = rng.integers(-50, 50, size=(200, 3)) * np.array([4, 2, 1])
    full = np.column_stack([x, x[:, 0] - x[:, 1], np.full(200, 7), 3 * x[:, 2]])
    rows = [(i, v.tolist()) for i, v in enumerate(full.astype(float) / 64)]
    found = whitening.whitened(frame(spark, rows)).collect()
    check(rows, found)
    assert {r.component for r in found} == {1, 2, 3}


def test_repeats_count_once_and_bad_vectors_not(spark):
    rng = np.random.default_rng(5)
    rows = [(i, v.tolist()) for i, v in enumerate((rng.normal(size=(40, 2)) * [5, 1]).astype(np.float32))]
    hot = [(1000 + i, rows[0][1]) for i in range(500)]
    bad = [(1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [1.0, float("-inf")]), (5, [1.0]), (6, [])]
    found = whitening.whitened(frame(spark, [*rows, *hot, *bad, (None, rows[1][1])])).collect()
    assert len(found) == 2 * (len(rows) + len(hot) + 1)
    check([*rows, *hot, (None, rows[1][1])], found)
    # Ones and zeros both count: a zero vector is a vector.
    assert whitening.whitened(frame(spark, [(1, [0.0, 0.0]), (2, [1.0, 0.0])])).count() == 2


def test_huge_components(spark):
    rows = [(1, [1e30, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 2.0])]
    found = whitening.whitened(frame(spark, rows)).collect()
    assert {r.vec_id for r in found} == {1, 2, 3} and all(r.deviation is None for r in found if r.vec_id == 1)


def test_nothing_varies(spark):
    for rows in ([], [(1, [1.0, 2.0])] * 3, [(1, None)]):
        found = whitening.whitened(frame(spark, rows))
        assert found.columns == COLUMNS and found.count() == 0


def test_factors_of_an_ill_conditioned_matrix():
    rng = np.random.default_rng(6)
    u, w = np.linalg.qr(rng.normal(size=(500, 10)))[0], np.linalg.qr(rng.normal(size=(10, 10)))[0]
    y = u * np.logspace(0, -12, 10) @ w

    def gram_of(factors):
        q = y
        for factor in factors:
            q = whitening.solved(q, factor)
        return q.T @ q

    factors, gram = whitening.triangular_factors(500, 10, gram_of)
    assert np.abs(gram - np.eye(10)).max() < 1e-9
    composed = np.eye(10)
    for factor in factors:
        composed = factor @ composed
    np.testing.assert_allclose(np.linalg.svd(composed)[1], np.logspace(0, -12, 10), rtol=1e-2)


def test_query(spark):
    rows = [(r.vec_id, list(map(float, r.embedding))) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    check(rows, op12_embedding_whitening(spark, SF_DIR).collect())
