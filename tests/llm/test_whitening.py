"""Whitening against numpy's eigenvectors and exact integers."""

import math

import numpy as np
import pytest

from tillwatch.llm import whitening
from tillwatch.llm.queries import op11_embedding_whitening

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>"
DOUBLES = "vec_id long, embedding array<double>"


def check(rows, vectors, components=32):
    """``rows`` of the operator over the good vectors (id -> list), against exact sums and numpy."""
    x = {i: [math.floor(64 * c) + 1000000 for c in v] for i, v in vectors.items()}
    n, dims = len(x), len(next(iter(x.values())))
    sums = [sum(v[k] for v in x.values()) for k in range(dims)]
    centred = np.array([[(n * a - s) / n for a, s in zip(v, sums, strict=True)] for v in x.values()])
    covariance = centred.T @ centred / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    m = min(components, int((values > 1e-12 * values[0]).sum()))
    assert len(rows) == n * m
    white = np.zeros((n, m))
    place = {i: k for k, i in enumerate(x)}
    for r in rows:
        white[place[r.vec_id], r.component - 1] = r.whitened
        assert r.n == n
        assert r.deviation == sum((n * a - s) ** 2 for a, s in zip(x[r.vec_id], sums, strict=True))
        assert r.explained == pytest.approx(values[r.component - 1] / np.trace(covariance), rel=1e-9)
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-8
    error = np.abs(white.T @ white / n - np.eye(m)).max()
    assert error < 1e-8
    # the same subspaces as numpy's: equal where eigenvalues lie apart, up to the sign
    want = centred @ axes[:, :m] / np.sqrt(values[:m])
    for k in range(m):
        gaps = [abs(values[k] - values[j]) for j in range(dims) if j != k]
        if min(gaps, default=1.0) > 1e-6 * values[0]:
            assert np.abs(np.abs(white[:, k]) - np.abs(want[:, k])).max() < 1e-7
    return white


def test_query_equals_numpy_on_the_embeddings(spark):
    vectors = {r.vec_id: list(r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    check(op11_embedding_whitening(spark, SF).collect(), vectors)


def test_bad_vectors_go_and_odd_rows_have_a_result(spark):
    rng = np.random.default_rng(2)
    vectors = {k: [float(np.float32(c)) for c in rng.normal(size=5) * [9, 4, 2, 1, .5]] for k in range(60)}
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0, 3.0, 4.0]), (103, [math.nan] * 5), (104, [1.0, math.inf, 0.0, 0.0, 0.0]), (105, [1.0, 2.0])]
    rows = [*vectors.items(), *bad]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA + ", K int, component int").repartition(7)
    check(whitening.whiten(df).collect(), vectors)
    found = whitening.whiten(spark.createDataFrame([(None, [1.0]), (None, [1.0]), (3, [2.0]), (3, [2.0])], SCHEMA)).collect()
    assert sorted((r.vec_id or 0, r.component, r.n, r.deviation, abs(r.whitened)) for r in found) == [
        (0, 1, 4, 128 ** 2, 1.0), (0, 1, 4, 128 ** 2, 1.0), (3, 1, 4, 128 ** 2, 1.0), (3, 1, 4, 128 ** 2, 1.0)]


def test_no_variance_gives_no_rows(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        found = whitening.whiten(spark.createDataFrame(rows, SCHEMA))
        assert found.count() == 0
        assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_huge_entries_stay_exact_or_null(spark):
    rows = [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.0, 2.0]), (4, [3e9, 5.0])]
    found = {r.vec_id: r for r in whitening.whiten(spark.createDataFrame(rows, DOUBLES)).collect()}
    assert set(found) == {1, 2, 3, 4} and found[1].deviation is None
    x = np.array([[1 << 52, 0], [-(1 << 52), 64], [0, 128], [64 * 3 * 10**9, 320]], dtype=object) + 1000000
    deviations = 4 * x - x.sum(axis=0)
    got = whitening.squares(deviations)
    assert got == [s if (s := sum(int(v) ** 2 for v in row)) < 1 << 63 else None for row in deviations]


@pytest.mark.parametrize("dims", [1, 2, 3, 10, 64, 130])
def test_solver_equals_numpy(dims):
    rng = np.random.default_rng(dims)
    a = rng.normal(size=(dims, dims)) * np.logspace(0, -3, dims)
    values, axes = whitening.principal(a.T @ a, 32)
    want = np.linalg.eigvalsh(a.T @ a)[::-1][:len(values)]
    assert np.allclose(values, want, rtol=1e-9, atol=1e-14 * want[0])
    assert np.abs(axes.T @ axes - np.eye(len(values))).max() < 1e-12
    assert np.abs(a.T @ a @ axes - axes * values).max() < 1e-12 * want[0] * dims


@pytest.mark.parametrize("matrix", [np.eye(40), np.diag([5.0] * 20 + [1.0] * 20), np.ones((30, 30)) + 3 * np.eye(30),
                                    np.kron(np.diag([2.0, 2.0, 7.0]), np.array([[2.0, 1.0], [1.0, 2.0]]))])
def test_equal_eigenvalues_have_orthogonal_vectors(matrix):
    values, axes = whitening.principal(matrix, 32)
    assert np.abs(axes.T @ axes - np.eye(len(values))).max() < 1e-12
    assert np.abs(matrix @ axes - axes * values).max() < 1e-11 * values[0]


def test_sturm_counts_are_ranks():
    rng = np.random.default_rng(3)
    d, e = rng.normal(size=50), rng.normal(size=49)
    t = np.diag(d) + np.diag(e, 1) + np.diag(e, -1)
    values = np.linalg.eigvalsh(t)
    at = np.linspace(-4, 4, 33)
    assert (whitening.eigenvalues_below(d, e, at) == np.searchsorted(values, at)).all()
    assert np.allclose(whitening.leading_eigenvalues(d, e, 7), values[::-1][:7], atol=1e-13)
