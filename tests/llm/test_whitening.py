"""Whitening: exact parts beside plain ones, components beside another solver."""

import math
from fractions import Fraction

import numpy as np
import pytest

from millrace.llm import whitening


def integer_matrix(seed, size, rank=None):
    draw = np.random.default_rng(seed).integers(-50, 50, (rank or size + 5, size)).astype(object)
    return draw.T @ draw


def plain_polynomial(matrix):
    """By the recurrence of traces (Faddeev and LeVerrier), in exact fractions."""
    size = len(matrix)
    out, m = [Fraction(1)], np.zeros((size, size), dtype=object)
    for k in range(1, size + 1):
        m = matrix @ m + out[-1] * np.eye(size, dtype=int).astype(object)
        out.append(-Fraction(int(np.trace(matrix @ m))) / k if k else 0)
    return [int(c) for c in reversed(out)]


@pytest.mark.parametrize("size, rank", [(1, None), (2, None), (6, None), (9, 4)])
def test_polynomial_is_exact(spark, size, rank):
    matrix = integer_matrix(size, size, rank)
    assert whitening.characteristic(spark, matrix) == plain_polynomial(matrix)


def test_polynomial_of_a_sparse_matrix_needs_pivots(spark):
    matrix = np.diag([3, 0, 5, 5, 0, 2]).astype(object)
    matrix[0, 4] = matrix[4, 0] = 0
    assert whitening.characteristic(spark, matrix) == plain_polynomial(matrix)
    block = integer_matrix(3, 3)
    matrix = np.zeros((6, 6), dtype=object)
    matrix[:3, :3], matrix[3:, 3:] = block, block  # every eigenvalue twice
    poly = whitening.characteristic(spark, matrix)
    assert poly == plain_polynomial(matrix)
    roots = whitening.largest_roots(poly, 8)
    assert [m for _, m in roots] == [2, 2, 2]
    for root, _ in roots:
        both = whitening.null_vectors(matrix, root, 2)
        assert np.allclose(both.T @ both, np.eye(2), atol=1e-14)
        assert np.allclose(matrix.astype(float) @ both, float(root) * both, rtol=1e-12, atol=1e-9)


def test_roots_and_their_counts():
    poly = [1]
    for r in (7, 7, 3, 2, 0):
        poly = [a - r * b for a, b in zip([0, *poly], [*poly, 0])]
    assert [whitening.above(poly, t) for t in (-1, 0, 2, 3, 6, 7)] == [5, 4, 3, 2, 2, 0]
    found = whitening.largest_roots(poly, 8)
    assert [m for _, m in found] == [2, 1, 1]
    assert all(abs(r - x) < Fraction(1, 1 << 100) for (r, _), x in zip(found, (7, 3, 2)))
    assert [m for _, m in whitening.largest_roots(poly, 1)] == [2]


def test_products_of_large_numbers_are_exact():
    draw = np.random.default_rng(4)
    for most in (100, 1 << 25, 1 << 61):
        rows = draw.integers(-most, most, (9000, 3))
        assert (whitening.product(rows) == rows.astype(object).T @ rows.astype(object)).all()


def made(spark, rows):
    return spark.createDataFrame([(i, v, "x", "x") for i, v in rows], "vec_id long, embedding array<double>, v string, component string").repartition(4)


def test_whitened_beside_a_plain_solver(spark):
    draw = np.random.default_rng(5)
    base = draw.normal(size=(400, 12)) @ np.diag(np.linspace(1, 3, 12))
    rows = [(i, v.tolist()) for i, v in enumerate(base)] + [(5, base[0].tolist()), (None, base[1].tolist()), (900, [0.0] * 12)]
    odd = [(1000, None), (1001, [1.0] * 11 + [None]), (1002, [math.nan] * 12), (1003, [math.inf] * 12), (1004, [1.0]), (1005, []), (1006, [1e300] * 12)]
    found = whitening.whitened(made(spark, rows + odd)).collect()
    x = np.floor(1024 * np.array([v for _, v in rows])).astype(np.int64) + 100_000
    n, sums = len(rows), x.sum(axis=0)
    values, vectors = np.linalg.eigh(np.cov(x.T, bias=True))
    deviation = ((n * x - sums) ** 2).sum(axis=1)
    assert sorted(str(r.vec_id) for r in found) == sorted(str(i) for i, _ in rows for _ in range(8))
    assert {r.n for r in found} == {n} and max(r.identity_error for r in found) < 1e-12
    for k in range(8):
        own = [r for r in found if r.component == k + 1]
        assert abs(own[0].explained - values[-1 - k] / values.sum()) < 1e-12
        plain = (x - sums / n) @ vectors[:, -1 - k] / math.sqrt(values[-1 - k])
        assert np.allclose(sorted(abs(r.whitened) for r in own), sorted(abs(plain)), atol=1e-9)
    assert sorted(r.deviation for r in found if r.component == 1) == sorted(deviation.tolist())
    assert all(str(r.deviation) == r.deviation_exact for r in found)


def test_large_entries_and_no_variance(spark):
    rows = [(i, [float(i * 2**40), -1.0, float(i % 2)]) for i in range(20)]
    found = whitening.whitened(made(spark, rows)).collect()
    x = [[int(math.floor(1024 * c)) + 100_000 for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x)]
    exact = {i: sum((20 * c - s) ** 2 for c, s in zip(v, sums)) for i, v in enumerate(x)}
    assert {r.component for r in found} == {1, 2}
    assert all(int(r.deviation_exact) == exact[r.vec_id] for r in found) and any(r.deviation is None for r in found)
    assert max(r.identity_error for r in found) < 1e-9
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 3, [(1, None)]):
        assert whitening.whitened(made(spark, rows)).collect() == []
