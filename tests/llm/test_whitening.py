"""Whitening: exact polynomials, roots and components, and whole results against plain arithmetic."""

from fractions import Fraction

import numpy as np
import pytest

from tests.llm.conftest import SF
from tidemark.llm import whitening as wh
from tidemark.llm.queries import QUERIES

VECTORS = "vec_id long, embedding array<float>, label int, component int, n long, i int, id string"


def frame(llm, vectors):
    rows = [(v if isinstance(v, tuple) else (k, v)) for k, v in enumerate(vectors)]
    return llm.createDataFrame([(k, v, 0, 7, 8, 9, "x") for k, v in rows], VECTORS)


def symmetric(d, seed, spread=1000):
    a = np.random.default_rng(seed).integers(-spread, spread, (d, max(d - seed % 3, 1))).astype(object)
    return a @ a.T


def plain_polynomial(m):
    """Faddeev and LeVerrier's recursion in rational numbers."""
    d, out, b = len(m), [1], np.zeros_like(m)
    for k in range(1, d + 1):
        b = m @ b + np.diag([out[-1]] * d).astype(object)
        out.append(Fraction(-int(np.trace(m @ b)), k))
    return [int(c) for c in out]


def whole_polynomial(m):
    moduli = wh.primes(wh.coefficient_bits(m))
    return wh.remaindered([wh.polynomial_modulo(m, p) for p in moduli], moduli)


@pytest.mark.parametrize("d", [1, 2, 3, 5, 9, 16])
def test_polynomial_is_exact(d):
    for seed in range(4):
        m = symmetric(d, seed)
        assert whole_polynomial(m) == plain_polynomial(m)
    sparse = np.diag(range(d)).astype(object)
    assert whole_polynomial(sparse) == plain_polynomial(sparse)


def test_polynomial_by_a_job(llm):
    m = symmetric(12, 1)
    assert wh.characteristic(llm, m) == plain_polynomial(m)


def test_primes():
    few = [n for n in range(2, 3000) if all(n % k for k in range(2, int(n ** 0.5) + 1))]
    assert [n for n in range(3000) if wh.is_prime(n)] == few and not wh.is_prime(3215031751)


def test_counting_roots():
    poly = whole_polynomial(np.diag([9, 9, 4, 1, 0, 0]).astype(object))
    assert [wh.roots_above(poly, x, 0) for x in (0, 1, 3, 4, 8, 9, 10)] == [4, 3, 3, 2, 2, 0, 0]
    assert wh.roots_above(poly, 35, 2) == 2 and wh.roots_above(poly, 37, 2) == 0


def test_equal_and_close_roots():
    h = np.array([[1]], object)
    for _ in range(3):
        h = np.block([[h, h], [h, -h]])
    for values in ([5, 5, 5, 3, 3, 1, 0, 0], [10**30 + 1, 10**30, 10**29, 7, 7, 2, 1, 0]):
        m = h @ np.diag(values).astype(object) @ h.T
        poly = whole_polynomial(m)
        roots = wh.largest_roots(poly, int(np.trace(m)), 32)
        assert sum(([8 * v] * 1 for v in values if v), []) == [round(Fraction(*((n, 1 << b)))) for r in roots for n, b in [wh.refined(poly, r)] for _ in range(r.count)]
        v = np.concatenate([wh.null_space(m, wh.refined(poly, r), r.count) for r in roots])
        assert np.abs(v @ v.T - np.eye(len(v))).max() < 1e-14
        basis = np.array(h.T, float) / 8 ** 0.5  # the row of each eigenvalue
        for r in roots:
            own = [k for k in range(8) if r.above <= k < r.above + r.count]
            other = np.delete(basis, own, axis=0)
            assert np.abs(other @ v[own].T).max() < 1e-14


def test_products_are_exact():
    rng = np.random.default_rng(3)
    for top in (10, 1 << 19, 1 << 21, 1 << 45):
        y = rng.integers(-top, top, (50, 4))
        assert (wh.gram(y) == y.astype(object).T @ y.astype(object)).all()


def plain_whitening(vectors, wanted=32):
    x = np.array([[int(np.floor(np.float64(c) * 64)) + 1_000_000 for c in np.array(v, np.float32)] for v in vectors], object)
    n, s = len(x), x.sum(axis=0)
    z = n * x - s
    deviation = [int(sum(v * v for v in row)) for row in z]
    c = x.astype(float) - (s / n).astype(float)
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1][:wanted], u[:, ::-1][:, :wanted]
    return n, deviation, c @ u / np.sqrt(e), e / (c ** 2).sum() * n


def test_query_against_plain_arithmetic(llm, tables):
    vectors = {r.vec_id: list(r.embedding) for r in tables("embeddings").collect()}
    n, deviation, whitened, explained = plain_whitening(list(vectors.values()))
    got = {}
    for r in QUERIES["op11_whitening"](llm, SF).collect():
        assert r.n == n and r.identity_error < 1e-9
        got[r.vec_id, r.component] = r
    assert set(got) == {(v, k) for v in vectors for k in range(1, 33)}
    for k in range(32):
        column = np.array([got[v, k + 1].whitened for v in vectors])
        assert min(np.abs(column - whitened[:, k]).max(), np.abs(column + whitened[:, k]).max()) < 1e-8
        assert abs(got[next(iter(vectors)), k + 1].explained / explained[k] - 1) < 1e-9
    assert [got[v, 1].deviation for v in vectors] == deviation


def test_odd_vectors(llm):
    rng = np.random.default_rng(2)
    good = [[float(np.float32(c)) for c in v] for v in rng.normal(size=(40, 3))]
    odd = [None, [], [1.0], [1.0, None, 2.0], [1.0, float("nan"), 2.0], [float("inf"), 1.0, 2.0]]
    rows = [*good, good[0], (None, good[1]), (0, good[2]), *odd]
    n, deviation, whitened, explained = plain_whitening([*good, good[0], good[1], good[2]])
    got = wh.whiten(frame(llm, rows)).collect()
    assert len(got) == 3 * n == 3 * 43 and {r.n for r in got} == {43} and max(r.identity_error for r in got) < 1e-12
    assert sorted(r.deviation for r in got if r.component == 1) == sorted(deviation)
    ids = sorted((r.vec_id is None, r.vec_id or 0) for r in got if r.component == 2)
    assert ids == sorted([(False, k) for k in range(41)] + [(True, 0), (False, 0)])
    for k in range(3):
        column, want = (np.sort(np.abs(x)) for x in ([r.whitened for r in got if r.component == k + 1], whitened[:, k]))
        assert np.abs(column - want).max() < 1e-9


def test_flat_and_huge_vectors(llm):
    same = [[1.0, 2.0, 3.0]] * 5
    assert wh.whiten(frame(llm, same)).count() == 0 and wh.whiten(frame(llm, same).limit(0)).count() == 0
    assert wh.whiten(frame(llm, [None, []])).count() == 0
    line = wh.whiten(frame(llm, [[float(k), 2.0 * k, 0.0] for k in range(9)])).collect()  # one direction only
    assert {r.component for r in line} == {1} and {r.explained for r in line} == {1.0} and line[0].identity_error < 1e-12
    huge = wh.whiten(frame(llm, [[1e30, 1.0, 0.5], [-1e30, 2.0, 0.25], [2e30, 0.0, 0.75], [1.0, 1.0, 1.0]])).collect()
    assert len(huge) == 12 and {r.deviation for r in huge} == {None} and huge[0].identity_error < 1e-9
