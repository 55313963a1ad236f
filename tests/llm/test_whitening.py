"""Whitening against numpy and exact integers."""

from fractions import Fraction

import numpy as np
import pytest

from scorebook.llm import spectrum, whitening

SCHEMA = "vec_id bigint, embedding array<float>, n int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(3)


def expected(vectors):
    """n, S, covariance of the distinct x-vectors, as exact integers and as doubles."""
    x = np.unique(np.floor(256 * np.asarray(vectors, np.float32).astype(np.float64)).astype(np.int64), axis=0)
    y = len(x) * x - x.sum(0)
    return len(x), x.sum(0), (y.T @ y / len(x) ** 3)


def test_equals_numpy(spark):
    rng = np.random.default_rng(5)
    m = (rng.normal(size=(300, 9)) * np.linspace(3, 0.5, 9)).round(3)
    rows = [(i, v.tolist()) for i, v in enumerate(m)] + [(1000, m[0].tolist()), (None, m[1].tolist()), (7, m[2].tolist())]
    bad = [(1001, None), (1002, [1.0, None] + [0.0] * 7), (1003, [float("nan")] * 9), (1004, [float("inf")] + [0.0] * 8), (1005, [])]
    got = whitening.whitened_components(frame(spark, rows + bad)).collect()
    n, s, cov = expected(m)
    values, vectors = np.linalg.eigh(cov)
    assert len(got) == 4 * len(rows) and {r.n for r in got} == {n}
    assert sorted(r.vec_id if r.vec_id is not None else -1 for r in got if r.component == 1) == sorted(
        i if i is not None else -1 for i, _ in rows)
    error = {r.identity_error for r in got}
    assert len(error) == 1 and error.pop() < 1e-9
    x = np.floor(256 * m.astype(np.float32).astype(np.float64)).astype(np.int64)
    by = {(r.vec_id, r.component): r for r in got if r.vec_id is not None and r.vec_id < 300 and r.vec_id != 7}
    for k in range(1, 5):
        want = (x - s / n) @ vectors[:, -k] / np.sqrt(values[-k])
        some = [i for i in range(300) if i != 7]
        have = np.array([by[i, k].whitened for i in some])
        sign = np.sign(have @ want[some])
        assert np.abs(sign * have - want[some]).max() < 1e-8
        assert by[0, k].explained == pytest.approx(values[-k] / values.sum(), rel=1e-10)
    for i in (0, 5, 299):
        assert int(by[i, 1].deviation) == sum((n * int(a) - int(b)) ** 2 for a, b in zip(x[i], s))


def test_huge_entries_stay_exact(spark):
    rows = [(0, [2.0**50, 1.0]), (1, [-(2.0**40), 0.5]), (2, [3.0, -(2.0**45)]), (3, [1e30, 0.0])]
    got = {r.vec_id: r for r in whitening.whitened_components(frame(spark, rows)).where("component = 1").collect()}
    x = [[2**58, 256], [-(2**48), 128], [768, -(2**53)], [2**63 - 1, 0]]
    s = [sum(c) for c in zip(*x)]
    for i, row in enumerate(x):
        want = sum((4 * a - b) ** 2 for a, b in zip(row, s))
        assert (int(got[i].deviation) if got[i].deviation is not None else None) == (want if want < 10**38 else None)
    assert all(r.identity_error < 1e-9 for r in got.values())


def test_repeated_roots_and_lacking_directions(spark):
    # the corners of a cube: one eigenvalue three times; a fourth and fifth dimension that never vary
    corners = [[a, b, c, 0.25, -0.5] for a in (-1.0, 1.0) for b in (-1.0, 1.0) for c in (-1.0, 1.0)]
    got = whitening.whitened_components(frame(spark, list(enumerate(corners)))).collect()
    assert all(r.identity_error < 1e-12 for r in got)
    for r in got:
        assert (r.whitened is None, r.explained) == ((True, 0.0) if r.component == 4 else (False, pytest.approx(1 / 3)))
    one = whitening.whitened_components(frame(spark, [(1, [0.5, 0.5]), (2, [0.5, 0.5])])).collect()
    assert len(one) == 4 and all(r.n == 1 and r.deviation == 0 and r.whitened is None and r.explained is None for r in one)


def test_lengths_apart_and_empty(spark):
    rows = [(0, [1.0, 2.0]), (1, [2.0, 1.0]), (2, [5.0, 5.0]), (3, [1.0]), (4, [2.0])]
    got = whitening.whitened_components(frame(spark, rows)).collect()
    assert {(r.vec_id, r.component, r.n) for r in got} == {(i, k, 3) for i in range(3) for k in (1, 2)} | {(3, 1, 2), (4, 1, 2)}
    assert whitening.whitened_components(frame(spark, [])).count() == 0


def test_characteristic_polynomial(spark):
    rng = np.random.default_rng(1)
    m = rng.integers(-50, 50, (7, 6)).astype(object)
    a = (m.T @ m).tolist()
    sums = spectrum.symmetric_sums(spark, a)
    assert sums[1] == sum(a[i][i] for i in range(6))
    frac = [[Fraction(v) for v in row] for row in a]
    det = Fraction(1)
    for k in range(6):
        det *= frac[k][k]
        for r in range(k + 1, 6):
            f = frac[r][k] / frac[k][k]
            frac[r] = [u - f * v for u, v in zip(frac[r], frac[k])]
    assert sums[6] == det
    roots, shift = spectrum.leading_roots(sums, 6)
    want = np.linalg.eigvalsh(np.array(a, float))[::-1]
    assert np.allclose([low / 2**shift for low, _ in roots], want, rtol=1e-9)
