import math
from fractions import Fraction

import numpy as np
import pytest
from tallyloom.llm import feast, queries, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def spd(rng, values):
    q, _ = np.linalg.qr(rng.standard_normal((len(values), len(values))))
    return (q * values) @ q.T


SPECTRA = [np.arange(1, 41.0), np.r_[np.full(12, 5.0), np.arange(1, 9) / 10], np.r_[np.zeros(20), 1e6, 1, 1e-3],
           np.full(9, 3.0), np.r_[1e8, np.full(30, 1.0)], np.array([2.0]), 1.0 / np.arange(1, 65) ** 3]


@pytest.mark.parametrize("k", range(len(SPECTRA)))
def test_feast_equals_the_dense_solver(k):
    a = spd(np.random.default_rng(k), SPECTRA[k])
    a = (a + a.T) / 2
    want = np.linalg.eigvalsh(a)[::-1]
    scale = np.abs(want).max()
    for wanted in (1, 5, 16):
        values, vectors = feast.largest(a, wanted, floor=1e-12 * scale)
        real = want[:wanted][want[:wanted] > 1e-12 * scale]
        assert len(values) == len(real) and np.allclose(values, real, atol=1e-13 * scale * len(a), rtol=0)
        assert np.abs(a @ vectors - vectors * values).max(initial=0) < 1e-13 * scale * len(a)
        assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-12)


@pytest.mark.parametrize("k", range(6))
def test_inertia_counts(k):
    rng = np.random.default_rng(k)
    a = rng.standard_normal((25, 25))
    a = a + a.T
    if k > 3:
        a[np.arange(25), np.arange(25)] = 0  # pivots of two rows
    want = np.linalg.eigvalsh(a)
    for shift in [0.0, *((want[1:] + want[:-1]) / 2)]:
        assert feast.count_below(a, shift) == (want < shift).sum()
    assert feast.count_below(np.zeros((3, 3)), 0.0) == 0


def brute(rows):
    """deviation and covariance facts by whole numbers and fractions."""
    ok = [(i, [math.floor(64 * x) + 1_000_000 for x in v]) for i, v, _ in rows
          if v and all(x is not None and math.isfinite(x) for x in v)]
    out = {}
    for d in {len(x) for _, x in ok}:
        fit = sorted({tuple(x) for _, x in ok if len(x) == d})
        n = len(fit)
        s = [sum(col) for col in zip(*fit, strict=True)]
        z = np.array([[float(a - Fraction(b, n)) for a, b in zip(x, s, strict=True)] for x in fit])
        out[d] = n, s, z.T @ z / n, z
    return ok, out


def check(spark, rows):
    f32 = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], g) for i, v, g in rows]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    ok, fits = brute(f32)
    expected = 0
    by = {}
    for r in got:
        by.setdefault(r.vec_id, []).append(r)
    for i, x in ok:
        n, s, v, _ = fits[len(x)]
        e, u = np.linalg.eigh(v)
        e, u = e[::-1], u[:, ::-1]
        k = min(16, int((e > 1e-9 * max(e[0], 1e-300)).sum()))
        expected += k
        mine = sorted(by.get(i, []), key=lambda r: r.component)
        if k and len(mine) == k:  # an id once
            assert [r.component for r in mine] == list(range(1, k + 1))
            deviation = sum((n * a - b) ** 2 for a, b in zip(x, s, strict=True))
            assert {r.deviation for r in mine} == {deviation if deviation < 10**38 else None}
            assert all(r.n == n for r in mine)
            assert np.allclose([r.explained for r in mine], e[:k] / np.trace(v), rtol=1e-9)
            assert max(r.identity_error for r in mine) < 1e-8
            want = np.abs((np.array([float(a - Fraction(b, n)) for a, b in zip(x, s, strict=True)]) @ u[:, :k]) / np.sqrt(e[:k]))
            parted = (np.abs(np.diff(e, append=0, prepend=2 * e[0] + 1))[: len(e)][:k] > 1e-6 * e[0]) & (np.abs(np.diff(e, append=0))[:k] > 1e-6 * e[0])
            assert np.allclose(np.abs([r.whitened for r in mine])[parted], want[parted], atol=1e-6)
    assert len(got) == expected
    return by


def test_against_whole_numbers(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.standard_normal(20) * (1 + np.arange(20))], 0) for i in range(120)]
    rows += [(500 + i, [float(x) for x in rng.standard_normal(3)], 0) for i in range(30)]  # another length
    rows += [(600, None, 0), (601, [1.0, None] + [0.0] * 18, 0), (602, [math.nan] * 20, 0), (603, [math.inf] * 3, 0), (604, [], 0)]
    rows += [(700 + i, rows[5][1], 0) for i in range(40)]  # copies count once
    rows += [(None, [0.5] * 20, 0), rows[3], rows[3]]
    by = check(spark, rows)
    assert len(by[3]) == 48 and len(by[None]) == 16


def test_flat_and_single_vectors(spark):
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    by = check(spark, [(i, [float(i % 2), 7.0, float(i % 2)], 0) for i in range(6)])  # rank one
    assert all(len(rows) == 1 for rows in by.values())
    check(spark, [(i, [s * 1.4e17, 1.0 + i], 0) for i, s in enumerate((1, -1, 1, -1))])  # x near the ends of a long


def test_sums_beyond_a_long():
    x = np.array([[2**60, -(2**60)], [5, 7]])
    sums = [int(c) * 10**9 for c in x.sum(axis=0)]
    n = 10**9
    want = [sum((n * int(a) - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    got = whitening.exact_deviation(x, n, sums)
    assert [None if w >= 10**38 else w for w in want] == [None if g is None else int(g) for g in got]


def test_query_has_clashing_columns(spark, tmp_path):
    rows = [(i, [float(i), float(i * i % 7)], 0, i, i) for i in range(20)]
    spark.createDataFrame(rows, SCHEMA + ", id long, x long").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = queries.op13_whitening(spark, str(tmp_path))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert dict(got.dtypes)["deviation"] == "bigint" and got.count() == 40
