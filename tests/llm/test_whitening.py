import math

import numpy as np
import pytest

from stratum.llm import whitening as W


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, x int, n int")


def sound(v):
    return v and all(c is not None and math.isfinite(c) for c in v)


def brute(rows):
    """By length: (n, sums, covariance of the distinct x) with whole numbers."""
    x = [tuple(math.floor(64 * float(np.float32(c))) + 1000000 for c in v) for _, v in rows if sound(v)]
    out = {}
    for size in {len(v) for v in x}:
        fit = np.array(sorted({v for v in x if len(v) == size}))
        out[size] = len(fit), [int(s) for s in fit.sum(axis=0)], fit
    return out


def check(rows, got):
    want = brute(rows)
    kept = [(i, [math.floor(64 * float(np.float32(c))) + 1000000 for c in v]) for i, v in rows if sound(v)]
    found = {}
    for r in got:
        found.setdefault((r.vec_id, r.deviation), []).append(r)
    for i, v in kept:
        n, sums, fit = want[len(v)]
        values, vectors = np.linalg.eigh(np.cov(fit.T, bias=True).reshape(len(v), len(v)))
        values, vectors = values[::-1], vectors[:, ::-1]
        k = min(16, int((values > 1e-9 * max(values[0], 1e-300)).sum()) if values[0] > 0 else 0)
        own = sorted(found.get((i, sum((n * a - s) ** 2 for a, s in zip(v, sums))), []), key=lambda r: r.component)
        if not k:
            assert not own
            continue
        own = own[:k] if len(own) == k else own[::len(own) // k]  # repeated rows
        assert [r.component for r in own] == list(range(1, k + 1)) and {r.n for r in own} == {n}
        y = np.array(v) - np.array(sums) / n
        for j, r in enumerate(own):
            assert abs(r.explained - values[j] / values.sum()) <= 1e-9 * r.explained + 1e-15
            assert abs(abs(r.whitened) - abs(y @ vectors[:, j]) / math.sqrt(values[j])) < 1e-6
            assert r.identity_error < 1e-8
    assert len(got) == sum(min(16, len(v), want[len(v)][0] - 1) for _, v in kept if want[len(v)][0] > 1)


def vectors(n, size, seed=0):
    rnd = np.random.default_rng(seed)
    return (rnd.standard_normal((n, size)) * np.linspace(1, 4, size)).astype(np.float32)


def test_matches_an_eigendecomposition(spark):
    rows = [(i, v.tolist()) for i, v in enumerate(vectors(300, 24))]
    rows += [(1000 + i, rows[i % 7][1]) for i in range(200)]  # copies count once
    rows += [(2000, None), (2001, []), (2002, [None] * 24), (2003, [float("nan")] * 24), (2004, [float("inf")] + [0.0] * 23), rows[3]]
    rows += [(3000 + i, v.tolist()) for i, v in enumerate(vectors(40, 3, 1))] + [(4000, [1.0, 2.0]), (None, [9.0, -1.0, 0.5])]
    check(rows, W.whiten(frame(spark, rows).repartition(5)).collect())


def test_few_directions(spark):
    rows = [(i, [float(i), 2.0 * i, 1.0, -float(i)]) for i in range(50)]
    got = W.whiten(frame(spark, rows)).collect()
    assert {r.component for r in got} == {1} and len(got) == 50 and got[0].explained == pytest.approx(1)
    assert W.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    assert W.whiten(frame(spark, rows).limit(0)).collect() == []


def test_large_entries_stay_exact(spark):
    rows = [(i, [1e12 * i, -3e15, float(i * i)]) for i in range(9)] + [(100, [1e30, 0.0, 0.0])]
    got = W.whiten(frame(spark, rows)).collect()
    x = [[math.floor(64 * float(np.float32(c))) + 1000000 for c in v] for _, v in rows[:9]]
    sums = [sum(c) for c in zip(*x)]
    want = {i: sum((9 * a - s) ** 2 for a, s in zip(v, sums)) for i, v in enumerate(x)}
    assert {r.vec_id for r in got} == set(range(9))
    assert all(r.deviation == (want[r.vec_id] if want[r.vec_id] < 1 << 63 else None) for r in got)


def test_factor_and_rotations():
    rnd = np.random.default_rng(5)
    for size, rank in ((1, 1), (7, 7), (30, 30), (12, 5)):
        m = rnd.standard_normal((size, rank))
        a = m @ m.T
        factor, order = W.pivoted_cholesky(a)
        assert factor.shape == (size, rank) and np.allclose(np.triu(factor, 1), 0)
        assert np.allclose(factor @ factor.T, a[np.ix_(order, order)])
        w = W.rotated_columns(factor)
        gram = w.T @ w
        assert np.allclose(gram, np.diag(gram.diagonal()), atol=1e-12 * gram.max())
        assert np.allclose(gram.diagonal(), np.linalg.eigvalsh(a)[::-1][:rank], rtol=1e-10)
