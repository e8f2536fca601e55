import math

import numpy as np
import pytest

from stratum.llm import projected_search as P


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "vec_id long, embedding array<float>, v int, rank int, bound int")


def brute(rows, k=20, every=20):
    """{query: [(vec_id, score)]} by the same sum of products."""
    some = {(i, tuple(float(np.float32(c)) for c in v)) for i, v in rows
            if i is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)}
    out = {}
    for i, v in sorted(some):
        if i % every == 0:
            own = [(-float((np.array(v) * np.array(w)).sum()), j) for j, w in some if j != i and len(w) == len(v)]
            out.setdefault(i, []).extend((j, -s) for s, j in sorted(own)[:k])
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def clustered(n, dim=12, seed=0):
    rnd = np.random.default_rng(seed)
    centres = rnd.standard_normal((9, dim))
    v = centres[rnd.integers(9, size=n)] + rnd.standard_normal((n, dim)) * rnd.choice([0.05, 0.4, 2.0], (n, 1))
    return [(i * 7 % 100003, x.astype(np.float32).tolist()) for i, x in enumerate(v)]


def recall(got, want):
    hits = sum(len({j for j, _ in got.get(q, [])} & {j for j, _ in own}) for q, own in want.items())
    return hits / sum(map(len, want.values()))


ODD = [(100020, None), (100040, []), (100060, [0.0] * 12), (100080, [None] * 12), (100100, [float("nan")] * 12),
       (100120, [float("inf")] * 12), (None, [1.0] * 12), (100140, [1.0, 2.0]), (-20, [2.0, -1.0]), (5, [0.5, 0.5]), (100160, [1e-30] * 12),
       (100180, [1e4] * 12)]


@pytest.mark.parametrize("options", [{}, {"cell_rows": 60, "query_rows": 7}, {"cell_rows": 50, "fit_rows": 100}])
def test_everything_is_found_at_full_confidence(spark, monkeypatch, options):
    monkeypatch.setattr(P, "LEAF_ROWS", 16)
    rows = clustered(700) + ODD
    rows += rows[:5] + [(200000 + i, rows[3][1]) for i in range(60)] + [(200000, rows[9][1])]  # repeats and copies
    rows = [r for r in rows if r[0] != 200000]
    assert found(P.nearest(frame(spark, rows).repartition(4), confidence=1.0, **options)) == brute(rows)


def test_ties_go_to_the_smaller_id(spark, monkeypatch):
    monkeypatch.setattr(P, "LEAF_ROWS", 8)
    rnd = np.random.default_rng(2)
    rows = [(i, rnd.integers(0, 2, 6).astype(float).tolist()) for i in range(300)]
    assert found(P.nearest(frame(spark, rows), confidence=1.0, cell_rows=20)) == brute(rows)


@pytest.mark.parametrize("n, dim", [(1500, 12), (4000, 32)])
def test_recall_and_exact_scores(spark, n, dim):
    for rows in (clustered(n, dim), [(i, v.tolist()) for i, v in enumerate(np.random.default_rng(n).standard_normal((n, dim)).astype(np.float32))]):
        want, got = brute(rows), found(P.nearest(frame(spark, rows).repartition(3), cell_rows=400))
        assert recall(got, want) >= 0.95
        vectors = dict(rows)
        for q, own in got.items():
            assert len(own) == 20 and [x[0] for x in own] == [j for _, j in sorted((-s, j) for j, s in own)]
            assert all(s == float((np.array(vectors[q]) * np.array(vectors[j])).sum()) for j, s in own)


def test_fewer_candidates_than_asked_for_are_all_returned(spark, monkeypatch):
    monkeypatch.setattr(P, "LEAF_ROWS", 1)
    rnd = np.random.default_rng(8)
    rows = [(20 * i, (rnd.choice([-1.0, 1.0]) * np.ones(4) + 0.01 * rnd.standard_normal(4)).tolist()) for i in range(18)]
    assert found(P.nearest(frame(spark, rows), confidence=0.5, cell_rows=2)) == brute(rows)


def test_few_rows_and_empty_table(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 1.0]), (2, [-1.0, 0.0]), (40, [3.0])]
    assert found(P.nearest(frame(spark, rows))) == {0: [(1, 0.5), (2, -1.0)]}
    assert found(P.nearest(frame(spark, rows).limit(0))) == {}


def test_chi_square():
    assert P.chi_square_cdf(2 * math.log(2), 2) == pytest.approx(0.5)
    assert P.chi_square_cdf(15.507313, 8) == pytest.approx(0.95, abs=1e-6)
    assert P.stopping_ratio(0.95, 8) == pytest.approx(15.507313, abs=1e-5)
