import numpy as np
import pytest

from stratum.llm import vector_forest as V


def brute(data, least=V.COSINE):
    links, parent = [0] * len(data), list(range(len(data)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def sound(row):
        i, label, v = row
        return i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    for a in range(len(data)):
        for b in range(a):
            (i, la, va), (j, lb, vb) = data[a], data[b]
            if la == lb and sound(data[a]) and sound(data[b]) and len(va) == len(vb):
                x, y = np.array(va, np.float32).astype(float), np.array(vb, np.float32).astype(float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= least:
                    links[a] += 1
                    links[b] += 1
                    ra, rb = find(a), find(b)
                    parent[ra] = rb
    low = {}
    for a, (i, _, _) in enumerate(data):
        if i is not None:
            low[find(a)] = min(low.get(find(a), i), i)
    return sorted(((i, links[a], low.get(find(a)) if i is not None else None) for a, (i, _, _) in enumerate(data)), key=str)


def groups(seed, n=500, dim=16):
    rnd = np.random.default_rng(seed)
    centres = rnd.standard_normal((12, dim))
    data = []
    for i in range(n):
        v = centres[rnd.integers(12)] + rnd.standard_normal(dim) * rnd.choice([0.0, 0.1, 0.3, 2.0])
        data.append((i * 3 % 1009, int(rnd.integers(3)), v.astype(np.float32).tolist()))
    return data


@pytest.mark.parametrize("options", [{}, {"group_rows": 40}, {"trees": 2, "fit_rows": 300}])
def test_links_and_components_match_brute_force(spark, monkeypatch, options):
    monkeypatch.setattr(V, "LEAF_ROWS", 60)  # several levels at this size
    data = groups(1)
    data += [(2000, None, data[0][2]), (2001, 1, None), (2002, 1, [0.0] * 16), (2003, 1, [None] + data[1][2][1:]),
             (2004, 1, [float("nan")] + data[1][2][1:]), (2005, 1, [float("inf")] * 16), (2006, 1, []), (2007, 1, [1.0, 2.0]),
             (2008, 1, [2.0, 4.0]), (None, 1, [1.0, 2.0]), data[0], data[0], (-3, *data[5][1:])]
    frame = spark.createDataFrame(data, "vec_id long, label int, embedding array<float>").selectExpr(
        "*", "1 as node", "2 as copies", "3 as vector").repartition(3)
    got = V.link_vectors(frame, **options).collect()
    found, want = sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str), brute(data)
    if "trees" not in options:
        assert found == want
    else:  # few trees miss some pairs, and never add one
        assert all(a[0] == b[0] and a[1] <= b[1] for a, b in zip(found, want))
        assert sum(a[1] for a in found) >= 0.9 * sum(b[1] for b in want)
    assert all(r.kept == (r.vec_id is None or r.vec_id == r.component_id) for r in got)


def test_recall_with_many_leaves(spark, monkeypatch):
    """Recall against brute force where the trees are deep (leaves of about 40 rows)."""
    monkeypatch.setattr(V, "LEAF_ROWS", 40)
    rnd = np.random.default_rng(4)
    base = rnd.standard_normal((1500, 64))
    near = base[:500] + 0.25 * rnd.standard_normal((500, 64))
    data = [(i, 0, v.astype(np.float32).tolist()) for i, v in enumerate(np.concatenate([base, near]))]
    x = np.array([v for _, _, v in data])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = int((x @ x.T >= V.COSINE).sum()) - len(data)
    frame = spark.createDataFrame(data, "vec_id long, label int, embedding array<float>")
    found = sum(r.n_links for r in V.link_vectors(frame).collect())
    assert want > 500 and 0.9 * want <= found <= want


def hot_group(n, share, dim=64):
    """``n`` unit vectors, the first ``share`` of them of one group with pair cosines of about 0.95."""
    rnd = np.random.default_rng(n)
    x = rnd.standard_normal((n, dim))
    m = int(n * share)
    x[:m] = rnd.standard_normal(dim) + 0.23 * x[:m]
    return x / np.linalg.norm(x, axis=1, keepdims=True), m


@pytest.mark.parametrize("n, share", [(10_000, 1 / 3), (50_000, 1 / 3), (200_000, 1 / 3), (200_000, 0.02)])
def test_recall_of_a_hot_dense_group_does_not_fall_with_the_table(n, share):
    """Production parameters, the trees alone: pairs of the group that meet in some leaf."""
    x, m = hot_group(n, share)
    rnd = np.random.default_rng(1)
    sample = x[rnd.permutation(n)[:V.FIT_ROWS]]
    some = x[rnd.permutation(m)[:1000]]
    links = some @ some.T >= V.COSINE
    np.fill_diagonal(links, False)
    met = np.zeros_like(links)
    for t in range(V.TREES):
        for rows, _ in V.Tree(sample, t, n / len(sample)).leaves(some):
            met[np.ix_(rows, rows)] = True
    assert links.sum() > 100_000
    assert (links & met).sum() >= 0.99 * links.sum()


def test_links_of_a_hot_dense_group_match_brute_force(spark):
    """Production parameters: several levels, and a group of several blocks."""
    x, m = hot_group(6_000, 1 / 2)
    frame = spark.createDataFrame([(i, 0, v.tolist()) for i, v in enumerate(x)], "vec_id long, label int, embedding array<double>")
    found = {r.vec_id: r.n_links for r in V.link_vectors(frame).collect()}
    want = (x @ x.T >= V.COSINE).sum(axis=1) - 1
    assert all(found[i] <= want[i] for i in range(len(x)))
    assert sum(found.values()) >= 0.99 * want.sum()


def test_empty_table(spark):
    assert V.link_vectors(spark.createDataFrame([], "vec_id long, label int, embedding array<float>")).count() == 0


def test_leaves_stay_small_where_the_sample_was_too_small(spark, monkeypatch):
    for name, value in (("LEAF_ROWS", 40), ("LARGE", 80), ("LEAF_FIT_ROWS", 200), ("ROUTE_ROWS", 100), ("DENSE_ROWS", 300)):
        monkeypatch.setattr(V, name, value)
    data = groups(5, n=1500, dim=24)
    frame = spark.createDataFrame(data, "vec_id long, label int, embedding array<float>").repartition(3)
    sizes, plain = [], V._refined

    def watched(placed, forest):
        out = plain(placed, forest)
        for leaves in (placed, out):
            sizes.append([r["count"] for r in leaves.selectExpr("explode(leaves) as leaf").groupBy("leaf").count().collect()])
        return out

    monkeypatch.setattr(V, "_refined", watched)
    got = V.link_vectors(frame, fit_rows=60).collect()  # trees of 60 sample rows end in leaves of hundreds
    assert max(sizes[0]) > 200 and max(sizes[1]) <= 80 < len(sizes[1])
    found, want = sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str), brute(data)
    assert all(a[0] == b[0] and a[1] <= b[1] for a, b in zip(found, want))
    assert sum(r[1] for r in found) >= 0.9 * sum(r[1] for r in want)


def test_an_id_with_several_vectors(spark):
    rows = [(5, 1, [1.0, 0.0]), (5, 1, [0.0, 1.0]), (6, 1, [1.0, 0.01]), (7, 1, [0.01, 1.0])]
    got = V.link_vectors(spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").repartition(4)).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(5, 1, 5), (5, 1, 5), (6, 1, 5), (7, 1, 5)]
