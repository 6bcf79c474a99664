import collections

import numpy as np
import pyarrow.parquet as pq
import pytest

from feedloom.llm import cover_tree as ct


def plain(rows, cosine):
    """(id, n_links, component_id) by comparing all pairs; rows: (id, x or None)."""
    fine = [k for k, (i, x) in enumerate(rows) if i is not None and x and all(c is not None and np.isfinite(c) for c in x) and any(x)]
    up = {k: k for k in fine}

    def find(k):
        while up[k] != k:
            k = up[k]
        return k
    links = collections.Counter()
    for size in {len(rows[k][1]) for k in fine}:
        own = [k for k in fine if len(rows[k][1]) == size]
        x = np.array([rows[k][1] for k in own], float)
        x /= np.sqrt((x * x).sum(1, keepdims=True))
        for a, b in zip(*np.nonzero(np.triu(x @ x.T >= cosine, 1))):
            links[own[a]] += 1
            links[own[b]] += 1
            up[find(own[a])] = find(own[b])
    least = {}
    for k in fine:
        least[find(k)] = min(least.get(find(k), rows[k][0]), rows[k][0])
    return collections.Counter((i, links[k], least[find(k)] if k in up else i) for k, (i, _) in enumerate(rows))


def got(spark, rows, cosine=0.95, **more):
    df = spark.createDataFrame(rows, "id long, x array<double>")
    return collections.Counter(tuple(r) for r in ct.near_duplicates(spark, df, cosine, **more).collect())


def cloud(seed, n, dim, groups, width):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(groups, dim))
    c /= np.linalg.norm(c, axis=1, keepdims=True)
    return [(int(i), (c[rng.integers(groups)] + rng.normal(size=dim) * width * rng.random()).tolist()) for i in rng.permutation(n)]


@pytest.mark.parametrize("n,dim,groups,width,cosine", [
    (900, 8, 40, 0.2, 0.95), (700, 3, 5, 0.5, 0.95), (600, 32, 3, 0.05, 0.95), (500, 16, 500, 1.0, 0.5), (400, 2, 1, 0.3, 0.999)])
def test_blocks_trees_and_pairs(spark, n, dim, groups, width, cosine):
    rows = cloud(n, n, dim, groups, width)
    rows += [(n + 10 + k, rows[k][1]) for k in range(60)] + [(n + 100 + k, rows[3][1]) for k in range(50)]
    want = plain(rows, cosine)
    assert got(spark, rows, cosine, block_bytes=100 * dim * 8) == want


def test_split_by_key_and_one_block(spark):
    rows = cloud(5, 500, 6, 1, 0.001) + cloud(6, 100, 6, 30, 0.3)
    want = plain(rows, 0.95)
    assert got(spark, rows, block_bytes=70 * 48, deep=0) == want
    assert got(spark, rows) == want


def test_given_vectors(spark):
    t = pq.read_table("/root/testdata/sf0.001/embeddings.parquet")
    rows = list(zip(t["vec_id"].to_pylist(), t["embedding"].to_pylist()))
    rows += [(10_000 + i, (np.array(x) + 0.02 * np.sin(np.arange(64) + i)).tolist()) for i, x in rows[:120]]
    assert got(spark, rows, block_bytes=80 * 512) == plain(rows, 0.95)


def test_defined_cases(spark):
    big = [1e200, 1e200, 0.0]
    rows = [(1, None), (2, []), (3, [0.0, 0.0, 0.0]), (4, [1.0, None, 0.0]), (5, [float("nan"), 1.0, 0.0]), (6, [float("inf"), 1.0, 0.0]),
            (7, big), (8, [1.0, 1.0, 0.0]), (9, [1e-200, 1e-200, 0.0]), (10, [-1.0, -1.0, 0.0]), (11, [1.0, 1.0]), (12, [1.0, 1.01]),
            (None, [1.0, 1.0, 0.0]), (None, None), (8, [1.0, 1.0, 0.0]), (8, [1.0, 1.1, -0.0]), (13, [0.0, 0.0, 1.0]), (13, [1.0, 1.1, 0.0])]
    n3 = 6     # 7, 8, 9, 8, 8, 13: all within a few degrees
    want = collections.Counter({(i, 0, i): 1 for i in (1, 2, 3, 4, 5, 6, 10)} | {(None, 0, None): 2})
    want.update([(11, 1, 11), (12, 1, 11), (13, 0, 13)] + [(i, n3 - 1, 7) for i in (7, 8, 9, 8, 8, 13)])
    assert got(spark, rows) == want
    assert got(spark, []) == collections.Counter()
    more = spark.createDataFrame([(1, [1.0], "a", 2), (2, [2.0], "b", 3)], "id long, x array<double>, node string, n int")
    assert sorted(tuple(r) for r in ct.near_duplicates(spark, more).collect()) == [(1, 1, 1), (2, 1, 1)]


def test_tree_levels_cover_and_nest():
    x = np.array([v for _, v in cloud(11, 800, 5, 12, 0.4)])
    tree = ct.Tree.built(x, np.arange(len(x)), np.ones(len(x), np.int64), 0.3)
    assert sorted(tree.cid.tolist()) == list(range(len(x)))
    for k, (s, r) in enumerate(zip(tree.starts, tree.radius)):
        assert s[0] == 0 and s[-1] == len(x) and (np.diff(s) > 0).all()
        if k:
            assert np.isin(tree.starts[k - 1], s).all()
        for a, b, far in zip(s[:-1], s[1:], r):
            d = ct.apart(tree.u[a:b] @ tree.u[a])
            assert d[1:].max(initial=0) <= far + 1e-7
            if 0 < k < len(tree.starts) - 1:
                assert far <= 2.0 ** (1 - k) + 1e-7


def test_wide_steps_work_out_few_distances_and_miss_none():
    """Points that are all far apart meet as a whole: in single precision, with double for what is near."""
    x = np.array([v for _, v in cloud(21, 3000, 48, 3000, 1.0)])
    x[-40:] = x[:40] + 0.01 * np.random.default_rng(22).normal(size=(40, 48))
    ids, one = np.arange(1500), np.ones(1500, np.int64)
    t = float(ct.apart(np.float64(0.95)))
    a, b = ct.Tree.built(x[:1500], ids, one, t), ct.Tree.built(x[1500:], 1500 + ids, one, t)
    walk = ct.Walk(a, b, 0.95)
    every, none = np.arange(1500), np.zeros(1500)
    near = {(int(i), int(j)) for p, q, _ in walk.within(every, every, none, none) for i, j in zip(p, q)}
    want = {(int(i), int(j)) for i, j in zip(*np.nonzero(ct.apart(a.u @ b.u.T) <= t))}
    assert len(want) >= 40 and want <= near and len(near) < 2 * len(want)
    cid, links, _ = walk.found()
    assert sorted(cid.tolist()) == sorted([a.cid[i] for i, _ in want] + [b.cid[j] for _, j in want]) and set(links) == {1}
