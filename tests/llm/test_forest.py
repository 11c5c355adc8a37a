from __future__ import annotations

import numpy as np

from hanji.llm import forest

SCHEMA = "vec_id long, embedding array<float>, label int, n long, leaf long, kept string"


def vectors(n=1500, dim=24, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim))
    for k in range(60):  # near copies
        x[n - 1 - k] = x[k] + 0.1 * rng.standard_normal(dim)
    for k in range(200):  # one dense group
        x[300 + k] = x[299] + 0.06 * rng.standard_normal(dim)
    rows = [(int(k), [float(v) for v in x[k]], 0, 1, 2, "") for k in range(n)]
    rows += [(n + k, rows[10][1], 0, 1, 2, "") for k in range(40)]  # copies
    rows += [(n + 100, None, 0, 1, 2, ""), (n + 101, [0.0] * dim, 0, 1, 2, ""), (n + 102, [None] * dim, 0, 1, 2, ""), (n + 103, [float("nan")] * dim, 0, 1, 2, ""), (n + 104, [], 0, 1, 2, ""), (n + 105, [1.0, 0.0], 0, 1, 2, ""), (n + 106, [1.0, 0.01], 0, 1, 2, ""), (n + 107, [1e30] * dim, 0, 1, 2, ""), (n + 108, [2e30] * dim, 0, 1, 2, ""), (None, [3.0] * dim, 0, 1, 2, "")]
    return rows


def brute(rows):
    good = [(v, np.array(e, dtype=np.float32).astype(float)) for v, e, *_ in rows if v is not None and e and all(x is not None and np.isfinite(x) for x in e) and any(e)]
    links, root = {v: 0 for v, _ in good}, {v: v for v, _ in good}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for dim in {len(e) for _, e in good}:
        own = [(v, e / np.abs(e).max()) for v, e in good if len(e) == dim]
        ids = [v for v, _ in own]
        x = np.array([e / np.linalg.norm(e) for _, e in own])
        for i, j in zip(*np.nonzero(x @ x.T >= 0.95), strict=True):
            if i != j:
                links[ids[i]] += 1
                a, b = find(ids[i]), find(ids[j])
                root[max(a, b)] = min(a, b)
    return links, {v: find(v) for v in links}


def check(got, rows, least):
    links, roots = brute(rows)
    assert len(got) == len(rows)
    found = 0
    for r in got:
        assert r.kept == (r.vec_id == r.component_id)
        if r.vec_id in links:
            assert r.n_links <= links[r.vec_id]
            found += r.n_links
            assert r.component_id >= roots[r.vec_id]
        else:
            assert (r.n_links, r.component_id) == (0, r.vec_id)
    assert found >= least * sum(links.values())
    assert np.mean([r.component_id == roots[r.vec_id] for r in got if r.vec_id in roots]) >= least


def test_recall_and_precision(spark, monkeypatch):
    rows = vectors()
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    check(forest.link_embeddings(df).collect(), rows, 1.0)  # one leaf
    monkeypatch.setattr(forest, "LEAF_ROWS", 128)
    check(forest.link_embeddings(df).collect(), rows, 0.9)
    check(forest.link_embeddings(df, block_rows=40).collect(), rows, 0.9)  # split further, the dense group in blocks


def test_leaves_are_split_on_the_executors(spark):
    """From a sample that grows no tree at all."""
    rows = vectors(3000, seed=6)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    check(forest.link_embeddings(df, sample=5, block_rows=400).collect(), rows, 0.9)


def test_two_vectors_under_one_id(spark):
    rows = [(1, [1.0, 0.0], 0, 1, 2, ""), (1, [0.0, 1.0], 0, 1, 2, ""), (2, [0.0, 1.01], 0, 1, 2, ""), (3, [0.01, 1.0], 0, 1, 2, "")]
    got = sorted(tuple(r) for r in forest.link_embeddings(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(1, 0, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 2, 1, False)]


def test_sampled_trees(spark, monkeypatch):
    monkeypatch.setattr(forest, "LEAF_ROWS", 128)
    rows = vectors(seed=4)
    check(forest.link_embeddings(spark.createDataFrame(rows, SCHEMA), sample=300).collect(), rows, 0.9)


def test_no_rows(spark):
    assert forest.link_embeddings(spark.createDataFrame([], SCHEMA)).collect() == []
    alone = spark.createDataFrame([(4, [1.0, 2.0], 0, 1, 2, "")], SCHEMA)
    assert [tuple(r) for r in forest.link_embeddings(alone).collect()] == [(4, 0, 4, True)]
