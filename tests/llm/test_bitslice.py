from __future__ import annotations

import random

import numpy as np

from hanji.llm import bitslice

SCHEMA = "vec_id long, embedding array<float>, label int, block string, dim int"


def brute(rows, every, k):
    good = {}
    for vec_id, e, *_ in rows:
        if vec_id is not None and e and all(x is not None and np.isfinite(x) for x in e):
            good[vec_id, tuple(int(np.floor(1024 * float(np.float32(x)))) for x in e)] = None
    out = []
    queries = {}
    for v, x in good:
        if v % every == 0:
            queries[v] = min(queries.get(v, x), x)
    for q, x in queries.items():
        scored = sorted((-sum(a * b for a, b in zip(x, y)), v) for v, y in good if v != q and len(y) == len(x))[:k]
        out += [(q, r, v, -s) for r, (s, v) in enumerate(scored, 1)]
    return sorted(out)


def data(n=400, dim=8):
    rng = random.Random(5)
    rows = [(k, [rng.gauss(0, 0.3) for _ in range(dim)], 0, "x", 1) for k in range(n)]
    rows += [(n + k, rows[3][1], 0, "x", 1) for k in range(30)]  # ties at every rank
    rows += [(n + 50, None, 0, "x", 1), (n + 51, [], 0, "x", 1), (n + 52, [None] * dim, 0, "x", 1), (n + 53, [float("nan")] * dim, 0, "x", 1), (n + 54, [float("inf")] * dim, 0, "x", 1)]
    rows += [(n + 55, [0.0] * dim, 0, "x", 1), (n + 100, [1.0, 2.0], 0, "x", 1), (n + 101, [0.5, -9.0], 0, "x", 1), (None, [1.0] * dim, 0, "x", 1), rows[7], rows[0], (n + 60, [1e6] * dim, 0, "x", 1)]
    return rows


def test_against_brute_force(spark):
    rows = data()
    df = spark.createDataFrame(rows, SCHEMA)
    for block_rows, k in ((1 << 15, 10), (64, 3)):
        got = sorted(tuple(r) for r in bitslice.top_k(df, every=20, k=k, block_rows=block_rows).collect())
        assert got == brute(rows, 20, k)


def test_no_rows_and_fewer_than_k(spark):
    assert bitslice.top_k(spark.createDataFrame([], SCHEMA)).collect() == []
    two = spark.createDataFrame([(0, [1.0], 0, "", 1), (1, [-1.0], 0, "", 1)], SCHEMA)
    assert [tuple(r) for r in bitslice.top_k(two).collect()] == [(0, 1, 1, -1024 * 1024)]


def test_slices_add_up():
    rng = np.random.default_rng(1)
    values = rng.integers(-700, 700, (130, 9))
    query = rng.integers(-700, 700, 9)
    low, maps, where = bitslice.slices_of(values)
    slices = bitslice.score_slices(query, maps, where)
    total = np.zeros(130, dtype=object)
    for level, bitmap in enumerate(slices):
        total += np.unpackbits(bitmap.view(np.uint8), bitorder="little")[:130].astype(object) << level
    exact = (values @ query).astype(object)
    assert len(set(total - exact)) == 1  # equal up to one constant
    for x in (0, 1, 7, 255, -255, 683):
        assert sum(d << bit for d, bit in bitslice.digits(x)) == x
