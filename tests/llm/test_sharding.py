from __future__ import annotations

import zlib
from collections import Counter

import numpy as np

from hanji.llm import sharding


def test_shards(docs, corpus_rows):
    got = sharding.shard_documents(docs).collect()
    counts = Counter(r.shard for r in got)
    assert set(counts) == set(range(8)) and max(counts.values()) - min(counts.values()) <= 1
    for k in range(8):
        assert sorted(r.slot for r in got if r.shard == k) == list(range(counts[k]))
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in corpus_rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}
    assert sorted(map(str, got)) == sorted(map(str, sharding.shard_documents(docs).collect()))


def test_few_rows_and_none(spark, no_docs):
    assert sharding.shard_documents(no_docs).collect() == []
    three = spark.createDataFrame([(k, "x") for k in range(3)], "doc_id long, text string")
    assert sorted((r.shard, r.slot) for r in sharding.shard_documents(three).collect()) == [(0, 0), (1, 0), (2, 0)]


def test_matrix_has_exact_margins_and_the_law():
    counts = [5, 0, 17, 1, 40]
    seen = Counter()
    for seed in range(3000):
        m = np.array(sharding.communication_matrix(counts, 4, seed))
        assert m.sum(axis=1).tolist() == counts
        assert m.sum(axis=0).tolist() == [16, 16, 16, 15]
        seen[m[0, 0]] += 1
    from math import comb

    for x in range(6):
        expected = comb(16, x) * comb(47, 5 - x) / comb(63, 5)
        assert abs(seen[x] / 3000 - expected) < 0.03


def test_hypergeometric_of_very_large_totals():
    rng = np.random.default_rng(1)
    draws = [sharding.hypergeometric(rng, 10**11, 7 * 10**11, 10**6) for _ in range(300)]
    assert abs(np.mean(draws) - 125_000) < 100
    assert 250 < np.std(draws) < 420


def test_order_is_shuffled(spark):
    from pyspark.sql import functions as F

    n = 4000
    got = sharding.uniform_shards(spark.range(n), [F.col("id")], shards=4, bucket_rows=100)
    pdf = got.select("row.id", "shard", "slot").toPandas()
    assert abs(np.corrcoef(pdf.id, pdf.slot)[0, 1]) < 0.06
    first = pdf[pdf.shard == 0]
    assert abs(first.id.mean() - n / 2) < 120
