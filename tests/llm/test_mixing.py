from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from hanji.llm import mixing


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes: dict) -> dict:
    """The contract's targets by repeated sharing."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    full: set = set()
    while True:
        rest = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in full)
        left = sum(weight[s] for s in order if s not in full)
        out = {s: 2.0 * sizes[s] if s in full else rest * weight[s] / left for s in order}
        above = {s for s in order if s not in full and out[s] > 2 * sizes[s]}
        if not above:
            return out
        full |= above


def test_mix(docs, corpus_rows):
    got = mixing.mix_documents(docs).toPandas()
    assert len(got) == len(corpus_rows)
    sizes = defaultdict(int)
    for _, text, _, source in corpus_rows:
        sizes[source] += size(text)
    want = targets(sizes)
    by_id = {r[0]: r for r in corpus_rows}
    for r in got.itertuples():
        source = None if r.source is None else r.source
        assert r.size == size(by_id[None if r.doc_id != r.doc_id else int(r.doc_id)][1])
        assert r.source_size == sizes[source]
        assert r.target == pytest.approx(want[source])
        assert r.taken == r.copies * r.size <= 2 * r.size
    for source, part in got.groupby(got.source.fillna("?")):
        largest = part["size"].sort_values().iloc[-2:].sum()
        assert abs(part.taken.sum() - part.target.iloc[0]) <= largest, source
    again = mixing.mix_documents(docs).toPandas()
    assert again.sort_values("row").copies.tolist() == got.sort_values("row").copies.tolist()


def test_one_mix_for_any_partitioning(spark, docs):
    """More copies of one row than a block holds too, which only a count tells apart."""
    again = spark.range(700).selectExpr("cast(null as long) doc_id", "'same words in every row' text", "'en' lang", "'hot' source")
    rows = docs.select("doc_id", "text", "lang", "source").unionByName(again)
    mixes = []
    for n in (1, 7):
        got = mixing.mix_documents(rows.repartition(n, "text", "lang")).toPandas()
        mixes.append(sorted(map(str, got[["doc_id", "source", "size", "copies"]].itertuples(index=False))))
    assert mixes[0] == mixes[1]


def test_targets_of_many_sources(spark):
    rng = random.Random(9)
    sizes = {f"s{k}": int(rng.lognormvariate(3, 3)) for k in range(200)} | {None: 50}
    df = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source string, source_size long, n long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(targets(sizes))


def test_no_rows_and_no_words(spark, no_docs, docs):
    assert mixing.mix_documents(no_docs).collect() == []
    blank = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [(r.target, r.taken, r.copies) for r in mixing.mix_documents(blank).collect()] == [(0.0, 0, 0)] * 2


def test_flight_balances_and_keeps_expectations():
    sizes = np.array(sorted(random.Random(3).choices(range(1, 500), k=60), reverse=True))
    chances = np.full(60, 0.3)
    runs = [mixing.flight(sizes, chances, random.Random(k), True) for k in range(400)]
    for p in runs:
        assert set(p) <= {0.0, 1.0}
        assert abs(p @ sizes - chances @ sizes) <= 2 * sizes[-10]
        assert abs(p.sum() - 18) <= 3
    assert np.abs(np.mean(runs, axis=0) - 0.3).max() < 0.12
    open_left = mixing.flight(sizes, chances, random.Random(1), False)
    assert ((open_left > 0) & (open_left < 1)).sum() <= 2
    assert open_left @ sizes == pytest.approx(chances @ sizes)


def test_levels_meet_in_one_block(spark):
    from pyspark.sql import functions as F

    n = 700
    units = spark.range(n).select(F.lit("s").alias("source"), F.col("id").alias("row"), F.xxhash64("id").alias("unit"), (F.col("id") % 50 + 1).alias("size"), F.lit(0.5).alias("chance"), F.lit(n).cast("long").alias("n"))
    got = mixing.cube_sample(units, block_rows=16).toPandas()
    assert len(got) == n
    taken = got[got.taken].row.map(lambda r: r % 50 + 1).sum()
    assert abs(taken - sum(k % 50 + 1 for k in range(n)) / 2) <= 60
