"""The SimHash stage of the pipeline: five-word shingles, similarity 0.8, counted from both texts."""

from __future__ import annotations

import random
from itertools import combinations

import pytest

from hanji.llm import simhash

from .conftest import prose

pytest.importorskip("public_tokenizers")
import corpus_pipeline  # noqa: E402


def shingles(text):
    words = text.lower().split()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4)))


def brute_groups(texts):
    """Position -> the smallest position that links of 5-word Jaccard 0.8 reach."""
    root, sets = list(range(len(texts))), [shingles(t) for t in texts]

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(texts)), 2):
        if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return [find(k) for k in range(len(texts))]


def edited(seed=3):
    """Texts apart, their copies with more and more words changed, a group around one text, and a common passage."""
    rng, out = random.Random(seed), []
    common = prose(rng, 30)
    for length in (6, 12, 40, 100, 300, 1000):
        for _ in range(6):
            base = prose(rng, length).split()
            out.append(" ".join(base))
            for share in (0.0, 0.005, 0.01, 0.02, 0.03, 0.06):
                words = list(base)
                for at in rng.sample(range(length), max(1, round(share * length))):
                    words[at] = "changed"
                out.append(" ".join(words))
    base = prose(rng, 200).split()
    for k in range(60):
        words = list(base)
        words[rng.randrange(200)] = f"other{k}"
        out.append(" ".join(words))
    out += [f"{common} {prose(rng, 40)}" for _ in range(60)] + ["Same words", "same  WORDS", "same words not"]
    return out


def test_near_copies_go_and_others_stay(spark):
    texts = edited()
    want = {k for k, first in enumerate(brute_groups(texts)) if k == first}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id for r in corpus_pipeline.simhash_dedup(spark, docs, "").collect()}
    assert got == want and len(texts) - len(want) > 150
    far = [(simhash.fingerprint(texts[a], 5) ^ simhash.fingerprint(texts[b], 5)).bit_count() for a, b in enumerate(brute_groups(texts)) if a != b]
    assert max(far) > simhash.RADIUS


def test_blocks_of_any_size_leave_the_same_groups(spark):
    texts = edited(seed=8)
    docs = spark.createDataFrame([(k, k, t) for k, t in enumerate(texts)], "number long, doc_id long, text string").repartition(3)
    want = brute_groups(texts)
    for block_shingles in (1 << 19, 500):
        got = simhash.similar_components(docs, block_shingles=block_shingles).toPandas().set_index("number")
        first = got.reset_index().groupby("component")["number"].min()
        assert {k: first[got.component[k]] for k in got.index} == dict(enumerate(want))


def test_one_row_of_repeated_and_reused_ids(spark):
    text, other = prose(random.Random(1), 40), prose(random.Random(2), 40)
    rows = [(1, text), (1, text), (None, text), (2, text), (2, other), (None, other), (3, None), (4, ""), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.text or "") for r in corpus_pipeline.simhash_dedup(spark, docs, "").collect())
    assert got == [(1, text), (2, other), (3, "")]


def test_whole_rows_stay_where_they_are(spark):
    """At no size do whole rows meet the numbers of those that go by a shuffle."""
    docs = spark.createDataFrame(list(enumerate(edited())), "doc_id long, text string")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = corpus_pipeline.simhash_dedup(spark, docs, "")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_buckets_are_made_of_nodes_alone(spark, monkeypatch):
    """Whole sketches aren't shuffled to meet their buckets' sizes."""
    asked, own = [], simhash.bucket_members
    monkeypatch.setattr(simhash, "bucket_members", lambda keyed, *rest: (asked.append(set(keyed.columns)), own(keyed, *rest))[1])
    words = " ".join(map(str, range(60)))
    docs = spark.createDataFrame([(0, 5, words), (1, 6, words + " more"), (2, 7, "other words")], "number long, doc_id long, text string")
    got = {r.number: r.component for r in simhash.similar_components(docs).collect()}
    assert asked == [{"node", "n", "key"}] and got[0] == got[1] != got[2]
