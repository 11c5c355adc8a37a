from __future__ import annotations

import random
import re

import numpy as np
import xxhash

from hanji.llm import simhash
from hanji.llm.common import connected_components


def brute_print(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(pairs):
    """pairs (id, fingerprint) -> id -> smallest id reachable over at most two differing bits."""
    ids = [d for d, _ in pairs if d is not None]
    root = {d: d for d in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, x in pairs:
        for b, y in pairs:
            if a is not None and b is not None and (x ^ y).bit_count() <= 2:
                a2, b2 = find(a), find(b)
                root[max(a2, b2)] = min(a2, b2)
    return {d: find(d) for d in ids}


def test_documents(docs, corpus_rows):
    got = simhash.simhash_components(docs).collect()
    prints = [(d, brute_print(t)) for d, t, *_ in corpus_rows]
    want = brute_components(prints)
    by_id = dict(prints)
    assert len(got) == len(corpus_rows)
    for r in got:
        assert r.fingerprint == f"{by_id[r.doc_id]:016x}"
        if r.doc_id is not None:
            assert r.component_id == want[r.doc_id]
    assert len({d for d, c in want.items() if d != c}) >= 12


def clustered(n=500, seed=2):
    """Fingerprints in chains, in a dense cluster and apart."""
    rng = random.Random(seed)
    out = {rng.getrandbits(64) for _ in range(n)}
    for start in list(out)[:20]:
        x = start
        for _ in range(rng.randint(1, 8)):
            x ^= 1 << rng.randrange(64)
            x ^= 1 << rng.randrange(64)
            out.add(x)
    centre = rng.getrandbits(64)
    out |= {centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(200)}
    return sorted(out)


def test_blocks_of_any_size_leave_the_same_components(spark):
    fps = clustered()
    want = brute_components([(simhash.signed(x), x) for x in fps])
    df = spark.createDataFrame([(simhash.signed(x),) for x in fps], "fp long")
    for table_rows in (4096, 20, 2):  # the smaller, the more buckets are cut into blocks
        links = simhash.fingerprint_links(df, table_rows)
        got = {r.node: r.component for r in connected_components(links).collect()}
        assert {d: c for d, c in want.items() if (d != c or list(want.values()).count(c) > 1)} == got


def test_pairs_of_a_bucket():
    fps = np.array(clustered(150, 5), dtype=np.uint64)
    refs = np.array(simhash.references(24, 1), dtype=np.uint64)[:, None]
    got = set()
    for i, j in simhash.near_pairs(fps[:, None], refs, 2, np.arange(len(fps)), np.zeros(len(fps), int)):
        got |= set(zip(j.tolist(), i.tolist(), strict=True))
    assert got == {(a, b) for a in range(len(fps)) for b in range(a + 1, len(fps)) if int(fps[a] ^ fps[b]).bit_count() <= 2}


def test_edges(spark, no_docs):
    assert simhash.simhash_components(no_docs).collect() == []
    zero = spark.createDataFrame([(5, None), (3, ""), (9, " \n"), (7, "one word")], "doc_id long, text string")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.simhash_components(zero).collect()}
    assert got[5] == got[3] == got[9] == ("0" * 16, 3) and got[7][1] == 7


def test_components_of_chains_hubs_and_loops(spark):
    rng = random.Random(1)
    chain = [(k, k + 1) for k in range(100, 160)]
    hub = [(7, 200 + k) for k in range(300)]
    edges = [*chain, *hub, (900, 900), (160, 199), *[(k + 5000, k) for k in range(300, 320)]]
    rng.shuffle(edges)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[k] for k in range(100, 161)} == {100} and got[199] == 100
    assert got[900] == 900 and all(got[200 + k] == 7 for k in range(300))
    assert got[5310] == 7  # 5310-310 and 310 is a spoke of the hub
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
