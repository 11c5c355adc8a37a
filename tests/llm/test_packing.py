from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from hanji.llm import packing  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")


def pieces(rows):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    out = []
    for doc_id, text, *_ in rows:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) % 2048 or min(len(ids), 2048)
        for k, s in enumerate([0, *range(first, len(ids), 2048)]):
            n = first if k == 0 else 2048
            out.append((doc_id, k, s, n, zlib.crc32(ids[s : s + n])))
    return out


def test_packing(docs, corpus_rows):
    got = packing.pack_documents(docs, PATH).collect()
    assert Counter(tuple(r)[:5] for r in got) == Counter(pieces(corpus_rows))
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r.length for r in got)
    assert len(sequences) <= -(-total // 2048) + 3


def test_no_rows(no_docs):
    assert packing.pack_documents(no_docs, PATH).collect() == []


def test_cut():
    for n in (1, 2047, 2048, 2049, 4096, 5000):
        parts = packing.cut(n)
        assert sum(length for _, length in parts) == n and all(length == 2048 for _, length in parts[1:])
        assert [s for s, _ in parts] == list(np.cumsum([0, *[length for _, length in parts[:-1]]]))


def slow_rule(lengths, capacity):
    """The rule written out, with the sum over all gaps for every choice."""
    gaps, out = [], []
    for size in lengths:
        best = None
        for k in [*range(len(gaps)), len(gaps)]:
            gap = gaps[k] if k < len(gaps) else capacity
            if gap < size:
                continue
            after = Counter(g for i, g in enumerate(gaps) if i != k and g)
            if gap - size:
                after[gap - size] += 1
            key = (sum(n * n for n in after.values()), k == len(gaps), gap)
            best = min(best or (key, k), (key, k), key=lambda x: x[0])
        out.append(best[0][0])
        if best[1] == len(gaps):
            gaps.append(capacity)
        gaps[best[1]] -= size
    return out, len(gaps)


def test_sum_of_squares_takes_the_smallest_sum():
    rng = random.Random(2)
    for _ in range(15):
        lengths = [rng.randint(1, 20) for _ in range(60)]
        sequence, offset = packing.sum_of_squares(lengths, 20)
        level, sums = Counter(), []
        for size, s, o in zip(lengths, sequence, offset, strict=True):
            assert level[s] == o
            level[s] += size
            assert level[s] <= 20
            sums.append(sum(n * n for n in Counter(20 - x for x in level.values() if x < 20).values()))
        want, made = slow_rule(lengths, 20)
        assert sums == want and len(level) == made


def test_a_worker_gives_memory_back_after_a_task(monkeypatch):
    import public_tokenizers
    import pyarrow as pa

    from hanji.llm import packing, tokens

    given = []
    monkeypatch.setattr(tokens, "give_back", lambda own=tokens.give_back: (given.append(1), own()))
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["one two", None]})
    assert sum(map(len, packing._pieces(public_tokenizers.path("byte_bpe_50k.json"), iter([batch])))) == 2 and given == [1]
