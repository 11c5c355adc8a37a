from __future__ import annotations

import random
import re
import string
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from hanji.llm import phrases

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute(rows, longest=5, least=100, share=100, top=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            w = re.findall(r"[^ \t]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + m])) for m in range(1, longest + 1) for i in range(len(w) - m + 1))
    cand = {k: a for k, a in f.items() if a >= least and len(k[1]) > 1}
    gone = set()
    for (lang, w), a in cand.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                if 100 * a >= share * cand[lang, w[i : i + m]]:
                    gone.add((lang, w[i : i + m]))
    out = []
    for (lang, w), a in cand.items():
        if (lang, w) not in gone:
            cut = lambda k: (1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k)  # noqa: B023, E731
            score, k = min(map(cut, range(1, len(w))))
            out.append((lang, " ".join(w), a, f[lang, w[:k]], f[lang, w[k:]], n[lang], score))
    ranked = []
    for lang in {r[0] for r in out}:
        own = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:top]
        ranked += [(lang, k, *r[1:]) for k, r in enumerate(own, 1)]
    return sorted(ranked)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    vocabulary = ["the", "of", "New", "york", "é", "ñandú", "a", "b", "c", "x-y", "\x00", "Ä"] + [f"w{k}" for k in range(40)]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    out = []
    for k in range(300):
        words = rng.choices(vocabulary, weights, k=rng.randint(0, 120))
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r\n"]) for w in words)
        out.append((text, rng.choice(["en", "en", "fr", None, "und", "a\tb"])))
    out += [("a b c the of " * 400, "en"), ("one two three four five six " * 200, "fr"), ("la la la la la la la " * 60, "fr"), (None, "en"), ("", None), ("...", "xx"), ("alone", "yy")]
    return out + out[:5]


@pytest.fixture(scope="module")
def table(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("phrases") / "documents.parquet")
    spark.createDataFrame(rows, "text string, lang string").repartition(5).select("*", *[F.lit("x").alias(c) for c in ("phrase", "count", "a", "n", "k", "words")]).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("options", [{}, {"least": 5, "shard_words": 50}, {"least": 2, "share": 60, "top": 7, "shard_words": 3}, {"least": 3, "most_bits": 1024, "longest": 4}, {"longest": 2, "least": 4}])
def test_against_brute_force(rows, table, options):
    got = phrases.collocations(table, **options)
    assert [t for _, t in got.dtypes] == ["string", "bigint", "string"] + ["bigint"] * 5
    bare = {k: v for k, v in options.items() if k not in ("shard_words", "most_bits")}
    assert sorted(map(tuple, got.collect())) == brute(rows, **bare)


def test_sql(rows, table):
    documents = table.select("text", "lang").toArrow()
    con = duckdb.connect()
    con.register("documents", documents)
    assert sorted(con.sql(phrases.oracle()).fetchall()) == brute(rows)


def test_no_rows(table):
    assert phrases.collocations(table.limit(0)).count() == 0


def test_suffix_array():
    rng = np.random.default_rng(1)
    ids = np.r_[rng.integers(0, 4, 300), np.zeros(8, int)]
    order = phrases.suffix_array(ids, 8)
    head = [tuple(ids[p : p + 8]) + (0,) * (8 - len(ids[p : p + 8])) for p in order]
    assert head == sorted(head) and sorted(order) == list(range(308))
    lcp = phrases.common_prefixes(ids[:300].repeat(1), order[order < 290][:50], 5)
    assert lcp[0] == 0 and lcp.max() <= 5


def test_products_beyond_64_bits(spark):
    rows = spark.createDataFrame([("p q", "en")] * 3, "text string, lang string")
    found = phrases.collocations(rows, least=1).first()
    assert found.score == 1000 * 3 * 6 // 9
    big = spark.sql("select (1000 * x.a * x.n) div (x.l * x.r) as score from (select struct(cast(9e12 as decimal(20,0)) a, cast(1e13 as decimal(20,0)) n, cast(9e12 as decimal(20,0)) l, cast(1e13 as decimal(20,0)) r) x)")
    assert big.first().score == 1000


def test_pairs_are_shuffled_as_stripes(spark):
    """One row for a first word and not for each pair; a hot first word's pairs are dealt into slots."""
    import pyarrow as pa

    class Known:
        value = phrases.Filter(np.full(128, 255, np.uint8))

    batch = pa.RecordBatch.from_pydict({"text": ["hot b hot c hot b x\x00 y x\x00 z, hot"] * 2, "lang": ["a\tb", None]})
    got = pa.Table.from_batches(phrases._stripes(Known, phrases.word_hashes([b"hot"], ["und"]), 1000, iter([batch]))).to_pylist()
    cold = {r["head"]: (r["slot"], r["seconds"], r["counts"]) for r in got if r["head"] != "und\thot"}
    assert cold["a\tb\thot"] == (0, "b c", [2, 1]) and cold["und\tx\x00"] == (0, "y z", [1, 1]) and len(cold) == 9
    hot = [r for r in got if r["head"] == "und\thot"]
    assert sorted(zip(" ".join(r["seconds"] for r in hot).split(), sum((r["counts"] for r in hot), []), strict=True)) == [("b", 2), ("c", 1)]
    slots = {h: int(phrases.word_hashes([h.encode()], ["und"])[0] % phrases.SLOTS) for h in "bc"}
    assert {r["slot"] for r in hot} == set(slots.values())


def test_a_shard_is_gone_before_the_next():
    """A worker holds one shard, without waiting for Python to look for rings of objects."""
    import gc
    import weakref

    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"text": ["a b c d", "b c d e", "c d e f"], "lang": ["en", "fr", None]})
    seen, found = [], phrases.shards(iter([batch]), 2, 3)
    gc.disable()
    try:
        for shard in found:
            assert all(ref() is None for ref in seen) and shard.upto <= 5
            seen.append(weakref.ref(shard))
            del shard
    finally:
        gc.enable()
    assert len(seen) > 2 and seen[-1]() is None


def test_filter_is_made_in_slices(spark):
    """No task makes more than a slice, and a filter of several has all its phrases and few others."""
    import pyarrow as pa

    bits = 4 * phrases.SLICE_BITS
    hashes = np.random.default_rng(5).integers(0, 1 << 64, 200_000, np.uint64)
    hashes = hashes[np.argsort(phrases.slice_of(hashes, bits), kind="stable")]
    columns = {"slice": phrases.slice_of(hashes, bits).astype(np.int32), "hash": hashes.view(np.int64)}
    batches = pa.Table.from_pydict(columns).to_batches(max_chunksize=30_000)
    made = pa.Table.from_batches(phrases._filter_slices(bits, iter(batches))).to_pylist()
    assert [r["slice"] for r in made] == [0, 1, 2, 3] and {len(r["bits"]) for r in made} == {phrases.SLICE_BITS // 8}
    whole = phrases.Filter(np.frombuffer(b"".join(r["bits"] for r in made), np.uint8))
    others = np.random.default_rng(6).integers(0, 1 << 64, 10_000, np.uint64)
    assert whole.has(hashes).all() and whole.has(others).mean() < 0.02

    rows = [(lang, f"w{k} é{k}") for k in range(3000) for lang in ("en", "a\tb")]
    known = phrases.filter_of(spark.createDataFrame(rows, "lang string, phrase string"), phrases.MOST_BITS).value
    first, second = (phrases.word_hashes([p.encode().split()[at] for _, p in rows], [lang for lang, _ in rows]) for at in (0, 1))
    assert known.has(phrases.mixed(first, second)).all() and known.has(phrases.mixed(second, first)).mean() < 0.05
