from __future__ import annotations

import hashlib
import math
import re
import string
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hanji.llm import resample, tokens

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def grams(text, lengths=(1, 1)):
    w = words(text)
    return [" ".join(w[i : i + n]) for n in range(lengths[0], lengths[1] + 1) for i in range(len(w) - n + 1)]


def brute(rows, target, percent=10, buckets=10_000, lengths=(1, 1), seed=2024):
    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    s = Counter(bucket(g) for _, t in rows for g in grams(t, lengths))
    t = Counter(bucket(g) for x in target for g in grams(x, lengths))
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (n_s + buckets) / ((s[b] + 1) * (n_t + buckets))))
    scored = []
    for d, text in rows:
        g = grams(text, lengths)
        weight = sum(map(gain, map(bucket, g)))
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        scored.append((d, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(text))))
    most = sorted((r for r in scored if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    drawn = most[: percent * len(most) // 100]
    out = Counter(r[:4] + (None,) for r in scored)
    out.subtract(r[:4] + (None,) for r in drawn)
    out.update(r[:4] + (k,) for k, r in enumerate(drawn, 1))
    return +out


@pytest.fixture(scope="module")
def rows(corpus_rows):
    out = [(d, t) for d, t, *_ in corpus_rows]
    return out + [(500 + k, "Target words, plain AND simple; é7 " * 5 + "a\x00b\x7fc `d` {e} " + "the " * k) for k in range(10)] + [(None, "the ing " * 15)] * 3


@pytest.fixture(scope="module")
def table(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("resample") / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(5).select("*", *[F.lit("x").alias(c) for c in ("row", "score", "rank", "weight", "position", "range")]).write.parquet(path)
    return spark.read.parquet(path)


TARGET = ["Target words plain and simple.", None, "", "é7 target the, the"]


@pytest.mark.parametrize("lengths,percent", [((1, 1), 10), ((1, 2), 33), ((2, 3), 100)])
def test_against_brute_force(spark, rows, table, lengths, percent):
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    got = resample.resample(table, target, percent=percent, lengths=lengths)
    assert [t for _, t in got.dtypes] == ["bigint"] * 5
    assert Counter(map(tuple, got.collect())) == brute(rows, TARGET, percent, lengths=lengths)


def test_draws_what_is_like_the_target(spark, table):
    target = spark.createDataFrame([(t,) for t in TARGET] * 500, "text string")
    drawn = {r.doc_id for r in resample.resample(table, target).filter("rank is not null").collect()}
    assert len(drawn & set(range(500, 510))) >= 8


def test_no_rows(spark, table):
    target = spark.createDataFrame([], "text string")
    assert resample.resample(table.limit(0), target).count() == 0
    assert resample.resample(table, target).count() == table.count()


def test_cut_texts_have_the_same_features(monkeypatch):
    text = ("one Two, three;four " * 50).encode()
    whole = resample.features(text, (1, 3), 997)
    monkeypatch.setattr(tokens, "slices", lambda t, f=tokens.slices: f(t, 7))
    cut = resample.features(text, (1, 3), 997)
    assert cut[0] == whole[0] and sorted(cut[1]) == sorted(whole[1])
