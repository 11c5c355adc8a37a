from __future__ import annotations

import random
import zlib

import numpy as np

from hanji.llm import langid

WORDS = {"en": ["the", "and", "house", "water", "think", "with"], "fr": ["le", "maison", "être", "eau", "avec", "château"], "de": ["das", "und", "häuser", "wasser", "schön", "mit"]}


def made(spark, n=240):
    rng = random.Random(4)
    rows = []
    for k in range(n):
        lang = rng.choice(list(WORDS))
        rows.append((k, " ".join(rng.choices(WORDS[lang], k=rng.randint(3, 40))), lang))
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_held_out_accuracy(spark):
    rows, df = made(spark)
    got = {r.doc_id: r for r in langid.identify_languages(df).collect()}
    assert len(got) == len(rows)
    for k, _, _ in rows:
        assert got[k].held_out == (zlib.crc32(str(k).encode()) % 4 == 2)
        assert 0 <= got[k].score <= 1
    held = [(got[k].lang_pred, lang) for k, _, lang in rows if got[k].held_out]
    assert len(held) > 20 and np.mean([a == b for a, b in held]) >= 0.95


def test_edges(spark):
    rows, df = made(spark)
    odd = [(9000, None, "en"), (9001, "", "en"), (9002, "12 !? 34", "en"), (9003, "x" * 300_000, None), (None, "the house", "en"), (9004, "the water", None), (9004, "the water", None)]
    both = df.unionAll(spark.createDataFrame(odd, df.schema))
    got = [r for r in langid.identify_languages(both).collect() if r.doc_id is None or r.doc_id >= 9000]
    by = {r.doc_id: r for r in got}
    assert len(got) == len(odd)
    assert [by[k].lang_pred for k in (9000, 9001, 9002)] == ["und"] * 3 and by[9000].score == 0
    assert by[9003].lang_pred in WORDS and by[9004].lang_pred == "en" and by[None].held_out is False


def test_labels_never_enter_a_prediction(spark):
    rows, df = made(spark)
    swapped = spark.createDataFrame([(k, t, "zz" if zlib.crc32(str(k).encode()) % 4 == 2 else lang) for k, t, lang in rows], df.schema)
    predict = lambda d: {r.doc_id: (r.lang_pred, r.score) for r in langid.identify_languages(d).collect()}
    assert predict(df) == predict(swapped)


def test_nothing_to_learn_and_one_language(spark, docs, no_docs):
    assert langid.identify_languages(no_docs).collect() == []
    none = spark.createDataFrame([(1, "words", None)], "doc_id long, text string, lang string")
    assert langid.identify_languages(none).first().lang_pred == "und"
    one = spark.createDataFrame([(k, "some words", "en") for k in range(8)], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in langid.identify_languages(one).collect()} == {"en"}
    assert langid.identify_languages(docs, carry=True).select("row.*").columns == docs.columns


def test_codewords_differ_much():
    for n in (1, 2, 3, 4, 6, 9, 20):
        code = langid.codewords(n)
        assert code.shape[0] == n
        distance = (code.shape[1] - code @ code.T) / 2
        least = min((distance[i, j] for i in range(n) for j in range(i)), default=9)
        assert least >= max(1, code.shape[1] // 4)


def test_windows_see_every_gram(monkeypatch):
    text = langid.cleaned("abcdefghij klmnop " * 5)
    whole = np.sort(langid.gram_buckets(text))
    monkeypatch.setattr(langid, "WINDOW", 1_000_000)
    assert (np.sort(np.concatenate(list(langid.windows(text)))) == whole).all()
    monkeypatch.setattr(langid, "WINDOW", 7)
    seen = np.bincount(np.concatenate(list(langid.windows(text))), minlength=langid.BUCKETS)
    assert (seen == np.bincount(whole, minlength=langid.BUCKETS)).all()


def test_no_language_is_left_out(spark, monkeypatch):
    """300 languages, each with a word of its own; tasks hold the counts of few at once."""
    monkeypatch.setattr(langid, "HELD", 3)
    monkeypatch.setattr(langid, "BLOCK", 7)
    word = lambda k: "".join(chr(0x3041 + int(x)) for x in f"{k * 7919 % 99991:05d}")
    rows = [(k, " ".join([word(k % 300)] * 8), f"l{k % 300}") for k in range(2400)]
    got = langid.identify_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert np.mean([r.lang_pred == f"l{r.doc_id % 300}" for r in got]) >= 0.98


def test_codewords_in_blocks():
    rng = np.random.default_rng(1)
    code = rng.choice([-1.0, 1.0], (50, 20))
    want = min(int((code[i] != code[j]).sum()) for i in range(50) for j in range(i))
    for langid.BLOCK in (7, 1024):
        assert langid.least_distance(code) == want


def test_a_bad_bit_counts_little():
    """Of two bits that are equally sure the one that is never right about a language hardly counts for it."""
    code = np.array([[1.0, 1.0], [-1.0, -1.0]])
    weights = np.tile(np.array([0.5, -0.5], np.float32), (langid.BUCKETS, 1))
    plain = langid.Model(["a", "b"], code, weights, np.ones((2, 2)))
    assert np.allclose(*plain.losses("some text")[0])
    told = langid.Model(["a", "b"], code, weights, np.array([[1.0, langid.LEAST]] * 2))
    assert told.losses("some text")[0].argmin() == 0


def brute(rows, languages, code):
    """The method written out, gram by gram with dictionaries: doc_id -> (language, score)."""
    import math
    import re
    from collections import Counter

    def grams(text):
        text = " " + " ".join(re.findall(r"[^\W\d_]+", text.lower())) + " "
        return Counter(int(langid.gram_buckets(text[k : k + n])[-1]) for n in (1, 2, 3) for k in range(len(text) - n + 1))

    counts = {x: Counter() for x in languages}
    for doc_id, text, lang in rows:
        if zlib.crc32(str(doc_id).encode()) % 4 != 2:
            counts[lang].update(grams(text))
    totals = {x: sum(counts[x].values()) + 0.5 * langid.BUCKETS for x in languages}
    share = lambda x, g: (counts[x][g] + 0.5) / totals[x]

    def margins_of(own):
        margins = []
        for bit in range(len(code[0])):
            yes = [x for k, x in enumerate(languages) if code[k][bit] > 0]
            no = [x for k, x in enumerate(languages) if code[k][bit] < 0]
            total = sum(n * math.log(sum(share(x, g) for x in yes) / len(yes) / (sum(share(x, g) for x in no) / len(no))) for g, n in own.items())
            margins.append(max(-20, min(20, 6 * total / sum(own.values()))))
        return margins

    bits = range(len(code[0]))
    right, seen = {x: [0] * len(code[0]) for x in languages}, Counter()
    for doc_id, text, lang in rows:
        if zlib.crc32(str(doc_id).encode()) % 4 != 2:
            seen[lang] += 1
            for b, m in enumerate(margins_of(grams(text))):
                right[lang][b] += m * code[languages.index(lang)][b] > 0
    reliable = [[max(2 * (right[x][b] + 1) / (seen[x] + 2) - 1, 0.01) for b in bits] for x in languages]
    out = {}
    for doc_id, text, _ in rows:
        margins = margins_of(grams(text))
        weight = [[reliable[k][b] * abs(margins[b]) for b in bits] for k in range(len(languages))]
        loss = [sum(weight[k][b] / sum(weight[k]) * math.exp(-code[k][b] * margins[b] / 2) for b in bits) for k in range(len(languages))]
        best = min(range(len(languages)), key=lambda k: loss[k])
        out[doc_id] = languages[best], 1 / sum(math.exp(loss[best] - x) for x in loss)
    return out


def test_against_brute_force(spark):
    import pytest

    rows, df = made(spark, 90)
    languages = sorted(WORDS)
    want = brute(rows, languages, langid.codewords(3).tolist())
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify_languages(df).collect()}
    assert {k: x for k, (x, _) in got.items()} == {k: x for k, (x, _) in want.items()}
    assert all(got[k][1] == pytest.approx(want[k][1], abs=1e-3) for k in want)
