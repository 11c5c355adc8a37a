"""The stages one after another, each against what its input calls for: known languages, brute-force similarity, the
mix's bounds, and every token of what was taken."""

from __future__ import annotations

import os
import random
from collections import Counter

import pytest

pytest.importorskip("public_tokenizers")
import corpus_pipeline  # noqa: E402

from .conftest import CLASHING  # noqa: E402
from .test_packing import pieces  # noqa: E402
from .test_similar import brute_groups  # noqa: E402

SYLLABLES = {
    "en": ["the", "ing", "wh", "ould", "th", "er", "ness", "ck", "ow", "sh", "ly"],
    "fr": ["eau", "ou", "que", "é", "tion", "ais", "ille", "ez", "oi", "ç", "au"],
    "de": ["sch", "ung", "ein", "ich", "ß", "ä", "ver", "keit", "tz", "ü", "cht"],
    "es": ["ción", "ñ", "ar", "ado", "os", "el", "ía", "rr", "que", "las", "ué"],
    "other": ["zky", "prz", "szcz", "ów", "ł", "ń", "ie", "ście", "rz", "ży", "wą"],
}
LANGUAGES = ("en", "fr", "de", "es")


def prose(rng, lang, words):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(words))


def made():
    """(doc_id, text, lang, source), and for each row whether language ID is to keep it."""
    rng, rows, stays = random.Random(5), [], []

    def add(text, lang, keep, source=None):
        rows.append((len(rows), text, lang, source or rng.choice(["hot", "hot", "a", "b", None])))
        stays.append(keep)

    for k in range(90):
        lang = LANGUAGES[k % 4]
        add(prose(rng, lang, rng.choice([1, 3, 40, 120, 300])), rng.choice([lang, lang, None]), True)
    for lang in ("en", "fr"):
        base = prose(rng, lang, 200).split()
        for k in range(12):
            words = list(base)
            if k % 3:
                words[rng.randrange(200)] = "changed"
            add(" ".join(words), lang, True, "hot")
    for _ in range(6):
        add(prose(rng, "other", 150), None, False)
    add(prose(rng, "en", 150) + " " + prose(rng, "fr", 110), "en", True)  # two learned languages, each beyond doubt
    add(prose(rng, "other", 300) + " " + prose(rng, "fr", 20), None, False)
    add(prose(rng, "other", 2), None, True)  # too short to be in doubt
    add(prose(rng, "en", 20_000), "en", True)
    for text in (None, "", " \t\n ", "12 34 !!"):
        add(text, "en", False)
    return rows, stays


def test_stages(spark, tmp_path):
    from pyspark.sql import functions as F

    rows, stays = made()
    current = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(4)
    current = current.select("*", *[F.lit("x").alias(c) for c in CLASHING])
    columns = current.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language ID", "SimHash near-dedup", "mixing sources", "best-fit packing"]
    frames = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(k))
        stage(spark, current, "").write.parquet(path)
        current = spark.read.parquet(path)
        frames.append(current)
    for df in frames[:-1]:
        assert df.columns == columns
    named = sorted(tuple(r)[:4] for r in frames[0].collect())
    assert [r[0] for r in named] == [r[0] for r, keep in zip(rows, stays, strict=True) if keep]
    for doc_id, text, lang, source in named:
        assert (text, source) == (rows[doc_id][1], rows[doc_id][3]) and lang == (rows[doc_id][2] or lang) is not None
        if rows[doc_id][2] is None and len(text) > 200:
            assert (doc_id >= 90 or lang == LANGUAGES[doc_id % 4])
    root = brute_groups([r[1] for r in named])
    single = sorted((r.doc_id, r.text) for r in frames[1].collect())
    assert single == [r[:2] for k, r in enumerate(named) if root[k] == k] and len(single) <= len(named) - 22
    mixed = [(r.doc_id, r.text) for r in frames[2].collect()]
    assert set(mixed) <= set(single) and max(Counter(mixed).values()) <= 2
    assert len(mixed) > len(single) / 2
    assert Counter(tuple(r)[:5] for r in frames[3].collect()) == Counter(pieces(mixed))


def test_no_documents(spark, no_docs):
    current = no_docs
    for _, stage in corpus_pipeline.STAGES:
        current = stage(spark, current, "")
    assert current.collect() == []


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="needs the driver's tables")
def test_run(spark):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 100
