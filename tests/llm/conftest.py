from __future__ import annotations

import random

import pytest

SYLLABLES = ["the", "ing", "tion", "an", "re", "wh", "ou", "st", "ble", "ly"]
#: Extra columns whose names operators use for their own.
CLASHING = ["size", "row", "target", "taken", "copies", "shard", "slot", "bucket", "part", "draw", "fp", "key", "component", "n", "leaf", "block", "has_letter", "held_out", "score", "piece", "start", "length", "tie", "segment", "host", "path"]


def prose(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(words))


def corpus(seed: int = 1, n: int = 120) -> list[tuple]:
    """(doc_id, text, lang, source): a hot source, a null one, copies, near copies, null, empty and long texts, and a
    repeated row."""
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        text = prose(rng, rng.choice([1, 2, 3, 20, 60, 150]))
        source = "hot" if k % 3 == 0 else rng.choice(["a", "b", "é", None])
        rows.append((k, text, rng.choice(["en", "fr", None]), source))
    base = prose(rng, 400)
    for k in range(n, n + 20):
        words = base.split()
        if k % 2:
            words[rng.randrange(400)] = "changed"
        rows.append((k, " ".join(words), "en", "hot"))
    rows += [(n + 20, None, "en", "a"), (n + 21, "", None, None), (n + 22, " \t\n ", "fr", "b"), (n + 23, prose(rng, 20_000), "en", "b"), (n + 24, "12 34 !!", "en", "a")]
    rows += [(None, "no id here", "en", "a"), rows[5], rows[5], (n + 25, "CAPS Ünïcödé\x0bvertical\xa0joined", "fr", "é")]
    return rows


SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def corpus_rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, corpus_rows, tmp_path_factory):
    """The corpus as several Parquet files, with columns of clashing names."""
    from pyspark.sql import functions as F

    path = str(tmp_path_factory.mktemp("corpus") / "documents.parquet")
    spark.createDataFrame(corpus_rows, SCHEMA).repartition(5).select("*", *[F.lit("x").alias(c) for c in CLASHING]).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
