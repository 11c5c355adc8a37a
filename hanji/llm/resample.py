"""Importance resampling: documents drawn by how much likelier their n-grams are in a target set than in the corpus."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import partial
from itertools import repeat
from string import ascii_lowercase, ascii_uppercase
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import in_order, staged

#: Buckets of features, shortest and longest run of words that is one, words a drawn document needs, percentage drawn, seed.
BUCKETS, LENGTHS, MIN_WORDS, PERCENT, SEED = 10_000, (1, 1), 20, 10, 2024
#: Bytes -> bytes in which words are a-z, 0-9 and everything beyond ASCII, and the rest is spaces.
WORD_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in bytes(range(256)).translate(bytes.maketrans(ascii_uppercase.encode(), ascii_lowercase.encode())))


def features(text: bytes, lengths: tuple[int, int], buckets: int) -> tuple[int, np.ndarray]:
    """Number of words, and the buckets of all runs of lengths[0] to lengths[1] words. Long texts are cut, and a cut hands
    on the words before it that runs across it need."""
    n_words, found, before = 0, [], []
    for part in tokens.slices(text.translate(WORD_BYTES)):
        words = part.split()
        n_words += len(words)
        for length in range(lengths[0], lengths[1] + 1):
            here = before[len(before) - min(len(before), length - 1) :] + words
            runs = here if length == 1 else list(map(b" ".join, zip(*(here[i:] for i in range(length)), strict=False)))
            found.append(np.fromiter(map(crc32, runs), np.uint32, len(runs)) % np.uint32(buckets))
        before = (before + words)[-(lengths[1] - 1) :] if lengths[1] > 1 else []
    return n_words, np.concatenate(found)


def in_portions(batches: Iterator[pa.RecordBatch], lengths: tuple[int, int], buckets: int) -> Iterator[tuple[pa.RecordBatch, list[int], np.ndarray, np.ndarray]]:
    """Rows (text, ...) -> portions of rows with each row's number of words, and the buckets of all their features with the
    rows they belong to."""
    for batch in batches:
        for part in tokens.portions(batch):
            found = [features(text or b"", lengths, buckets) for text in part.column("text").cast(pa.binary()).to_pylist()]
            rows = np.repeat(np.arange(len(found)), [len(b) for _, b in found])
            yield part, [n for n, _ in found], np.concatenate([b for _, b in found]), rows


def _counts(lengths: tuple[int, int], buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One vector of counts for a partition."""
    total = np.zeros(buckets, np.int64)
    for _, _, found, _ in in_portions(batches, lengths, buckets):
        total += np.bincount(found, minlength=buckets)
    yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["counts"])


def bucket_counts(docs: DataFrame, lengths: tuple[int, int] = LENGTHS, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket. Partitions send one vector each, which a tree of tasks adds
    up; the driver gets the last few."""
    sc = docs.sparkSession.sparkContext
    vectors = docs.select("text").mapInArrow(partial(_counts, lengths, buckets), "counts binary").rdd.map(lambda r: np.frombuffer(r[0], np.int64))
    return sc.union([vectors, sc.parallelize([np.zeros(buckets, np.int64)], 1)]).treeReduce(np.add)


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(p / q)) of each bucket, with one more feature in every bucket of both."""
    n, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    gain = lambda s, t: math.floor(1000 * math.log((t + 1) * float(s_all + n) / ((s + 1) * float(t_all + n))))
    return np.array(list(map(gain, corpus.tolist(), target.tolist())), np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """floor(1000 g) for a draw g of Gumbel's distribution that doc_id and seed decide."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _scores(gains: Broadcast, lengths: tuple[int, int], seed: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    of_bucket = gains.value
    for part, n_words, found, rows in in_portions(batches, lengths, len(of_bucket)):
        weight = np.bincount(rows, weights=of_bucket[found], minlength=len(part)).astype(np.int64)  # sums of integers far below 2 ** 53
        score = weight + np.fromiter(map(noise, part.column("doc_id").to_pylist(), repeat(seed)), np.int64, len(part))
        n_features = np.bincount(rows, minlength=len(part))
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), *map(pa.array, (np.array(n_words, np.int64), n_features, weight, score))], ["doc_id", "n_words", "n_features", "weight", "score"])


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, buckets: int = BUCKETS, lengths: tuple[int, int] = LENGTHS, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """Documents (doc_id, text, ...) and target (text, ...) -> doc_id, n_features, weight, score, rank, one row for each
    document; rank is null where it isn't drawn.

    Words are runs of letters and digits of ASCII (A-Z made small) and of any other characters; features, runs of words,
    fall into buckets by crc32. A bucket's gain is the logarithm of its share in the target against that in the corpus, a
    document's weight the sum over its features, and its score the weight and a Gumbel draw, so that the highest scores are
    a sample without replacement by importance. Of the N documents of min_words words or more, the highest
    percent * N / 100 (rounded down) scores are drawn, ties by doc_id.

    Null and empty texts have no features and weight 0. A null doc_id draws like an empty one and loses ties. Repeated
    rows are documents of their own. No documents give no rows; without target texts all gains follow from the corpus
    alone. Other columns are ignored.

    Two passes over the texts: the first sends a vector of counts for each partition, the second sends four numbers for
    each document. What is broadcast is one number a bucket. The order comes from a sort by ranges, of which the driver
    sees one count a range.
    """
    spark = docs.sparkSession
    gains = spark.sparkContext.broadcast(bucket_gains(bucket_counts(docs, lengths, buckets), bucket_counts(target, lengths, buckets)))
    schema = "doc_id long, n_words long, n_features long, weight long, score long"
    scored = docs.select("doc_id", "text").mapInArrow(partial(_scores, gains, lengths, seed), schema)
    scored = staged(scored.withColumn("row", F.monotonically_increasing_id()), "scores")
    enough = scored.filter(F.col("n_words") >= min_words)
    drawn = percent * enough.count() // 100
    placed = in_order(enough, F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("row"))
    rank = F.when(F.col("position") < drawn, F.col("position") + 1).alias("rank")
    found = ["doc_id", "n_features", "weight", "score"]
    return placed.select(*found, rank).unionByName(scored.filter(F.col("n_words") < min_words).select(*found, F.lit(None).cast("long").alias("rank")))
