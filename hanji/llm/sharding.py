"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

SHARDS = 8
SEED = 20_011
#: Rows that one task permutes in the second permutation, on average.
BUCKET_ROWS = 4096


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of `draws` items taken without replacement are good, exactly distributed, for totals of any size.

    The probabilities come from the recurrence outward from the mode, over a window beyond which they are below 1e-20.
    """
    low, high = max(0, draws - bad), min(draws, good)
    if low == high:
        return low
    total = good + bad
    mode = min(max((draws + 1) * (good + 1) // (total + 2), low), high)
    spread = (draws * (good / total) * (bad / total)) ** 0.5
    reach = int(10 * spread + 60)
    up = np.arange(mode, min(high, mode + reach), dtype=float)
    down = np.arange(mode, max(low, mode - reach), -1, dtype=float)
    rising = np.cumprod((good - up) * (draws - up) / ((up + 1) * (bad - draws + up + 1)))
    falling = np.cumprod(down * (bad - draws + down) / ((good - down + 1) * (draws - down + 1)))
    weights = np.concatenate([falling[::-1], [1.0], rising])
    sums = np.cumsum(weights)
    return mode - len(falling) + int(np.searchsorted(sums, rng.random() * sums[-1], side="right").clip(0, len(sums) - 1))


def communication_matrix(counts: list[int], shards: int, seed: int) -> list[list[int]]:
    """Rows that each partition sends to each shard: row sums are `counts`, column sums are the shard sizes."""
    total = sum(counts)
    room = [total // shards + (k < total % shards) for k in range(shards)]
    rng = np.random.default_rng(seed)
    matrix = []
    for n in counts:
        row, left, open_room = [], n, sum(room)
        for k in range(shards):
            x = hypergeometric(rng, room[k], open_room - room[k], left)
            row.append(x)
            open_room -= room[k]
            left -= x
        room = [a - b for a, b in zip(room, row, strict=True)]
        matrix.append(row)
    return matrix


def uniform_shards(rows: DataFrame, key: list[Column], shards: int = SHARDS, seed: int = SEED, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Deal all rows into shards: (row struct, shard int, slot long), a uniformly random order with counts at most one apart.

    1. Each partition puts its rows in a random order (a local sort by a seeded hash of `key`, no shuffle) and is staged.
    2. From the partitions' row counts the driver draws how many rows each sends to each shard: the counts of a uniform
       shuffle follow the multivariate hypergeometric law. The matrix has one small row for each input partition.
    3. A partition's first rows go to shard 0, the next to shard 1, and so on: with (2), a uniform choice of rows.
    4. Each shard is permuted again: rows fall into buckets by a fresh hash and are numbered in each bucket in hash
       order after the sizes of the buckets before. No task holds a shard, and no key decides where a row goes, so hot
       sources and groups of copies are spread evenly.

    Columns of any name and number travel in `row`, so names can't clash. Nulls in the key only join the hash. Rows that
    are equal in all of `key` keep any order between them. No rows give no rows. Reruns over the same files agree.
    """
    spark = rows.sparkSession
    at = F.monotonically_increasing_id()
    local = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"), F.xxhash64(F.lit(seed), *key).alias("draw"))
    local = local.sortWithinPartitions("draw").withColumn("at", at)
    local = staged(local.select("row", F.shiftright("at", 33).alias("part"), F.col("at").bitwiseAND(F.lit((1 << 33) - 1)).alias("nth")), "permuted")

    counts = sorted((r.part, r.n) for r in local.groupBy("part").agg(F.count("*").alias("n")).collect())
    matrix = communication_matrix([n for _, n in counts], shards, seed)
    ends = [(part, np.cumsum(row).tolist()) for (part, _), row in zip(counts, matrix, strict=True)]
    ends = staged(spark.createDataFrame(ends, "part long, ends array<long>").coalesce(1), "matrix")
    buckets = max(1, round(sum(n for _, n in counts) / shards / bucket_rows))

    dealt = (
        local.join(ends, "part")
        .withColumn("shard", F.size(F.filter("ends", lambda end: end <= F.col("nth"))))
        .withColumn("draw", F.xxhash64(F.lit(seed + 1), "part", "nth"))
        .withColumn("bucket", F.pmod("draw", F.lit(buckets)))
        .select("row", "shard", "bucket", "draw", "part", "nth")
    )
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("shard", "bucket").agg(F.count("*").alias("n")).select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "bucket").orderBy("draw", "part", "nth")
    return dealt.join(starts, ["shard", "bucket"]).select("row", F.col("shard").cast("int").alias("shard"), (F.col("start") + F.row_number().over(inside) - 1).alias("slot"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Documents (doc_id, text, ...) -> doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Null texts count as empty (size 1, checksum 0); other columns are ignored. The law is `rows`.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    dealt = uniform_shards(rows, [F.col("doc_id"), F.col("text_crc32")], shards, seed)
    return dealt.select("row.*", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
