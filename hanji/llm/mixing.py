"""Mixing sources to target weights by the cube method."""

from __future__ import annotations

import random
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import join_hot, marked, staged, word_count

#: Weights of the sources in order, repeating; the mix's size against all sizes; the most that a source is repeated.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
SEED = 7_001
#: Documents that one flight phase balances, on average.
BLOCK_ROWS = 512


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, n) -> those and target: share * all sizes by weight, at most `most` times a source's size.

    What a source can't take is shared again by weight: the level (target for each unit of weight) rises until no source
    is above its limit. Each rise is one aggregate over the sources, and their places in order come from sorted
    partitions, so there may be as many sources as there are documents.
    """
    ordered = sizes.repartitionByRange(F.col("source").asc_nulls_last()).sortWithinPartitions(F.col("source").asc_nulls_last())
    numbered = staged(ordered.withColumns({"part": F.spark_partition_id(), "place": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}), "sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    starts = numbered.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.col("start") + F.col("place"), F.lit(len(weights))))
    named = numbered.join(F.broadcast(starts), "part").select("source", "source_size", "n", weight.alias("weight"), (F.col("source_size") * float(most)).alias("limit"))
    goal = (named.agg(F.sum("source_size")).first()[0] or 0) * share
    level = 0.0
    while True:
        full = F.col("limit") <= F.col("weight") * level
        row = named.agg(F.sum(F.when(full, F.col("limit"))), F.sum(F.when(~full, F.col("weight")))).first()
        if not row[1]:
            return named.select("source", "source_size", "n", F.col("limit").alias("target"))
        rest = max(0.0, goal - (row[0] or 0.0)) / row[1]
        if rest <= level:
            return named.select("source", "source_size", "n", F.least("limit", F.col("weight") * level).alias("target"))
        level = rest


def flight(sizes: np.ndarray, chances: np.ndarray, rng: random.Random, land: bool) -> np.ndarray:
    """Move chances to 0 or 1 along the null space of the two balancing constraints, the expected number of documents
    and the expected number of words, until fewer than three are left between.

    Each step moves the first open unit, and all others by as little as keeps both sums, until one of them arrives; up
    or down is drawn so that each chance keeps its expectation. With sizes in descending order large units are settled
    while there are many others to make up for them, and small ones stay open. land: settle the last ones too, first
    giving up the number of documents, then at random.
    """
    p, sizes = chances.astype(float), sizes.astype(float)

    def step(at: np.ndarray, u: np.ndarray) -> None:
        q = p[at]
        moving = np.abs(u) > 1e-12
        q, u, at = q[moving], u[moving], at[moving]
        up = (np.where(u > 0, 1 - q, q) / np.abs(u)).min()
        down = (np.where(u > 0, q, 1 - q) / np.abs(u)).min()
        q = q + (up if rng.random() * (up + down) < down else -down) * u
        q[q < 1e-9], q[q > 1 - 1e-9] = 0.0, 1.0
        p[at] = q

    at = np.flatnonzero((p > 0) & (p < 1))
    while len(at) > 2:
        room, size = p[at] * (1 - p[at]), sizes[at]
        away = size - (room @ size) / room.sum()
        spread = room @ (away * away)
        for k in range(3):
            u = -room[k] / room.sum() - (room[k] * away[k] / spread * away if spread > 1e-9 else 0.0) + np.zeros(len(at))
            u[k] += 1
            u *= room
            if np.abs(u).max() > 1e-9:
                break
        step(at, u / np.abs(u).max())
        at = at[(p[at] > 0) & (p[at] < 1)]
    while land and len(at):
        if len(at) == 2 and sizes[at].all():
            step(at, np.array([sizes[at[1]], -sizes[at[0]]]) / sizes[at].max())
        else:
            step(at[:1], np.ones(1))
        at = at[(p[at] > 0) & (p[at] < 1)]
    return p


def _balance(level: int, last: bool, seed: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """One block: the largest documents enter the flight first, so that small ones remain for the next level."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "unit", "row"], ascending=[False, True, True], kind="stable")
        rng = random.Random(f"{seed},{level},{pdf['source'].iloc[0]},{pdf['block'].iloc[0]}")
        return pdf.assign(chance=flight(pdf["size"].to_numpy(), pdf["chance"].to_numpy(), rng, last))

    return run


def cube_sample(units: DataFrame, block_rows: int = BLOCK_ROWS, seed: int = SEED) -> DataFrame:
    """units (source, row, unit, size, chance, n) -> source, row, taken boolean, by the cube method within each source.

    chance is the same for all rows of a source, n its number of rows, row a unique number, and unit the number from which
    all draws come.
    Rows fall by hash into blocks of about `block_rows`, each of which flies on its own and leaves at most two rows open;
    those meet in larger and fewer blocks of the next level, until one block is left in every source and lands. Hot
    sources have more blocks. The words taken of a source miss their expected number by a few small documents.
    """
    found = units.agg(F.max("n"), F.count("*")).first()
    most, total = found[0] or 0, found[1]
    schema = "source string, row long, unit long, size long, chance double, n long, block long"
    settled, level, left = None, 0, units.select("source", "row", "unit", "size", "chance", "n")
    while True:
        last = most <= block_rows
        blocks = F.greatest(F.ceil(F.col("n") / block_rows), F.lit(1))
        left = left.withColumn("block", F.pmod(F.xxhash64(F.lit(seed + level), "unit"), blocks))
        # The work is a block's steps, not its bytes, so bytes don't decide how many tasks share it.
        tasks = max(1, min(1000, total // (4 * block_rows)))
        flown = staged(left.repartition(tasks, "source", "block").groupBy("source", "block").applyInPandas(_balance(level, last, seed), schema), f"flight{level}")
        done = flown if last else flown.filter("chance = 0 or chance = 1")
        settled = done if settled is None else settled.unionAll(done)
        if last:
            return settled.select("source", "row", (F.col("chance") == 1).alias("taken"))
        left = flown.filter("chance > 0 and chance < 1").select("source", "row", "unit", "size", "chance", F.least("n", 2 * F.ceil(F.col("n") / block_rows)).alias("n"))
        most, total, level = min(most, 2 * -(-most // block_rows)), min(total, 2 * -(-total // block_rows)), level + 1


def numbered_units(rows: DataFrame) -> DataFrame:
    """Stored rows (row, draw, ...) -> row and unit, a number from draw and a count among the rows of equal draw, so the
    units are the same however the rows are partitioned. Equal draws are counted within the partitions of `row` and
    those counts added up, so many equal rows are no single task's work."""
    keyed = rows.select("row", "draw", F.shiftright("row", 33).alias("part"))
    inside = F.row_number().over(Window.partitionBy("draw", "part").orderBy("row"))
    parts = staged(keyed.groupBy("draw", "part").count(), "draws")
    before = Window.partitionBy("draw").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    starts = parts.withColumn("start", F.sum("count").over(before)).filter("start > 0").select("draw", "part", "start")
    counted = staged(keyed.withColumn("inside", inside), "counted")
    placed = join_hot(counted, staged(starts, "starts"), ["draw", "part"], "left")
    return placed.select("row", F.xxhash64("draw", F.col("inside") + F.coalesce("start", F.lit(0))).alias("unit"))


def mix_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = SEED, carry: bool = False) -> DataFrame:
    """Documents (doc_id, source, text, ...) -> row, doc_id, source, size, source_size, target, copies, taken.

    A source with target / size = q + f takes each document q times and once more with chance f, by the cube method.
    Null texts have size 0; a null source is a source of its own, last in order. `row` numbers the input's rows (other
    columns are ignored, repeated rows are rows of their own, with chances of their own). A source without words has
    target 0 and no copies. No rows give no rows. Draws come from doc_id, source and text and, among equal rows, from a
    count, so the same rows give the same mix in whatever files and partitions. carry: a struct `all` holds all of a
    row's columns.
    """
    whole = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("all")] if carry else []
    draw = F.xxhash64(F.lit(seed), "doc_id", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")), "text").alias("draw")
    rows = staged(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "source", draw, word_count(F.col("text")).alias("size"), *whole), "sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    targets = staged(source_targets(sizes, weights, share, most), "targets")
    ratio = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    targets = targets.withColumn("whole", F.least(F.floor(ratio + 1e-12), F.lit(most))).withColumn("chance", F.greatest(ratio - F.col("whole"), F.lit(0.0)))
    named = F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")).alias("of")
    known = join_hot(rows.select("*", named), targets.withColumn("of", named).drop("source"), ["of"], counted="n")
    units = known.filter("chance > 0").join(numbered_units(rows), "row").select(F.col("of").alias("source"), "row", "unit", "size", "chance", "n")
    extra = cube_sample(staged(units, "units"), seed=seed).filter("taken").select("row")
    mixed = marked(known, extra, "row")
    copies = (F.col("whole") + F.col("marked").cast("int")).cast("int")
    return mixed.select("row", "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).cast("long").alias("taken"), *(["all"] if carry else []))
