from __future__ import annotations

import os
import random

import pytest

from hanji.llm import common


def test_hot_keys_join_like_others(spark):
    rng = random.Random(1)
    rows = [(k, 7 if k % 3 == 0 else None if k % 50 == 0 else rng.randrange(2000)) for k in range(6000)]
    many = common.staged(spark.createDataFrame(rows, "id long, key long"), "many")
    one = spark.createDataFrame([(k, k * 10) for k in range(0, 2000, 1)], "key long, v long")
    known = {k: k * 10 for k in range(2000)}
    left = {(r.id, r.key, r.v) for r in common.join_hot(many, one, ["key"], "left").collect()}
    assert left == {(k, key, known.get(key)) for k, key in rows}
    inner = common.join_hot(many, one.filter("key <> 9").withColumn("n", one.key * 0 + 2000), ["key"], counted="n")
    assert {(r.id, r.v) for r in inner.collect()} == {(k, known[key]) for k, key in rows if key is not None and key != 9}


def test_staged_tables_can_be_removed(spark):
    df = common.staged(spark.range(5), "five")
    path = df.inputFiles()[0].removeprefix("file:").removeprefix("//")
    assert df.count() == 5 and os.path.exists(path)
    common.clear_staged(spark)
    assert not os.path.exists(path)


def test_a_cluster_needs_a_shared_folder():
    class Session:
        class conf:
            get = staticmethod(lambda name, default: default)

        class sparkContext:
            master = "spark://somewhere:7077"

    with pytest.raises(ValueError, match="checkpoint"):
        common.shared_folder(Session())


def test_rows_are_marked_by_number(spark):
    rng = random.Random(2)
    numbers = [(part << 33) + k for part in (0, 1, 900) for k in range(200)]
    rows = spark.createDataFrame([(x, f"text {x}") for x in [*numbers, numbers[3]]], "number long, text string")
    some = {0, 63, 64, *rng.sample(numbers, 150)}
    for most in (common.BITMAP_ROWS, 0):
        got = common.marked(rows, spark.createDataFrame([(x,) for x in some], "number long"), "number", most)
        assert got.columns == ["number", "text", "marked"]
        assert sorted((r.number, r.marked) for r in got.collect()) == sorted((x, x in some) for x in [*numbers, numbers[3]])
    assert {r.marked for r in common.marked(rows, rows.filter("false"), "number").collect()} == {False}


def test_staged_tables_are_packed_tight(spark):
    import pyarrow.parquet as pq

    file = common.staged(spark.range(5), "five").inputFiles()[0].removeprefix("file:").removeprefix("//")
    assert pq.ParquetFile(file).metadata.row_group(0).column(0).compression == "ZSTD"
