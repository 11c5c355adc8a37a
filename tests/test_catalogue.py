"""Every query with an oracle against DuckDB on the smallest tables, and what the driver reads."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from hanji.plans import catalogue

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(FOLDER):
        con.sql(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{name}'")
    return con


def plain(rows):
    same = lambda v: round(v, 6) if isinstance(v, float) else tuple(map(same, v)) if isinstance(v, list) else v
    return sorted((tuple(same(v) for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_oracle(spark, duck, name):
    got = catalogue.QUERIES[name](spark, FOLDER)
    columns = sorted(got.columns)
    want = duck.sql(catalogue.ORACLES[name])
    assert columns == sorted(want.columns)
    quoted = ", ".join(f'"{c}"' for c in columns)
    assert plain([tuple(r) for r in got.select(columns).collect()]) == plain(duck.sql(f"SELECT {quoted} FROM ({catalogue.ORACLES[name]})").fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() == 20


def test_searches_take_only_the_top(spark):
    for name in ("vector_topk", "hybrid_topk"):
        plan = catalogue.QUERIES[name](spark, FOLDER)._jdf.queryExecution().toString()
        assert "TakeOrderedAndProject" in plan
        assert "Python" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = catalogue.QUERIES["vector_topk_filtered"](spark, FOLDER)._jdf.queryExecution().toString()
    assert "EqualTo(lang,en)" in plan
    assert "html" not in plan
