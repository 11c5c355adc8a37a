from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from hanji.operators import search, vector_index


def clustered(n, centers, dimension=32, seed=1):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centers, dimension))
    v = middle[rng.integers(0, centers, n)] + 0.45 * rng.normal(size=(n, dimension))
    return (v / np.linalg.norm(v, axis=1, keepdims=True)).round(6)


@pytest.fixture(scope="module")
def chunks(spark, tmp_path_factory):
    rows = [(f"c{k}", f"d{k // 4}", "text" if k % 3 else "table", f"words {k}", v.tolist()) for k, v in enumerate(clustered(6000, 40))]
    rows += [("null", "d0", "text", "x", None), ("zero", "d1", "text", "x", [0.0] * 32), ("short", "d2", "text", "x", [1.0])]
    path = str(tmp_path_factory.mktemp("chunks") / "chunks")
    spark.createDataFrame(rows[:-1], "chunk_id string, doc_id string, chunk_type string, text string, embedding array<float>").write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def index(spark, chunks, tmp_path_factory):
    made = vector_index.VectorIndex(spark, str(tmp_path_factory.mktemp("index") / "i"))
    assert not made.exists()
    made.build(chunks, lists=40, rows_per_list=50)
    assert made.exists()
    return made


QUERIES = [v.tolist() for v in clustered(12, 40, seed=1)[:12]]


def hits(df):
    return [(r["chunk_id"], round(r["similarity"], 5)) for r in df.collect()]


def test_all_probes_equal_the_scan(chunks, index):
    assert index.chunks().filter("chunk_id is not null").count() == chunks.count()
    lists = index.centroids().count()
    assert 20 <= lists <= 40
    for query in QUERIES[:2]:
        assert hits(index.similarity_search(query, 20, lists)) == hits(search.similarity_search(chunks, search.literal_vector(query), 20))
        exact = search.hybrid_search(chunks, search.literal_vector(query), "words 7", 20)
        assert hits(index.hybrid_search(query, "words 7", 20, lists)) == hits(exact)


def test_few_probes_find_most(index):
    assert vector_index.recall(index, QUERIES, 10, 6) >= 0.9


def test_only_probed_lists_are_read(index):
    found = index.similarity_search(QUERIES[0], 5, 3, filters={"chunk_type": "text"}, threshold=0.1)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "list#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    read = index.probed(QUERIES[0], 3).select(F.input_file_name().alias("f")).distinct().count()
    assert 1 <= read <= 3


def test_replaced_documents(spark, chunks, index, tmp_path):
    own = vector_index.VectorIndex(spark, str(tmp_path / "own"))
    own.build(chunks, lists=8)
    new = spark.createDataFrame([("n1", "d3", "text", "new", QUERIES[0]), ("n2", "dx", "text", "new", None)], chunks.schema)
    own.replace(new, spark.createDataFrame([("d3",), ("dx",), ("d0",)], "doc_id string"))
    got = own.chunks().filter("chunk_id is not null")
    want = chunks.filter("doc_id not in ('d3', 'd0')").select("chunk_id").union(new.select("chunk_id"))
    assert sorted(r[0] for r in got.select("chunk_id").collect()) == sorted(r[0] for r in want.collect())
    assert hits(own.similarity_search(QUERIES[0], 1, 2))[0] == ("n1", 1.0)


def test_an_empty_index(spark, chunks, tmp_path):
    own = vector_index.VectorIndex(spark, str(tmp_path / "own"))
    own.build(chunks.limit(0))
    assert own.exists() and own.similarity_search(QUERIES[0], 5).count() == 0
    own.replace(chunks.limit(3), chunks.limit(3))
    assert own.similarity_search(QUERIES[0], 5).count() == 3
    with pytest.raises(ValueError):
        own.similarity_search(QUERIES[0], 5, 0)
