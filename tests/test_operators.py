from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F

from hanji.config import EngineConfig, clean_query, expand_root
from hanji.operators import attachments, chunking, search, stats, store


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def chunks(spark):
    data = [("c1", "d1", "text", "부산 항만 License", [1.0, 0.0]), ("c2", "d1", "table", "50% off_", [0.0, 1.0]), ("c3", "d2", "text", None, None), ("c4", "d2", "text", "x", [-1.0, 0.0])]
    return spark.createDataFrame(data, "chunk_id string, doc_id string, chunk_type string, text string, embedding array<float>")


def test_similarity_search(spark, chunks):
    q = search.literal_vector([1.0, 0.0])
    got = search.similarity_search(chunks, q, 10).collect()
    assert [(r["chunk_id"], r["similarity"]) for r in got] == [("c1", 1.0), ("c2", 0.0), ("c4", -1.0)]
    assert [r["chunk_id"] for r in search.similarity_search(chunks, q, 10, threshold=0.5).collect()] == ["c1"]
    assert [r["chunk_id"] for r in search.similarity_search(chunks, q, 10, filters={"chunk_type": "table"}).collect()] == ["c2"]
    docs = spark.createDataFrame([("d1", "A"), ("d2", "B")], "doc_id string, biz_cate string")
    assert [r["chunk_id"] for r in search.similarity_search(chunks, q, 10, filters={"biz_cate": "B"}, documents=docs).collect()] == ["c4"]
    with pytest.raises(ValueError):
        search.similarity_search(chunks, q, 0)
    assert search.clamp_top_k(5000) == 1000


def test_hybrid_search(chunks):
    q = search.literal_vector([0.0, 1.0])
    got = search.hybrid_search(chunks, q, " license ", 2, vector_weight=0.2).collect()
    assert [(r["chunk_id"], round(r["similarity"], 6)) for r in got] == [("c1", 0.8), ("c2", 0.2)]
    assert [r["chunk_id"] for r in search.hybrid_search(chunks, q, "0% OFF_", 1, vector_weight=0.5).collect()] == ["c2"]
    with pytest.raises(ValueError):
        search.hybrid_search(chunks, q, "x", vector_weight=1.5)


def test_search_joins_documents_last(spark, chunks):
    docs = spark.createDataFrame([("d1", "제목", "n", "a", "b", "2024-01-01", "p")], "doc_id string, title string, doc_no string, author_name string, dept_name string, report_date string, biz_full_path string")
    got = search.search(chunks, docs, search.literal_vector([1.0, 0.0]), 2, keyword="license").collect()
    assert [(r["chunk_id"], r["title"], r["search_mode"]) for r in got] == [("c1", "제목", "hybrid"), ("c2", "제목", "hybrid")]
    assert search.search(chunks, docs, search.literal_vector([-1.0, 0.0]), 1).first()["title"] is None


def test_stats(spark, chunks):
    got = stats.store_stats(spark.range(3), chunks).first()
    assert (got["document_count"], got["chunk_count"], got["chunk_types"]) == (3, 4, {"text": 3, "table": 1})
    counts = rows(stats.value_counts(spark.createDataFrame([("a", None), ("a", "b")], "x string, y string"), "x", "y").select(F.coalesce("column", F.lit("")), F.coalesce("value", F.lit("")), "n"))
    assert counts == [("", "", 2), ("x", "a", 2), ("y", "b", 1)]
    empty = stats.run_counters(spark.createDataFrame([], "status string, chunks int, excluded int")).first()
    assert tuple(empty) == (0, 0, 0, 0, 0)


def test_upsert_keeps_created_at(spark):
    stored = spark.createDataFrame([(1, "a", "2020", "2020"), (2, "b", "2020", "2020")], "doc_id int, v string, created_at string, updated_at string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "doc_id int, v string")
    assert rows(store.upsert(stored, new, "doc_id", F.lit("2024"))) == [(1, "a", "2020", "2020"), (2, "c", "2020", "2024"), (3, "d", "2024", "2024")]


def test_replace_delete_classify_report(spark):
    old = spark.createDataFrame([("a", 0), ("a", 1), ("b", 0)], "doc_id string, n int")
    assert rows(store.replace_children(old, spark.createDataFrame([("a", 9)], old.schema))) == [("a", 9), ("b", 0)]
    assert rows(store.replace_children(old, old.limit(0))) == [("a", 0), ("a", 1), ("b", 0)]
    assert rows(store.delete({"t": old}, spark.createDataFrame([("a",)], "doc_id string"))["t"]) == [("b", 0)]
    now = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "doc_id string, file_hash string")
    was = spark.createDataFrame([("a", "1"), ("b", "x")], "doc_id string, file_hash string")
    assert rows(store.classify_changes(now, was).select("doc_id", "change")) == [("a", "unchanged"), ("b", "update"), ("c", "new")]
    assert rows(store.id_report(now, was.unionAll(spark.createDataFrame([("z", "")], was.schema)))) == [("a", "matched"), ("b", "matched"), ("c", "missing_in_metadata"), ("z", "missing_in_data")]


def test_keep_last(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, "y"), ("b", 1, "z"), (None, 5, "n")], "k string, o int, v string")
    assert sorted(map(str, store.keep_last(df, "k", F.col("o")).collect())) == sorted(["Row(k='a', o=2, v='y')", "Row(k='b', o=1, v='z')", "Row(k=None, o=5, v='n')"])


def test_mirror_sync_is_idempotent_and_keeps_vanished_documents(spark):
    docs = spark.createDataFrame([("a", "t", "n", "n")], "doc_id string, title string, created_at string, updated_at string")
    parts = spark.createDataFrame([("a", 0, [1.0], "n")], "doc_id string, chunk_num int, embedding array<float>, created_at string")
    files = spark.createDataFrame([(1, "a", "f", "n")], "attachment_id int, doc_id string, file_name string, created_at string")
    source = {"documents": docs, "document_chunks": parts, "attachments": files}
    target = {
        "documents": spark.createDataFrame([("gone", "x")], "doc_id string, title string"),
        "document_chunks": spark.createDataFrame([("a", 7, [0.0]), ("gone", 0, [0.0])], "doc_id string, chunk_num int, embedding array<double>"),
        "attachments": spark.createDataFrame([("a", "old")], "doc_id string, file_name string"),
    }
    once = store.sync_mirror(source, target)
    twice = store.sync_mirror(source, once)
    assert rows(once["documents"]) == [("a", "t"), ("gone", "x")]
    assert [(r["doc_id"], r["chunk_num"]) for r in once["document_chunks"].orderBy("doc_id").collect()] == [("a", 0), ("gone", 0)]
    assert rows(once["attachments"]) == [("a", "f")]
    for name, df in once.items():
        assert sorted(map(str, df.collect())) == sorted(map(str, twice[name].collect()))


def test_table_store_rewrites_only_touched_buckets(spark, tmp_path):
    tables = store.TableStore(spark, str(tmp_path), buckets=8)
    assert not tables.exists("t")
    df = spark.createDataFrame([(str(k), k) for k in range(40)], "doc_id string, v int")
    tables.write("t", df)
    assert tables.exists("t") and rows(tables.read("t")) == rows(df)
    before = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{tmp_path}/t/bucket=*/*.parquet")}
    new = spark.createDataFrame([("7", -7), ("99", 99)], df.schema)
    tables.change("t", new, lambda old: store.upsert(old, new, "doc_id"))
    assert rows(tables.read("t")) == sorted([r for r in rows(df) if r[0] != "7"] + rows(new))
    kept = [f for f in before if os.path.exists(f) and os.stat(f).st_mtime_ns == before[f]]
    assert len({f.rsplit("/", 2)[1] for f in kept}) >= 6
    gone = tables.read("t").select("doc_id")
    tables.change("t", gone, lambda old: store.delete({"t": old}, gone)["t"])  # buckets become empty
    assert tables.read("t").count() == 0
    tables.append("t", new)
    assert rows(tables.lookup("t", "99")) == [("99", 99)] and tables.lookup("t", "1").isEmpty()
    tables.change("t", new.limit(0), lambda old: old.limit(0))
    assert tables.read("t").count() == 2


def plain_pack(text: str, size: int) -> list[str]:
    """The greedy rules written out: paragraphs, then sentences of paragraphs that are too long."""
    import re

    def pack(pieces, joint, split=None):
        out, now = [], ""
        for p in (p.strip() for p in pieces):
            if not p:
                continue
            longer = now + joint + p if now else p
            if chunking.estimate(longer) <= size:
                now = longer
                continue
            if now:
                out.append(now)
            now = p
            if split and chunking.estimate(p) > size:
                parts = split(p)
                out, now = out + parts[:-1], parts[-1]
        return [*out, now] if now else out

    return pack(text.split("\n\n"), "\n\n", lambda p: pack(re.split(r"(?<=[.!?다요])\s+", p), " "))


def test_greedy_chunks_follow_the_rules(spark):
    import random

    rng = random.Random(1)
    texts = ["", "   ", "짧다."] + ["".join(rng.choice(["가나다 ", "한다. ", "ok! ", "\n\n", "\n", "word "]) for _ in range(rng.randint(1, 150))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, x string")
    got = {r["k"]: r["c"] for r in df.select("k", chunking.split_paragraphs(F.col("x"), 40).alias("c")).collect()}
    for k, x in enumerate(texts):
        assert got[k] == plain_pack(x, 40), repr(x)


def test_recursive_split():
    assert chunking.recursive_split("aaaa bbbb cccc dddd", 2, 0) == ["aaaa bbbb", "cccc dddd"]
    long = "한국어 문장이다. " * 200
    parts = chunking.recursive_split(long, 64, 8)
    # Sizes are sums of truncated estimates, so a chunk measured as a whole can exceed its limit a little.
    assert all(chunking.estimate(p) <= 72 for p in parts)
    assert "".join("".join(parts).split()).count("문장") >= 200
    assert chunking.recursive_split("가" * 100, 30, 3)[0] == "가" * 30


def test_chunk_sections_number_across_sections(spark):
    df = spark.createDataFrame([("d", "text", "하나다. 둘이다.", 0), ("d", "table", "| a |", 1), ("d", "text", "셋이다.", 2)], "doc_id string, section_type string, content string, order int")
    got = chunking.chunk_sections(df).orderBy("chunk_num").collect()
    assert [(r["chunk_num"], r["chunk_type"], r["chunk_id"]) for r in got] == [(0, "text", "CH-d-000"), (1, "table", "CH-d-001"), (2, "text", "CH-d-002")]


def test_renumber(spark):
    df = spark.createDataFrame([("d", 0, "x"), ("d", 1, "drop"), ("d", 2, "y")], "doc_id string, chunk_num int, text string")
    assert rows(store.renumber(df, F.col("text") != "drop")) == [("d", 0, "x"), ("d", 1, "y")]


def test_attachments(spark):
    names = ["000_main.odt", "000_main.pdf", "001_a.pdf", "001_a.hwp", "002_b.odt", "002_b.hwpx", "003_c.hwp", "004_d.hwpx", "x.docx", "y.txt", "zz.pdf"]
    files = spark.createDataFrame([(f"/d/DCT1/{n}",) for n in names if n != "002_b.odt"], "path string")
    got = attachments.attachments_of(files).orderBy("file_order").collect()
    assert [(r["file_name"], r["file_order"], r["is_main_pdf"]) for r in got] == [("000_main.pdf", 0, True), ("001_a.pdf", 1, False), ("002_b.hwpx", 2, False), ("003_c.hwp", 3, False), ("004_d.hwpx", 4, False), ("zz.pdf", 5, False)]


def test_config(tmp_path):
    for bad in ({"chunk_size": 10}, {"chunk_overlap": 2000}, {"embedding_device": "tpu"}, {"embedding_model": "somewhere/else"}, {"batch_size": 0}):
        with pytest.raises(ValueError):
            EngineConfig(**bad)
    data = tmp_path / "data"
    for name in ("2024", "2013", "misc"):
        (data / name).mkdir(parents=True)
    assert [p[-4:] for p in expand_root(str(data))] == ["2013", "2024"]
    assert expand_root("/nowhere/data") == ["/nowhere/data"]
    assert clean_query("  " + "x" * 600) == "x" * 500
    with pytest.raises(ValueError):
        clean_query("  ")


def test_a_store_keeps_its_number_of_buckets(spark, tmp_path):
    first = store.TableStore(spark, str(tmp_path), buckets=256)
    first.write("t", spark.range(100).select(F.col("id").cast("string").alias("doc_id"), "id"))
    again = store.TableStore(spark, str(tmp_path))
    assert again.buckets == 256
    assert all(again.lookup("t", str(k)).count() == 1 for k in range(0, 100, 20))
    for other in ({"buckets": 64}, {"key": "id"}):
        with pytest.raises(ValueError):
            store.TableStore(spark, str(tmp_path), **other)
    assert store.TableStore(spark, str(tmp_path / "new")).buckets == 64


def test_differing_keys(spark):
    schema = "doc_id string, a int, v array<double>"
    ours = spark.createDataFrame([("same", 1, [1.0]), ("same", None, None), ("row", 1, [1.0]), ("row", 1, [1.0]), ("value", None, [1.0]), ("ours", 1, [])], schema)
    theirs = spark.createDataFrame([("same", None, None), ("same", 1, [1.0]), ("row", 1, [1.0]), ("value", 1, None), ("theirs", 1, [])], schema)
    assert rows(store.differing_keys(ours, theirs)) == [("ours",), ("row",), ("theirs",), ("value",)]
