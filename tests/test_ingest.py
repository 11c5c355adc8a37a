from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from hanji.config import EngineConfig
from hanji.operators import lookups, search, stats, store
from hanji.plans import ingest

from .test_sources import odt_bytes, table


@pytest.fixture(scope="module")
def corpus(tmp_path_factory):
    root = tmp_path_factory.mktemp("corpus")
    for k, body in enumerate(("<text:p>가. 위치 : 부산광역시 영도구 1번지 지선 공유수면</text:p>" + table(("신청인", "한빛건설"), ("목적", "선박 계류 시설")), "<text:p>결재 2020. 3. 4.</text:p>", "")):
        folder = root / "data" / "2024" / f"DCT{k}" / "attachments"
        folder.mkdir(parents=True)
        (folder / "000_문서.odt").write_bytes(odt_bytes(body))
        (folder / "000_문서.pdf").write_bytes(b"%PDF")
    (root / "data" / "2024" / "DCT9").mkdir()
    (root / "data" / "2024" / "DCT9" / "x.odt").write_bytes(b"broken")
    meta = root / "meta"
    meta.mkdir()
    (meta / "list.csv").write_text("se,doc_id,doc_nm,exlpn_1,exlpn_2,open,act_dt\nP2024,DCT0,목록 제목,갑,을,DPBT1,2024-05-06\n", encoding="utf-8")
    return root


def test_ingest_twice_search_and_sync(spark, corpus, tmp_path):
    tables = store.TableStore(spark, str(tmp_path / "store"), buckets=4)
    ingest.create_tables(tables)
    config = EngineConfig(data_dirs=(str(corpus / "data"),), metadata_doc_list=str(corpus / "meta"), embedding_dimension=8)
    first = ingest.ingest(spark, config, tables).first()
    assert (first["processed"], first["skipped"], first["failed"], first["total_chunks"]) == (3, 0, 1, 3)
    docs = {r["doc_id"]: r for r in tables.read("documents").collect()}
    assert set(docs) == {"DCT0", "DCT1"}  # a document without chunks isn't stored
    assert (docs["DCT0"]["title"], docs["DCT0"]["biz_full_path"], docs["DCT0"]["open_name"], str(docs["DCT0"]["report_date"]), docs["DCT0"]["doc_year"]) == ("문서", "갑 > 을", "대국민공개", "2024-05-06", 2024)
    assert (str(docs["DCT1"]["report_date"]), docs["DCT1"]["biz_cate"]) == ("2020-03-04", "")
    permit = tables.read("permit_extractions").filter("doc_id = 'DCT0'").first()
    assert (permit["ask_org_nm"], permit["purps_cn"], permit["addr"]) == ("한빛건설", "선박 계류 시설", "부산광역시 영도구 1번지 지선 공유수면")
    assert tables.read("attachments").filter("is_main_pdf and file_order = 0").count() == 2
    second = ingest.ingest(spark, config, tables).first()
    assert (second["skipped"], second["total_chunks"]) == (2, 0)  # the empty and the broken file are tried again
    assert {r["doc_id"]: r["created_at"] for r in tables.read("documents").collect()} == {k: r["created_at"] for k, r in docs.items()}

    chunks = tables.read("document_chunks")
    hit = search.search(chunks, tables.read("documents"), search.literal_vector([1.0] + [0.0] * 7), 1, keyword="영도구").first()
    assert (hit["doc_id"], hit["title"], hit["search_mode"]) == ("DCT0", "문서", "hybrid")
    assert stats.store_stats(tables.read("documents"), chunks).first()["chunk_types"] == {"text": 2, "table": 1}

    mirror = store.TableStore(spark, str(tmp_path / "mirror"), buckets=4)
    ingest.create_mirror(mirror, permits_too=True)
    for _ in range(2):
        counts = {r["table"]: r["n"] for r in ingest.sync_to_mirror(tables, mirror).collect()}
        assert counts == {"documents": 2, "document_chunks": 3, "attachments": 2}
        assert mirror.read("document_chunks").agg(F.max(F.size("embedding")), F.count("*")).first() == (8, 3)
        assert mirror.read("permit_extractions").count() == 2 and "created_at" not in mirror.read("permit_extractions").columns


def fixed_model():
    import numpy as np

    return lambda texts: np.array([[1.0, float(len(t))] for t in texts])


def test_a_run_that_breaks_off_is_made_up_for(spark, corpus, tmp_path, monkeypatch):
    """Chunks are there, documents aren't; metadata can't be read; the model is one's own; lookups by document."""
    tables = store.TableStore(spark, str(tmp_path / "store"), buckets=4)
    ingest.create_tables(tables)
    config = EngineConfig(data_dirs=(str(corpus / "data"),), metadata_doc_list=str(corpus / "nowhere"), embedding_loader="tests.test_ingest:fixed_model")
    change = tables.change

    def breaks(name, keys, how):
        if name == "documents":
            raise OSError("lost")
        change(name, keys, how)

    monkeypatch.setattr(tables, "change", breaks)
    with pytest.raises(OSError):
        ingest.ingest(spark, config, tables)
    assert tables.read("documents").isEmpty() and tables.read("document_chunks").count() == 3
    monkeypatch.setattr(tables, "change", change)
    again = ingest.ingest(spark, config, tables).first()
    assert (again["processed"], again["skipped"], again["total_chunks"]) == (3, 0, 3)
    assert tables.read("document_chunks").count() == 3 and lookups.exists(tables, "DCT0") and not lookups.exists(tables, "DCT7")
    assert lookups.document(tables, "DCT0").first()["biz_cate"] == ""
    found = lookups.chunks(tables, "DCT0").collect()
    assert [r["chunk_num"] for r in found] == [0, 1] and len(found[0]["embedding"]) == 2
    assert [r["file_order"] for r in lookups.attachments(tables, "DCT0").collect()] == [0]
    assert lookups.permit(tables, "DCT0").first()["ask_org_nm"] == "한빛건설" and lookups.documents(tables, ["DCT0", "DCT1"]).count() == 2
    one = str(corpus / "data" / "2024" / "DCT1")
    alone = ingest.ingest(spark, config, tables, incremental=False, paths=[one]).first()
    assert (alone["processed"], alone["skipped"], alone["failed"]) == (1, 0, 0) and tables.read("documents").count() == 2


def test_one_document_for_an_id(spark, tmp_path):
    """Of two files of one document the later counts, whatever the run; the other is no change."""
    import os

    folder = tmp_path / "data" / "DCT5"
    folder.mkdir(parents=True)
    for k, (name, body) in enumerate((("000_old.odt", "<text:p>first words</text:p>"), ("001_new.odt", "<text:p>second words</text:p>"))):
        (folder / name).write_bytes(odt_bytes(body))
        (folder / name.replace(".odt", ".pdf")).write_bytes(b"%PDF")
        os.utime(folder / name, (1_700_000_000 + k, 1_700_000_000 + k))
    tables = store.TableStore(spark, str(tmp_path / "store"), buckets=4)
    ingest.create_tables(tables)
    config = EngineConfig(data_dirs=(str(tmp_path / "data"),), metadata_doc_list=str(tmp_path / "nowhere"), embedding_dimension=8)
    for processed, skipped in ((1, 0), (0, 1)):
        got = ingest.ingest(spark, config, tables).first()
        assert (got["processed"], got["skipped"], got["superseded"]) == (processed, skipped, 1)
        assert [r["title"] for r in tables.read("documents").collect()] == ["new"]
        assert [r["text"] for r in tables.read("document_chunks").collect()] == ["second words"]
        assert sorted((r["file_name"], r["is_main_pdf"]) for r in tables.read("attachments").collect()) == [("000_old.pdf", False), ("001_new.pdf", True)]
    os.utime(folder / "000_old.odt", (1_800_000_000, 1_800_000_000))
    assert ingest.ingest(spark, config, tables).first()["processed"] == 1
    assert [r["title"] for r in tables.read("documents").collect()] == ["old"]


def test_no_content_moves_to_find_changes(spark, corpus, tmp_path):
    from hanji.sources import odt

    found = odt.hash_files(spark, str(corpus / "data"))
    stored = spark.createDataFrame([], "doc_id string, file_hash string")
    plan = ingest.changed_files(ingest.latest_files(found), stored)._jdf.queryExecution().executedPlan().toString()
    shuffled = [line for line in plan.splitlines() if "Exchange" in line or "Join" in line or "Sort" in line or "Aggregate" in line]
    assert shuffled and not any("content" in line for line in shuffled)
    assert ingest.changed_files(ingest.latest_files(found), stored).count() == 4


def test_a_second_sync_rewrites_nothing(spark, corpus, tmp_path):
    import os

    tables, mirror = store.TableStore(spark, str(tmp_path / "store"), buckets=4), store.TableStore(spark, str(tmp_path / "mirror"), buckets=4)
    ingest.create_tables(tables)
    ingest.create_mirror(mirror)
    config = EngineConfig(data_dirs=(str(corpus / "data"),), metadata_doc_list=str(corpus / "meta"), embedding_dimension=8)
    ingest.ingest(spark, config, tables)
    ingest.sync_to_mirror(tables, mirror)
    files = lambda: sorted(str(p) for name in store.MANAGED_MIRROR_TABLES for p in (tmp_path / "mirror" / name).rglob("*.parquet"))
    before = files()
    ingest.sync_to_mirror(tables, mirror)
    assert files() == before and before
    changed = tables.read("document_chunks").filter("doc_id = 'DCT0'").withColumn("text", F.lit("other"))
    tables.change("document_chunks", changed.select("doc_id"), lambda old: store.replace_children(old, changed))
    ingest.sync_to_mirror(tables, mirror)
    assert {r["text"] for r in mirror.read("document_chunks").filter("doc_id = 'DCT0'").collect()} == {"other"}
    assert os.path.isdir(tmp_path / "mirror" / "_settings")


def test_command_line_on_an_empty_store(spark, tmp_path, capsys):
    from hanji.__main__ import main

    own = ["--store", str(tmp_path / "store")]
    main([*own, "init-db", "--buckets", "8"])
    assert store.TableStore(spark, str(tmp_path / "store")).buckets == 8
    main([*own, "search", "영도구 점용", "-k", "2", "--dimension", "8"])
    main([*own, "index", "--lists", "4"])
    main([*own, "search", "영도구 점용", "-k", "2", "--dimension", "8", "--probes", "2"])
    for _ in range(2):
        main([*own, "sync-to-mirror", "--mirror", str(tmp_path / "mirror")])
    main([*own, "show", "DCT0"])
    main([*own, "stats"])
    assert "document_count" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        main([*own, "no-such-command"])


def test_documents_that_arrive_while_it_breaks_off(spark, tmp_path, monkeypatch):
    """A stream that is killed in a batch and started again stores what one batch run stores, and each batch once."""
    from hanji.streaming import ingest as streaming

    root = tmp_path / "data"

    def arrive(*numbers):
        for k in numbers:
            folder = root / f"DCT{k}" / "attachments"
            folder.mkdir(parents=True)
            (folder / f"00{k}_문서.odt").write_bytes(odt_bytes(f"<text:p>words of {k}</text:p>" if k % 4 else ""))

    config = EngineConfig(data_dirs=(str(root),), metadata_doc_list=str(tmp_path / "nowhere"), embedding_dimension=8)
    tables = store.TableStore(spark, str(tmp_path / "stream"), buckets=4)
    ingest.create_tables(tables)
    arrive(1, 2, 3)
    change, calls = tables.change, []

    def breaks(name, keys, how):
        calls.append(name)
        if name == "documents" and calls.count("documents") == 2:
            raise OSError("killed")
        change(name, keys, how)

    monkeypatch.setattr(tables, "change", breaks)
    follow = lambda: streaming.follow_documents(spark, config, tables, str(tmp_path / "checkpoint"), per_batch=2)
    with pytest.raises(Exception, match="killed"):
        follow().awaitTermination()
    assert tables.read("documents").count() == 2
    monkeypatch.setattr(tables, "change", change)
    arrive(4, 5)
    follow().awaitTermination()
    follow().awaitTermination()
    batches = streaming.batch_table(tables).read("batches").orderBy("batch_id").collect()
    assert [r["batch_id"] for r in batches] == [0, 1, 2] and sum(r["processed"] for r in batches) == 5

    whole = store.TableStore(spark, str(tmp_path / "batch"), buckets=4)
    ingest.create_tables(whole)
    ingest.ingest(spark, config, whole)
    for name in ("documents", "document_chunks", "attachments", "permit_extractions"):
        times = ["created_at", "updated_at"]
        ours, theirs = (sorted(map(repr, t.read(name).drop(*times).collect())) for t in (tables, whole))
        assert ours == theirs, name
    # A batch whose number is kept isn't done again.
    streaming.once(tables, "documents", lambda batch: 1 / 0)(tables.read("documents"), 2)


def test_tasks_list_files(spark, corpus, tmp_path):
    """However few folders a task may list, the files, their times and hashes are those of Spark's reader; the driver asks
    for no path."""
    from hanji.sources import listing, odt

    root = tmp_path / "data"
    for k in range(7):
        for name in ("a 한.odt", ".hidden.odt", "_temporary.odt", "_a=b.odt", "x[1].pdf"):
            (root / f"DCT{k}" / "deep" / f"{k % 3}").mkdir(parents=True, exist_ok=True)
            (root / f"DCT{k}" / "deep" / f"{k % 3}" / name).write_bytes(odt_bytes(f"<text:p>{k}</text:p>"))
    (root / "_left_out").mkdir()
    (root / "_left_out" / "b.odt").write_bytes(b"x")
    read = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(root))
    want = sorted(map(tuple, read.select("path", "modificationTime").collect()))
    assert len(want) == 21
    for most in (1, 2, 1000):
        for roots in ([str(root)], [f"file:{root}", str(root / "DCT3")]):
            shared = listing.shared_roots(spark, roots)
            got = listing.list_files(spark, str(tmp_path / "listed"), shared, most)
            assert sorted(map(tuple, got.collect())) == want
    assert sorted(map(tuple, listing.hash_files(got).collect())) == sorted(map(tuple, odt.hash_files(spark, str(root)).collect()))
    assert sorted(map(str, listing.parse_documents(got.filter("path like '%.odt'")).collect())) == sorted(map(str, odt.read_documents(spark, str(root)).collect()))
    one = listing.shared_roots(spark, [str(root / "DCT1" / "deep" / "1" / "a 한.odt")])
    assert listing.list_files(spark, str(tmp_path / "listed"), one).count() == 1
    assert listing.shared_roots(spark, [str(root / "nowhere")]) is None and listing.shared_roots(spark, ["hdfs://x/y"]) is None


def test_driver_gets_no_paths(spark, corpus, tmp_path, monkeypatch):
    """The plan asks neither Spark's reader for folders that tasks can list, nor the driver for files."""
    from hanji.sources import odt

    def refused(*_, **__):
        raise AssertionError("files listed by the driver")

    monkeypatch.setattr(odt, "read_files", refused)
    config = EngineConfig(data_dirs=(str(corpus / "data"),), metadata_doc_list=str(tmp_path / "nowhere"), embedding_dimension=8)
    tables = store.TableStore(spark, str(tmp_path / "store"), buckets=4)
    ingest.create_tables(tables)
    assert ingest.ingest(spark, config, tables).first()["processed"] > 0
