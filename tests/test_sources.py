from __future__ import annotations

import io
import os
import struct
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from hanji.functions import text
from hanji.sources import biff, compound, hwp, metadata, odt
from hanji.streaming import ingest

NS = 'xmlns:office="urn:oasis:names:tc:opendocument:xmlns:office:1.0" xmlns:text="urn:oasis:names:tc:opendocument:xmlns:text:1.0" xmlns:table="urn:oasis:names:tc:opendocument:xmlns:table:1.0"'


def odt_bytes(body: str, head: str = "") -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("content.xml", f"<?xml version='1.0'?>{head}<office:document-content {NS}><office:body><office:text>{body}</office:text></office:body></office:document-content>")
    return out.getvalue()


def table(*rows: tuple[str, ...]) -> str:
    cell = lambda c: f"<table:table-cell><text:p>{c}</text:p></table:table-cell>"
    return "<table:table>" + "".join(f"<table:table-row>{''.join(map(cell, r))}</table:table-row>" for r in rows) + "</table:table>"


BODY = (
    "<text:p>첫<text:line-break/>줄<text:s text:c='2'/>끝</text:p><text:list><text:list-item><text:p>항목</text:p></text:list-item></text:list>"
    + "<table:table><table:table-row><table:table-cell table:number-columns-repeated='2'><text:p>a|b</text:p></table:table-cell></table:table-row><table:table-row><table:table-cell><text:p>1</text:p></table:table-cell></table:table-row></table:table>"
    + "<text:section><text:p>안</text:p>" + table(("x", "y")) + "</text:section><text:p>뒤</text:p>"
)


def test_odt_documents(spark, tmp_path):
    folder = tmp_path / "2024" / "DCT7" / "attachments"
    folder.mkdir(parents=True)
    (folder / "000_허가 공문.odt").write_bytes(odt_bytes(BODY))
    approval = table(("수신자", "갑"), ("", ""), ("주무관", "과장 전결"), ("홍길동", "김철수"), ("전결 2024. 3. 5.", ""), ("", ""), ("", ""), ("항만물류과-123", ""))
    (folder / "001_결재.odt").write_bytes(odt_bytes("<text:p>본문</text:p>" + approval))
    (folder / "002_빈.odt").write_bytes(b"no zip")
    (folder / "003_dtd.odt").write_bytes(odt_bytes("<text:p>x</text:p>", "<!DOCTYPE x [<!ENTITY e 'x'>]>"))
    (folder / "004_bomb.odt").write_bytes(odt_bytes("<text:p>" + " " * 3_000_000 + "</text:p>"))
    (folder / "005_id.odt").write_bytes(odt_bytes("<text:p xml:id='1 2'>남는다</text:p>".replace("'", '"')))
    got = {r["title"]: r for r in odt.read_documents(spark, str(tmp_path)).collect()}
    assert {r["doc_id"] for r in got.values()} == {"DCT7"}
    first = got["허가 공문"]
    assert [(s["section_type"], s["content"], s["order"]) for s in first["sections"]] == [
        ("text", "첫\n줄  끝\n- 항목", 0),
        ("table", "| a\\|b | a\\|b |\n| --- | --- |\n| 1 |  |", 1),
        ("text", "안\nxy\n뒤", 2),
    ]
    assert (got["결재"]["author_name"], got["결재"]["report_date"], got["결재"]["dept_name"]) == ("홍길동, 김철수", "2024-03-05", "항만물류과")
    for title in ("빈", "dtd", "bomb"):
        assert got[title]["sections"] == [] and got[title]["error"] and "/" not in got[title]["error"]
    assert got["id"]["sections"][0]["content"] == "남는다"
    marked = odt.read_documents(spark, str(tmp_path)).filter(F.col("title") == "허가 공문").select(text.marked_text(F.col("sections")), text.raw_text(F.col("sections"))).first()
    assert marked[0].count("[TABLE_START]\n") == 1
    assert marked[1].startswith("첫\n줄  끝\n- 항목\n\n| a")


KOREAN = "구분(P:생산, R:접수),문서ID,문서명,구분1,구분2,구분3"
ENGLISH = "se,doc_id,doc_nm,exlpn_1,exlpn_2,exlpn_3"


def test_metadata_files(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(f"﻿{KOREAN}\n{ENGLISH}\nP2026,D1,제목,갑,을,병\n,,,,,\nR2025, D2 ,둘째,갑,,병\n".encode())
    (tmp_path / "b.csv").write_text("se,doc_id,doc_nm,send_dept_name,open,open_reason\nP2024,D1,새 제목,항만과,DPBT2,사유\n", encoding="utf-8")
    os.utime(tmp_path / "a.csv", (1, 1))
    os.utime(tmp_path / "b.csv", (2, 2))
    (tmp_path / "note.txt").write_text("x")
    got = {r["doc_id"]: r for r in metadata.document_metadata(metadata.read_metadata(spark, str(tmp_path))).collect()}
    assert set(got) == {"D1", "D2"}
    assert (got["D1"]["title"], got["D1"]["sender_dept_name"], got["D1"]["open_name"], got["D1"]["close_reason"], got["D1"]["doc_year"]) == ("새 제목", "항만과", "비공개", "사유", 2024)
    assert (got["D2"]["biz_full_path"], got["D2"]["type_name"], got["D2"]["doc_no"]) == ("갑 > 병", "접수", "")


def test_metadata_by_position_and_xlsx(spark, tmp_path):
    sheet = '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>%s</sheetData></worksheet>'
    row = lambda n, *cells: f"<row>{''.join(f'<c r="{c}{n}" t="inlineStr"><is><t>{v}</t></is></c>' for c, v in cells)}</row>"
    with zipfile.ZipFile(tmp_path / "old.xlsx", "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", sheet % (row(1, ("A", "안내")) + row(2, ("A", "P2026"), ("D", "D9"), ("G", "제목"))))
    got = metadata.read_metadata(spark, str(tmp_path)).collect()
    assert [(r["doc_id"], r["doc_type_raw"], r["title"], r["state_code"]) for r in got] == [("D9", "P2026", "제목", None)]


def test_first_sheet_by_the_workbook(spark, tmp_path):
    sheet = '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>%s</sheetData></worksheet>'
    row = lambda n, *cells: f"<row>{''.join(f'<c r="{c}{n}" t="inlineStr"><is><t>{v}</t></is></c>' for c, v in cells)}</row>"
    with zipfile.ZipFile(tmp_path / "order.xlsx", "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", sheet % (row(1, ("A", "x")) + row(2, ("D", "WRONG"))))
        z.writestr("xl/worksheets/sheet2.xml", sheet % (row(1, ("A", "x")) + row(2, ("D", "RIGHT"))))
        z.writestr("xl/workbook.xml", '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="b" sheetId="2" r:id="rId2"/><sheet name="a" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/><Relationship Id="rId2" Target="/xl/worksheets/sheet2.xml"/></Relationships>')
    assert [r["doc_id"] for r in metadata.read_metadata(spark, str(tmp_path)).collect()] == ["RIGHT"]


def xls_bytes(sheets: list[list[list]]) -> bytes:
    """A legacy workbook: shared strings cut across a continued record, numbers of each kind, a date, a formula."""
    record = lambda number, body: struct.pack("<HH", number, len(body)) + body
    strings = sorted({v for grid in sheets for r in grid for v in r if isinstance(v, str)})
    flat = b"".join(struct.pack("<HB", len(v), 1) + v.encode("utf-16-le") for v in strings)
    cut = 3 + 2 * (len(strings[0]) // 2)  # inside the first string
    shared = record(0xFC, struct.pack("<II", 1, len(strings)) + flat[:cut]) + record(0x3C, b"\x01" + flat[cut:])
    styles = record(0xE0, struct.pack("<HH", 0, 0) + b"\0" * 16) + record(0xE0, struct.pack("<HH", 0, 164) + b"\0" * 16)
    format_ = record(0x41E, struct.pack("<HHB", 164, 10, 0) + b"yyyy-mm-dd")
    bodies = []
    for grid in sheets:
        out = record(0x809, b"\0\x06\x10\0" + b"\0" * 12)
        for r, cells in enumerate(grid):
            for c, v in enumerate(cells):
                at = struct.pack("<3H", r, c, 1 if isinstance(v, tuple) else 0)
                if isinstance(v, str):
                    out += record(0xFD, at + struct.pack("<I", strings.index(v)))
                elif isinstance(v, tuple):
                    out += record(0x203, at + struct.pack("<d", v[0]))
                elif isinstance(v, int):
                    out += record(0x27E, at + struct.pack("<I", v << 2 | 2))
                elif isinstance(v, float):
                    out += record(0x203, at + struct.pack("<d", v))
                elif isinstance(v, bytes):
                    out += record(0x06, at + b"\0" * 6 + b"\xff\xff" + b"\0" * 8) + record(0x207, struct.pack("<HB", len(v), 0) + v)
        bodies.append(out + record(0x0A, b""))
    head = record(0x809, b"\0\x06\x05\0" + b"\0" * 12) + format_ + styles + shared
    names = [f"s{k}".encode() for k in range(len(sheets))]
    start = len(head) + sum(4 + 8 + len(n) for n in names) + 4
    offsets, at = [], start  # the first listed sheet lies last
    for body in bodies:
        offsets.append(at)
        at += len(body)
    bound = b"".join(record(0x85, struct.pack("<IBBBB", offset, 0, 0, len(n), 0) + n) for offset, n in zip(reversed(offsets), names, strict=True))
    return head + bound + record(0x0A, b"") + b"".join(bodies)


def test_legacy_spreadsheets(spark, tmp_path):
    first = [["안내"], ["P2026", None, None, "D7", 12, None, "옛 표의 제목", None, None, (45000.5,), 1.25, b"result"]]
    book = xls_bytes([[["x"], ["P2020", None, None, "WRONG"]], first])
    data = compound_file({"Workbook": book}, storage=False)
    assert biff.rows_of(data) == [["안내"], ["P2026", None, None, "D7", "12", None, "옛 표의 제목", None, None, "2023-03-15 12:00:00", "1.25", "result"]]
    (tmp_path / "old.xls").write_bytes(data)
    (tmp_path / "bad.xls").write_bytes(b"no workbook")
    (tmp_path / "bad.xlsx").write_bytes(b"no archive")
    got = metadata.read_metadata(spark, str(tmp_path)).collect()
    assert [(r["doc_id"], r["title"], r["receive_date"], r["doc_seq"], r["link_id"]) for r in got] == [("D7", "옛 표의 제목", "2023-03-15 12:00:00", "12", "result")]
    assert {r["source"] for r in metadata.unreadable(metadata.read_rows(spark, str(tmp_path))).collect()} == {"bad.xls", "bad.xlsx"}


def compound_file(streams: dict[str, bytes], storage: bool = True) -> bytes:
    """A compound file with all streams in one storage BinData, or none; every stream padded beyond the mini-stream limit."""
    padded = {n: d + b"\0" * (max(4096, -(-len(d) // 512) * 512) - len(d)) for n, d in streams.items()}
    names = list(padded)
    entries = [("Root Entry", 5, -1, -1, 1 if storage else 2, 0, 0), ("BinData", 1, -1, -1, 2, 0, 0)]
    data, fat = [], []
    for k, n in enumerate(names):
        start = len(fat)
        fat += [*range(start + 1, start + len(padded[n]) // 512), 0xFFFFFFFE]
        data.append(padded[n])
        entries.append((n, 2, -1, k + 3 if k + 1 < len(names) else -1, -1, start, len(streams[n]) if len(streams[n]) >= 4096 else 4096))
    while len(entries) % 4:
        entries.append(("", 0, -1, -1, -1, 0, 0))
    directory = b"".join(n.encode("utf-16-le").ljust(64, b"\0") + struct.pack("<HBB3I", 2 * len(n) + 2 if n else 0, kind, 1, *(x & 0xFFFFFFFF for x in (left, right, child))) + b"\0" * 36 + struct.pack("<IQ", start, size) for n, kind, left, right, child, start, size in entries)
    first_dir = len(fat)
    count = len(directory) // 512
    fat += [*range(first_dir + 1, first_dir + count), 0xFFFFFFFE, 0xFFFFFFFD]
    fat_sector = len(fat) - 1
    table_ = struct.pack("<128I", *fat, *[0xFFFFFFFF] * (128 - len(fat)))
    head = compound.SIGNATURE + b"\0" * 16 + struct.pack("<5H", 62, 3, 0xFFFE, 9, 6) + b"\0" * 6 + struct.pack("<9I", 0, 1, first_dir, 0, 4096, 0xFFFFFFFE, 0, 0xFFFFFFFE, 0)
    return head + struct.pack("<109I", fat_sector, *[0xFFFFFFFF] * 108) + b"".join(data) + directory + table_


def test_images_beyond_the_limits_fail_their_document(spark, tmp_path, monkeypatch):
    png = bytes.fromhex("89504E470D0A1A0A") + b"x" * 4200
    data = compound_file({"BIN0001.png": png, "BIN0002.png": png})
    assert len(hwp.images_of("a", data)) == 2
    for limit, value, said in (("MAX_STREAM", 4100, "stream is too large"), ("MAX_IMAGE", 4100, "image is too large"), ("MAX_TOTAL", 8000, "together are too large")):
        with monkeypatch.context() as m:
            m.setattr(hwp, limit, value)
            with pytest.raises(ValueError, match=said):
                hwp.images_of("a", data)


def test_hwp_images(spark, tmp_path):
    png = bytes.fromhex("89504E470D0A1A0A") + bytes(range(200))
    deflate = zlib.compressobj(9, zlib.DEFLATED, -15)
    packed = deflate.compress(png) + deflate.flush()
    (tmp_path / "a.hwp").write_bytes(compound_file({"BIN0001.png": png, "BIN0002.png": packed, "BIN0003.png": b"broken"}))
    (tmp_path / "b.hwp").write_bytes(b"nothing")
    got = {(r["source_path"][-5:], r["filename"]): r for r in hwp.extract_images(spark, str(tmp_path)).collect()}
    assert got["a.hwp", "BIN0001.png"]["status"] == "extracted"
    assert bytes(got["a.hwp", "BIN0001.png"]["payload"]).startswith(png)
    assert bytes(got["a.hwp", "BIN0002.png"]["payload"]) == png
    assert (got["a.hwp", "BIN0003.png"]["status"], got["a.hwp", "BIN0003.png"]["message"]) == ("failed", "invalid image payload: BIN0003.png")
    assert got["b.hwp", None]["status"] == "failed" and got["b.hwp", None]["message"].startswith("b.hwp: ")


def test_stream_gives_what_the_batch_gives(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(10).repartition(3).write.parquet(source)
    apply = lambda df, n: df.withColumn("twice", F.col("id") * 2).write.mode("overwrite").parquet(f"{out}/batch={n}")
    for _ in range(2):  # the second run finds nothing new
        ingest.follow_files(spark, source, "id long", apply, str(tmp_path / "state")).awaitTermination()
    assert sorted(r["twice"] for r in spark.read.parquet(out).collect()) == [2 * x for x in range(10)]


def test_hwp_files_are_listed(spark, tmp_path):
    (tmp_path / "a").mkdir()
    for name in ("a/x.HWP", "y.hwpx", "z.hwpy", "hwp"):
        (tmp_path / name).write_bytes(b"12")
    got = sorted((r["path"].rsplit("/", 1)[-1], r["length"]) for r in hwp.list_files(spark, str(tmp_path)).collect())
    assert got == [("x.HWP", 2), ("y.hwpx", 2)]


def test_odt_as_a_data_source(spark, tmp_path):
    """The rows of read_documents; ten thousand small files in a few tasks, balanced by size."""
    from hanji.sources import odt_format

    for k in range(40):
        folder = tmp_path / "data" / f"DCT{k:02}" / "attachments"
        folder.mkdir(parents=True)
        body = f"<text:p>words {k}</text:p>" * (1 + 50 * (k % 5)) + table(("신청인", "한빛건설"))
        (folder / "000_문서.odt").write_bytes(odt_bytes(body) if k % 9 else b"broken")
    (tmp_path / "data" / "other.txt").write_text("x")
    got, want = odt_format.read(spark, str(tmp_path / "data")), odt.read_documents(spark, str(tmp_path / "data"))
    plain = lambda df: sorted(repr(r) for r in df.withColumn("file_path", F.regexp_replace("file_path", "^file:", "")).collect())
    assert got.columns == want.columns and plain(got) == plain(want)
    assert odt_format.read(spark, str(tmp_path / "data" / "DCT01"), str(tmp_path / "data" / "DCT02")).count() == 2
    (tmp_path / "none").mkdir()
    assert odt_format.read(spark, str(tmp_path / "none")).count() == 0

    many = tmp_path / "many"
    many.mkdir()
    data = odt_bytes("<text:p>x</text:p>")
    for k in range(10_000):
        (many / f"{k}.odt").write_bytes(data)
    odt_format.register(spark)
    found = spark.read.format("odt").load(str(many))
    assert found.count() == 10_000 and found.rdd.getNumPartitions() <= 12
    sizes = [(0, f"f{k}", s) for k, s in enumerate([900, 500, 400, 300, 200, 100, 50, 50])]
    loads = [sum(dict((p, s) for _, p, s in sizes)[p] for p in part.paths) for part in odt_format.balanced([(t, p, s << 10) for t, p, s in sizes], 840 << 10)]
    assert sum(loads) == 2500 and max(loads) <= 900


def test_odt_as_a_stream(spark, tmp_path):
    from hanji.sources import odt_format

    odt_format.register(spark)
    root = tmp_path / "in"
    root.mkdir()

    def run():
        source = spark.readStream.format("odt").option("maxFilesPerTrigger", 2).load(str(root))
        source.select("path", "file_hash", "error").writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
        return sorted(os.path.basename(r["path"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    for k in range(5):
        (root / f"{k}.odt").write_bytes(odt_bytes(f"<text:p>{k}</text:p>"))
        os.utime(root / f"{k}.odt", (1_700_000_000 + k, 1_700_000_000 + k))
    first = run()
    assert first == [f"{k}.odt" for k in range(len(first))] and len(first) >= 2
    (root / "5.odt").write_bytes(b"broken")
    for _ in range(4):
        last = run()
    assert last == [f"{k}.odt" for k in range(6)]
