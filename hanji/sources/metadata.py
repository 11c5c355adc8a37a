"""Metadata spreadsheets: CSV and XLSX files with or without recognisable headers -> one table of strings."""

from __future__ import annotations

import csv
import io
import re
import struct
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hanji.functions import metadata as md
from hanji.functions.text import strip
from hanji.operators.store import keep_last

from . import biff

# The columns in order, each with the header texts that name it.
COLUMNS: dict[str, tuple[str, ...]] = {
    "doc_type_raw": ("구분(p:생산,r:접수)", "se"),
    "state_code": ("상태코드", "stts_cd"),
    "state_name": ("상태명", "stts_nm"),
    "doc_id": ("문서id", "문서아이디"),
    "doc_seq": ("문서연번", "doc_no_seq"),
    "doc_no": ("생산문서번호", "appr_doc_num"),
    "title": ("문서명", "doc_nm"),
    "open_code_raw": ("공개여부", "open"),
    "close_reason": ("비공개사유", "open_reason"),
    "receive_date": ("수신일", "recv_dt"),
    "process_date": ("처리일", "act_dt"),
    "link_id": ("연계id",),
    "register_datetime": ("등록일시", "reg_dt"),
    "approval_yn": ("승인여부", "aprv_yn"),
    "biz_cate": ("구분1", "exlpn_1"),
    "biz_sub_cate": ("구분2", "exlpn_2"),
    "biz_detail_cate": ("구분3", "exlpn_3"),
    "org_name": ("기관명", "instt_nm"),
    "view_scope": ("열람범위종류", "read_range_type"),
    "internal_external": ("대내/대외구분", "enf_gubun"),
    "receive_dept_id": ("수신부서id", "recv_dept_id"),
    "attachment_count": ("붙임파일갯수", "attach_seq"),
    "processor_dept_id": ("처리자부서id", "acter_dept_id"),
    "processor_dept_name": ("처리자부서이름", "acter_dept_name"),
    "processor_dept_detail": ("처리자부서상세이름", "acter_dept_name_desc"),
    "processor_type": ("처리자구분", "acter_gubun"),
    "receiver_dept_id": ("수신자부서id", "rec_dept_id"),
    "receiver_dept_name": ("수신자부서이름", "rec_dept_name"),
    "receiver_dept_detail": ("수신자부서상세이름", "rec_dept_name_desc"),
    "sender_dept_name": ("발송자부서이름", "send_dept_name"),
}
# Namespaces of the format.
SHEET = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def canonical(header: str | None) -> str | None:
    """The column that a header names: exactly, else by a text that it begins with. (The exact match first: a plain
    prefix rule would read send_dept_name as se.)"""
    h = "".join((header or "").replace("﻿", "").lower().split())
    if not h:
        return None
    names = {alias: column for column, aliases in COLUMNS.items() for alias in (column, *aliases)}
    if h in names:
        return names[h]
    return next((column for alias, column in names.items() if h.startswith(alias)), None)


def mapping_of(row: list[str | None]) -> dict[int, str]:
    """Positions of the columns that a row of headers names; the first position wins."""
    found: dict[int, str] = {}
    for k, cell in enumerate(row):
        name = canonical(cell)
        if name and name not in found.values():
            found[k] = name
    return found


def header_of(rows: list[list[str | None]]) -> tuple[dict[int, str], int]:
    """(mapping, first data row). Header rows name doc_id and two more columns; of a run of them the one that names most
    counts, the later of equals. Without any, columns go by position after the first row."""
    best, start = None, 0
    for k, row in enumerate(rows[:5]):
        found = mapping_of(row)
        if len(found) >= 3 and "doc_id" in found.values() and (best is None or k == start):
            best = found if best is None or len(found) >= len(best) else best
            start = k + 1
    return (best, start) if best is not None else (dict(enumerate(COLUMNS)), 1 if len(rows) > 1 else 0)


def csv_rows(data: bytes) -> list[list[str | None]]:
    return [[cell or None for cell in row] for row in csv.reader(io.StringIO(data.decode("utf-8-sig")))]


def first_sheet(book: zipfile.ZipFile) -> str:
    """The member that the workbook names as its first sheet, whatever its number; without a workbook, that of the
    lowest number."""
    names = book.namelist()
    if {"xl/workbook.xml", "xl/_rels/workbook.xml.rels"} <= set(names):
        first = next(ET.fromstring(book.read("xl/workbook.xml")).iter(SHEET + "sheet"), None)
        targets = {r.get("Id"): (r.get("Target") or "") for r in ET.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
        if first is not None and (target := targets.get(first.get(RELATION + "id"))):
            return target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    return min((n for n in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.sub(r"\D", "", n)))


def xlsx_rows(data: bytes) -> list[list[str | None]]:
    """The first sheet's cells as strings."""
    with zipfile.ZipFile(io.BytesIO(data)) as book:
        shared = []
        if "xl/sharedStrings.xml" in book.namelist():
            shared = ["".join(t.text or "" for t in si.iter(SHEET + "t")) for si in ET.fromstring(book.read("xl/sharedStrings.xml"))]
        sheet = first_sheet(book)
        rows = []
        for row in ET.fromstring(book.read(sheet)).iter(SHEET + "row"):
            cells: dict[int, str] = {}
            for k, c in enumerate(row.iter(SHEET + "c")):
                at = 0
                for letter in re.sub(r"\d", "", c.get("r", "")):
                    at = at * 26 + ord(letter) - 64
                value = c.find(SHEET + "v")
                own = "".join(t.text or "" for t in c.iter(SHEET + "t")) if c.get("t") == "inlineStr" else (value.text if value is not None else None)
                if own:
                    cells[at - 1 if at else k] = shared[int(own)] if c.get("t") == "s" else own
            rows.append([cells.get(k) for k in range(max(cells, default=-1) + 1)])
    return rows


READERS = {"csv": csv_rows, "xlsx": xlsx_rows, "xls": biff.rows_of}
UNREADABLE = (ValueError, KeyError, IndexError, struct.error, zipfile.BadZipFile, ET.ParseError, csv.Error)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Files -> rows of the known columns, with the file's order and the row's place; a file that can't be read is one row
    with an error."""
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), *[pa.string()] * len(COLUMNS)]
    for batch in batches:
        for file in batch.to_pylist():
            out: dict[str, list] = {c: [] for c in ("modified", "source", "place", "error", *COLUMNS)}

            def put(place: int, error: str | None, named: dict[str, str | None], file: dict = file, out: dict = out) -> None:
                own = {"modified": file["modified"], "source": file["path"].rsplit("/", 1)[-1], "place": place, "error": error}
                for c, values in out.items():
                    values.append(own[c] if c in own else named.get(c))

            try:
                rows = [r for r in READERS[file["path"].lower().rsplit(".", 1)[-1]](file["content"]) if any(c not in (None, "") for c in r)]
                mapping, start = header_of(rows)
                for place, row in enumerate(rows[start:]):
                    put(place, None, {name: row[k] for k, name in mapping.items() if k < len(row)})
            except UNREADABLE as error:
                put(0, f"{type(error).__name__}: {error}", {})
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], list(out))


def read_rows(spark: SparkSession, *paths: str) -> DataFrame:
    """All rows of all files (.csv, .xlsx, .xls), with `error` for files that can't be read. Each file is read by one task; a
    folder's files in parallel."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    files = files.filter(F.lower("path").rlike(r"\.(csv|xlsx|xls)$")).select("path", F.unix_micros("modificationTime").alias("modified"), "content")
    schema = "modified long, source string, place long, error string, " + ", ".join(f"{c} string" for c in COLUMNS)
    return files.mapInArrow(_rows, schema)


def unreadable(rows: DataFrame) -> DataFrame:
    """(source, error) of the files that couldn't be read."""
    return rows.filter(F.col("error").isNotNull()).select("source", "error")


def latest(rows: DataFrame) -> DataFrame:
    """One row for each doc_id, all columns strings: of rows with one doc_id the last by the files' time, their name and
    the row's place."""
    named = rows.filter(F.col("error").isNull()).withColumn("doc_id", md.text_or_empty(F.col("doc_id"))).filter(F.col("doc_id") != "")
    return keep_last(named, "doc_id", F.col("modified"), F.col("source"), F.col("place")).drop("modified", "place", "error")


def read_metadata(spark: SparkSession, *paths: str) -> DataFrame:
    """The latest row of each doc_id in all files that can be read."""
    return latest(read_rows(spark, *paths))


def document_metadata(rows: DataFrame) -> DataFrame:
    """The typed view: stripped texts (empty for missing), type, year, disclosure and classification."""
    text = {c: md.text_or_empty(F.col(c)) for c in COLUMNS if c not in ("doc_type_raw", "open_code_raw", "attachment_count", "doc_id")}
    return rows.select(
        "doc_id", md.doc_type(F.col("doc_type_raw")).alias("doc_type"), md.doc_year(F.col("doc_type_raw")).alias("doc_year"),
        md.open_code(F.col("open_code_raw")).alias("open_code"), md.open_name(F.col("open_code_raw")).alias("open_name"),
        md.int_or_null(F.col("attachment_count")).alias("attachment_count"), *[v.alias(c) for c, v in text.items()],
        md.type_name(F.col("doc_type_raw")).alias("type_name"), md.full_path(F.col("biz_cate"), F.col("biz_sub_cate"), F.col("biz_detail_cate")).alias("biz_full_path"),
    )


def metadata_stats(rows: DataFrame) -> DataFrame:
    from hanji.operators.stats import value_counts

    return value_counts(rows.withColumn("biz_cate", F.nullif(strip(F.col("biz_cate")), F.lit(""))).withColumn("biz_sub_cate", F.nullif(strip(F.col("biz_sub_cate")), F.lit(""))), "biz_cate", "biz_sub_cate")
