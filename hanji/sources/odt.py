"""OpenDocument texts: files -> elements by one small Arrow function, elements -> documents by column expressions."""

from __future__ import annotations

import io
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hanji.functions import names, text

# Namespaces of the format, and the guards against oversized or over-compressed members.
OFFICE = "{urn:oasis:names:tc:opendocument:xmlns:office:1.0}"
TEXT = "{urn:oasis:names:tc:opendocument:xmlns:text:1.0}"
TABLE = "{urn:oasis:names:tc:opendocument:xmlns:table:1.0}"
MAX_XML, MAX_RATIO = 20 * 1024 * 1024, 200

ELEMENTS = "elements array<struct<kind:string,text:string,rows:array<array<string>>>>, table_rows array<array<string>>, paragraphs array<string>, spans array<string>, error string"
_ROW = pa.struct([("kind", pa.string()), ("text", pa.string()), ("rows", pa.list_(pa.list_(pa.string())))])
_TYPES = {"elements": pa.list_(_ROW), "table_rows": pa.list_(pa.list_(pa.string())), "paragraphs": pa.list_(pa.string()), "spans": pa.list_(pa.string()), "error": pa.string()}


def content_xml(data: bytes) -> bytes:
    """The member content.xml of the archive, if it is there and within the guards."""
    with zipfile.ZipFile(io.BytesIO(data)) as archive:
        try:
            info = archive.getinfo("content.xml")
        except KeyError:
            raise ValueError("no content.xml") from None
        if info.file_size <= 0 or info.file_size > MAX_XML:
            raise ValueError(f"content.xml has {info.file_size} bytes")
        if info.file_size / max(info.compress_size, 1) > MAX_RATIO:
            raise ValueError("content.xml is compressed too far")
        return archive.read(info)


def xml_root(xml: bytes) -> ET.Element:
    """The parsed document; document types and entities are refused, broken xml:id values are mended once."""
    if re.search(rb"<!(?:DOCTYPE|ENTITY)", xml):
        raise ValueError("document type declarations are refused")
    try:
        return ET.fromstring(xml)
    except ET.ParseError:
        return ET.fromstring(re.sub(rb'(xml:id=")([^"]*)(")', lambda m: m[1] + b"id_" + re.sub(rb"[^A-Za-z0-9_.\-]", b"_", m[2]) + m[3], xml))


def text_of(node: ET.Element) -> str:
    """A node's text with what lies below it; breaks, tabs and counted spaces become characters."""
    parts = [node.text or ""]
    for child in node:
        if child.tag == TEXT + "line-break":
            parts.append("\n")
        elif child.tag == TEXT + "tab":
            parts.append("\t")
        elif child.tag == TEXT + "s":
            parts.append(" " * int(child.get(TEXT + "c", 1)))
        else:
            parts.append(text_of(child))
        parts.append(child.tail or "")
    return "".join(parts)


def list_text(node: ET.Element, level: int = 0) -> str:
    """A bullet for each paragraph of each item at any depth, and again for nested lists, two spaces further in."""
    lines = []
    for item in node.iter(TEXT + "list-item"):
        lines += [f"{'  ' * level}- {t}" for p in item.findall(TEXT + "p") if (t := text_of(p).strip())]
        lines += [t for nested in item.findall(TEXT + "list") if (t := list_text(nested, level + 1))]
    return "\n".join(lines)


def grid_of(table: ET.Element) -> list[list[str]]:
    """Cells of all rows; repeated cells as often as they say."""
    rows = []
    for row in table.iter(TABLE + "table-row"):
        cells: list[str] = []
        for cell in row.findall(TABLE + "table-cell"):
            own = " ".join(t for p in cell.iter(TEXT + "p") if (t := text_of(p).strip()))
            cells += [own] * int(cell.get(TABLE + "number-columns-repeated", 1))
        if cells:
            rows.append(cells)
    return rows


def flat_texts(section: ET.Element) -> Iterator[str]:
    for child in section:
        if child.tag == TEXT + "section":
            yield from flat_texts(child)
        else:
            yield list_text(child) if child.tag == TEXT + "list" else text_of(child)


def elements_of(body: ET.Element) -> Iterator[dict]:
    for child in body:
        if child.tag == TABLE + "table":
            yield {"kind": "table", "text": None, "rows": grid_of(child)}
            continue
        own = flat_texts(child) if child.tag == TEXT + "section" else [list_text(child) if child.tag == TEXT + "list" else text_of(child)]
        yield from ({"kind": "text", "text": t, "rows": None} for t in own if t.strip())


def parse(data: bytes) -> dict:
    root = xml_root(content_xml(data))
    body = root.find(f".//{OFFICE}body/{OFFICE}text")
    rows = [[" | ".join(t for p in row.findall(f"{TABLE}table-cell//{TEXT}p") if (t := "".join(p.itertext()).strip())) for row in table.iter(TABLE + "table-row")] for table in root.iter(TABLE + "table")]
    return {
        "elements": list(elements_of(body)) if body is not None else [],
        "table_rows": rows,
        "paragraphs": [text_of(p).strip() for p in root.iter(TEXT + "p")],
        "spans": [s.text.strip() for s in root.iter(TEXT + "span") if s.text],
        "error": None,
    }


def failed(error: Exception) -> dict:
    return {"elements": [], "table_rows": [], "paragraphs": [], "spans": [], "error": f"{type(error).__name__}: {error}"}


def parsed_or_failed(data: bytes) -> dict:
    try:
        return parse(data)
    except (ValueError, ET.ParseError, zipfile.BadZipFile, RecursionError) as error:
        return failed(error)


def batch_of(rows: list[dict]) -> pa.RecordBatch:
    types = {"path": pa.string(), "file_hash": pa.string(), **_TYPES}
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in types.items()], list(types))


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        named = zip(*(batch.column(c).to_pylist() for c in ("path", "file_hash")), strict=True)
        yield batch_of([{"path": path, "file_hash": digest, **parsed_or_failed(value.as_py())} for (path, digest), value in zip(named, batch.column("content"), strict=True)])


def read_files(spark: SparkSession, *roots: str, glob: str = "*.odt") -> DataFrame:
    """(path, content, file_hash, ...) of all files below the roots whose name fits."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(list(roots))
    return files.withColumn("file_hash", F.sha2("content", 256))


def hash_files(spark: SparkSession, *roots: str, glob: str = "*.odt") -> DataFrame:
    """(path, doc_id, file_hash, modified) of all files: each content is hashed where it is read and goes no further."""
    return read_files(spark, *roots, glob=glob).select("path", text.document_id(F.col("path")).alias("doc_id"), "file_hash", F.col("modificationTime").alias("modified"))


def sections(elements: Column) -> Column:
    """Elements -> array<struct<section_type,content,order>>: neighbouring texts are joined, tables become Markdown."""
    kind = "array<struct<section_type:string,content:string>>"

    def add(acc: Column, e: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        table = F.struct(F.lit("table").alias("section_type"), text.markdown_table(F.coalesce(e["rows"], F.array().cast("array<array<string>>"))).alias("content"))
        joined = F.struct(F.lit("text").alias("section_type"), F.concat(last["content"], F.lit("\n"), e["text"]).alias("content"))
        first = F.struct(F.lit("text").alias("section_type"), e["text"].alias("content"))
        return (
            F.when((e["kind"] == "table") & (table["content"] == ""), acc)
            .when(e["kind"] == "table", F.concat(acc, F.array(table)))
            .when(last["section_type"] == "text", F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(joined)))
            .otherwise(F.concat(acc, F.array(first)))
        )

    found = F.aggregate(elements, F.array().cast(kind), add)
    found = F.filter(F.transform(found, lambda s: F.struct(s["section_type"].alias("section_type"), text.strip(s["content"]).alias("content"))), lambda s: s["content"] != "")
    return F.transform(found, lambda s, i: F.struct(s["section_type"].alias("section_type"), s["content"].alias("content"), i.alias("order")))


SIGNED = r"(?:전결|승인|대결)[^\d]*(\d{4})\.\s*(\d{1,2})\.\s*(\d{1,2})"
DOTTED = r"(\d{4})\.\s*(\d{1,2})\.\s*(\d{1,2})"
DEPARTMENT = r"([가-힣]+(?:과|부|팀|실))-\d+"


def _iso(x: Column, pattern: str) -> Column:
    part = lambda n: F.regexp_extract(x, pattern, n)
    return F.when(part(1) != "", F.concat_ws("-", part(1), F.lpad(part(2), 2, "0"), F.lpad(part(3), 2, "0")))


def signed_date(table_rows: Column, spans: Column) -> Column:
    """Of the last table's fifth, then sixth row the signed date, else the row's last date; else the first signed date
    of any span. ISO text, not checked to be a date."""
    last = F.try_element_at(table_rows, F.lit(-1))
    of_row = lambda n: F.coalesce(_iso(F.get(last, F.lit(n)), SIGNED), _iso(F.try_element_at(F.regexp_extract_all(F.get(last, F.lit(n)), F.lit(DOTTED), F.lit(0)), F.lit(-1)), DOTTED))
    of_span = F.get(F.filter(F.transform(spans, lambda s: _iso(s, SIGNED)), lambda d: d.isNotNull()), F.lit(0))
    return F.coalesce(of_row(4), of_row(5), of_span)


def department(table_rows: Column, spans: Column) -> Column:
    row = F.get(F.try_element_at(table_rows, F.lit(-1)), F.lit(7))
    found = lambda x: F.nullif(F.regexp_extract(x, DEPARTMENT, 1), F.lit(""))
    return F.coalesce(found(row), F.get(F.filter(F.transform(spans, found), lambda d: d.isNotNull()), F.lit(0)))


def read_documents(spark: SparkSession, *roots: str) -> DataFrame:
    return parse_documents(read_files(spark, *roots))


def parse_documents(files: DataFrame) -> DataFrame:
    """Files (path, file_hash, content) -> doc_id, file_path, title, file_hash, author_name, dept_name, report_date,
    sections, error. A file that can't be read is a row with an error and no sections."""
    return documents_of(files.select("path", "file_hash", "content").mapInArrow(_parsed, f"path string, file_hash string, {ELEMENTS}"))


def documents_of(parsed: DataFrame) -> DataFrame:
    """Parsed files, from files or from the source `odt`, as documents."""
    path = F.col("path")
    return parsed.select(
        text.document_id(path).alias("doc_id"), path.alias("file_path"), text.title_from_path(path).alias("title"), "file_hash",
        F.coalesce(names.from_tables(F.col("table_rows")), names.from_paragraphs(F.col("paragraphs"))).alias("author_name"),
        department(F.col("table_rows"), F.col("spans")).alias("dept_name"), signed_date(F.col("table_rows"), F.col("spans")).alias("report_date"),
        sections(F.col("elements")).alias("sections"), text.sanitize_paths(F.col("error")).alias("error"),
    )
