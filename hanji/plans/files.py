"""Office files made from table rows, for the queries that read such files."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hanji.sources import odt

NAMESPACES = " ".join(f'xmlns:{name}="{uri.strip("{}")}"' for name, uri in (("office", odt.OFFICE), ("text", odt.TEXT), ("table", odt.TABLE)))
#: Characters that XML can't hold; they become spaces.
ILLEGAL = "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f￾￿]"
#: Files that are made at once.
PORTION = 64


def paragraph(line: str, inner: str = "{}") -> str:
    """A line as a paragraph: tabs and further spaces of a run as elements of their own."""
    marked = escape(re.sub(ILLEGAL, " ", line), {"\r": "&#13;"}).replace("\t", "<text:tab/>")
    spaced = re.sub("  +", lambda m: f' <text:s text:c="{len(m[0]) - 1}"/>', marked)
    return f"<text:p>{inner.format(spaced)}</text:p>"


def grid(rows: list[list[str | None]]) -> str:
    cell = lambda c: f"<table:table-cell>{paragraph(c or '')}</table:table-cell>"
    return "<table:table>" + "".join(f"<table:table-row>{''.join(map(cell, r))}</table:table-row>" for r in rows) + "</table:table>"


def document(text: str | None, tables: list[list[list[str | None]]], spans: list[str]) -> bytes:
    """An OpenDocument text: the text's lines, the tables, and each span in a paragraph of its own. Stored, not
    compressed, so that no text looks like a bomb."""
    lines = [paragraph(line) for line in (text or "").split("\n")]
    body = "".join([*lines, *map(grid, tables), *[paragraph(s, "<text:span>{}</text:span>") for s in spans]])
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as archive:
        archive.writestr("content.xml", f"<?xml version='1.0'?><office:document-content {NAMESPACES}><office:body><office:text>{body}</office:text></office:body></office:document-content>")
    return out.getvalue()


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, PORTION):
            rows = batch.slice(at, PORTION).to_pylist()
            made = [document(r["text"], r["tables"], r["spans"]) for r in rows]
            yield pa.RecordBatch.from_arrays([pa.array([r["path"] for r in rows], pa.string()), pa.array(made, pa.binary())], ["path", "content"])


def documents(rows: DataFrame) -> DataFrame:
    """(path, text, tables array<array<array<string>>>, spans array<string>) -> (path, content): OpenDocument texts."""
    return rows.select("path", "text", "tables", "spans").mapInArrow(_documents, "path string, content binary")


def table_of(*rows: tuple[Column, ...]) -> Column:
    return F.array(*[F.array(*[c.cast("string") for c in row]) for row in rows])


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
            system, name = fs.FileSystem.from_uri(re.sub("^file:/+", "/", path))
            system.create_dir(name.rpartition("/")[0], recursive=True)
            with system.open_output_stream(name) as out:
                out.write(content.as_buffer())
        yield pa.RecordBatch.from_arrays([batch.column("path")], ["path"])


def write(rows: DataFrame) -> int:
    """Write (path, content) as files into a folder that driver and executors share; how many. A task that is done again writes the same."""
    return rows.select("path", "content").mapInArrow(_write, "path string").count()
