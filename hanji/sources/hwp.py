"""Images inside HWP documents, as one Arrow function over files."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hanji.functions.text import looks_like_image, safe_basename, stem

from . import compound

# Limits on a stream, a decoded image and all images of a document.
MAX_STREAM, MAX_IMAGE, MAX_TOTAL = 32 << 20, 64 << 20, 256 << 20
SCHEMA = "path string, filename string, raw binary, inflated binary, error string"


def referenced(doc_info: bytes) -> dict[int, str]:
    """Numbers and suffixes of the embedded images that the document's information records name."""
    refs, at, number = {}, 0, 0
    while at + 4 <= len(doc_info):
        head, = struct.unpack_from("<I", doc_info, at)
        tag, size, at = head & 0x3FF, head >> 20, at + 4
        if size == 0xFFF:
            size, = struct.unpack_from("<I", doc_info, at)
            at += 4
        body = doc_info[at : at + size]
        at += size
        if tag == 18 and len(body) >= 6:
            number += 1
            if struct.unpack_from("<H", body)[0] & 0xF == 1:
                item, length = struct.unpack_from("<HH", body, 2)
                refs[item] = body[6 : 6 + 2 * length].decode("utf-16-le", "replace").lower()
    return refs


def inflate(data: bytes) -> bytes | None:
    """Raw deflate, null for anything else; one byte more than MAX_IMAGE tells that there is more."""
    try:
        return zlib.decompressobj(-15).decompress(data, MAX_IMAGE + 1)
    except zlib.error:
        return None


def images_of(path: str, content: bytes) -> list[tuple]:
    """The images of a document as rows of SCHEMA. A stream, an image or all images together beyond the limits fail the
    document: one row with an error, and no image."""
    found = compound.streams(content, MAX_STREAM)
    info = found.get("DocInfo") or b""
    refs = {f"bin{n:04x}.{x}" for n, x in referenced(inflate(info) or info).items()}
    rows, total = [], 0
    for name, raw in sorted(found.items()):
        if not name.startswith("BinData/") or (refs and name[8:].lower() not in refs):
            continue
        if raw is None:
            raise ValueError("an embedded image's stream is too large")
        inflated = inflate(raw)
        size = len(raw if inflated is None else inflated)
        total += size
        if size > MAX_IMAGE:
            raise ValueError("an embedded image is too large")
        if total > MAX_TOTAL:
            raise ValueError("the embedded images together are too large")
        rows.append((path, name[8:], raw, inflated, None))
    return rows or [(path, None, None, None, None)]


def _images(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
            try:
                rows = images_of(path, content.as_py())
            except (ValueError, IndexError, struct.error) as error:
                rows = [(path, None, None, None, f"{type(error).__name__}: {error}")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.string(), pa.binary(), pa.binary(), pa.string()), strict=True)], ["path", "filename", "raw", "inflated", "error"])


def list_files(spark: SparkSession, *roots: str) -> DataFrame:
    """path and length of all .hwp and .hwpx files below the roots, whatever the suffix's case. Reads none of them."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(roots)).select("path", "length")
    return files.filter(F.lower("path").rlike(r"\.hwpx?$"))


def extract_images(spark: SparkSession, *roots: str) -> DataFrame:
    """source_path, filename, payload, status (extracted, no_images or failed), message: an image as it is stored if it
    begins as its suffix says, else inflated if that does."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.hwp").load(list(roots)).select("path", "content")
    found = files.mapInArrow(_images, SCHEMA)
    name = F.col("filename")
    payload = F.when(looks_like_image(name, F.col("raw")), F.col("raw")).when(looks_like_image(name, F.col("inflated")), F.col("inflated"))
    status = F.when(F.col("error").isNotNull(), "failed").when(name.isNull(), "no_images").when(F.col("payload").isNull(), "failed").otherwise("extracted")
    message = F.when(F.col("error").isNotNull(), F.concat(safe_basename(F.col("path")), F.lit(": "), F.col("error"))).when(name.isNotNull() & F.col("payload").isNull(), F.concat(F.lit("invalid image payload: "), name))
    return found.withColumn("payload", payload).select(F.col("path").alias("source_path"), "filename", "payload", status.alias("status"), message.alias("message"), F.concat(stem(F.col("path")), F.lit("_images")).alias("folder"))
