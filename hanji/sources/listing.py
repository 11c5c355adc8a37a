"""Files below folders that driver and executors share, listed, hashed and parsed by tasks: however many there are, the
driver holds none of their names. Paths in other file systems, and patterns, are for Spark's own readers."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import partial, reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hanji.functions import text
from hanji.sources import odt

#: Folders that a task lists for each one that it is given, further ones being left to the next round; rows of a batch,
#: files that it has the contents of at once, and files of a task.
MOST_FOLDERS, BATCH_ROWS, PORTION, TASK_FILES = 1000, 10_000, 64, 1000
ENTRY = "path string, folder boolean, modified timestamp"


def hidden(name: str) -> bool:
    """What Spark's readers leave out."""
    return name.startswith(".") or name.endswith("._COPYING_") or name.startswith("_") and "=" not in name and not name.startswith(("_metadata", "_common_metadata"))


def shared_roots(spark: SparkSession, roots: list[str]) -> list[str] | None:
    """The roots as plain paths, if each is there in the file system that programs see."""
    jvm = spark.sparkContext._jsc
    plain_is_local = str(jvm.hadoopConfiguration().get("fs.defaultFS", "file:///")).startswith("file:")
    plain = [re.sub("^file:/+", "/", r) for r in roots]
    fine = all((plain_is_local or r != p) and os.path.exists(p) for r, p in zip(roots, plain, strict=True))
    return [os.path.abspath(p) for p in plain] if fine else None


def entry(path: str, folder: bool, changed_ns: int) -> tuple[str, bool, int]:
    return f"file:{path}", folder, changed_ns // 1_000_000 * 1000  # as Spark's readers give both


def walked(root: str, most: int) -> Iterator[tuple[str, bool, int]]:
    """Files below a folder, and folders that are left to others: never more than `most` of them are held or listed."""
    todo, listed = [root], 0
    while todo:
        folder = todo.pop()
        if listed == most:
            yield entry(folder, True, 0)
            continue
        listed += 1
        with os.scandir(folder) as found:
            for e in found:
                if hidden(e.name):
                    continue
                if not e.is_dir():
                    yield entry(e.path, False, e.stat().st_mtime_ns)
                elif len(todo) < most:
                    todo.append(e.path)
                else:
                    yield entry(e.path, True, 0)


def _batch(rows: list[tuple[str, bool, int]]) -> pa.RecordBatch:
    paths, folders, times = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(folders, pa.bool_()), pa.array(times, pa.timestamp("us", "UTC"))], ["path", "folder", "modified"])


def _walked(most: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = []
    for batch in batches:
        for path in batch.column("path").to_pylist():
            for row in walked(path.removeprefix("file:"), most):
                rows.append(row)
                if len(rows) >= BATCH_ROWS:
                    yield _batch(rows)
                    rows = []
    if rows:
        yield _batch(rows)


def dealt(rows: DataFrame, of_task: int = TASK_FILES) -> DataFrame:
    """Stored rows that stand for far more work than their size tells, so many to a task, but one to each core at least."""
    return rows.repartition(max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // of_task)))


def list_files(spark: SparkSession, folder: str, roots: list[str], most: int = MOST_FOLDERS) -> DataFrame:
    """(path, modified) of all files below the roots, each once. Every round lists the folders that the one before has
    left; each is written below `folder`."""
    start = [entry(r, os.path.isdir(r), os.stat(r).st_mtime_ns) for r in roots if os.path.isdir(r) or not hidden(os.path.basename(r))]
    here = [_batch(start)] if start else []
    found = spark.createDataFrame(pa.Table.from_batches(here, _batch([("", False, 0)]).schema)).select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in ENTRY.split(", ")])
    rounds = []
    while True:
        path = f"{folder}/{len(rounds)}"
        found.write.mode("overwrite").parquet(path)
        rounds.append(spark.read.schema(ENTRY).parquet(path))
        left = rounds[-1].filter("folder").select("path")
        if left.isEmpty():
            files = reduce(DataFrame.unionAll, rounds).filter(~F.col("folder")).select("path", "modified")
            return files if len(roots) == 1 else files.groupBy("path").agg(F.max("modified").alias("modified"))
        found = dealt(left, most).mapInArrow(partial(_walked, most), ENTRY)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests = []
        for path in batch.column("path").to_pylist():
            with open(path.removeprefix("file:"), "rb") as f:
                digests.append(hashlib.file_digest(f, "sha256").hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("modified"), pa.array(digests, pa.string())], ["path", "modified", "file_hash"])


def hash_files(files: DataFrame, suffix: str = ".odt") -> DataFrame:
    """Listed files -> (path, doc_id, file_hash, modified) of those whose name ends so, as odt.hash_files."""
    hashed = dealt(files.filter(F.endswith("path", F.lit(suffix)))).mapInArrow(_hashed, "path string, modified timestamp, file_hash string")
    return hashed.select("path", text.document_id(F.col("path")).alias("doc_id"), "file_hash", "modified")


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths = batch.column("path").to_pylist()
        for at in range(0, len(paths), PORTION):
            rows = []
            for path in paths[at : at + PORTION]:
                with open(path.removeprefix("file:"), "rb") as f:
                    data = f.read()
                rows.append({"path": path, "file_hash": hashlib.sha256(data).hexdigest(), **odt.parsed_or_failed(data)})
            yield odt.batch_of(rows)


def parse_documents(files: DataFrame) -> DataFrame:
    """Files (path) -> documents, as odt.parse_documents."""
    return odt.documents_of(dealt(files.select("path")).mapInArrow(_parsed, f"path string, file_hash string, {odt.ELEMENTS}"))
