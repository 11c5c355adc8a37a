"""OpenDocument texts as a data source of their own: `spark.read.format("odt")` and `spark.readStream.format("odt")`.

Rows are files as `odt.parse` reads them (path, file_hash and the parsed elements); `odt.documents_of` makes documents of
them. Files are listed and opened through pyarrow's file systems, so paths may be local, shared or in an object store;
paths that only Spark's own readers know are for `odt.read_documents`.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from fnmatch import fnmatch
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from . import odt

#: Bytes of files that a task reads, counting each file as so many at least, and files that a stream's batch takes.
TASK_BYTES, FILE_BYTES, BATCH_FILES = 64 << 20, 64 << 10, 10_000


class Files(InputPartition):
    """Files that one task reads: paths in order."""

    def __init__(self, paths: list[str]):
        super().__init__(paths)
        self.paths = paths


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    if urlsplit(path).scheme:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def listed(roots: list[str], glob: str) -> list[tuple[int, str, int]]:
    """(time of change in ns, path, bytes) of all files below the roots whose name fits; a root may be a file."""
    found = []
    for root in roots:
        system, inside = file_system(root)
        prefix = root[: len(root) - len(inside)] if root.endswith(inside) else ""
        info = system.get_file_info(inside)
        files = [info] if info.type == pafs.FileType.File else system.get_file_info(pafs.FileSelector(inside, recursive=True))
        found += [(f.mtime_ns or 0, prefix + f.path, f.size) for f in files if f.type == pafs.FileType.File and fnmatch(f.base_name, glob)]
    return sorted(set(found))


def balanced(files: list[tuple[int, str, int]], task_bytes: int = TASK_BYTES) -> list[Files]:
    """Files in so many tasks that each gets about task_bytes: the largest first, each to the task that has least."""
    weight = lambda size: max(size, FILE_BYTES)
    tasks = max(1, -(-sum(weight(size) for _, _, size in files) // task_bytes))
    heap: list[tuple[int, int, list[str]]] = [(0, k, []) for k in range(min(tasks, max(1, len(files))))]
    for _, path, size in sorted(files, key=lambda f: (-f[2], f[1])):
        load, k, paths = heapq.heappop(heap)
        paths.append(path)
        heapq.heappush(heap, (load + weight(size), k, paths))
    return [Files(sorted(paths)) for _, _, paths in sorted(heap, key=lambda t: t[1]) if paths]


def parsed(part: Files, batch_bytes: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """The part's files as batches of rows, each of about batch_bytes of files. A file that can't be read is a row with an
    error, as one that can't be parsed."""
    rows, held = [], 0
    for path in part.paths:
        system, inside = file_system(path)
        try:
            with system.open_input_stream(inside) as stream:
                data = stream.read()
        except OSError as error:
            rows.append({"path": path, "file_hash": None, **odt.failed(error)})
            continue
        rows.append({"path": path, "file_hash": hashlib.sha256(data).hexdigest(), **odt.parsed_or_failed(data)})
        held += len(data)
        if held >= batch_bytes:
            yield odt.batch_of(rows)
            rows, held = [], 0
    if rows:
        yield odt.batch_of(rows)


class OdtReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.roots, self.glob = roots_of(options), options.get("pathGlobFilter", "*.odt")
        self.task_bytes = int(options.get("taskBytes", TASK_BYTES))

    def partitions(self) -> list[InputPartition]:
        return list(balanced(listed(self.roots, self.glob), self.task_bytes)) or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        return parsed(partition)


class OdtStreamReader(DataSourceStreamReader):
    """Files in order of their time of change and path; an offset is the last one's. A file that changes is read again. One
    that arrives with a time before the offset is not: move files in after writing them, without keeping old times."""

    def __init__(self, options: dict[str, str]):
        self.roots, self.glob = roots_of(options), options.get("pathGlobFilter", "*.odt")
        self.task_bytes, self.batch_files = int(options.get("taskBytes", TASK_BYTES)), int(options.get("maxFilesPerTrigger", BATCH_FILES))
        self.last: tuple[int, str] | None = None

    def initialOffset(self) -> dict:
        return {"modified": -1, "path": ""}

    def latestOffset(self) -> dict:
        """The last of the next batch_files files behind what was handed out before."""
        ahead = [f for f in listed(self.roots, self.glob) if self.last is None or f[:2] > self.last][: self.batch_files]
        if ahead:
            self.last = ahead[-1][:2]
        modified, path = self.last or (-1, "")
        return {"modified": modified, "path": path}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        low, high = ((o["modified"], o["path"]) for o in (start, end))
        self.last = max(self.last or high, high)
        return list(balanced([f for f in listed(self.roots, self.glob) if low < f[:2] <= high], self.task_bytes))

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        return parsed(partition)

    def commit(self, end: dict) -> None:
        pass


def roots_of(options: dict[str, str]) -> list[str]:
    """The `path` option: one path, or a JSON list of several."""
    path = options.get("path")
    if not path:
        raise ValueError("the odt source needs a path")
    return json.loads(path) if path.startswith("[") else [path]


class OdtSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "odt"

    def schema(self) -> str:
        return f"path string, file_hash string, {odt.ELEMENTS}"

    def reader(self, schema: object) -> DataSourceReader:
        return OdtReader(dict(self.options))

    def streamReader(self, schema: object) -> DataSourceStreamReader:
        return OdtStreamReader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(OdtSource)


def read(spark: SparkSession, *roots: str, glob: str = "*.odt") -> DataFrame:
    """The documents below the roots, as odt.read_documents gives them."""
    register(spark)
    return odt.documents_of(spark.read.format("odt").option("pathGlobFilter", glob).load(json.dumps(list(roots)) if len(roots) > 1 else roots[0]))
