"""Settings of the engine and the checks on them."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from pathlib import Path

YEAR = re.compile(r"\d{4}")


def in_range(name: str, value: int, low: int, high: int | None = None) -> int:
    if isinstance(value, bool) or not isinstance(value, int) or value < low or (high is not None and value > high):
        raise ValueError(f"{name} must be an integer from {low}" + (f" to {high}" if high is not None else " on"))
    return value


def mask_url(url: str | None) -> str:
    """A URL's password as three stars."""
    return re.sub(r"(://[^:/@]+:)[^@]+@", r"\1***@", url or "")


def expand_root(path: str) -> list[str]:
    """A folder named data stands for its year folders in order, if it has any; any other for itself."""
    root = Path(path)
    if root.name == "data" and root.is_dir():
        years = sorted(str(p) for p in root.iterdir() if p.is_dir() and YEAR.fullmatch(p.name))
        return years or [path]
    return [path]


def within_roots(path: str, roots: list[str]) -> str:
    """The resolved path, if it is one of the roots or below one."""
    full = Path(path).resolve()
    if not any(full == Path(r).resolve() or Path(r).resolve() in full.parents for r in roots):
        raise ValueError(f"{full.name or '<unnamed>'} is outside the allowed folders")
    return str(full)


def clean_query(query: str, longest: int = 500) -> str:
    query = (query or "").strip()
    if not query:
        raise ValueError("the query is empty")
    return query[:longest]


@dataclass(frozen=True)
class EngineConfig:
    store_root: str = "store"
    mirror_root: str | None = None
    embedding_model: str = "BAAI/bge-m3"
    #: `module:function` that gives a function from texts to a matrix.
    embedding_loader: str | None = None
    embedding_device: str = "cpu"
    embedding_dimension: int = 1024
    chunk_size: int = 1024
    chunk_overlap: int = 128
    data_dirs: tuple[str, ...] = ("data",)
    metadata_doc_list: str = "metadata"
    batch_size: int = 32
    log_level: str = "INFO"
    exclude_boilerplate_table: bool = False
    extract_hwp_images: bool = False
    allowed_models: tuple[str, ...] = field(default=("BAAI/bge-m3",))

    def __post_init__(self) -> None:
        in_range("embedding_dimension", self.embedding_dimension, 1, 4096)
        in_range("chunk_size", self.chunk_size, 64, 8192)
        in_range("chunk_overlap", self.chunk_overlap, 0)
        in_range("batch_size", self.batch_size, 1, 512)
        if self.chunk_overlap >= self.chunk_size:
            raise ValueError("chunk_overlap must be smaller than chunk_size")
        if self.embedding_device not in ("cpu", "cuda", "mps"):
            raise ValueError(f"no such device: {self.embedding_device}")
        if self.log_level not in ("DEBUG", "INFO", "WARNING", "ERROR", "CRITICAL"):
            raise ValueError(f"no such log level: {self.log_level}")
        if self.embedding_model not in self.allowed_models and not Path(self.embedding_model).exists():
            raise ValueError("embedding_model must be an allowed name or an existing path")

    def data_folders(self) -> list[str]:
        return [p for d in self.data_dirs for p in expand_root(d)]
