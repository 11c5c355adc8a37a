"""Look-ups by document: each reads the buckets of the ids asked for and nothing else."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import TableStore


def document(tables: TableStore, doc_id: str) -> DataFrame:
    """The document's row, or none."""
    return tables.lookup("documents", doc_id)


def exists(tables: TableStore, doc_id: str) -> bool:
    return not document(tables, doc_id).select("doc_id").isEmpty()


def attachments(tables: TableStore, doc_id: str) -> DataFrame:
    """The document's attachments in their order, the main one first."""
    return tables.lookup("attachments", doc_id).orderBy("file_order", "file_name")


def chunks(tables: TableStore, doc_id: str) -> DataFrame:
    """The document's chunks in their order."""
    return tables.lookup("document_chunks", doc_id).orderBy("chunk_num")


def permit(tables: TableStore, doc_id: str) -> DataFrame:
    return tables.lookup("permit_extractions", doc_id)


def documents(tables: TableStore, ids: list[str]) -> DataFrame:
    """Several documents, in order of id."""
    return tables.lookup("documents", *ids).orderBy(F.col("doc_id"))
