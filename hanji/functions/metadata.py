"""Column functions on the metadata of documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

# Disclosure codes and what they are called, and what the document types are called.
OPEN_CODES = (("DPBT1", "대국민공개"), ("DPBT2", "비공개"), ("DPBT3", "부분공개"))
TYPE_NAMES = (("P", "생산"), ("R", "접수"))


def text_or_empty(x: Column) -> Column:
    return F.coalesce(strip(x), F.lit(""))


def int_or_null(x: Column) -> Column:
    return strip(x).try_cast("int")


def doc_type(raw: Column) -> Column:
    return F.substring(text_or_empty(raw), 1, 1)


def doc_year(raw: Column) -> Column:
    return F.substring(text_or_empty(raw), 2, 100).try_cast("int")


def type_name(raw: Column) -> Column:
    kind, name = doc_type(raw), F.lit("")
    for code, label in TYPE_NAMES:
        name = F.when(kind == code, label).otherwise(name)
    return name


def open_code(raw: Column) -> Column:
    x = out = text_or_empty(raw)
    for code, _ in reversed(OPEN_CODES):
        out = F.when(F.contains(x, F.lit(code)), code).otherwise(out)
    return out


def open_name(raw: Column) -> Column:
    x, out = text_or_empty(raw), F.lit("")
    for code, name in reversed(OPEN_CODES):
        out = F.when(F.contains(x, F.lit(code)), name).otherwise(out)
    return out


def full_path(*levels: Column) -> Column:
    """The levels that hold anything, joined by ' > '."""
    return F.array_join(F.filter(F.array(*[text_or_empty(x) for x in levels]), lambda x: x != ""), " > ")
