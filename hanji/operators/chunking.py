"""Splitting sections into chunks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hanji.functions import text
from hanji.functions.text import let

CHUNK_SIZE, CHUNK_OVERLAP = 1024, 128
# Separators of the recursive splitter, tried in this order.
SEPARATORS = ("\n\n\n", "\n\n", "\n", "다.", "요.", "니다.", ". ", ".", " ", "")
SENTENCE_END = r"(?<=[.!?다요])(?U)\s+"


def _item(piece: Column, alone: bool) -> Column:
    """A piece with its length, its number of Hangul syllables, and whether it begins a chunk whatever fits."""
    return F.struct(piece.alias("text"), F.length(piece).alias("n"), text.hangul_count(piece).alias("hangul"), F.lit(alone).alias("alone"))


def _pack(items: Column, joint: str, size: int) -> Column:
    """Greedy packing of _items: one joins the open chunk while their estimate fits. Only lengths and places are carried
    along; each chunk's text is joined once."""
    start = F.struct(F.array().cast("array<int>").alias("starts"), F.lit(0).alias("k"), F.lit(0).alias("n"), F.lit(0).alias("hangul"))

    def add(acc: Column, item: Column) -> Column:
        n, hangul = acc["n"] + len(joint) + item["n"], acc["hangul"] + item["hangul"]
        fits = (acc["k"] > 0) & ~item["alone"] & (text.estimate_of(n, hangul) <= size)
        return F.struct(
            F.when(fits, acc["starts"]).otherwise(F.concat(acc["starts"], F.array(acc["k"] + 1))).alias("starts"), (acc["k"] + 1).alias("k"),
            F.when(fits, n).otherwise(item["n"]).alias("n"), F.when(fits, hangul).otherwise(item["hangul"]).alias("hangul"),
        )

    def chunks(v: Column) -> Column:
        upto = lambda k: F.coalesce(F.get(v["starts"], k + 1), F.size(v["items"]) + 1)
        return F.transform(v["starts"], lambda at, k: F.array_join(F.slice(v["items"]["text"], at, upto(k) - at), joint))

    return let(items, lambda xs: let(F.struct(xs.alias("items"), F.aggregate(xs, start, add)["starts"].alias("starts")), chunks))


def _filled(parts: Column) -> Column:
    return F.filter(F.transform(parts, text.strip), lambda p: p != "")


def split_sentences(x: Column, size: int = CHUNK_SIZE) -> Column:
    """Sentences packed up to `size` estimated tokens; a longer sentence is a chunk of its own."""
    return _pack(F.transform(_filled(F.split(x, SENTENCE_END)), lambda p: _item(p, False)), " ", size)


def split_paragraphs(x: Column, size: int = CHUNK_SIZE) -> Column:
    """Paragraphs packed up to `size` estimated tokens; a longer one is split into sentences, the last of which stays
    open for what follows. Built-in functions only."""
    whole = lambda p: F.array(_item(p, False))
    parted = lambda p: F.transform(split_sentences(p, size), lambda part: _item(part, True))
    items = F.transform(_filled(F.split(x, "\n\n")), lambda p: F.when(text.token_estimate(p) > size, parted(p)).otherwise(whole(p)))
    return _pack(F.flatten(items), "\n\n", size)


class Measured:
    """A text in which any stretch's estimate takes two look-ups, by sums of its Hangul syllables from the beginning."""

    def __init__(self, x: str):
        codes = np.frombuffer(x.encode("utf-32-le", "surrogatepass"), np.uint32)
        self.text, self.before = x, [0, *np.cumsum((codes >= ord("가")) & (codes <= ord("힣"))).tolist()]

    def estimate(self, start: int, end: int) -> int:
        hangul = self.before[end] - self.before[start]
        return int(hangul * 1.5 + (end - start - hangul) * 0.25)

    def cut(self, start: int, end: int, mark: str) -> list[tuple[int, int]]:
        """Stretches that begin at each mark; single characters for the empty mark."""
        if not mark:
            return [(k, k + 1) for k in range(start, end)]
        starts, at = [start], self.text.find(mark, start, end)
        while at >= 0:
            starts.append(at)
            at = self.text.find(mark, at + len(mark), end)
        return [(s, e) for s, e in zip(starts, [*starts[1:], end], strict=True) if e > s]

    def split(self, start: int, end: int, size: int, overlap: int, separators: tuple[str, ...]) -> list[tuple[int, int]]:
        at = next((k for k, s in enumerate(separators) if s == "" or self.text.find(s, start, end) >= 0), len(separators) - 1)
        rest = separators[at + 1 :]
        out: list[tuple[int, int]] = []
        fitting: list[tuple[int, int]] = []
        for part in self.cut(start, end, separators[at]):
            if self.estimate(*part) < size:
                fitting.append(part)
                continue
            out += self.merge(fitting, size, overlap)
            fitting = []
            out += self.split(*part, size, overlap, rest) if rest else [part]
        return out + self.merge(fitting, size, overlap)

    def merge(self, parts: list[tuple[int, int]], size: int, overlap: int) -> list[tuple[int, int]]:
        """Neighbouring parts packed up to `size`, each pack with parts of up to `overlap` of the one before."""
        out: list[tuple[int, int]] = []
        sizes = [self.estimate(*p) for p in parts]
        first, total = 0, 0
        for k, n in enumerate(sizes):
            if total + n > size and k > first:
                out.append((parts[first][0], parts[k - 1][1]))
                while first < k and (total > overlap or (total + n > size and total > 0)):
                    total -= sizes[first]
                    first += 1
            total += n
        return [*out, (parts[first][0], parts[-1][1])] if parts else out


def estimate(x: str) -> int:
    return Measured(x).estimate(0, len(x))


def recursive_split(x: str, size: int, overlap: int, separators: tuple[str, ...] = SEPARATORS) -> list[str]:
    """Split at the first separator that occurs, pack the parts with an overlap, and split what is too long by the
    separators that follow. Lengths are sums of the parts' own estimates, each truncated."""
    found = (x[s:e].strip() for s, e in Measured(x).split(0, len(x), size, overlap, separators))
    return [c for c in found if c]


def recursive_splitter(size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP):
    """recursive_split as an Arrow-batched function on a column."""

    @F.pandas_udf("array<string>")
    def split(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([recursive_split(x, size, overlap) if x else [] for x in texts])

    return split


def chunk_sections(sections: DataFrame, split: Callable[[Column], Column] = split_paragraphs) -> DataFrame:
    """Sections (doc_id, section_type, content, order) -> doc_id, chunk_num, chunk_id, chunk_type, text, section_order,
    token_count: a table is one chunk, other sections are split; numbers run through a document's sections."""
    pieces = F.when(F.col("section_type") == "table", F.array("content")).otherwise(_filled(split(F.col("content"))))
    cut = sections.select("doc_id", F.col("order").alias("section_order"), F.when(F.col("section_type") == "table", "table").otherwise("text").alias("chunk_type"), F.posexplode(pieces).alias("piece", "text"))
    number = F.row_number().over(Window.partitionBy("doc_id").orderBy("section_order", "piece")) - 1
    numbered = cut.withColumn("chunk_num", number.cast("int")).drop("piece")
    return numbered.withColumn("chunk_id", text.chunk_id(F.col("doc_id").cast("string"), F.col("chunk_num"))).withColumn("token_count", text.token_estimate(F.col("text")))


def with_context(chunks: DataFrame, include_title: bool = True, include_doc_info: bool = False) -> DataFrame:
    """Text chunks with their document's id and title before them."""
    head = []
    if include_doc_info:
        head.append(F.concat(F.lit("[문서ID: "), F.col("doc_id"), F.lit("]")))
    if include_title:
        head.append(F.when(F.col("title") != "", F.concat(F.lit("[제목: "), F.col("title"), F.lit("]"))))
    prefix = F.concat_ws(" ", *head) if head else F.lit("")
    return chunks.withColumn("text", F.when((F.col("chunk_type") == "text") & (prefix != ""), F.concat(prefix, F.lit("\n\n"), F.col("text"))).otherwise(F.col("text")))
