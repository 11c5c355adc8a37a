"""Packing documents into training sequences by the sum-of-squares rule."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import staged

#: Tokens of a sequence, the id that ends a document, the pieces that one task packs, on average, and the length up to
#: which pieces are kept back to fill gaps.
CAPACITY, END, BLOCK_ROWS, FILLER = 2048, 0, 16384, 300


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: all as long as a sequence but the first, which takes the rest."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def _pieces(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    encoder = tokens.encoder(path, "byte")
    for batch in batches:
        for part in tokens.portions(batch, chars=tokens.ENCODE_CHARS):
            rows, piece, start, length, crc = [], [], [], [], []
            for row, ids in enumerate(encoder.encode(tokens.texts_of(part))):
                ids = np.append(ids, ids.dtype.type(END)).astype("<u4")
                for k, (s, n) in enumerate(cut(len(ids))):
                    rows.append(row)
                    piece.append(k)
                    start.append(s)
                    length.append(n)
                    crc.append(zlib.crc32(ids[s : s + n]))
            columns = [part.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])
    tokens.give_back()


def sum_of_squares(lengths: list[int], capacity: int = CAPACITY) -> tuple[list[int], list[int]]:
    """(sequence, offset) of each item in turn: it goes where the sum over gaps g of n(g) squared becomes smallest,
    n(g) being the number of open sequences with g tokens left; a full sequence counts no more. Ties take the smaller
    gap, and an open sequence before a new one."""
    twice = np.zeros(capacity + 1, np.int64)  # 2 n(g)
    open_or_never = np.full(capacity + 1, -(1 << 40), np.int64)  # the same, or never chosen where no sequence is open
    by_gap: dict[int, list[int]] = defaultdict(list)
    sequence, offset, made = [], [], 0
    for size in lengths:
        # What the sum changes by, less 2: n(g - size) rises by one, n(g) falls by one; a full sequence isn't counted.
        change = twice[: capacity - size] - open_or_never[size:capacity]
        gap = -1
        if len(change):
            change[0] -= 1
            best = int(change.argmin())
            if change[best] + 2 <= twice[capacity - size] + 1:
                gap = size + best
        if gap < 0:
            gap, at, made = capacity, made, made + 1
        else:
            at = by_gap[gap].pop()
            twice[gap] -= 2
            open_or_never[gap] = twice[gap] or -(1 << 40)
        sequence.append(at)
        offset.append(capacity - gap)
        if gap > size:
            by_gap[gap - size].append(at)
            twice[gap - size] += 2
            open_or_never[gap - size] = twice[gap - size]
    return sequence, offset


def _pack(pdf: pd.DataFrame) -> pd.DataFrame:
    """A block in random order, short pieces last: the rule keeps many different gaps open, which those then fill."""
    pdf = pdf.assign(short=pdf["length"] <= FILLER).sort_values(["short", "draw", "row"], kind="stable", ignore_index=True)
    sequence, offset = sum_of_squares(pdf["length"].tolist())
    return pd.DataFrame({"row": pdf["row"], "sequence_id": pdf["block"] * (1 << 32) + np.array(sequence, np.int64), "offset": np.array(offset, np.int64)})


def pack_documents(docs: DataFrame, tokenizer_path: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Documents (doc_id, text, ...) -> doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Texts become ids where they are; from there on only a few numbers for each piece move. Pieces fall by hash into
    blocks, so that equal lengths and copies spread, and each block is packed on its own; it leaves a handful of
    sequences partly empty. Null and empty texts are one end id; repeated rows and repeated
    doc_ids are documents of their own; other columns are ignored; no rows give no rows.
    """
    encode = lambda batches: _pieces(tokenizer_path, batches)
    pieces = docs.select("doc_id", "text").mapInArrow(encode, "doc_id long, piece int, start long, length long, ids_crc32 long")
    pieces = staged(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    blocks = max(1, -(-pieces.count() // block_rows))
    sized = pieces.select("row", "length", F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("block"), F.xxhash64(F.lit(1), "row").alias("draw"))
    placed = sized.groupBy("block").applyInPandas(_pack, "row long, sequence_id long, offset long")
    return pieces.join(placed, "row").drop("row")
