"""Exact top-k inner products on a bit-sliced index."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

#: Components become floor(LEVELS * x); rows of a block of the index; queries that meet a block in one task.
LEVELS, K, BLOCK_ROWS, QUERY_ROWS = 1024, 10, 1 << 15, 1 << 14


def slices_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """values (rows, dims) -> (lowest of each dim, bitmaps, and for each bitmap its dim and weight as bit number).

    A bitmap holds one bit of one dim's values above its lowest, for all rows, 64 in a word.
    """
    low = values.min(axis=0)
    above = (values - low).astype(np.uint64)
    maps, where = [], []
    for d in range(values.shape[1]):
        for b in range(int(above[:, d].max()).bit_length()):
            bits = np.packbits((above[:, d] >> np.uint64(b) & np.uint64(1)).astype(bool), bitorder="little")
            maps.append(np.pad(bits, (0, -len(bits) % 8)).view(np.uint64))
            where.append((d, b))
    words = -(-len(values) // 64)
    return low, np.array(maps, dtype=np.uint64).reshape(len(maps), words), np.array(where, dtype=np.int64).reshape(len(where), 2)


def digits(x: int) -> list[tuple[int, int]]:
    """(sign, bit) of the signed binary digits of x, no two next to each other: about a third of its bits."""
    sign, x, out, bit = (1 if x >= 0 else -1), abs(x), [], 0
    while x:
        if x & 1:
            d = 2 - (x & 3)
            out.append((sign * d, bit))
            x -= d
        x >>= 1
        bit += 1
    return out


def score_slices(query: np.ndarray, maps: np.ndarray, where: np.ndarray) -> list[np.ndarray]:
    """Slices, least significant first, of all rows' scores plus a constant that is the same for all rows (what the
    dims' lowest values take off, and the complements below add), so their order is that of the scores.

    Each digit of a query's component adds the dim's bitmaps, shifted; a negative digit adds their complements.
    Bitmaps of one weight are added three by three: a sum there, a carry above.
    """
    plan: dict[int, tuple[list[int], list[int]]] = {}
    of_dim: dict[int, list[int]] = {}
    for k, (d, _) in enumerate(where):
        of_dim.setdefault(int(d), []).append(k)
    for d, rows in of_dim.items():
        for sign, bit in digits(int(query[d])):
            for k in rows:
                level = bit + int(where[k, 1])
                plan.setdefault(level, ([], []))[sign < 0].append(k)
    out, carried, level = [], np.empty((0, maps.shape[1]), np.uint64), 0
    top = max(plan, default=-1)
    while level <= top or len(carried):
        plus, minus = plan.get(level, ([], []))
        here = np.concatenate([maps[plus], ~maps[minus], carried])
        carries = []
        while len(here) > 1:
            third = len(here) // 3
            if third:
                a, b, c = here[:third], here[third : 2 * third], here[2 * third : 3 * third]
                half = a ^ b
                carries.append((a & b) | (half & c))
                here = np.concatenate([half ^ c, here[3 * third :]])
            else:
                a, b = here[:1], here[1:]
                carries.append(a & b)
                here = a ^ b
        out.append(here[0] if len(here) else np.zeros(maps.shape[1], np.uint64))
        carried = np.concatenate(carries) if carries else np.empty((0, maps.shape[1]), np.uint64)
        level += 1
    return out


def count(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def top_rows(slices: list[np.ndarray], candidates: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(certain, boundary) bitmaps: rows surely among the k largest, and rows equal to the k-th, by descending through
    the slices from the most significant one."""
    certain, equal = np.zeros_like(candidates), candidates
    for s in reversed(slices):
        more = certain | (equal & s)
        n = count(more)
        if n > k:
            equal = equal & s
        else:
            certain, equal = more, equal & ~s
            if n == k:
                return certain, np.zeros_like(candidates)
    return certain, equal


def positions(bitmap: np.ndarray, rows: int) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little")[:rows])


def _index(pdf: pd.DataFrame) -> pd.DataFrame:
    """One block of rows -> one row that holds its index."""
    pdf = pdf.sort_values("vec_id", ignore_index=True)
    values = np.array(pdf["values"].tolist(), dtype=np.int64).reshape(len(pdf), -1)
    low, maps, where = slices_of(values)
    kind = np.promote_types(np.min_scalar_type(int(values.min())), np.min_scalar_type(int(values.max()))) if values.min() < 0 else np.min_scalar_type(int(values.max()))
    kind = kind if np.can_cast(kind, np.int64) else np.dtype(np.int64)
    made = {"dim": pdf["dim"].iloc[0], "block": pdf["block"].iloc[0], "ids": pdf["vec_id"].to_numpy().tobytes(), "maps": maps.tobytes(), "places": where.tobytes(), "kind": kind.str, "numbers": values.astype(kind).tobytes()}
    return pd.DataFrame([made])


def search_block(ids: np.ndarray, values: np.ndarray, maps: np.ndarray, where: np.ndarray, query_id: int, query: np.ndarray, k: int) -> list[tuple[int, int]]:
    """(vec_id, score) of the k best rows of a block, the query's own left out, ties to smaller vec_id."""
    n = len(ids)
    candidates = np.packbits(ids != query_id, bitorder="little")
    candidates = np.pad(candidates, (0, -len(candidates) % 8)).view(np.uint64)
    scores = score_slices(query, maps, where)
    certain, boundary = top_rows(scores, candidates, k)
    sure, edge = positions(certain, n), positions(boundary, n)
    # Rows stand in order of vec_id, so the first of the equal rows are those that win the tie.
    chosen = np.concatenate([sure, edge[: k - len(sure)]])
    exact = values[chosen] @ query
    return list(zip(ids[chosen].tolist(), exact.tolist(), strict=True))


def _search(k: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """One block's index (a frame of one row) and the queries that meet it."""

    def run(index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int]] = []
        if len(index) and len(queries):
            row = index.iloc[0]
            ids = np.frombuffer(row["ids"], np.int64)
            where = np.frombuffer(row["places"], np.int64).reshape(-1, 2)
            maps = np.frombuffer(row["maps"], np.uint64).reshape(len(where), -(-len(ids) // 64))
            values = np.frombuffer(row["numbers"], row["kind"]).astype(np.int64).reshape(len(ids), -1)
            for query_id, query in zip(queries["vec_id"].tolist(), queries["values"], strict=True):
                out += [(query_id, *hit) for hit in search_block(ids, values, maps, where, query_id, np.array(query, np.int64), k)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"], dtype=np.int64)

    return run


def top_k(table: DataFrame, every: int = 100, k: int = K, levels: int = LEVELS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Embeddings (vec_id, embedding, ...) -> query_id, rank, vec_id, score: exact largest integer inner products.

    Queries are the rows whose vec_id is divisible by `every`, candidates all rows with another vec_id. Rows are dealt by
    hash into blocks of about `block_rows`, each indexed once as bitmaps; the stated set of queries travels to every
    block, in chunks of QUERY_ROWS, and a block sends back k rows for each query, which are ranked together. Work is
    queries x rows, in tasks of one block and one chunk; the index is a fixed number of bits for each row. Nothing is approximated.

    Vectors that are null, empty or hold null or non-finite components take no part, nor do rows without a vec_id; zero
    vectors do. Vectors of another dimension than the query's are no candidates. Rows equal in vec_id and vector count
    once; of different vectors under one vec_id all are candidates, and the smallest is the query. Scores must fit 64
    bits. Other columns are ignored; no rows give no rows.
    """
    e = F.col("embedding").cast("array<double>")
    fine = F.coalesce((F.size(e) > 0) & ~F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(False))
    rows = table.filter(F.col("vec_id").isNotNull() & fine).select("vec_id", F.transform(e, lambda x: F.floor(x * levels).cast("long")).alias("values"))
    rows = staged(rows.distinct().withColumn("dim", F.size("values")), "integers")
    n = rows.count()
    blocks = max(1, -(-n // block_rows))
    index = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks))).groupBy("dim", "block").applyInPandas(_index, "dim int, block long, ids binary, maps binary, places binary, kind string, numbers binary")
    index = staged(index, "index")

    queries = rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("values").alias("values")).withColumn("dim", F.size("values"))
    chunks = max(1, -(-queries.count() // QUERY_ROWS))  # counted: ids need not be evenly spread
    upto = lambda count: F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long"))
    to_blocks = queries.withColumn("chunk", F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(chunks))).withColumn("block", F.explode(upto(blocks)))
    to_chunks = index.withColumn("chunk", F.explode(upto(chunks)))
    key = ["dim", "block", "chunk"]
    hits = to_chunks.groupBy(*key).cogroup(to_blocks.groupBy(*key)).applyInPandas(_search(k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def oracle(every: int = 100, k: int = K, levels: int = LEVELS) -> str:
    return f"""
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor({levels} * x::DOUBLE)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % {every} = 0 AND c.vec_id <> q.vec_id AND len(c.x) = len(q.x)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= {k}"""
