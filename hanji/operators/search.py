"""Vector and hybrid search over a chunk table: exact scores, top-k by TakeOrderedAndProject, metadata joined last."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hanji.functions import text, vectors

MAX_TOP_K, MAX_KEYWORD, DEFAULT_WEIGHT = 1000, 100, 0.7


def clamp_top_k(top_k: int) -> int:
    if not isinstance(top_k, int) or isinstance(top_k, bool) or top_k < 1:
        raise ValueError("top_k must be a positive integer")
    return min(top_k, MAX_TOP_K)


def literal_vector(v: list[float]) -> Column:
    return F.array(*[F.lit(float(x)) for x in v])


def score_order(score: str, id_column: str) -> list[Column]:
    return [F.desc_nulls_last(score), F.asc(id_column)]


def similarity_search(
    chunks: DataFrame, query: Column, top_k: int = 10, threshold: float = 0.0, filters: dict[str, str] | None = None,
    documents: DataFrame | None = None, id_column: str = "chunk_id", decimals: int | None = None,
) -> DataFrame:
    """The top_k chunks by cosine to `query` (a Column: a literal vector, or one joined from a row).

    filters: equalities on doc_id or chunk_type, or on biz_cate, which is looked up in `documents`; they reach the scan.
    threshold: kept only if above 0. Null vectors are left out. Ties: the smaller id. The vector isn't carried on.
    """
    for name, value in (filters or {}).items():
        if name == "biz_cate":
            assert documents is not None, "a biz_cate filter needs the documents"
            chunks = chunks.join(documents.filter(F.col("biz_cate") == value).select("doc_id"), "doc_id", "left_semi")
        elif name in ("doc_id", "chunk_type"):
            chunks = chunks.filter(F.col(name) == value)
        else:
            raise ValueError(f"no such filter: {name}")
    score = vectors.cosine(F.col("embedding"), query)
    scored = chunks.filter(F.col("embedding").isNotNull()).withColumn("similarity", score if decimals is None else F.round(score, decimals)).drop("embedding")
    if threshold > 0:
        scored = scored.filter(F.col("similarity") >= threshold)
    return scored.orderBy(*score_order("similarity", id_column)).limit(clamp_top_k(top_k))


def hybrid_search(
    chunks: DataFrame, query: Column, keyword: str | None, top_k: int = 10, vector_weight: float = DEFAULT_WEIGHT,
    id_column: str = "chunk_id", decimals: int | None = None, occurs: Column | None = None,
) -> DataFrame:
    """The top_k chunks by vector_weight * cosine + (1 - vector_weight) if the keyword occurs, whatever its case.

    The keyword is stripped and cut to MAX_KEYWORD characters; without one this is similarity_search. occurs: whether it
    does, where texts lie elsewhere and have been searched there; else `text` is.
    """
    if not 0 <= vector_weight <= 1:
        raise ValueError("vector_weight must be between 0 and 1")
    keyword = (keyword or "").strip()[:MAX_KEYWORD]
    if not keyword:
        return similarity_search(chunks, query, top_k, id_column=id_column, decimals=decimals)
    hit = F.coalesce(text.contains_ignoring_case(F.col("text"), keyword) if occurs is None else occurs, F.lit(False)).cast("int")
    score = F.lit(vector_weight) * vectors.cosine(F.col("embedding"), query) + F.lit(1 - vector_weight) * hit
    scored = chunks.filter(F.col("embedding").isNotNull()).withColumn("similarity", score if decimals is None else F.round(score, decimals)).drop("embedding")
    return scored.orderBy(*score_order("similarity", id_column)).limit(clamp_top_k(top_k))


def with_metadata(hits: DataFrame, documents: DataFrame, columns: list[str], key: str = "doc_id") -> DataFrame:
    """Metadata for the few hits, joined after the limit; null where a document is unknown.

    The hits are a top-k of at most MAX_TOP_K rows; more raise. They are needed twice, and finding them may read every vector,
    so they are found once, here, and held as a local table: its keys are broadcast to find their documents in one pass
    without a shuffle, and those few rows are broadcast in turn to the hits.
    """
    held = hits.limit(MAX_TOP_K + 1).collect()
    if len(held) > MAX_TOP_K:
        raise ValueError(f"more than {MAX_TOP_K} hits")
    few = hits.sparkSession.createDataFrame(held, hits.schema)
    found = documents.select(key, *columns).join(F.broadcast(few.select(key).distinct()), key)
    return few.join(F.broadcast(found), key, "left")


def search(chunks: DataFrame, documents: DataFrame, query: Column, top_k: int = 10, keyword: str | None = None, vector_weight: float = DEFAULT_WEIGHT, filters: dict[str, str] | None = None) -> DataFrame:
    """Search as users see it: hybrid with a keyword, else by vector, with each hit's document. chunks: all of them, or what
    an index's probes leave (VectorIndex.probed)."""
    if keyword and keyword.strip():
        hits, mode = hybrid_search(chunks, query, keyword, top_k, vector_weight), "hybrid"
    else:
        hits, mode = similarity_search(chunks, query, top_k, filters=filters, documents=documents), "vector"
    found = with_metadata(hits.select("chunk_id", "doc_id", "text", "chunk_type", "similarity"), documents, ["title", "doc_no", "author_name", "dept_name", "report_date", "biz_full_path"])
    return found.filter(F.col("doc_id").isNotNull()).withColumn("report_date", F.col("report_date").cast("string")).withColumn("search_mode", F.lit(mode)).orderBy(*score_order("similarity", "chunk_id"))


def preview(hits: DataFrame, characters: int = 200) -> DataFrame:
    return hits.withColumn("preview", F.substring("text", 1, characters)).drop("text")
