"""Inverted lists over chunk vectors: centroids by k-means, chunks stored by their nearest centroid, and searches that read
only the lists nearest to the query."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from hanji.config import in_range
from hanji.functions import vectors

from . import search

#: Lists of an index and lists that a search reads; rows that k-means sees for each list, and its rounds; the list of chunks
#: whose vector is null, zero or of another length.
LISTS, PROBES, ROWS_PER_LIST, ROUNDS, NOWHERE = 100, 200, 256, 20, -1


def fit_centroids(chunks: DataFrame, lists: int = LISTS, rows_per_list: int = ROWS_PER_LIST, seed: int = 1) -> DataFrame:
    """(list int, centroid array<double>) by k-means on the angle between vectors, fitted on the executors.

    At most about lists * rows_per_list chunks are fitted, chosen by their ids' hashes; the lists themselves hold all. Fewer
    distinct vectors than lists give fewer lists; none give none.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    usable = chunks.filter(F.col("embedding").isNotNull() & (vectors.l2_norm(F.col("embedding")) > 0))
    share = min(1.0, lists * rows_per_list / max(1, chunks.count()))
    sample = usable.filter(F.pmod(F.xxhash64("chunk_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    points = sample.select(array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    if points.isEmpty():
        return chunks.sparkSession.createDataFrame([], "list int, centroid array<double>")
    model = KMeans(k=max(2, lists), distanceMeasure="cosine", maxIter=ROUNDS, seed=seed).fit(points)
    centers = sorted(c.tolist() for c in model.clusterCenters())
    return chunks.sparkSession.createDataFrame(list(enumerate(centers)), "list int, centroid array<double>")


def _nearest(centroids: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column("embedding")
        fits = np.diff(column.offsets.to_numpy()) == centroids.shape[1]
        fits &= ~column.is_null().to_numpy(zero_copy_only=False)
        matrix = np.zeros((len(batch), centroids.shape[1]))
        if fits.any():
            matrix[fits] = column.filter(pa.array(fits)).flatten().to_numpy(zero_copy_only=False).reshape(-1, centroids.shape[1])
        matrix = np.nan_to_num(matrix)
        best = (matrix @ centroids.T).argmax(axis=1) if len(centroids) else np.zeros(len(batch), int)
        best = np.where(np.abs(matrix).sum(axis=1) > 0, best, NOWHERE)
        yield batch.append_column("list", pa.array(best.astype(np.int32)))


def assign(chunks: DataFrame, centroids: DataFrame) -> DataFrame:
    """chunks with `list`, the centroid of the smallest angle (the smaller number of equal ones); NOWHERE without any. The
    centroids are the index's own few, and the only thing that tasks are sent."""
    rows = centroids.orderBy("list").collect()
    matrix = np.array([r["centroid"] for r in rows]) if rows else np.zeros((0, 1))
    matrix = matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-12)
    return chunks.mapInArrow(partial(_nearest, matrix), StructType([*chunks.schema, StructField("list", IntegerType())]))


class VectorIndex:
    """Chunks (chunk_id, doc_id, embedding, ...) as Parquet partitions, one for each list, and the centroids beside them.

    Searches score what they read exactly; what they leave out is lists far from the query. With as many probes as there
    are lists they equal a scan. A list is many files where it is large, so a hot one is no single task's work. One
    writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.chunks_path, self.centroids_path = spark, f"{root.rstrip('/')}/lists", f"{root.rstrip('/')}/centroids"

    def exists(self) -> bool:
        try:
            return bool(self.spark.read.parquet(self.centroids_path).columns)
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return False

    def centroids(self) -> DataFrame:
        return self.spark.read.parquet(self.centroids_path)

    def chunks(self) -> DataFrame:
        return self.spark.read.parquet(self.chunks_path)

    def _write(self, rows: DataFrame, mode: str, lists: list[int]) -> None:
        """Rows by list; a row without values marks each of `lists`, which may have no others left."""
        marks = self.spark.createDataFrame([(k,) for k in lists], "list int").select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema if f.name != "list"], "list")
        # Rows of a list come together, and adaptive execution cuts large lists into several tasks.
        writer = rows.unionByName(marks).hint("rebalance", "list").write.mode("overwrite").partitionBy("list")
        writer.option("partitionOverwriteMode", mode).parquet(self.chunks_path)

    def build(self, chunks: DataFrame, lists: int = LISTS, rows_per_list: int = ROWS_PER_LIST) -> None:
        """A new index of all chunks, centroids last: an index that broke off isn't there."""
        centroids = fit_centroids(chunks, in_range("lists", lists, 1), rows_per_list)
        self._write(assign(chunks, centroids), "static", [NOWHERE])
        centroids.coalesce(1).write.mode("overwrite").parquet(self.centroids_path)

    def replace(self, chunks: DataFrame, doc_ids: DataFrame) -> None:
        """The documents' chunks go and the new ones come, in the lists that had or get some; other lists stay as they are.
        The centroids stay: build anew when the vectors have become others."""
        ids = doc_ids.select("doc_id").distinct()
        new = assign(chunks, self.centroids())
        held = self.chunks().join(ids, "doc_id", "left_semi").select("list").distinct()
        touched = sorted(r["list"] for r in held.union(new.select("list").distinct()).distinct().collect())
        if not touched:
            return
        old = self.chunks().filter(F.col("list").isin(touched))
        stay = old.join(ids, "doc_id", "left_anti").select(new.columns)
        self._write(stay.unionByName(new), "dynamic", touched)

    def nearest(self, query: list[float], probes: int) -> list[int]:
        """The lists whose centroids have the smallest angle to the query."""
        near = vectors.cosine(F.col("centroid"), search.literal_vector(query))
        return [r["list"] for r in self.centroids().select("list", near.alias("near")).orderBy(F.desc_nulls_last("near"), "list").limit(probes).collect()]

    def probed(self, query: list[float], probes: int = PROBES) -> DataFrame:
        """The chunks of the `probes` nearest lists, by partition; all chunks if there are no more lists."""
        known = self.chunks().filter(F.col("chunk_id").isNotNull())
        if in_range("probes", probes, 1) >= self.centroids().count():
            return known.drop("list")
        return known.filter(F.col("list").isin(self.nearest(query, probes))).drop("list")

    def similarity_search(self, query: list[float], top_k: int = 10, probes: int = PROBES, **options: object) -> DataFrame:
        """As search.similarity_search, within the probed lists."""
        return search.similarity_search(self.probed(query, probes), search.literal_vector(query), top_k, **options)

    def hybrid_search(self, query: list[float], keyword: str | None, top_k: int = 10, probes: int = PROBES, **options: object) -> DataFrame:
        """As search.hybrid_search, within the probed lists: a keyword alone doesn't bring in a list."""
        return search.hybrid_search(self.probed(query, probes), search.literal_vector(query), keyword, top_k, **options)


def recall(index: VectorIndex, queries: list[list[float]], top_k: int, probes: int) -> float:
    """The share of the exact top_k of some queries that searches with so many probes find."""
    shares = []
    for query in queries:
        exact, found = ({r["chunk_id"] for r in index.similarity_search(query, top_k, p).select("chunk_id").collect()} for p in (index.centroids().count() or 1, probes))
        shares.append(len(exact & found) / max(1, len(exact)))
    return sum(shares) / max(1, len(shares))
