"""Counts of a store and of runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hanji.functions import vectors

PERMIT_FIELDS = ("org_name", "permittee_name", "location", "area", "purpose", "collection_volume", "permit_start_date", "permit_end_date", "amount")


def store_stats(documents: DataFrame, chunks: DataFrame) -> DataFrame:
    """One row: document_count, chunk_count, chunk_types (map of counts)."""
    by_type = chunks.groupBy("chunk_type").agg(F.count("chunk_id").alias("n"))
    types = by_type.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("chunk_count"), F.map_from_entries(F.collect_list(F.struct("chunk_type", "n"))).alias("chunk_types"))
    return documents.agg(F.count("*").alias("document_count")).join(types)


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    """(column, value, n) for each column's values and nulls left out, and the total (column and value null), in one
    pass by grouping sets."""
    sets = df.groupingSets([*[[F.col(c)] for c in columns], []], *columns).agg(F.count("*").alias("n"), F.grouping_id().alias("gid"))
    name = value = F.lit(None).cast("string")
    every = (1 << len(columns)) - 1
    for k, c in enumerate(columns):
        here = F.col("gid") == every - (1 << (len(columns) - 1 - k))
        name, value = F.when(here, F.lit(c)).otherwise(name), F.when(here, F.col(c).cast("string")).otherwise(value)
    counted = sets.select(name.alias("column"), value.alias("value"), "n")
    return counted.filter(F.col("column").isNull() | F.col("value").isNotNull())


def run_counters(results: DataFrame, *by: str) -> DataFrame:
    """results (status, chunks, excluded) -> processed, skipped, failed, total_chunks, excluded, for all or by `by`."""
    agg = [F.count_if(F.col("status") == s).alias(s) for s in ("processed", "skipped", "failed")]
    agg += [F.coalesce(F.sum("chunks"), F.lit(0)).alias("total_chunks"), F.coalesce(F.sum("excluded"), F.lit(0)).alias("excluded")]
    return results.groupBy(*by).agg(*agg)


def status_counts(results: DataFrame) -> DataFrame:
    return results.groupBy("status").agg(F.count("*").alias("n"))


def confidence(*fields: str):
    """Share of the fields that are filled, to three decimals."""
    filled = sum((F.col(f).isNotNull().cast("int") for f in fields), F.lit(0))
    return F.round(filled / float(len(fields)), 3)


def embedding_degeneration(embeddings: DataFrame, id_column: str = "vec_id", limit: float = 1e-6) -> DataFrame:
    """One row: vectors, same_as_first (those within `limit` of the first one in L1, itself included), all_identical.

    The first vector is one row, found by a top-1 and broadcast.
    """
    first = embeddings.orderBy(id_column).limit(1).select(F.col("embedding").alias("first"))
    near = embeddings.join(F.broadcast(first)).select((vectors.l1_distance(F.col("embedding"), F.col("first")) < limit).alias("same"))
    counted = near.agg(F.count("*").alias("vectors"), F.count_if("same").alias("same_as_first"))
    return counted.withColumn("all_identical", (F.col("vectors") > 1) & (F.col("vectors") == F.col("same_as_first")))
