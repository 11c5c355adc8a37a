"""Attachments that lie beside documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hanji.functions import text


def attachments_of(files: DataFrame) -> DataFrame:
    """files (path) -> doc_id, file_name, file_path, file_order, is_main_pdf.

    Beside each .odt file, its folder's .pdf files, and its .hwp and .hwpx files unless a .pdf or .odt file has their
    stem. The .pdf with the document's own stem is its main file, number 0; the others are numbered from 1, those with a
    leading number first and by it, then by stem.
    """
    path = F.col("path")
    listed = files.select(path, text.parent(path).alias("folder"), text.stem(path).alias("stem"), text.suffix(path).alias("kind"))
    covered = listed.filter(F.col("kind").isin(".pdf", ".odt")).select("folder", "stem").distinct()
    plain = listed.filter(F.col("kind").isin(".hwp", ".hwpx")).join(covered, ["folder", "stem"], "left_anti")
    beside = listed.filter(F.col("kind") == ".pdf").unionByName(plain)
    documents = listed.filter(F.col("kind") == ".odt").select("folder", F.col("stem").alias("own"), text.document_id(path).alias("doc_id"), path.alias("document"))
    pairs = documents.join(beside, "folder")
    main = (F.col("kind") == ".pdf") & (F.col("stem") == F.col("own"))
    numbered = pairs.withColumn("is_main_pdf", main).withColumn("number", text.file_order(F.col("stem")))
    order = Window.partitionBy("document", "is_main_pdf").orderBy(F.col("number").asc_nulls_last(), "stem", "path")
    place = F.when(F.col("is_main_pdf"), 0).otherwise(F.row_number().over(order))
    return numbered.select("doc_id", text.basename(path).alias("file_name"), path.alias("file_path"), place.cast("int").alias("file_order"), "is_main_pdf")
