"""From raw documents to packed training sequences: four stages, each handed what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hanji.llm import langid, mixing, packing, simhash
from hanji.llm.common import join_hot, marked, staged
from hanji.llm.queries import tokenizer


#: The share of a text's n-grams that must lie in parts whose language is beyond doubt, and n-grams that every text is given
#: beside its own as such: a text has to show little where it is short, and the full share where it is long.
DECIDED, PRESUMED = 0.2, 150


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in learned languages stay; where lang is null it becomes the prediction. Documents go whose language
    can't be told (no letter, or nothing learned), and those of which most parts stay in doubt between codewords: other
    languages and no language. One rule for all lengths, by the evidence: a text of which nothing is decided goes if it
    has more than PRESUMED * (1 - DECIDED) / DECIDED n-grams (600)."""
    found = langid.identify_languages(docs, carry=True)
    shown = (F.col("decided") * F.col("evidence") + PRESUMED) / (F.col("evidence") + PRESUMED)
    known = found.filter((F.col("lang_pred") != "und") & (shown >= DECIDED))
    lang = F.coalesce("row.lang", "lang_pred").alias("lang")
    return known.select(*[lang if c == "lang" else F.col(f"row.`{c}`") for c in docs.columns])


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts linked by similarity (five words, 0.8) one row stays: that with the smallest doc_id, null
    last, and of several such rows the first. Null and empty texts are one group. No rows give none.

    SimHash fingerprints of 128 bits and their distance table discard pairs here too, but at so wide a radius blocks of bits
    can't name buckets: those come from the smallest shingle hashes (simhash.similar_components)."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")
    rows = staged(docs.select(F.monotonically_increasing_id().alias("number"), "doc_id", whole), "numbered")
    found = staged(simhash.similar_components(rows.select("number", "doc_id", F.col("whole.text").alias("text"))), "components")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "number")
    stays = found.groupBy("component").agg(F.count("*").alias("rows"), F.min(order)["number"].alias("stays")).filter("rows > 1")
    gone = join_hot(found, staged(stays, "groups"), ["component"], counted="rows").filter("number <> stays").select("number")
    return marked(rows, gone, "number").filter(~F.col("marked")).select("whole.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as many times as it was taken (0 to 2). A null text has size 0 and isn't taken where its source
    has no words at all; a null source is one of its own; repeated rows are drawn each by itself; no rows give none. The
    columns stay those of the documents, whatever their names."""
    mixed = mixing.mix_documents(docs, carry=True).filter(F.col("copies") > 0)
    return mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).select("all.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences; a document that was taken twice is packed twice. A null text is packed as an empty
    one, its end id alone; no rows give no pieces; columns other than doc_id and text are left behind."""
    return packing.pack_documents(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [("language ID", language_id), ("SimHash near-dedup", simhash_dedup), ("mixing sources", mix_sources), ("best-fit packing", pack)]

#: SQL expresses neither trained classifiers nor balanced draws; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each stage's result staged for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
