"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bitslice, forest, idcoder, langid, licenses, lines, mixing, packing, phrases, resample, sharding, simhash, urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents")).drop("row", "copies")


@query
def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_languages(table(spark, sf_dir, "documents"))


@query
def op3_bitslice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitslice.top_k(table(spark, sf_dir, "embeddings"))


ORACLES["op3_bitslice"] = bitslice.oracle()


@query
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


@query
def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


ORACLES["op5_licenses"] = licenses.oracle()


@query
def op9_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.link_embeddings(table(spark, sf_dir, "embeddings"))


@query
def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"))


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op6_idcoder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idcoder.round_trip(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


@query
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


@query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


@query
def op11_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.digests(lines.dedup_lines(table(spark, sf_dir, "documents")))


ORACLES["op11_lines"] = lines.oracle()


@query
def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


ORACLES["op12_phrases"] = phrases.oracle()


@query
def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
