"""Queries over the reference tables, each with the DuckDB SQL that gives the same rows.

Here `documents` stands for stored documents and their texts, `embeddings` (vec_id = doc_id) for chunk vectors, `labels`
for spreadsheet metadata that covers some documents, `conversations` for ordered rows, `orders` for dates and amounts.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hanji.config import EngineConfig
from hanji.functions import dates, keywords, metadata, names, permits, text, vectors
from hanji.operators import attachments, chunking, search, stats, store, vector_index
from hanji.plans import files, ingest, templates
from hanji.session import shared_folder, spread
from hanji.sources import metadata as spreadsheets
from hanji.sources import odt
from hanji.streaming import ingest as streaming

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- search ---------------------------------------------------------------------------------------------------------

COSINE = "round(list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]), 6)"
QUERY_ROW = "(SELECT embedding FROM embeddings WHERE vec_id = 0) q"


def query_vector(embeddings: DataFrame) -> DataFrame:
    """The one row that stands for a query's vector, as column `query`."""
    return embeddings.filter(F.col("vec_id") == 0).limit(1).select(F.col("embedding").alias("query"))


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors with the query's vector beside each; the query is a single row, so it is what gets broadcast."""
    e = table(spark, sf_dir, "embeddings")
    return e.join(F.broadcast(query_vector(e)))


def top(found: DataFrame, k: int, **options) -> DataFrame:
    return search.similarity_search(found, F.col("query"), k, id_column="vec_id", decimals=6, **options)


def chunk_index(spark: SparkSession, sf_dir: str, lists: int) -> vector_index.VectorIndex:
    """An index of the vectors as chunks, in the shared folder, built anew for each query so that it holds these rows."""
    index = vector_index.VectorIndex(spark, f"{shared_folder(spark)}/hanji-index/{uuid.uuid4().hex}")
    index.build(table(spark, sf_dir, "embeddings").select(F.format_string("%019d", "vec_id").alias("chunk_id"), "vec_id", "embedding"), lists)
    return index


@query(f"SELECT e.vec_id, {COSINE} AS similarity FROM embeddings e, {QUERY_ROW} ORDER BY similarity DESC, e.vec_id LIMIT 10")
def vector_topk_probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The top ten through inverted lists, all of them probed, which must equal a scan."""
    index = chunk_index(spark, sf_dir, 16)
    asked = query_vector(table(spark, sf_dir, "embeddings")).first()
    return index.similarity_search(asked["query"], 10, 16, id_column="vec_id", decimals=6).select("vec_id", "similarity")


@query()
def vector_topk_few_probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The top ten from the four nearest of sixteen lists: partitions of the others aren't read. Which lists there are is
    k-means' choice, so SQL can't say; recall is tested."""
    index = chunk_index(spark, sf_dir, 16)
    asked = query_vector(table(spark, sf_dir, "embeddings")).first()
    return index.similarity_search(asked["query"], 10, 4, id_column="vec_id", decimals=6).select("vec_id", "similarity")


@query(f"SELECT vec_id, {COSINE} AS similarity FROM embeddings e, {QUERY_ROW} ORDER BY similarity DESC, vec_id LIMIT 10")
def vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top(chunks(spark, sf_dir), 10).select("vec_id", "similarity")


@query(f"SELECT vec_id, {COSINE} AS similarity FROM embeddings e, {QUERY_ROW} WHERE {COSINE} >= 0.2 ORDER BY similarity DESC, vec_id LIMIT 50")
def vector_topk_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top(chunks(spark, sf_dir), 50, threshold=0.2).select("vec_id", "similarity")


@query(f"SELECT vec_id, {COSINE} AS similarity FROM embeddings e JOIN documents d ON d.doc_id = e.vec_id, {QUERY_ROW} WHERE d.lang = 'en' ORDER BY similarity DESC, vec_id LIMIT 10")
def vector_topk_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id"), F.col("lang").alias("biz_cate"))
    found = chunks(spark, sf_dir).withColumn("doc_id", F.col("vec_id"))
    return top(found, 10, filters={"biz_cate": "en"}, documents=docs).select("vec_id", "similarity")


HYBRID = "round(0.7::DOUBLE * list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) + (1 - 0.7::DOUBLE) * (d.text ILIKE '%tion%the%')::INT, 6)"


@query(f"SELECT vec_id, {HYBRID.replace('%tion%the%', '%license%')} AS similarity FROM embeddings e JOIN documents d ON d.doc_id = e.vec_id, {QUERY_ROW} ORDER BY similarity DESC, vec_id LIMIT 20")
def hybrid_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Texts lie beside the vectors here: they are searched where they are read, and one bit each meets its vector.
    searched = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("vec_id"), text.contains_ignoring_case(F.col("text"), "License").alias("occurs"))
    found = chunks(spark, sf_dir).join(searched, "vec_id")
    return search.hybrid_search(found, F.col("query"), " License ", 20, id_column="vec_id", decimals=6, occurs=F.col("occurs")).select("vec_id", "similarity")


@query(
    f"SELECT h.vec_id, h.similarity, d.lang, d.source FROM (SELECT vec_id, {HYBRID.replace('%tion%the%', '%license%')} AS similarity "
    f"FROM embeddings e JOIN documents d ON d.doc_id = e.vec_id, {QUERY_ROW} ORDER BY similarity DESC, vec_id LIMIT 20) h LEFT JOIN documents d ON d.doc_id = h.vec_id"
)
def hybrid_late_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumnRenamed("doc_id", "vec_id")
    return search.with_metadata(hybrid_topk(spark, sf_dir), docs, ["lang", "source"], key="vec_id")


@query("SELECT page_id FROM pages WHERE url ILIKE '%\\_SOURCE=%' ESCAPE '\\'")
def like_escape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").filter(text.contains_ignoring_case(F.col("url"), "_SOURCE=")).select("page_id")


@query("SELECT doc_id, substr(text, 1, 200) AS preview FROM documents ORDER BY n_chars DESC, doc_id LIMIT 10")
def preview_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    longest = table(spark, sf_dir, "documents").orderBy(F.desc("n_chars"), "doc_id").limit(10)
    return search.preview(longest.select("doc_id", "text"))


# --- counts ---------------------------------------------------------------------------------------------------------


@query("SELECT (SELECT count(*) FROM documents) AS document_count, (SELECT count(*) FROM conversations) AS chunk_count, role AS chunk_type, count(*) AS n FROM conversations GROUP BY role")
def store_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select(F.col("role").alias("chunk_type"), F.col("conv_id").alias("chunk_id"))
    counted = stats.store_stats(table(spark, sf_dir, "documents"), turns)
    return counted.select("document_count", "chunk_count", F.explode("chunk_types").alias("chunk_type", "n"))


@query(
    "SELECT 'lang' AS \"column\", lang AS value, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang UNION ALL "
    "SELECT 'source', source, count(*) FROM documents WHERE source IS NOT NULL GROUP BY source UNION ALL SELECT NULL, NULL, count(*) FROM documents"
)
def multi_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.value_counts(table(spark, sf_dir, "documents"), "lang", "source")


def run_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as results of a run: those with labels processed or failed, the others skipped."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    status = F.when(F.col("toxic").isNull(), "skipped").when(F.col("toxic") == 1, "failed").otherwise("processed")
    return docs.join(labels, "doc_id", "left").select("source", status.alias("status"), F.floor(F.col("n_chars") / 1000).alias("chunks"), F.col("quality").alias("excluded"))


RUN = "(SELECT source, CASE WHEN toxic IS NULL THEN 'skipped' WHEN toxic = 1 THEN 'failed' ELSE 'processed' END AS status, n_chars // 1000 AS chunks, quality AS excluded FROM documents LEFT JOIN labels USING (doc_id))"


@query(
    f"SELECT source, count(*) FILTER (status = 'processed') AS processed, count(*) FILTER (status = 'skipped') AS skipped, count(*) FILTER (status = 'failed') AS failed, "
    f"coalesce(sum(chunks), 0)::BIGINT AS total_chunks, coalesce(sum(excluded), 0)::BIGINT AS excluded FROM {RUN} GROUP BY source"
)
def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.run_counters(run_results(spark, sf_dir), "source")


@query(f"SELECT status, count(*) AS n FROM {RUN} GROUP BY status")
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.status_counts(run_results(spark, sf_dir))


@query("SELECT doc_id, round(((lang IS NOT NULL)::INT + (quality IS NOT NULL)::INT + (toxic IS NOT NULL)::INT) / 3.0::DOUBLE, 3) AS confidence FROM documents LEFT JOIN labels USING (doc_id)")
def confidence_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return joined.select("doc_id", stats.confidence("lang", "quality", "toxic").alias("confidence"))


@query(
    "WITH f AS (SELECT embedding AS f FROM embeddings ORDER BY vec_id LIMIT 1), c AS (SELECT count(*) AS vectors, count(*) FILTER (list_sum(list_transform(list_zip(embedding::DOUBLE[], f::DOUBLE[]), lambda p: abs(p[1] - p[2]))) < 1e-6) AS same_as_first FROM embeddings, f) "
    "SELECT vectors, same_as_first, vectors > 1 AND vectors = same_as_first AS all_identical FROM c"
)
def embedding_degeneration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.embedding_degeneration(table(spark, sf_dir, "embeddings"))


@query("SELECT vec_id, round(sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))), 6) AS norm, round(embedding[1]::DOUBLE / greatest(sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))), 1e-12), 6) AS first FROM embeddings")
def l2_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("embedding")
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(vectors.l2_norm(e), 6).alias("norm"), F.round(F.get(vectors.normalized(e), F.lit(0)), 6).alias("first"))


# --- changes --------------------------------------------------------------------------------------------------------

CURRENT = "(SELECT doc_id, sha256(text) AS file_hash FROM documents)"
STORED = "(SELECT doc_id, CASE WHEN toxic = 1 THEN 'old' ELSE sha256(text) END AS file_hash FROM documents JOIN labels USING (doc_id))"
CHANGES = f"(SELECT c.doc_id, CASE WHEN s.file_hash IS NULL THEN 'new' WHEN s.file_hash <> c.file_hash THEN 'update' ELSE 'unchanged' END AS change FROM {CURRENT} c LEFT JOIN {STORED} s USING (doc_id))"


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents against a stored state that knows those with labels, and the toxic ones by another hash."""
    current = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("file_hash"))
    stored = current.join(table(spark, sf_dir, "labels"), "doc_id").withColumn("file_hash", F.when(F.col("toxic") == 1, "old").otherwise(F.col("file_hash")))
    return store.classify_changes(current, stored).select("doc_id", "change")


@query(f"SELECT doc_id, change FROM {CHANGES}")
def incremental_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes(spark, sf_dir)


@query(f"SELECT change, count(*) AS n FROM {CHANGES} GROUP BY change")
def incremental_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes(spark, sf_dir).groupBy("change").agg(F.count("*").alias("n"))


@query("SELECT doc_id, sha256(text) AS file_hash FROM documents")
def file_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("file_hash"))


@query("SELECT max(doc_id) AS doc_id, sha256(text) AS key FROM documents GROUP BY text")
def dedup_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    hashed = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("key"))
    return store.keep_last(hashed, "key", F.col("doc_id"))


def both_ids(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    labels = table(spark, sf_dir, "labels").select("doc_id")
    extra = table(spark, sf_dir, "pages").select((F.col("page_id") + 1_000_000_000_000).alias("doc_id"))
    return table(spark, sf_dir, "documents").select("doc_id"), labels.unionAll(extra)


META_IDS = "(SELECT doc_id FROM labels UNION ALL SELECT page_id + 1000000000000 FROM pages)"


@query(f"SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM {META_IDS}")
def ids_matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.id_report(*both_ids(spark, sf_dir)).filter(F.col("status") == "matched").select("doc_id")


@query(f"SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM {META_IDS}")
def ids_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.id_report(*both_ids(spark, sf_dir)).filter(F.col("status") == "missing_in_metadata").select("doc_id")


@query(
    f"SELECT coalesce(d.doc_id, m.doc_id) AS doc_id, CASE WHEN m.doc_id IS NULL THEN 'missing_in_metadata' WHEN d.doc_id IS NULL THEN 'missing_in_data' ELSE 'matched' END AS status "
    f"FROM (SELECT DISTINCT doc_id FROM documents) d FULL JOIN (SELECT DISTINCT doc_id FROM {META_IDS}) m ON d.doc_id = m.doc_id"
)
def ids_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.id_report(*both_ids(spark, sf_dir))


@query("SELECT doc_id AS id, 'documents' AS source FROM documents UNION ALL SELECT page_id, 'pages' FROM pages UNION ALL SELECT item_id, 'benchmark' FROM benchmark")
def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    of = lambda name, key: table(spark, sf_dir, name).select(F.col(key).alias("id"), F.lit(name).alias("source"))
    return of("documents", "doc_id").unionByName(of("pages", "page_id")).unionByName(of("benchmark", "item_id"))


@query("SELECT doc_id, quality, toxic FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE lang = 'fr') UNION ALL SELECT doc_id, 9, 9 FROM documents WHERE lang = 'fr'")
def upsert_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = table(spark, sf_dir, "documents").filter(F.col("lang") == "fr").select("doc_id", F.lit(9).alias("quality"), F.lit(9).alias("toxic"))
    return store.upsert(table(spark, sf_dir, "labels"), new, "doc_id")


@query(
    "WITH s AS (SELECT DISTINCT conv_id FROM conversations WHERE role = 'system') SELECT conv_id, turn, role FROM conversations WHERE conv_id NOT IN (SELECT conv_id FROM s) "
    "UNION ALL SELECT conv_id, turn + 100, 'new' FROM conversations WHERE conv_id IN (SELECT conv_id FROM s) AND role = 'user'"
)
def replace_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    replaced = turns.filter(F.col("role") == "system").select("conv_id").distinct()
    new = turns.filter(F.col("role") == "user").join(replaced, "conv_id", "left_semi").withColumn("turn", F.col("turn") + 100).withColumn("role", F.lit("new"))
    return store.replace_children(turns, new, "conv_id", replaced=replaced)


@query(
    "WITH gone AS (SELECT DISTINCT doc_id FROM labels WHERE toxic = 1) SELECT 'documents' AS \"table\", count(*) AS n FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM gone) "
    "UNION ALL SELECT 'labels', count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM gone) UNION ALL SELECT 'embeddings', count(*) FROM embeddings WHERE vec_id NOT IN (SELECT doc_id FROM gone)"
)
def delete_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    tables = {"documents": table(spark, sf_dir, "documents").select("doc_id"), "labels": labels, "embeddings": table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"))}
    left = store.delete(tables, labels.filter(F.col("toxic") == 1))
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), "n") for name, df in left.items()]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


@query("SELECT vec_id, len(embedding)::INTEGER AS dimension, round(list_sum(embedding::DOUBLE[]), 6) AS total FROM embeddings")
def mirror_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks_ = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("chunk_id"), "embedding", "label")
    return store.mirrored(chunks_, "document_chunks").select(F.col("chunk_id").alias("vec_id"), F.size("embedding").alias("dimension"), F.round(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x), 6).alias("total"))


@query(
    "SELECT 'documents' AS \"table\", count(*) AS n FROM documents UNION ALL SELECT 'document_chunks', count(*) FROM embeddings JOIN documents ON doc_id = vec_id UNION ALL SELECT 'attachments', count(*) FROM labels JOIN documents USING (doc_id)"
)
def mirror_sync_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    vectors_ = table(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "doc_id").join(docs.select("doc_id"), "doc_id", "left_semi")
    labels = table(spark, sf_dir, "labels").join(docs.select("doc_id"), "doc_id", "left_semi")
    return store.sync_counts({"documents": docs, "document_chunks": vectors_, "attachments": labels})


# --- metadata and titles --------------------------------------------------------------------------------------------


@query("SELECT d.doc_id, coalesce(l.quality, -1) AS quality, coalesce(l.toxic, -1) AS toxic FROM documents d LEFT JOIN labels l USING (doc_id)")
def metadata_left_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.with_defaults(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), "doc_id", {"quality": -1, "toxic": -1})


@query("SELECT p_partkey, coalesce(nullif(trim(CASE WHEN p_size % 3 = 0 THEN '  ' ELSE p_name END), ''), nullif(trim(p_brand), ''), '') AS title FROM part")
def coalesce_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(F.col("p_size") % 3 == 0, "  ").otherwise(F.col("p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", F.coalesce(text.first_filled(name, F.col("p_brand")), F.lit("")).alias("title"))


CODE = "CASE o_orderkey % 4 WHEN 0 THEN 'xDPBT1' WHEN 1 THEN 'DPBT2 ' WHEN 2 THEN 'DPBT3' ELSE ' raw' END"


@query(
    f"SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'DPBT1' WHEN 1 THEN 'DPBT2' WHEN 2 THEN 'DPBT3' ELSE 'raw' END AS open_code, "
    "CASE o_orderkey % 4 WHEN 0 THEN '대국민공개' WHEN 1 THEN '비공개' WHEN 2 THEN '부분공개' ELSE '' END AS open_name FROM orders"
)
def open_code_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", metadata.open_code(F.expr(CODE)).alias("open_code"), metadata.open_name(F.expr(CODE)).alias("open_name"))


@query("SELECT o_orderkey, o_orderstatus AS doc_type, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE year(o_orderdate)::INTEGER END AS doc_year FROM orders")
def type_year_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(F.lit(" "), "o_orderstatus", F.when(F.col("o_orderkey") % 5 == 0, "20x4").otherwise(F.year("o_orderdate").cast("string")))
    return table(spark, sf_dir, "orders").select("o_orderkey", metadata.doc_type(raw).alias("doc_type"), metadata.doc_year(raw).alias("doc_year"))


@query("SELECT p_partkey, concat_ws(' > ', nullif(trim(p_brand), ''), CASE WHEN p_size % 2 = 0 THEN p_type END, p_name) AS path FROM part")
def biz_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    middle = F.when(F.col("p_size") % 2 == 0, F.col("p_type")).otherwise(" ")
    return table(spark, sf_dir, "part").select("p_partkey", metadata.full_path(F.col("p_brand"), middle, F.col("p_name")).alias("path"))


@query("SELECT conv_id, turn, 'CH-' || substr(conv_id::VARCHAR, 1, 16) || '-' || printf('%03d', turn) AS chunk_id FROM conversations")
def chunk_id_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", text.chunk_id(F.col("conv_id").cast("string"), F.col("turn")).alias("chunk_id"))


@query("SELECT p_partkey, trim(regexp_replace(replace(replace(p_name, '&amp;', '&'), '·', '·'), '\\s+', ' ', 'g')) AS title FROM part")
def title_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(F.lit(" "), F.format_string("%03d", F.col("p_size")), F.lit("_"), F.replace("p_name", F.lit(" "), F.lit(" \t ")), F.lit(" "))
    return table(spark, sf_dir, "part").select("p_partkey", text.normalize_title(raw).alias("title"))


@query("SELECT page_id, regexp_extract(url, '([^/\\\\]*)[/\\\\]*$', 1) AS name FROM pages")
def path_basename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.basename(F.col("url")).alias("name"))


@query("SELECT page_id, regexp_replace('at ' || regexp_replace(url, '^[a-z]+:/', ''), '/(?:[^\\s:/]*/)*([^\\s:/]+)', '\\1', 'g') AS message FROM pages")
def path_sanitize(spark: SparkSession, sf_dir: str) -> DataFrame:
    message = F.concat(F.lit("at "), F.regexp_replace("url", "^[a-z]+:/", ""))
    return table(spark, sf_dir, "pages").select("page_id", text.sanitize_paths(message).alias("message"))


@query("SELECT c_custkey, 'postgresql://' || c_mktsegment || ':***@db/' || c_custkey AS url FROM customer")
def mask_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.concat(F.lit("postgresql://"), "c_mktsegment", F.lit(":"), "c_name", F.lit("@db/"), F.col("c_custkey").cast("string"))
    return table(spark, sf_dir, "customer").select("c_custkey", text.mask_url(url).alias("url"))


# --- chunks ---------------------------------------------------------------------------------------------------------


@query("SELECT doc_id, floor(0.25::DOUBLE * length(text) + 1.25::DOUBLE * (length(text) - length(regexp_replace(text, '[가-힣]', '', 'g'))))::INTEGER AS tokens FROM documents")
def token_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.token_estimate(F.col("text")).alias("tokens"))


@query(
    "WITH p AS (SELECT doc_id, generate_subscripts(l, 1) AS k, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)) "
    "SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY k) - 1)::INTEGER AS number, length(line)::INTEGER AS size FROM p WHERE trim(line) <> ''"
)
def paragraph_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("k", "line")).filter(F.trim("line") != "")
    number = F.row_number().over(Window.partitionBy("doc_id").orderBy("k")) - 1
    return lines.select("doc_id", number.cast("int").alias("number"), F.length("line").alias("size"))


def document_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id"), F.lit("text").alias("section_type"), F.regexp_replace("text", "\n", "\n\n").alias("content"), F.lit(0).alias("order"))


#: The greedy packing as folds over lists: sentences of each long paragraph, then paragraphs.
GREEDY = r"""
WITH paragraphs AS (SELECT doc_id, list_filter(list_transform(string_split(replace(text, chr(10), chr(10) || chr(10)), chr(10) || chr(10)), lambda p: regexp_replace(p, '^\s+|\s+$', '', 'g')), lambda p: p <> '') AS ps FROM documents),
items AS (SELECT doc_id, flatten(list_transform(ps, lambda p: CASE WHEN {p} <= 256 THEN [{{'done': []::VARCHAR[], 'cur': p, 'alone': false}}] ELSE
  list_transform(list_transform([list_reduce(list_transform(list_filter(list_transform(string_split(regexp_replace(p, '([.!?다요])\s+', '\1' || chr(1), 'g'), chr(1)), lambda s: regexp_replace(s, '^\s+|\s+$', '', 'g')), lambda s: s <> ''),
      lambda s: {{'done': []::VARCHAR[], 'cur': s}}), lambda a, b: CASE WHEN {ab} <= 256 THEN {{'done': a.done, 'cur': a.cur || ' ' || b.cur}} ELSE {{'done': list_append(a.done, a.cur), 'cur': b.cur}} END)],
    lambda r: list_append(r.done, r.cur))[1], lambda c: {{'done': []::VARCHAR[], 'cur': c, 'alone': true}}) END)) AS xs FROM paragraphs),
packed AS (SELECT doc_id, list_reduce(xs, lambda a, b: CASE WHEN NOT b.alone AND {aabb} <= 256 THEN {{'done': a.done, 'cur': a.cur || chr(10) || chr(10) || b.cur, 'alone': false}}
  ELSE {{'done': list_append(a.done, a.cur), 'cur': b.cur, 'alone': false}} END) AS r FROM items WHERE len(xs) > 0),
listed AS (SELECT doc_id, list_append(r.done, r.cur) AS l FROM packed),
chunks AS (SELECT doc_id, generate_subscripts(l, 1) - 1 AS k, unnest(l) AS text FROM listed)
SELECT doc_id, k::INTEGER AS chunk_num, 'CH-' || doc_id[1:16] || '-' || lpad(k::VARCHAR, greatest(3, len(k::VARCHAR))::INTEGER, '0') AS chunk_id, text, {t}::INTEGER AS token_count
FROM (SELECT doc_id::VARCHAR AS doc_id, k, text FROM chunks)"""


def estimate_sql(text: str) -> str:
    """The estimate of tokens in DuckDB's SQL."""
    hangul = f"length(regexp_replace({text}, '[^가-힣]', '', 'g'))"
    return f"floor({hangul} * 1.5 + (length({text}) - {hangul}) * 0.25)"


GREEDY = GREEDY.format(p=estimate_sql("p"), ab=estimate_sql("(a.cur || ' ' || b.cur)"), aabb=estimate_sql("(a.cur || chr(10) || chr(10) || b.cur)"), t=estimate_sql("text")).replace("SELECT doc_id, k::INTEGER", "SELECT doc_id::BIGINT AS doc_id, k::INTEGER")


@query(GREEDY)
def greedy_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs packed by built-in functions alone; tested against the rules written as plain Python too."""
    return chunking.chunk_sections(spread(document_sections(spark, sf_dir)), lambda x: chunking.split_paragraphs(x, 256)).select("doc_id", "chunk_num", "chunk_id", "text", "token_count")


@query()
def recursive_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The recursive splitter with overlap; tested by the properties of its chunks."""
    return chunking.chunk_sections(spread(document_sections(spark, sf_dir)), chunking.recursive_splitter(256, 32)).select("doc_id", "chunk_num", "chunk_id", "text", "token_count")


@query("SELECT conv_id AS doc_id, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::INTEGER AS chunk_num, text FROM conversations WHERE role <> 'system'")
def chunk_renumber(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("chunk_num"), "role", "text")
    return store.renumber(turns, F.col("role") != "system").select("doc_id", "chunk_num", "text")


@query(
    "SELECT r_regionkey, '[TABLE_START]' || chr(10) || '| name | key |' || chr(10) || '| --- | --- |' || chr(10) || string_agg('| ' || n_name || ' | ' || n_nationkey || ' |', chr(10) ORDER BY n_nationkey) || chr(10) || '[TABLE_END]' AS marked "
    "FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY r_regionkey"
)
def markdown_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = nation.groupBy("r_regionkey").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", F.array("n_name", F.col("n_nationkey").cast("string")).alias("cells")))).alias("rows"))
    grid = F.concat(F.array(F.array(F.lit("name"), F.lit("key"))), F.col("rows.cells"))
    section = F.array(F.struct(F.lit("table").alias("section_type"), text.markdown_table(grid).alias("content"), F.lit(0).alias("order")))
    return rows.select("r_regionkey", text.marked_text(section).alias("marked"))


@query("SELECT page_id, len(regexp_extract_all(html, '<li>'))::INTEGER AS items FROM pages")
def html_paragraph_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.size(F.regexp_extract_all("html", F.lit("<li>"), F.lit(0))).alias("items"))


@query(
    "SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN '홍길동, 김철수' WHEN 1 THEN '박영희' END AS author FROM supplier"
)
def lookahead_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names in the two rows after an approval row, else in the row itself; none after a row of receivers."""
    rows = F.expr("CASE s_suppkey % 3 WHEN 0 THEN array('수신자 이몽룡', '주무관 과장 전결', '', '홍길동 | 김철수과장') WHEN 1 THEN array('결재 박영희', '', '제목') ELSE array('수신자 성춘향', '', '홍길동') END")
    return table(spark, sf_dir, "supplier").select("s_suppkey", names.from_tables(F.array(rows)).alias("author"))


# --- dates, amounts, labelled lines ---------------------------------------------------------------------------------


def order_text() -> Column:
    """A notice for each order: a labelled date in one of three forms (the third of which is no date) and an amount."""
    day = F.col("o_orderdate")
    form = F.expr("o_orderkey % 3")
    dated = F.when(form == 0, F.date_format(day, "yyyy.M.d")).when(form == 1, F.date_format(day, "yyyy'년 'M'월 'd'일'")).otherwise(F.lit("2014-02-30"))
    amount = F.format_number("o_totalprice", 0)
    return F.concat(F.lit("제목 허가\n가. 결재일자 : "), dated, F.lit(" 시행\n나. 점용료 : 금 "), amount, F.lit("원\n다. 채취량 : "), amount, F.lit(" ㎥ 이하\n라. 신청인 : "), "o_orderpriority", F.lit(" ."))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE o_orderdate::DATE::VARCHAR END AS found FROM orders")
def date_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "orders")).select("o_orderkey", dates.parse_date(order_text()).cast("string").alias("found"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN '2001-02-03' ELSE o_orderdate::DATE::VARCHAR END AS report_date FROM orders")
def report_date_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "orders")).select("o_orderkey", dates.resolve_report_date(F.lit(None).cast("string"), order_text(), F.lit(""), F.lit("2001. 2. 3")).cast("string").alias("report_date"))


@query(
    "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate::DATE::VARCHAR END AS proposed, CASE WHEN o_orderkey % 3 = 0 THEN 'high' ELSE 'low' END AS confidence FROM orders"
)
def header_date_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = spread(table(spark, sf_dir, "orders")).select("o_orderkey", dates.choose_report_date(F.year("o_orderdate"), F.lit(None).cast("string"), order_text()).alias("d"))
    return chosen.select("o_orderkey", F.col("d.proposed_report_date").cast("string").alias("proposed"), F.col("d.confidence").alias("confidence"))


MONEY = "regexp_replace(format('{:,}', round_even(o_totalprice, 0)::BIGINT), ',', ',', 'g')"


@query(f"SELECT o_orderkey, {MONEY} || '원' AS amount FROM orders")
def amount_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", permits.amount(permits.normalize(order_text())).alias("amount"))


@query(f"SELECT o_orderkey, {MONEY} || '㎥' AS volume FROM orders")
def volume_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", permits.quantity(permits.labelled(permits.normalize(order_text()), permits.VOLUME)).alias("volume"))


@query("SELECT o_orderkey, o_orderpriority AS applicant FROM orders")
def labeled_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", permits.labelled(permits.normalize(order_text()), permits.PERMITTEE).alias("applicant"))


@query("SELECT c_custkey, c_name AS permittee, c_mktsegment AS purpose FROM customer")
def kv_table_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    block = F.concat(F.lit("[TABLE_START]\n| 신청인 | "), "c_name", F.lit(" |\n| --- | --- |\n| 목적 | "), "c_mktsegment", F.lit(" |\n[TABLE_END]"))
    pairs = spread(table(spark, sf_dir, "customer")).select("c_custkey", permits.table_pairs(block).alias("pairs"))
    return pairs.select("c_custkey", permits.from_tables(F.col("pairs"), "permittee_name").alias("permittee"), permits.from_tables(F.col("pairs"), "purpose").alias("purpose"))


@query("SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN '부산지방해양수산청' WHEN 1 THEN '해양수산부' END AS agency FROM supplier")
def known_org_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = F.expr("CASE s_suppkey % 3 WHEN 0 THEN '해양수산부부산지방해양수산청장' WHEN 1 THEN 'x해양수산부' ELSE s_name END")
    return table(spark, sf_dir, "supplier").select("s_suppkey", permits.known_agency(seen).alias("agency"))


@query(
    f"SELECT o_orderkey, NULL::VARCHAR AS org_nm, o_orderpriority AS ask_org_nm, NULL::VARCHAR AS addr, NULL::VARCHAR AS xtn, NULL::VARCHAR AS purps_cn, {MONEY} || '㎥' AS collection_volume, "
    f"NULL::DATE AS permit_start_date, NULL::DATE AS permit_end_date, {MONEY} || '원' AS amount, 0.333::DOUBLE AS confidence FROM orders"
)
def permit_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All fields of the notices made from orders; every shape of notice is tested against fixtures."""
    notices = spread(table(spark, sf_dir, "orders")).select("o_orderkey", order_text().alias("text"))
    return permits.extract(notices).select("o_orderkey", *permits.stored(F.col("permit"))).drop("source_text")


@query(
    "SELECT c_custkey, CASE c_custkey % 3 WHEN 2 THEN NULL ELSE c_name END AS ask_org_nm, CASE c_custkey % 3 WHEN 2 THEN '통영시 산양읍 ' || c_nationkey || '번지 지선' ELSE '군산시 옥도면 ' || c_nationkey || '번지 지선' END AS addr, "
    "CASE c_custkey % 3 WHEN 2 THEN NULL ELSE c_custkey || '㎡' END AS xtn, '부두 축조 공사' AS purps_cn, CASE c_custkey % 3 WHEN 0 THEN DATE '2020-03-01' END AS permit_start_date, CASE c_custkey % 3 WHEN 0 THEN DATE '2021-02-28' END AS permit_end_date FROM customer"
)
def permit_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A flattened table, a Markdown table in one line, and a sentence with a quoted purpose."""
    notice = F.expr(
        "CASE c_custkey % 3 WHEN 0 THEN concat('신청인위 치목 적면 적허가 기간', c_name, '군산시 옥도면 ', c_nationkey, '번지 지선 부두 축조 공사 ', c_custkey, '㎡2020.3.1.~2021.2.28.') "
        "WHEN 1 THEN concat('[TABLE_START] | 신청인 | 위치 | 면적(㎡) | 목적 | --- | --- | --- | --- | ', c_name, ' | 군산시 옥도면 ', c_nationkey, '번지 지선 | ', c_custkey, ' | 부두 축조 공사 | [TABLE_END]') "
        "ELSE concat('귀하께서 통영시 산양읍 ', c_nationkey, '번지 지선에 “부두 축조 공사”를 위한 점용 신청') END"
    )
    found = permits.extract(spread(table(spark, sf_dir, "customer")).select("c_custkey", notice.alias("text")))
    return found.select("c_custkey", *permits.stored(F.col("permit"))).select("c_custkey", "ask_org_nm", "addr", "xtn", "purps_cn", "permit_start_date", "permit_end_date")


RUN_ON_COLUMNS = ("ask_org_nm", "addr", "xtn", "purps_cn", "collection_volume", "permit_start_date", "permit_end_date", "amount")


def run_on_sql() -> str:
    said = lambda c: templates.pick_sql("c_custkey", tuple(fields.get(c) for _, fields in templates.RUN_ON))
    return "SELECT c_custkey, " + ", ".join(f"({said(c)}){'::DATE' if c.endswith('date') else ''} AS {c}" for c in RUN_ON_COLUMNS) + " FROM customer"


@query(run_on_sql())
def permit_run_on(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flattened tables of six kinds, a table of changes, quantities in brackets and sentences about the ground."""
    notices = spread(table(spark, sf_dir, "customer")).select("c_custkey", templates.pick("c_custkey", tuple(x for x, _ in templates.RUN_ON)).alias("text"))
    return permits.extract(notices).select("c_custkey", *permits.stored(F.col("permit"))).select("c_custkey", *RUN_ON_COLUMNS)


LABELLED_COLUMNS = ("org_nm", "ask_org_nm", "addr", "xtn", "purps_cn", "collection_volume", "permit_start_date", "permit_end_date", "amount")


def labelled_sql() -> str:
    said = lambda c: templates.pick_sql("c_custkey", tuple(fields.get(c) for _, fields in templates.LABELLED))
    return "SELECT c_custkey, " + ", ".join(f"({said(c)}){'::DATE' if c.endswith('date') else ''} AS {c}" for c in LABELLED_COLUMNS) + " FROM customer"


@query(labelled_sql())
def permit_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notices of labelled lines: areas with purposes, volumes, periods in three forms, and agencies by label, head and address."""
    notices = spread(table(spark, sf_dir, "customer")).select("c_custkey", templates.pick("c_custkey", tuple(x for x, _ in templates.LABELLED)).alias("text"))
    return permits.extract(notices).select("c_custkey", *permits.stored(F.col("permit"))).select("c_custkey", *LABELLED_COLUMNS)


@query(f"SELECT c_custkey, {templates.pick_sql('c_custkey', tuple(name for _, name in templates.SENTENCES))} AS applicant FROM customer")
def permit_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who applied, in the ways in which sentences say so, with addressees and bare marks refused."""
    notices = spread(table(spark, sf_dir, "customer")).select("c_custkey", templates.pick("c_custkey", tuple(x for x, _ in templates.SENTENCES)).alias("text"))
    return permits.extract(notices).select("c_custkey", F.col("permit.permittee_name").alias("applicant"))


@query("SELECT p_partkey, " + ", ".join(f"{templates.pick_sql('p_partkey', tuple(want for _, want in cases))} AS {field}" for field, cases in templates.VALUES.items()) + " FROM part")
def permit_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of four fields as they are cut, chosen among parts, or refused."""
    clean = {"location": permits.sanitize_location, "area": permits.sanitize_area, "purpose": permits.sanitize_purpose, "permittee_name": permits.sanitize_permittee}
    return table(spark, sf_dir, "part").select("p_partkey", *[clean[field](templates.pick("p_partkey", tuple(x for x, _ in cases))).alias(field) for field, cases in templates.VALUES.items()])


QUESTIONS = (
    ("㈜한빛{n}해운에서 낸 공유수면 점용", "한빛{n}해운"), ("건설 (주)새바다{n}건설의 허가", "새바다{n}건설"), ("여수{n}시청으로부터, 산업", "여수{n}시청"),
    ("부산 앞바다 점용 {n}건", None), ("항만 {n}번 공사", None),
)


@query(f"SELECT c_custkey, {templates.pick_sql('c_custkey', tuple(want for _, want in QUESTIONS))} AS keyword FROM customer")
def keyword_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The name in a search question, without company marks and particles; an ending alone is no name."""
    asked = table(spark, sf_dir, "customer").select("c_custkey", templates.pick("c_custkey", tuple(q for q, _ in QUESTIONS)).alias("q"))
    return asked.select("c_custkey", keywords.keyword(F.col("q")).alias("keyword"))


@query("SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN '홍길동, 김철수' WHEN 1 THEN '박영희' END AS author FROM supplier")
def lookahead_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names in the paragraph after an approval line, else in the line itself; none after receivers or without approval."""
    lines = F.expr("CASE s_suppkey % 4 WHEN 0 THEN array('제목 허가', '', '주무관 과장 전결', '', '홍길동 | 김철수과장') WHEN 1 THEN array('결재 박영희', '', '제목') WHEN 2 THEN array('수신자 성춘향', '홍길동') ELSE array('제목', '홍길동') END")
    return table(spark, sf_dir, "supplier").select("s_suppkey", names.from_paragraphs(lines).alias("author"))


@query("SELECT doc_id::VARCHAR AS doc_id, sha256(text) AS file_hash, lang, 1 AS runs FROM documents")
def streaming_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as a stream of files whose batches are upserted by key into a stored table, each batch once: a second run
    of the stream finds nothing new, and a batch that is handed over again changes nothing."""
    root = f"{shared_folder(spark)}/hanji-stream/{uuid.uuid4().hex}"
    table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "text", "lang").repartition(4, "doc_id").write.parquet(f"{root}/arrived")
    tables = store.TableStore(spark, f"{root}/store", 8)
    tables.write("state", spark.createDataFrame([], "doc_id string, file_hash string, lang string, runs int"))

    def work(batch: DataFrame) -> DataFrame:
        new = batch.select("doc_id", F.sha2("text", 256).alias("file_hash"), "lang", F.lit(1).alias("runs"))
        seen = lambda old: new.unionByName(old).groupBy("doc_id").agg(F.max("file_hash").alias("file_hash"), F.max("lang").alias("lang"), F.sum("runs").cast("int").alias("runs"))
        tables.change("state", new.select("doc_id"), seen)
        return stats.run_counters(new.select(F.lit("processed").alias("status"), F.lit(0).alias("chunks"), F.lit(0).alias("excluded"))).withColumn("superseded", F.lit(0))

    apply = streaming.once(tables, "documents", work)
    for _ in range(2):
        streaming.follow_files(spark, f"{root}/arrived", "doc_id string, text string, lang string", apply, f"{root}/checkpoint", per_batch=2).awaitTermination()
    apply(tables.read("state"), 0)
    return tables.read("state")


@query("SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN ['홍길동', '김철수'] WHEN 1 THEN ['박영희'] ELSE [] END AS names FROM supplier")
def name_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names among titles, words that are none, and repeats."""
    row = F.expr("CASE s_suppkey % 3 WHEN 0 THEN '주무관 홍길동 | 김철수과장, 홍길동(대리)' WHEN 1 THEN '결재:박영희/행정사무관' ELSE '해양수산부 장관 귀하' END")
    return table(spark, sf_dir, "supplier").select("s_suppkey", names.names_in(row).alias("names"))


# --- attachments ----------------------------------------------------------------------------------------------------


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders with a document, its .pdf, a numbered .pdf, an .hwp with that one's stem, and a lone .hwp."""
    folder = F.concat(F.lit("/data/2024/DCT"), F.col("s_suppkey").cast("string"))
    names = F.array(*[F.lit(n) for n in ("000_main.odt", "000_main.pdf", "010_plan.pdf", "010_plan.hwp", "002_map.hwp", "zeta.hwp", "note.txt")])
    return table(spark, sf_dir, "supplier").select(F.explode(names).alias("name"), folder.alias("folder")).select(F.concat_ws("/", "folder", "name").alias("path"))


@query(
    "SELECT 'DCT' || s_suppkey AS doc_id, n.name AS file_name, n.k::INTEGER AS file_order, n.k = 0 AS is_main_pdf FROM supplier, "
    "(VALUES ('000_main.pdf', 0), ('002_map.hwp', 1), ('010_plan.pdf', 2), ('zeta.hwp', 3)) n(name, k)"
)
def attachment_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attachments.attachments_of(listing(spark, sf_dir)).select("doc_id", "file_name", "file_order", "is_main_pdf")


@query("SELECT 'DCT' || s_suppkey AS doc_id, '010_plan.hwp' AS file_name FROM supplier")
def sibling_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attachments that are left out because a .pdf has their stem."""
    files = listing(spark, sf_dir)
    left_out = files.join(attachments.attachments_of(files).select(F.col("file_path").alias("path")), "path", "left_anti").filter(F.col("path").endswith(".hwp"))
    return left_out.select(F.element_at(F.split("path", "/"), -2).alias("doc_id"), text.basename(F.col("path")).alias("file_name"))


# Beginnings of image files, and of files that only claim to be such.
IMAGES = (
    ("a.PNG", "89504E470D0A1A0A00", True), ("b.jpeg", "FFD8FF00", True), ("c.jpg", "89504E47", False), ("d.bmp", "424D01", True), ("e.gif", "474946383961", True),
    ("f.gif", "474946383861", False), ("g.tif", "49492A00", True), ("h.tiff", "4D4D002A", True), ("i.wmf", "D7CDC69A", True), ("j.emf", "01000000", False), ("k.png", "", False),
)


@query(f"SELECT r_regionkey, name, is_image FROM region, (VALUES {', '.join(f"('{n}', {ok})" for n, _, ok in IMAGES)}) v(name, is_image)")
def magic_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.lit(h).alias("head")) for n, h, _ in IMAGES])).alias("file")
    rows = table(spark, sf_dir, "region").select("r_regionkey", files)
    return rows.select("r_regionkey", "file.name", text.looks_like_image(F.col("file.name"), F.unhex("file.head")).alias("is_image"))


@query("SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY event_type")
def event_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


# --- files ----------------------------------------------------------------------------------------------------------


def own_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/hanji-{name}/{uuid.uuid4().hex}"


#: White space, for DuckDB.
WHITE_SQL = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


@query(
    "SELECT 'DCT' || doc_id AS doc_id, coalesce(lang, 'und') || ' & 공문·' || doc_id AS title, CASE doc_id % 3 WHEN 0 THEN '홍길동, 김철수' WHEN 1 THEN '박영희' END AS author_name, "
    "CASE doc_id % 3 WHEN 0 THEN '항만물류과' END AS dept_name, CASE doc_id % 3 WHEN 0 THEN '2024-03-' WHEN 1 THEN '2023-04-' ELSE '2022-05-' END || lpad((doc_id % 28 + 1)::VARCHAR, 2, '0') AS report_date, "
    "(2 + (body <> '')::INTEGER)::INTEGER AS n_sections, sha256(body) AS text_sha256, '| lang | source | id |' || chr(10) || '| --- | --- | --- |' || chr(10) || '| ' || coalesce(lang, '') || ' | ' || coalesce(source, '') || ' | ' || doc_id || ' |' AS first_table "
    "FROM (SELECT *, regexp_replace(array_to_string(list_filter(string_split(regexp_replace(coalesce(text, ''), '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x{fffe}\\x{ffff}]', ' ', 'g'), chr(10)), "
    f"lambda l: regexp_replace(l, '{WHITE_SQL}+', '', 'g') <> ''), chr(10)), '^{WHITE_SQL}+|{WHITE_SQL}+$', '', 'g') AS body FROM documents)"
)
def odt_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as OpenDocument texts, read back: names and dates from approval tables or spans, sections, titles."""
    d, day = F.col("doc_id"), (F.col("doc_id") % 28 + 1).cast("string")
    own = files.table_of((F.lit("lang"), F.lit("source"), F.lit("id")), (F.col("lang"), F.col("source"), d))
    one = lambda *cells: files.table_of(*[(c if isinstance(c, Column) else F.lit(c),) for c in cells])
    signed = one("수신자 이몽룡", "주무관 과장 전결", "", "홍길동 | 김철수과장", F.concat(F.lit("전결 2024. 3. "), day, F.lit(".")), "", "", F.concat(F.lit("항만물류과-"), d.cast("string")))
    dated = one("결재 박영희", "", "제목", "", "없음", F.concat(F.lit("시행 2023. 1. 2. 접수 2023. 4. "), day), "", "")
    tables = F.when(d % 3 == 0, F.array(own, signed)).when(d % 3 == 1, F.array(own, dated)).otherwise(F.array(own))
    spans = F.when(d % 3 == 2, F.array(F.concat(F.lit("승인 2022. 5. "), day))).otherwise(F.array().cast("array<string>"))
    path = F.concat(F.lit("/data/2024/DCT"), d.cast("string"), F.lit("/attachments/001_"), F.coalesce("lang", F.lit("und")), F.lit(" &amp; 공문・"), d.cast("string"), F.lit(".odt"))
    rows = spread(table(spark, sf_dir, "documents")).select(path.alias("path"), "text", tables.alias("tables"), spans.alias("spans"))
    read = odt.parse_documents(files.documents(rows).withColumn("file_hash", F.sha2("content", 256)))
    texts = F.when(F.get("sections", F.lit(0))["section_type"] == "text", F.get("sections", F.lit(0))["content"]).otherwise("")
    first = F.get(F.filter("sections", lambda s: s["section_type"] == "table"), F.lit(0))["content"]
    return read.filter(F.col("error").isNull()).select("doc_id", "title", "author_name", "dept_name", "report_date", F.size("sections").alias("n_sections"), F.sha2(texts, 256).alias("text_sha256"), first.alias("first_table"))


#: Rows of one spreadsheet, which one task reads.
SPREADSHEET_ROWS = 100_000


def listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as rows of a list, under the names of the columns in hanji."""
    d = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        d.alias("k"), F.concat(F.when(d % 2 == 0, "P").otherwise("R"), (2000 + d % 25).cast("string")).alias("doc_type_raw"), F.concat(F.lit(" DCT"), d.cast("string"), F.lit(" ")).alias("doc_id"),
        F.concat(F.lit('문서, "'), d.cast("string"), F.lit('"')).alias("title"), F.concat(F.lit("DPBT"), (d % 4).cast("string"), F.lit("(")).alias("open_code_raw"), F.when(d % 7 > 0, (d % 7).cast("string")).alias("attachment_count"),
        F.lit("2024-05-06").alias("process_date"), F.col("lang").alias("biz_cate"), F.col("source").alias("biz_sub_cate"),
    )


@query(
    "SELECT 'DCT' || doc_id AS doc_id, '문서, \"' || doc_id || '\"' AS title, CASE doc_id % 2 WHEN 0 THEN 'P' ELSE 'R' END AS doc_type, CASE doc_id % 2 WHEN 0 THEN '생산' ELSE '접수' END AS type_name, (2000 + doc_id % 25)::INTEGER AS doc_year, "
    "CASE WHEN doc_id % 4 = 0 THEN 'DPBT0(' ELSE 'DPBT' || doc_id % 4 END AS open_code, CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN '대국민공개' WHEN 2 THEN '비공개' ELSE '부분공개' END AS open_name, "
    "nullif(doc_id % 7, 0)::INTEGER AS attachment_count, '2024-05-06' AS process_date, concat_ws(' > ', lang, source) AS biz_full_path FROM documents"
)
def metadata_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of the documents as spreadsheets with Korean headers, with English ones, and with columns by position, after an
    older list that says something else about every fifth document: the latest row of each, typed."""
    root, rows = own_folder(spark, "lists"), listed(spark, sf_dir)
    columns = [c for c in rows.columns if c != "k"]

    def write(name: str, part: DataFrame) -> None:
        part.write.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, maxRecordsPerFile=SPREADSHEET_ROWS).csv(f"{root}/{name}")

    korean = {"doc_type_raw": "구분(P:생산, R:접수)", "doc_id": "문서ID", "title": "문서명", "open_code_raw": "공개 여부", "attachment_count": "붙임파일갯수", "process_date": "처리일", "biz_cate": "구분1", "biz_sub_cate": "구분2"}
    english = {"doc_type_raw": "SE", "doc_id": "doc_id", "title": "DOC_NM", "open_code_raw": "open", "attachment_count": "attach_seq", "process_date": "act_dt", "biz_cate": "exlpn_1", "biz_sub_cate": "exlpn_2"}
    headed = lambda part, header: part.select(*[F.col(c).alias(header[c]) for c in columns])
    write("older", headed(rows.filter("k % 5 = 0").withColumns({"title": F.lit("옛 문서"), "doc_type_raw": F.lit("P1999")}), english))
    write("korean", headed(rows.filter("k % 3 = 0"), korean))
    write("english", headed(rows.filter("k % 3 = 1"), english))
    by_place = [(F.col(c) if c in columns else F.lit(None).cast("string")).alias(f"c{n}") for n, c in enumerate(spreadsheets.COLUMNS)]
    write("places", rows.filter("k % 3 = 2").select(by_place))
    # Where there are no documents by position, their file has one line, which is no document.
    found = spreadsheets.document_metadata(spreadsheets.read_metadata(spark, root)).filter(F.col("doc_id").startswith("DCT"))
    return found.select("doc_id", "title", "doc_type", "type_name", "doc_year", "open_code", "open_name", "attachment_count", "process_date", "biz_full_path")


@query(
    "SELECT 'DCT' || s_suppkey AS doc_id, '문서 ' || s_suppkey AS title, CASE s_suppkey % 2 WHEN 0 THEN DATE '2024-05-06' ELSE DATE '2020-03-04' END AS report_date, CASE s_suppkey % 2 WHEN 0 THEN '갑 > ' || s_nationkey ELSE '' END AS biz_full_path, "
    "CASE s_suppkey % 2 WHEN 0 THEN '대국민공개' ELSE '' END AS open_name, s_name AS applicant, '부산광역시 영도구 ' || s_suppkey || '번지 지선 공유수면' AS place, 2::BIGINT AS chunks, 2::BIGINT AS attachments, count(*) OVER () AS skipped FROM supplier"
)
def ingest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of documents for each supplier, with a .pdf of it and a map, and a list that knows every second: taken in, taken
    in once more (all are skipped), copied to a mirror, and read from there."""
    root, k = own_folder(spark, "corpus"), F.col("s_suppkey").cast("string")
    suppliers = spread(table(spark, sf_dir, "supplier"))
    folder = F.concat(F.lit(f"{root}/data/2024/DCT"), k, F.lit("/attachments/"))
    body = F.concat(F.when(F.col("s_suppkey") % 2 == 1, "결재 2020. 3. 4.\n").otherwise(""), F.lit("가. 위치 : 부산광역시 영도구 "), k, F.lit("번지 지선 공유수면"))
    tables = F.array(files.table_of((F.lit("신청인"), F.col("s_name")), (F.lit("목적"), F.lit("선박 계류 시설"))))
    made = files.documents(suppliers.select(F.concat(folder, F.lit("000_문서 "), k, F.lit(".odt")).alias("path"), body.alias("text"), tables.alias("tables"), F.array().cast("array<string>").alias("spans")))
    beside = F.explode(F.array(F.concat(F.lit("000_문서 "), k, F.lit(".pdf")), F.lit("001_도면.hwp"))).alias("name")
    files.write(made.unionByName(suppliers.select(folder.alias("folder"), beside).select(F.concat("folder", "name").alias("path"), F.encode(F.lit("%PDF"), "UTF-8").alias("content"))))
    known = suppliers.filter("s_suppkey % 2 = 0").select(F.lit("P2024").alias("se"), F.concat(F.lit("DCT"), k).alias("doc_id"), F.lit("목록 제목").alias("doc_nm"), F.lit("갑").alias("exlpn_1"), F.col("s_nationkey").alias("exlpn_2"), F.lit("DPBT1").alias("open"), F.lit("2024-05-06").alias("act_dt"))
    known.write.options(header=True, maxRecordsPerFile=SPREADSHEET_ROWS).csv(f"{root}/lists")

    tables_, mirror = store.TableStore(spark, f"{root}/store", 8), store.TableStore(spark, f"{root}/mirror", 8)
    ingest.create_tables(tables_)
    ingest.create_mirror(mirror, permits_too=True)
    config = EngineConfig(data_dirs=(f"{root}/data",), metadata_doc_list=f"{root}/lists", embedding_dimension=8)
    ingest.ingest(spark, config, tables_)
    again = ingest.ingest(spark, config, tables_)
    ingest.sync_to_mirror(tables_, mirror)
    counted = lambda name: mirror.read(name).groupBy("doc_id").agg(F.count("*").alias(name))
    said = mirror.read("permit_extractions").select("doc_id", F.col("ask_org_nm").alias("applicant"), F.col("addr").alias("place"))
    found = mirror.read("documents").select("doc_id", "title", "report_date", "biz_full_path", "open_name").join(said, "doc_id").join(counted("document_chunks"), "doc_id").join(counted("attachments"), "doc_id")
    return found.withColumnRenamed("document_chunks", "chunks").join(F.broadcast(again.select("skipped")))
