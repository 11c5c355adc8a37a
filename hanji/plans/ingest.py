"""From files to stored tables: changed documents are parsed, enriched, split, embedded and written."""

from __future__ import annotations

import datetime
import importlib
import logging
from functools import partial, reduce
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hanji.config import EngineConfig
from hanji.functions import dates, permits, text, vectors
from hanji.operators import chunking, stats, store
from hanji.operators.attachments import attachments_of
from hanji.sources import listing, metadata, odt

log = logging.getLogger(__name__)

#: Unreadable files that a warning names.
NAMED_FILES = 20

DOCUMENT = (
    "doc_id string, doc_no string, title string, author_name string, dept_name string, report_date date, doc_year int, state_code string, state_name string, open_code string, open_name string, "
    "close_reason string, file_hash string, file_path string, biz_cate string, biz_sub_cate string, biz_detail_cate string, biz_full_path string, created_at timestamp_ntz, updated_at timestamp_ntz"
)
CHUNK = "chunk_id string, doc_id string, page_num int, chunk_num int, chunk_type string, text string, embedding array<float>, created_at timestamp_ntz"
ATTACHMENT = "doc_id string, file_name string, file_path string, file_order int, is_main_pdf boolean, created_at timestamp_ntz"
PERMIT = (
    "doc_id string, org_nm string, ask_org_nm string, addr string, xtn string, purps_cn string, collection_volume string, permit_start_date date, permit_end_date date, amount string, confidence double, "
    "source_text string, created_at timestamp_ntz, updated_at timestamp_ntz"
)
TABLES = {"documents": DOCUMENT, "document_chunks": CHUNK, "attachments": ATTACHMENT, "permit_extractions": PERMIT}


def create_tables(tables: store.TableStore, names: tuple[str, ...] = tuple(TABLES)) -> None:
    for name in names:
        tables.write(name, tables.spark.createDataFrame([], TABLES[name]))


def latest_files(found: DataFrame) -> DataFrame:
    """Of the files that stand for one document, the last by time and path: a run stores no document twice."""
    return store.keep_last(found, "doc_id", F.col("modified"), F.col("path"))


def changed_files(found: DataFrame, stored: DataFrame) -> DataFrame:
    """Files (path, doc_id, file_hash, ...) whose document isn't stored with this very hash. Only names and hashes move."""
    return found.join(stored.select("doc_id", "file_hash"), ["doc_id", "file_hash"], "left_anti")


def document_rows(parsed: DataFrame, meta: DataFrame, now: Column) -> DataFrame:
    """Parsed documents with what the spreadsheets say; documents that they don't know have empty texts there."""
    known = metadata.document_metadata(meta).withColumnRenamed("title", "meta_title")
    empty = ("doc_no", "state_code", "state_name", "open_code", "open_name", "close_reason", "biz_cate", "biz_sub_cate", "biz_detail_cate", "biz_full_path")
    joined = store.with_defaults(parsed.drop("error"), known, "doc_id", dict.fromkeys(empty, ""))
    raw = text.raw_text(F.col("sections"))
    own = {
        "title": text.resolve_title(F.col("title"), F.col("meta_title")),
        "dept_name": text.first_filled(F.col("dept_name"), F.col("processor_dept_name"), F.col("sender_dept_name"), F.col("receiver_dept_name")),
        "report_date": dates.resolve_report_date(F.col("report_date"), raw, F.col("process_date"), F.col("receive_date")),
        "created_at": now, "updated_at": now,
    }
    columns = [c.split()[0] for c in DOCUMENT.split(", ")]
    return joined.select(*[(own[c] if c in own else F.col(c)).alias(c) for c in columns])


def embedder(config: EngineConfig):
    """The embedding function that the settings name: `module:function` gives a loader of one's own, a folder with an ONNX
    model is loaded there; without either a stand-in drawn from each text's hash, with a warning."""
    if config.embedding_loader:
        module, _, name = config.embedding_loader.partition(":")
        return vectors.model_embedding(getattr(importlib.import_module(module), name), config.batch_size)
    if Path(config.embedding_model, "model.onnx").exists():
        return vectors.model_embedding(partial(vectors.onnx_model, config.embedding_model), config.batch_size)
    log.warning("no model for %s here: vectors are drawn from each text's hash", config.embedding_model)
    return vectors.hash_embedding(config.embedding_dimension)


def known_metadata(spark: SparkSession, path: str, tables: store.TableStore) -> DataFrame:
    """The spreadsheets' rows, stored. Files that can't be read are left out and named in a warning, the others count; where
    there are none at all, documents come in without metadata, with a warning."""
    try:
        tables.write("metadata_rows", metadata.read_rows(spark, path))
        rows = tables.stored("metadata_rows").drop("bucket").filter(F.col("source").isNotNull())
        bad = metadata.unreadable(rows)
        for r in bad.limit(NAMED_FILES).collect():
            log.warning("metadata file left out: %s (%s)", r["source"], r["error"].split(":")[0])
        tables.write("metadata", metadata.latest(rows))
    except AnalysisException as error:  # no such folder
        log.warning("metadata left out: %s", type(error).__name__)
        tables.write("metadata", spark.createDataFrame([], ", ".join(f"{c} string" for c in ("source", *metadata.COLUMNS))))
    return tables.read("metadata")


def ingest(spark: SparkSession, config: EngineConfig, tables: store.TableStore, incremental: bool = True, paths: list[str] | None = None) -> DataFrame:
    """Bring the stored tables up to the files; one row of counters (processed, skipped, failed, total_chunks, excluded,
    superseded).

    paths: single files or folders instead of the configured ones. A first scan reads hashes only; what has changed is
    read once more by its paths, so no content is shuffled to learn that it is known. Files in folders that driver and
    executors share are listed and opened by tasks; others by Spark's readers, whose driver holds their names. Of several files with one doc_id the
    last one counts (latest_files); the others are superseded. The parse is written once, beside the tables, and
    everything else reads that. Documents without any chunk count as processed but aren't stored. Only touched buckets are
    rewritten, documents last: a run that breaks off leaves their old hashes, so the next one does the work again.
    """
    now = F.lit(datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None))
    folders = paths or config.data_folders()
    shared = listing.shared_roots(spark, folders)
    if shared:
        listed = listing.list_files(spark, tables.path("listed_files"), shared)
        tables.write("found_files", listing.hash_files(listed))
    else:
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folders)
        tables.write("found_files", odt.hash_files(spark, *folders))
    found = tables.read("found_files")
    latest = latest_files(found)
    todo = changed_files(latest, tables.read("documents")) if incremental else latest
    if shared:
        tables.write("parsed", listing.parse_documents(todo))
    else:
        # The driver lists every file anyway; these are some of their names.
        wanted = [r["path"] for r in todo.select("path").collect()]
        files = odt.read_files(spark, *(wanted or folders))
        tables.write("parsed", odt.parse_documents(files if wanted else files.limit(0)))
    parsed = tables.read("parsed")
    fine = parsed.filter(F.col("error").isNull())

    sections = fine.select("doc_id", F.explode("sections").alias("s")).select("doc_id", "s.*")
    pieces = chunking.chunk_sections(sections, chunking.recursive_splitter(config.chunk_size, config.chunk_overlap))
    head = text.is_boilerplate_table(F.col("text")) & (F.col("chunk_type") == "table") & F.lit(config.exclude_boilerplate_table)
    excluded = pieces.filter(head).groupBy("doc_id").agg(F.count("*").alias("excluded"))
    kept = store.renumber(pieces, ~head).withColumn("chunk_id", text.chunk_id(F.col("doc_id"), F.col("chunk_num")))
    embedded = kept.select("chunk_id", "doc_id", F.lit(1).alias("page_num"), "chunk_num", "chunk_type", "text", embedder(config)("text").alias("embedding"), now.alias("created_at"))
    tables.write("new_chunks", embedded)
    chunks = tables.read("new_chunks")
    counted = chunks.groupBy("doc_id").agg(F.count("*").alias("chunks"))
    kept_docs = fine.join(counted.select("doc_id"), "doc_id", "left_semi")

    documents = document_rows(kept_docs, known_metadata(spark, config.metadata_doc_list, tables), now)
    fields = permits.extract(kept_docs.select("doc_id", text.marked_text(F.col("sections")).alias("text")))
    permit_rows = fields.select("doc_id", *permits.stored(F.col("permit"))).withColumn("created_at", now).withColumn("updated_at", now)
    superseded = found.join(latest.select("path"), "path", "left_anti").select("path")
    beside = attachments_of(listed.select("path").join(superseded, "path", "left_anti")).join(kept_docs.select("doc_id"), "doc_id", "left_semi").withColumn("created_at", now)

    keys = counted.select("doc_id")
    tables.change("document_chunks", keys, lambda old: store.replace_children(old, chunks))
    tables.change("attachments", keys, lambda old: store.replace_children(old, beside, replaced=keys))
    tables.change("permit_extractions", keys, lambda old: store.upsert(old, permit_rows, "doc_id", now))
    tables.change("documents", keys, lambda old: store.upsert(old, documents, "doc_id", now))

    status = F.when(F.col("error").isNull(), "processed").otherwise("failed")
    results = parsed.select("doc_id", status.alias("status")).join(counted, "doc_id", "left").join(excluded, "doc_id", "left").select("status", "chunks", "excluded")
    # What was not parsed was skipped, unless another file stood for its document.
    others = found.join(parsed.select(F.col("file_path").alias("path")), "path", "left_anti").join(superseded, "path", "left_anti")
    skipped = others.select(F.lit("skipped").alias("status"), F.lit(0).cast("long").alias("chunks"), F.lit(0).cast("long").alias("excluded"))
    return stats.run_counters(results.unionByName(skipped)).join(F.broadcast(superseded.agg(F.count("*").alias("superseded"))))


def sync_to_mirror(source: store.TableStore, mirror: store.TableStore) -> DataFrame:
    """Copy the managed tables, and permits if the mirror has such a table; (table, n) of what the managed ones carry.

    Only documents that differ in any of these tables are carried, so a second sync rewrites no bucket. Documents come
    last, so a sync that breaks off is done again by the next.
    """
    names = [*store.MANAGED_MIRROR_TABLES, *(["permit_extractions"] if mirror.exists("permit_extractions") else [])]
    tables = {name: source.read(name) for name in names}
    differing = reduce(DataFrame.unionAll, [store.differing_keys(store.mirrored(tables[name], name), mirror.read(name)) for name in names]).distinct()
    mirror.write("changed_keys", differing.join(tables["documents"].select("doc_id"), "doc_id", "left_semi"))
    keys = mirror.read("changed_keys")
    changed = {name: df.join(keys, "doc_id", "left_semi").select(df.columns) for name, df in tables.items()}
    for name in [*[n for n in names if n != "documents"], "documents"]:
        mirror.change(name, keys, lambda old, name=name: store.sync_mirror(changed, {n: old if n == name else mirror.read(n) for n in names})[name])
    return store.sync_counts(tables)


def create_mirror(mirror: store.TableStore, permits_too: bool = False) -> None:
    spark = mirror.spark
    for name in [*store.MANAGED_MIRROR_TABLES, *(["permit_extractions"] if permits_too else [])]:
        mirror.write(name, store.mirrored(spark.createDataFrame([], TABLES[name]), name))
