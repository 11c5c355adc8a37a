"""Command line: init-db, run, index, search, show, stats, images, sync-to-mirror."""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from hanji.config import EngineConfig, clean_query, in_range
from hanji.functions import keywords
from hanji.operators import lookups, search, stats, store, vector_index
from hanji.plans import ingest
from hanji.session import spark_session
from hanji.sources import hwp
from hanji.streaming import ingest as streaming


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="hanji")
    parser.add_argument("--store", default="store")
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("init-db").add_argument("--buckets", type=int, help="into how many parts each table is cut; fixed from then on")
    run = commands.add_parser("run")
    run.add_argument("-d", "--data", action="append", required=True)
    run.add_argument("-m", "--metadata", required=True)
    run.add_argument("--chunk-size", type=int, default=1024)
    run.add_argument("--chunk-overlap", type=int, default=128)
    run.add_argument("--dimension", type=int, default=1024)
    run.add_argument("--exclude-boilerplate-table", action="store_true")
    run.add_argument("--full", action="store_true", help="read unchanged files too")
    run.add_argument("--file", action="append", help="only this file or folder; may be given more than once")
    run.add_argument("--follow", metavar="CHECKPOINT", help="take in what no earlier run with this checkpoint has seen, batch by batch")
    run.add_argument("--files-per-batch", type=int, default=1000)
    run.add_argument("--mirror", help="bring this mirror up to the store afterwards")
    run.add_argument("--batch-size", type=int, default=32)
    run.add_argument("--model", default="BAAI/bge-m3", help="an allowed name, or a folder with an ONNX model")
    run.add_argument("--allow-model", action="append", default=[], help="one more allowed name")
    run.add_argument("--loader", help="module:function that loads a model")
    run.add_argument("--log-level", default="INFO")
    find = commands.add_parser("search")
    find.add_argument("query")
    find.add_argument("-k", "--top-k", type=int, default=10)
    find.add_argument("--keyword")
    find.add_argument("--weight", type=float, default=search.DEFAULT_WEIGHT)
    find.add_argument("--biz-cate", help="only documents of this class (vector search)")
    find.add_argument("--probes", type=int, default=vector_index.PROBES, help="lists of the index that are read; all of them equal a scan")
    find.add_argument("--scan", action="store_true", help="read all vectors even if there is an index")
    find.add_argument("--dimension", type=int, default=1024)
    find.add_argument("--model", default="BAAI/bge-m3")
    find.add_argument("--allow-model", action="append", default=[])
    find.add_argument("--loader")
    commands.add_parser("index").add_argument("--lists", type=int, default=vector_index.LISTS)
    show = commands.add_parser("show")
    show.add_argument("doc_id")
    commands.add_parser("stats")
    images = commands.add_parser("images")
    images.add_argument("-d", "--data", action="append", required=True)
    images.add_argument("--out", required=True)
    commands.add_parser("sync-to-mirror").add_argument("--mirror", required=True)
    return parser


def model_of(args: argparse.Namespace) -> dict:
    allowed = (*EngineConfig().allowed_models, *args.allow_model)
    return {"embedding_model": args.model, "embedding_loader": args.loader, "allowed_models": allowed}


def main(argv: list[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    spark = spark_session()
    tables = store.TableStore(spark, args.store, getattr(args, "buckets", None))
    if args.command == "init-db":
        ingest.create_tables(tables)
    elif args.command == "run":
        config = EngineConfig(
            store_root=args.store, data_dirs=tuple(args.data), metadata_doc_list=args.metadata, chunk_size=args.chunk_size,
            chunk_overlap=args.chunk_overlap, embedding_dimension=args.dimension, exclude_boilerplate_table=args.exclude_boilerplate_table,
            batch_size=args.batch_size, log_level=args.log_level, **model_of(args),
        )
        logging.basicConfig(level=config.log_level)
        if args.follow:
            streaming.follow_documents(spark, config, tables, args.follow, args.files_per_batch).awaitTermination()
            streaming.batch_table(tables).read("batches").orderBy("batch_id").show(truncate=False)
        else:
            ingest.ingest(spark, config, tables, incremental=not args.full, paths=args.file).show(truncate=False)
        if args.mirror:
            sync(spark, tables, args.mirror)
    elif args.command == "search":
        in_range("top-k", args.top_k, 1, search.MAX_TOP_K)
        query = clean_query(args.query)
        asked = spark.range(1).select(F.lit(query).alias("q")).select(ingest.embedder(EngineConfig(embedding_dimension=args.dimension, **model_of(args)))("q").alias("v"), keywords.keyword(F.col("q")).alias("k")).first()
        assert asked is not None
        index = vector_index.VectorIndex(spark, tables.path("vector_index"))
        chunks = index.probed(asked["v"], in_range("probes", args.probes, 1)) if index.exists() and not args.scan else tables.read("document_chunks")
        hits = search.search(chunks, tables.read("documents"), search.literal_vector(asked["v"]), args.top_k, keyword=None if args.biz_cate else args.keyword or asked["k"], vector_weight=args.weight, filters={"biz_cate": args.biz_cate} if args.biz_cate else None)
        search.preview(hits).show(args.top_k, truncate=False)
    elif args.command == "index":
        vector_index.VectorIndex(spark, tables.path("vector_index")).build(tables.read("document_chunks"), in_range("lists", args.lists, 1))
    elif args.command == "stats":
        stats.store_stats(tables.read("documents"), tables.read("document_chunks")).show(truncate=False)
    elif args.command == "show":
        lookups.document(tables, args.doc_id).show(truncate=False, vertical=True)
        lookups.permit(tables, args.doc_id).drop("source_text").show(truncate=False, vertical=True)
        lookups.attachments(tables, args.doc_id).show(truncate=False)
        search.preview(lookups.chunks(tables, args.doc_id).drop("embedding")).show(truncate=False)
    elif args.command == "images":
        hwp.extract_images(spark, *args.data).write.parquet(args.out)
        stats.status_counts(spark.read.parquet(args.out)).show()
    else:
        sync(spark, tables, args.mirror)


def sync(spark: SparkSession, tables: store.TableStore, root: str) -> None:
    mirror = store.TableStore(spark, root)
    if not mirror.exists("documents"):
        ingest.create_mirror(mirror)
    ingest.sync_to_mirror(tables, mirror).show()


if __name__ == "__main__":
    main()
