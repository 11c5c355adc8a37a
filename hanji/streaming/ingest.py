"""Continuous ingestion: files that arrive go through the batch plan, as often as there are new ones."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hanji.config import EngineConfig
from hanji.operators import store
from hanji.plans import ingest

#: What a stream of files says of each; only the path is asked for, so no content is read.
FILES = "path string, modificationTime timestamp, length long, content binary"
#: One row for each batch that is done: the stream's name, its number and the counters of the ingest.
BATCHES = "stream string, batch_id long, processed long, skipped long, failed long, total_chunks long, excluded long, superseded long"


def follow(source: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str, name: str | None = None) -> StreamingQuery:
    """Run `apply` on each batch of a streaming DataFrame until all that is there has been read.

    The checkpoint stands for a lock file: a batch that failed is run again with the same rows, so `apply` has to be
    idempotent, as upserts by key are.
    """
    writer = source.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return (writer.queryName(name) if name else writer).start()


def follow_files(spark: SparkSession, root: str, schema: str, apply: Callable[[DataFrame, int], None], checkpoint: str, kind: str = "parquet", per_batch: int = 1000) -> StreamingQuery:
    """As `follow`, over the files of a folder. A file that changes in place isn't seen again: write beside and move."""
    return follow(spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).format(kind).load(root), apply, checkpoint)


def batch_table(tables: store.TableStore) -> store.TableStore:
    """The batches that are done, in a store of their own beside the others."""
    done = store.TableStore(tables.spark, tables.path("batches"), 1, key="stream")
    if not done.exists("batches"):
        done.write("batches", tables.spark.createDataFrame([], BATCHES))
    return done


def once(tables: store.TableStore, stream: str, work: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """A function for foreachBatch that does a batch's work once: `work` gives one row of counters, which is kept under the
    batch's number after all else is written. A batch whose number is kept is passed over; one that broke off before
    that is done again, and what it had stored already counts as unchanged then."""
    done = batch_table(tables)

    def apply(batch: DataFrame, batch_id: int) -> None:
        if not done.read("batches").filter((F.col("stream") == stream) & (F.col("batch_id") == batch_id)).isEmpty():
            return
        counted = work(batch).select(F.lit(stream).alias("stream"), F.lit(batch_id).cast("long").alias("batch_id"), *[c.split()[0] for c in BATCHES.split(", ")[2:]])
        done.append("batches", counted)

    return apply


def follow_documents(spark: SparkSession, config: EngineConfig, tables: store.TableStore, checkpoint: str, per_batch: int = 1000, glob: str = "*.odt", stream: str = "documents") -> StreamingQuery:
    """Take in the documents below the configured folders that no earlier run of this stream has seen, per_batch files at a
    time, by the batch plan.

    The tables are the same as after one batch run over all files, but for the times of writing. A batch's files are named
    by their paths (per_batch of them), so their contents are read where they are parsed and nowhere else.
    """
    reader = spark.readStream.schema(FILES).format("binaryFile").option("maxFilesPerTrigger", per_batch).option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    folders = config.data_folders()
    source = reader.load(folders[0] if len(folders) == 1 else "{" + ",".join(folders) + "}")

    def work(batch: DataFrame) -> DataFrame:
        return ingest.ingest(spark, config, tables, paths=[r["path"] for r in batch.select("path").collect()])

    return follow(source, once(tables, stream, work), checkpoint, f"hanji-{stream}")
