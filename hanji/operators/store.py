"""Changes to tables as plain DataFrames: each takes the stored rows and gives what is to be stored."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

CHILD_TABLES = ("document_chunks", "attachments", "permit_extractions")
MANAGED_MIRROR_TABLES = ("documents", "document_chunks", "attachments")


def upsert(stored: DataFrame, new: DataFrame, key: str, now: Column | None = None) -> DataFrame:
    """Stored rows without the new keys, and the new rows. With `now`, rows have created_at, kept from the stored row,
    and updated_at, set on all new rows."""
    kept = stored.join(new.select(key), key, "left_anti").select(stored.columns)
    if now is not None:
        before = stored.select(key, F.col("created_at").alias("first_created"))
        new = new.join(before, key, "left").withColumn("created_at", F.coalesce("first_created", now)).withColumn("updated_at", now)
    return kept.unionByName(new.select(stored.columns))


def replace_children(stored: DataFrame, new: DataFrame, key: str = "doc_id", replaced: DataFrame | None = None) -> DataFrame:
    """All of a document's rows are replaced by its new ones. replaced: the documents whose rows go even without new
    ones; by default only those with new rows."""
    keys = (new if replaced is None else replaced).select(key).distinct()
    return stored.join(keys, key, "left_anti").select(stored.columns).unionByName(new.select(stored.columns))


def delete(tables: dict[str, DataFrame], ids: DataFrame, key: str = "doc_id") -> dict[str, DataFrame]:
    """Documents deleted with all that belongs to them: each table without the ids."""
    gone = ids.select(key).distinct()
    return {name: df.join(gone, key, "left_anti").select(df.columns) for name, df in tables.items()}


def affected(table: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    return table.join(ids.select(key).distinct(), key, "left_semi").agg(F.count("*").alias("affected"))


def keep_last(rows: DataFrame, key: str | list[str], *order: Column) -> DataFrame:
    """Of each key the last row in the given order. Only the order columns decide, so give a total one."""
    keys = [key] if isinstance(key, str) else key
    packed = F.struct(*[c.alias(f"o{k}") for k, c in enumerate(order)])
    # max_by combines before the shuffle, so a key with very many rows moves one row for each task.
    best = rows.withColumn("__order", packed).groupBy(*keys).agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in rows.columns]), F.col("__order")).alias("row"))
    return best.select("row.*")


def classify_changes(current: DataFrame, stored: DataFrame, key: str = "doc_id", hash_column: str = "file_hash") -> DataFrame:
    """current rows with `change`: new, update (another hash) or unchanged."""
    before = stored.select(key, F.col(hash_column).alias("stored_hash"))
    change = F.when(F.col("stored_hash").isNull(), "new").when(F.col("stored_hash") != F.col(hash_column), "update").otherwise("unchanged")
    return current.join(before, key, "left").withColumn("change", change).drop("stored_hash")


def with_defaults(rows: DataFrame, known: DataFrame, key: str, defaults: dict[str, str | int]) -> DataFrame:
    """rows with what is known of them; where nothing is, or the value is null, the columns named have their defaults."""
    joined = rows.join(known, key, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(value)) for c, value in defaults.items()})


def id_report(data: DataFrame, metadata: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, status): matched, missing_in_metadata or missing_in_data, for the distinct ids of both."""
    a = data.select(key).distinct().withColumn("in_data", F.lit(True))
    b = metadata.select(key).distinct().withColumn("in_metadata", F.lit(True))
    both = a.join(b, key, "full")
    status = F.when(F.col("in_metadata").isNull(), "missing_in_metadata").when(F.col("in_data").isNull(), "missing_in_data").otherwise("matched")
    return both.select(key, status.alias("status"))


def renumber(chunks: DataFrame, keep: Column) -> DataFrame:
    """Chunks that `keep` holds for, numbered again from 0 within their document."""
    order = Window.partitionBy("doc_id").orderBy("chunk_num")
    return chunks.filter(keep).withColumn("chunk_num", (F.row_number().over(order) - 1).cast("int"))


# The columns that a mirror's tables have, of those that the store's have.
MIRROR_COLUMNS = {
    "documents": (
        "doc_id", "doc_no", "title", "author_name", "dept_name", "report_date", "doc_year", "state_code", "state_name", "open_code", "open_name",
        "close_reason", "file_hash", "file_path", "biz_cate", "biz_sub_cate", "biz_detail_cate", "biz_full_path",
    ),
    "document_chunks": ("chunk_id", "doc_id", "page_num", "chunk_num", "chunk_type", "text", "embedding"),
    "attachments": ("doc_id", "file_name", "file_path", "file_order", "is_main_pdf"),
    "permit_extractions": (
        "doc_id", "org_nm", "ask_org_nm", "addr", "xtn", "purps_cn", "collection_volume", "permit_start_date", "permit_end_date", "amount", "confidence",
        "source_text",
    ),
}


def mirrored(table: DataFrame, name: str) -> DataFrame:
    """A stored table as its mirror has it: the mirror's columns, as far as they are there, and vectors as doubles."""
    columns = [c for c in MIRROR_COLUMNS[name] if c in table.columns]
    return table.select(*[F.col(c).cast("array<double>").alias(c) if c == "embedding" else F.col(c) for c in columns])


def sync_mirror(source: dict[str, DataFrame], target: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The mirror's tables after a full sync: documents are merged, their chunks, attachments and, where the target has
    that table, permits replaced (also by nothing). Documents that the source no longer has stay in the mirror. Documents
    come last, so a sync that breaks off is done again by the next."""
    docs = mirrored(source["documents"], "documents")
    parts = [name for name in CHILD_TABLES if name in MANAGED_MIRROR_TABLES or name in target]
    out = {name: replace_children(target[name], mirrored(source[name], name), replaced=docs) for name in parts}
    return out | {"documents": upsert(target["documents"], docs, "doc_id")}


def content_marks(table: DataFrame, key: str = "doc_id") -> DataFrame:
    """For each key the number of its rows and two sums over hashes of all their columns: equal for equal rows in any order,
    and combined before the shuffle, which carries no values."""
    columns = [F.col(f"`{c}`") for c in sorted(table.columns)]
    null_marks = F.concat(*[c.isNull().cast("string") for c in columns])  # hashes pass over nulls
    one, two = (F.xxhash64(F.lit(seed), null_marks, *columns) for seed in (1, 2))
    return table.groupBy(key).agg(F.count("*").alias("rows"), F.bit_xor(one).alias("one"), F.sum(two.cast("decimal(38,0)")).alias("two"))


def differing_keys(source: DataFrame, target: DataFrame, key: str = "doc_id") -> DataFrame:
    """The keys whose rows are not the same in both tables, those of only one of them too."""
    ours, theirs = (content_marks(t.select(*sorted(source.columns)), key).select(key, F.struct("rows", "one", "two").alias(name)) for t, name in ((source, "ours"), (target, "theirs")))
    return ours.join(theirs, key, "full").filter(~F.col("ours").eqNullSafe(F.col("theirs"))).select(key)


def sync_counts(source: dict[str, DataFrame]) -> DataFrame:
    """(table, n) of what a sync carries."""
    parts = [source[t].agg(F.count("*").alias("n")).select(F.lit(t).alias("table"), "n") for t in MANAGED_MIRROR_TABLES]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


class TableStore:
    """Tables as Parquet folders partitioned by a bucket of the key's hash, so a change rewrites the buckets that it
    touches and no others, and look-ups by key read one bucket.

    Buckets are replaced by Spark's dynamic partition overwrite: a job writes beside them and puts them in place when all
    its tasks are done, so a lost executor costs a retry. Rows with a null key mark buckets that may have no others; they
    are left out on reading. One writer at a time.

    `buckets` is fixed when the store is made and kept with it: the more data, the more. Whoever opens the store later
    gets its number, and one who asks for another an error. A bucket is several files where it is large.
    """

    BUCKETS, SETTINGS = 64, "_settings"

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None, key: str = "doc_id"):
        self.spark, self.root, self.key, self._made = spark, root.rstrip("/"), key, False
        stored = self._settings()
        if stored and buckets not in (None, stored["buckets"]):
            raise ValueError(f"the store has {stored['buckets']} buckets, not {buckets}")
        if stored and stored["key"] != key:
            raise ValueError(f"the store's key is {stored['key']}, not {key}")
        self.buckets, self._made = stored["buckets"] if stored else buckets or self.BUCKETS, bool(stored)

    def _settings(self) -> Row | None:
        return self.spark.read.json(self.path(self.SETTINGS), "buckets int, key string").first() if self.exists(self.SETTINGS) else None

    def _make(self) -> None:
        """Keep the number of buckets before anything is put into one."""
        if not self._made:
            settings = self.spark.createDataFrame([(self.buckets, self.key)], "buckets int, key string").coalesce(1)
            settings.write.mode("overwrite").json(self.path(self.SETTINGS))
            self._made = True

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int").alias("bucket")

    def exists(self, name: str) -> bool:
        reader = self.spark.read
        try:
            reader.json(self.path(name), "buckets int") if name == self.SETTINGS else reader.parquet(self.path(name))
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return False
        return True

    def stored(self, name: str) -> DataFrame:
        """All rows with their bucket, those without a key and marks too."""
        return self.spark.read.parquet(self.path(name))

    def read(self, name: str) -> DataFrame:
        return self.stored(name).filter(F.col(self.key).isNotNull()).drop("bucket")

    def lookup(self, name: str, *keys: str) -> DataFrame:
        """The rows of a few keys, from their buckets only."""
        wanted = self.spark.createDataFrame([(k,) for k in keys], f"{self.key} string").select(self.bucket()).distinct()
        buckets = [r["bucket"] for r in wanted.collect()]
        return self.stored(name).filter(F.col("bucket").isin(buckets) & F.col(self.key).isin(*keys)).drop("bucket")

    def _put(self, name: str, rows: DataFrame, mode: str, dynamic: bool = False) -> None:
        self._make()
        # A bucket's rows come together, and adaptive execution cuts large buckets into several tasks and files.
        writer = rows.hint("rebalance", "bucket").write.mode(mode).partitionBy("bucket")
        (writer.option("partitionOverwriteMode", "dynamic") if dynamic else writer.option("partitionOverwriteMode", "static")).parquet(self.path(name))

    def _marks(self, rows: DataFrame, buckets: list[int]) -> DataFrame:
        empty = self.spark.createDataFrame([(b,) for b in buckets], "bucket int")
        return empty.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema], "bucket")

    def write(self, name: str, rows: DataFrame) -> None:
        """The whole table anew. Not for a table that `rows` reads."""
        marked = rows.withColumn("bucket", self.bucket()).unionByName(self._marks(rows, [0]))
        self._put(name, marked, "overwrite")

    def append(self, name: str, rows: DataFrame) -> None:
        self._put(name, rows.withColumn("bucket", self.bucket()), "append")

    def change(self, name: str, keys: DataFrame, change: Callable[[DataFrame], DataFrame]) -> None:
        """Replace the stored rows of the keys' buckets by what `change` makes of them. Its rows must stay in these
        buckets, as all changes by key do."""
        touched = sorted(r["bucket"] for r in keys.select(self.bucket()).distinct().collect())  # `buckets` numbers at most
        if not touched:
            return
        old = self.stored(name).filter(F.col("bucket").isin(touched) & F.col(self.key).isNotNull()).drop("bucket")
        new = change(old)
        self._put(name, new.withColumn("bucket", self.bucket()).unionByName(self._marks(new, touched)), "overwrite", dynamic=True)
