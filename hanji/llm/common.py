"""What several operators need: tables staged in the shared folder, and connected components."""

from __future__ import annotations

import tempfile
import uuid
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Code points that separate words: space, tab to carriage return. Everything else belongs to a word.
WORD = r"[^\x20\x09-\x0D]+"

#: Share of a table's rows above which a join key is hot: there can be no more than so many hot keys.
HOT_KEYS = 1000
#: Rows of a bitmap, 64 numbers each, up to which it is broadcast.
BITMAP_ROWS = 1 << 22

_own_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which driver and executors share. Where it is unset, a session with a local
    master gets a folder of its own; on a cluster that would be several machines' own folders, so it is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_folders:
        _own_folders[app] = tempfile.mkdtemp(prefix="hanji-")
    return _own_folders[app]


def staging_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/hanji-staged/{spark.sparkContext.applicationId}"


def clear_staged(spark: SparkSession) -> None:
    """Remove what this application has staged. For the end of a job: results that are read from staged tables must have
    been written by then."""
    assert spark.sparkContext._jvm is not None
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(staging_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back.

    This cuts the lineage with files that outlive any executor, computes what several readers need once, and gives
    Spark the true size of small tables, by which it decides whether to broadcast them. Texts take a third less room by
    Zstandard than by Spark's default.
    """
    spark = df.sparkSession
    path = f"{staging_folder(spark)}/{uuid.uuid4().hex}-{label}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def join_hot(many: DataFrame, one: DataFrame, keys: list[str], how: str = "inner", counted: str | None = None) -> DataFrame:
    """many.join(one, keys, how) for a `one` that has one row for each key, whatever share of `many` a key holds.
    counted: a column of `one` that already says how many rows of `many` a key has.

    A key with more than a HOT_KEYS-th of the rows of `many` is hot. There are fewer than HOT_KEYS such keys by
    arithmetic, so their rows of `one` are broadcast and no task has to take all of a hot key's rows; the others are
    shuffled as ever. `many` is read twice, so it should be a stored table.
    """
    key = F.xxhash64(*keys)
    counts = one.select(key.alias("hash"), F.col(counted).alias("count")) if counted else many.groupBy(key.alias("hash")).count()
    total = many.count()
    hot = [r["hash"] for r in counts.filter(F.col("count") > total / HOT_KEYS).select("hash").collect()]
    if not hot:
        return many.join(one, keys, how)
    is_hot = key.isin(hot)
    near = many.filter(is_hot).join(F.broadcast(one.filter(is_hot)), keys, how)
    return near.unionByName(many.filter(~is_hot).join(one, keys, how))


def marked(rows: DataFrame, numbers: DataFrame, number: str, bitmap_rows: int = BITMAP_ROWS) -> DataFrame:
    """Rows with a boolean `marked`: whether their `number` (a column of both, of numbers that lie close together) is among
    `numbers`.

    The numbers travel as bitmaps of 64, so rows that carry whole texts stay where they are instead of being shuffled to
    meet a number. Beyond `bitmap_rows` bitmaps (some 64 times as many rows) Spark chooses the join.
    """
    at = F.shiftright(number, 6).alias("bitmap_at")
    bit = F.col(number).bitwiseAND(63).cast("int")
    bitmaps = staged(numbers.groupBy(at).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("bitmap")), "bitmaps")
    found = rows.withColumn("bitmap_at", at).join(F.broadcast(bitmaps) if bitmaps.count() <= bitmap_rows else bitmaps, "bitmap_at", "left")
    is_set = F.call_function("shiftright", F.col("bitmap"), bit).bitwiseAND(1) == 1
    return found.withColumn("marked", F.coalesce(is_set, F.lit(False))).drop("bitmap_at", "bitmap")


def in_order(rows: DataFrame, *order: Column) -> DataFrame:
    """Stored rows with `position`, from 0, in the order given, which should leave no two rows equal.

    Ranges of rows are sorted side by side and staged, each row with its place in its range. The driver gets one count for
    each range and sends back where it starts. Rows of an equal order would share a range.
    """
    spark = rows.sparkSession
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    placed = staged(placed, "in-order").withColumn("range", F.shiftright("place", 33))  # the id's high bits number the task
    counts = sorted(tuple(r) for r in placed.groupBy("range").count().collect())
    starts = accumulate((n for _, n in counts), initial=0)
    firsts = spark.createDataFrame([(r, start - (r << 33)) for (r, _), start in zip(counts, starts, strict=False)], "range long, first long")
    return placed.join(F.broadcast(firsts), "range").withColumn("position", F.col("place") + F.col("first")).drop("range", "place", "first")


def connected_components(edges: DataFrame) -> DataFrame:
    """edges (a long, b long) -> (node long, component long): the smallest node that each node reaches.

    Labels start at the smallest neighbour and shrink each round: over every edge, then by one jump to the label's own
    label, so that the rounds grow with the logarithm of a chain's length. Minima are combined before they are
    shuffled, and the joins take hubs with very many neighbours and components with very many nodes by join_hot, so
    neither is a single task's work. Each round is staged. Loops (a = b) give a component of one. An empty input gives
    an empty result.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = staged(both, "edges")
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("component")), "labels")
    while True:
        near = join_hot(both, labels.select(F.col("node").alias("b"), "component"), ["b"]).groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        met = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        met = staged(met, "met")
        of_label = labels.select(F.col("node").alias("component"), F.col("component").alias("jump"))
        # Every label is itself a node, so the inner join keeps all rows.
        new = staged(join_hot(met, of_label, ["component"]).select("node", "old", F.least("component", "jump").alias("component")), "labels")
        if new.filter("component < old").isEmpty():
            return new.select("node", "component")
        labels = new.select("node", "component")
