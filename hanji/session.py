"""The Spark session that the command line, the bench and the tests share."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

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


def spark_session(app: str = "hanji", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC; on a cluster, `master` stays with spark-submit."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Columns of some thousand parts are built faster without a note of the line that made each part.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            cpus = os.cpu_count() or 4
            builder = builder.config("spark.sql.shuffle.partitions", str(min(cpus, 8)))
            builder = builder.config("spark.driver.memory", os.environ.get("HANJI_DRIVER_MEMORY", "8g"))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def spread(rows: DataFrame) -> DataFrame:
    """Rows of a few files dealt to all cores, before work that costs far more than to move its input. Tables in as many
    partitions as there are cores, so all large ones, stay as they are."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores)
