"""Session settings and the shared folder for staged tables."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


#: At least so many tasks list the folders of a table or of raw files, and some for each core.
LISTING_TASKS = 64
LISTING_TASKS_PER_CORE = 4
#: Bytes of an Arrow batch, of which a task holds a few in Spark and in Python.
BATCH_BYTES = 4 << 20


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the lake relies on; cluster sizing stays outside."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Settings the lake relies on: days are UTC days, and plans adapt to skew.

    Forcing the skew rule lets Spark split a hot join partition also where the step
    after the join could have used the join's own partitioning. Spark lists files with a
    task per folder, up to 10,000, each of which reports to the driver; a few per core
    list as fast.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    tasks = max(LISTING_TASKS, LISTING_TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(tasks))
    return spark


def bound_batches(spark: SparkSession) -> None:
    """Keep what goes to Python at a time small, however long the texts; Spark's own bound is 64 MB."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors reach, as the cluster names it in spark.checkpoint.dir.

    Only a local session may go without the setting: it then gets a temporary
    folder, kept for the life of the session.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by the cluster")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="loglake-"))
    return context.getCheckpointDir().rstrip("/")
