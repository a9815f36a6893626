"""Which raw files a table has taken in, kept beside the table.

<path>/_ledger   a row per file: its name, the rows it brought, and the run that brought it
<path>/_runs     the run that is being written, or the last one, and whether it is still open
<path>/_dead     runs that died before they were closed

A run is opened, writes its rows to partitions of its own (``_run``), enters its files in the
ledger and is closed. Until then neither its rows nor its entries count. The next run that
finds it open declares it dead and takes in the same files anew, so a file is taken in
whole and once, however the run before ended, also a file without any row.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from loglake.sources.tables import read_appended, read_if_exists

RUN = "_run"
_LEDGER = T.StructType(
    [
        T.StructField("_source_file", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField(RUN, T.StringType()),
    ]
)
_STATE = T.StructType([T.StructField(RUN, T.StringType()), T.StructField("open", T.BooleanType())])
_DEAD = T.StructType([_STATE[RUN]])


def _open_run(spark: SparkSession, path: str) -> str | None:
    state = read_if_exists(spark, f"{path}/_runs", _STATE, "json")
    row = None if state is None else state.where("open").first()
    return None if row is None else row[RUN]


def _not_counted(spark: SparkSession, path: str) -> list[str]:
    """Runs that are dead or open: one for each time that a driver was lost."""
    dead = read_if_exists(spark, f"{path}/_dead", _DEAD, "json")
    runs = set() if dead is None else {r[RUN] for r in dead.distinct().collect()}
    return sorted(runs | {_open_run(spark, path)} - {None})


def closed_rows(rows: DataFrame, path: str) -> DataFrame:
    """Rows of a table or its ledger without those of runs that were not closed."""
    runs = _not_counted(rows.sparkSession, path) if RUN in rows.columns else []
    return rows.where(F.col(RUN).isNull() | ~F.col(RUN).isin(runs)) if runs else rows


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """(_source_file, rows, _run) of all files taken in; none before the first run."""
    held = read_if_exists(spark, f"{path}/_ledger", _LEDGER)
    return spark.createDataFrame([], _LEDGER) if held is None else closed_rows(held, path)


def not_taken_in(files: DataFrame, path: str) -> DataFrame:
    """Those of the files that are not in the ledger: two lists of names, no row of the table."""
    return files.join(ledger(files.sparkSession, path).select("_source_file"), "_source_file", "left_anti")


def begin_run(spark: SparkSession, path: str) -> str:
    """Open a run. One found open is dead; a table from before ledgers gets one."""
    found = _open_run(spark, path)
    if found is not None:
        spark.range(1).select(F.lit(found).alias(RUN)).coalesce(1).write.mode("append").json(f"{path}/_dead")
    run = f"r{uuid.uuid4().hex}"
    _mark(spark, path, run, True)
    return run


def adopt(spark: SparkSession, path: str) -> None:
    """Give a table from before there were ledgers one with the files of its rows."""
    if read_if_exists(spark, f"{path}/_ledger", _LEDGER) is not None:
        return
    table = read_appended(spark, path)
    if table is not None and "_source_file" in table.columns and RUN not in table.columns:
        rows = table.groupBy("_source_file").agg(F.count("*").alias("rows"))
        rows.withColumn(RUN, F.lit("before")).write.parquet(f"{path}/_ledger")


def close_run(entries: DataFrame, path: str, run: str) -> None:
    """Enter (_source_file, rows) in the ledger; from then on the run counts."""
    columns = ("_source_file", F.col("rows").cast("long").alias("rows"), F.lit(run).alias(RUN))
    entries.select(*columns).write.mode("append").parquet(f"{path}/_ledger")
    _mark(entries.sparkSession, path, run, False)


def _mark(spark: SparkSession, path: str, run: str, open_: bool) -> None:
    # A driver lost in here leaves no state: nothing is written yet, or everything is.
    row = spark.range(1).select(F.lit(run).alias(RUN), F.lit(open_).alias("open"))
    row.coalesce(1).write.mode("overwrite").json(f"{path}/_runs")
