"""Typing and de-duplication of a batch, and the choice of which rows are new."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from loglake.contract import SILVER_SCHEMA
from loglake.functions.columns import latest_first


def clean_and_type(df: DataFrame) -> DataFrame:
    """Give the columns their types. A value that does not parse becomes null.

    ``ingest_date`` is the UTC day of the parsed event time.
    """
    return df.withColumns(
        {
            "status_code": F.col("status_code").try_cast("int"),
            "latency_ms": F.col("latency_ms").try_cast("int"),
            "event_time": F.col("event_time").try_cast("timestamp"),
            "endpoint": F.trim("endpoint"),
            "method": F.upper(F.trim("method")),
            "ingest_date": F.to_date(F.col("event_time").try_cast("timestamp")),
        }
    )


def to_contract(df: DataFrame) -> DataFrame:
    """Exactly the silver columns; those a batch does not have yet are null."""
    present = set(df.columns)
    return df.select(
        *(
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in SILVER_SCHEMA
        )
    )


def keep_latest(df: DataFrame, key: str = "event_id") -> DataFrame:
    """One row per key, the newest. Rows without a key are all kept.

    Spark cuts each key to one row before the shuffle (WindowGroupLimit), so a
    key with very many copies sends one row per map task. Rows without a key go
    round the shuffle altogether.
    """
    newest = Window.partitionBy(key).orderBy(*latest_first(df))
    keyed = (
        df.where(F.col(key).isNotNull())
        .withColumn("_version", F.row_number().over(newest))
        .where(F.col("_version") == 1)
        .drop("_version")
    )
    return keyed.unionByName(df.where(F.col(key).isNull()))


def watermark(silver: DataFrame) -> DataFrame:
    """One row: the newest arrival time in silver, null when it is empty."""
    return silver.agg(F.max("_ingested_at").alias("watermark"))


def arrived_after(df: DataFrame, newest_seen: Column | None) -> DataFrame:
    """Rows that arrived strictly after the watermark; all rows without one.

    Where the table carries ``_arrival_date`` as a partition, whole days are
    pruned before any file is opened.
    """
    if newest_seen is None:
        return df
    if "_arrival_date" in df.columns:
        df = df.where(F.col("_arrival_date") >= F.to_date(newest_seen))
    return df.where(F.col("_ingested_at") > newest_seen)


def arrived_between(df: DataFrame, start: Column, end: Column) -> DataFrame:
    """Rows that arrived in [start, end): the backfill counterpart of arrived_after."""
    if "_arrival_date" in df.columns:
        df = df.where(F.col("_arrival_date").between(F.to_date(start), F.to_date(end)))
    return df.where((F.col("_ingested_at") >= start) & (F.col("_ingested_at") < end))


def source_files(df: DataFrame) -> DataFrame:
    return df.select("_source_file").distinct()


def without_known_files(df: DataFrame, known_files: DataFrame) -> DataFrame:
    """Rows of files not ingested before. Spark broadcasts the list if it is small
    enough when measured; else it sort-merges and splits a file that is too large."""
    return df.join(known_files.select("_source_file"), "_source_file", "left_anti")
