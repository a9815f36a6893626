"""The same steps driven by Structured Streaming.

A micro-batch is what arrived since the last one. Events are selected by arrival,
never by event time, so late ones are merged like any other; an event-time
watermark would drop them.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.query import StreamingQuery

from loglake.operators.cleaning import without_known_files
from loglake.plans.jobs import (
    BRONZE_PARTITIONS,
    FILES_AT_ONCE,
    bronze_rows,
    bronze_to_silver,
    incoming_schema,
    new_files,
)
from loglake.sources.ledger import adopt, begin_run, close_run, ledger
from loglake.sources.raw import require_event_columns
from loglake.sources.tables import append_with_evolution, read_appended, scratch_table


def raw_stream(
    spark: SparkSession,
    raw_path: str,
    bronze_path: str,
    schema: T.StructType | None = None,
    **options,
) -> DataFrame:
    """Raw files as a stream. All files there are when it starts set its schema,
    unless one is given, so that fields bronze does not have yet come along."""
    if schema is None:
        listed, fresh = new_files(spark, raw_path, bronze_path)
        fresh = scratch_table(fresh, "new-files")
        others_there = listed.count() > fresh.count()
        names = (r._source_file for r in fresh.toLocalIterator())
        schema = incoming_schema(spark, names, others_there, bronze_path, FILES_AT_ONCE)
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True).options(**options)
    stream = reader.json(raw_path)
    require_event_columns(stream)
    return stream


def append_bronze(batch: DataFrame, bronze_path: str) -> None:
    """Append a micro-batch as a run; when Spark repeats one, its files are in the ledger."""
    spark = batch.sparkSession
    adopt(spark, bronze_path)
    known = ledger(spark, bronze_path)
    batch = without_known_files(batch, known).select(*batch.columns)
    run = begin_run(spark, bronze_path)
    append_with_evolution(batch, bronze_path, BRONZE_PARTITIONS, run)
    written = read_appended(spark, bronze_path).where(F.col("_run") == run)
    close_run(written.groupBy("_source_file").agg(F.count("*").alias("rows")), bronze_path, run)


def stream_to_bronze(
    spark: SparkSession,
    raw_path: str,
    bronze_path: str,
    checkpoint_path: str,
    ingested_at: datetime | None = None,
    schema: T.StructType | None = None,
    **options,
) -> StreamingQuery:
    """Ingest all files the checkpoint has not seen, then stop."""
    rows = bronze_rows(raw_stream(spark, raw_path, bronze_path, schema, **options), ingested_at)
    return (
        rows.writeStream.foreachBatch(lambda batch, _: append_bronze(batch, bronze_path))
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )


def stream_to_silver(
    spark: SparkSession,
    raw_path: str,
    lake_path: str,
    checkpoint_path: str,
    schema: T.StructType | None = None,
    limits: Mapping[str, float] | None = None,
    **options,
) -> StreamingQuery:
    """Ingest and merge micro-batch by micro-batch. ``limits`` are those of the gate.

    A batch that fails the gate stops the query; the checkpoint then still holds
    it, and a restart meets it again.
    """

    def step(batch: DataFrame, _: int) -> None:
        append_bronze(batch, f"{lake_path}/bronze")
        bronze_to_silver(
            batch.sparkSession,
            f"{lake_path}/bronze",
            f"{lake_path}/silver",
            f"{lake_path}/quarantine",
            **(limits or {}),
        )

    return (
        bronze_rows(raw_stream(spark, raw_path, f"{lake_path}/bronze", schema, **options))
        .writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
