"""Raw JSON-lines batches."""

from __future__ import annotations

import re
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from loglake.contract import REQUIRED_COLUMNS, MissingColumnsError

PROVENANCE = ("_source_file", "_ingested_at", "ingest_date")


def read_json_lines(
    spark: SparkSession, paths: str | list[str], schema: T.StructType | None = None, **options
) -> DataFrame:
    """All JSON-lines files below ``paths``. A line that does not parse fills
    ``_corrupt_record``. Without a schema Spark reads the files once to infer it."""
    reader = spark.read.option("recursiveFileLookup", True).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(paths)


def file_name() -> Column:
    """Name of the file a row is from, in the one form that listings also use."""
    return F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:///")


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Unparsed lines (``value``) with the file each is from."""
    lines = spark.read.option("recursiveFileLookup", True).text(paths)
    return lines.select("value", file_name().alias("_source_file"))


def with_provenance(df: DataFrame, ingested_at: datetime | None = None) -> DataFrame:
    """Add file, arrival time (one per query) and the event's UTC day."""
    arrival = F.current_timestamp() if ingested_at is None else F.lit(ingested_at).cast("timestamp")
    return df.select(
        "*",
        file_name().alias("_source_file"),
        arrival.alias("_ingested_at"),
        F.to_date(F.col("event_time").try_cast("timestamp")).alias("ingest_date"),
    )


def require_event_columns(raw: DataFrame) -> None:
    """Stop before reading on when no file of the batch has a field all events have."""
    absent = set(REQUIRED_COLUMNS).difference(raw.columns)
    if absent:
        raise MissingColumnsError("fields absent from the raw batch: " + ", ".join(sorted(absent)))


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(_source_file) of all files below ``path`` that hold anything, named as their rows name them.

    Only the listing that any scan makes: no file is opened, and no name leaves Spark. A file of
    no bytes is not there yet; it may be one that is still to be written.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(file_name().alias("_source_file"))


def as_paths(names: list[str]) -> list[str]:
    """Paths to read exactly these files: names come URL-encoded, and readers take globs."""
    return [re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(name)) for name in names]
