"""Data contract of the lake: columns, types and the limits rows must keep."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values -----------------------------------------------------------
# These must be exactly so for results to be right: field names and types of a
# request event, the values the gate and the data tests accept, and the names
# and detail formats of the gate's report.

REQUIRED_COLUMNS = (
    "event_id",
    "event_time",
    "endpoint",
    "method",
    "status_code",
    "latency_ms",
    "user_id",
    "country",
    "ingest_batch_id",
)

VALID_METHODS = ("GET", "POST", "PUT", "PATCH", "DELETE", "HEAD", "OPTIONS")
MIN_STATUS, MAX_STATUS = 100, 599
KNOWN_STATUS_CODES = (200, 201, 204, 301, 302, 400, 401, 403, 404, 429, 500, 502, 503)
MAX_LATENCY_MS = 30_000
NULL_RATE_THRESHOLD = 0.01
NULL_CHECKED_COLUMNS = ("event_id", "event_time", "endpoint", "status_code", "user_id")
FRESHNESS_HOURS = 2
TOP_ENDPOINTS = 15
NO_RUN_TEXT = "no successful run recorded yet"

# Type changes a table may take on by itself, in Spark's own type names.
SAFE_WIDENING = (
    ("int", "bigint"),
    ("int", "double"),
    ("bigint", "double"),
    ("float", "double"),
)
# ----------------------------------------------------------------------------

# Other spellings of the type names above.
TYPE_ALIASES = {"integer": "int", "long": "bigint"}

# One row per event: nine required fields, three that later producers add, and
# three set at ingest.
SILVER_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("endpoint", T.StringType()),
        T.StructField("method", T.StringType()),
        T.StructField("status_code", T.IntegerType()),
        T.StructField("latency_ms", T.IntegerType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("ingest_batch_id", T.StringType()),
        T.StructField("user_agent", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("is_authenticated", T.BooleanType()),
        T.StructField("_source_file", T.StringType()),
        T.StructField("_ingested_at", T.TimestampType()),
        T.StructField("ingest_date", T.DateType()),
    ]
)

# Raw JSON fields as inference types them; used where a stream needs a schema.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("event_time", T.StringType()),
        T.StructField("endpoint", T.StringType()),
        T.StructField("method", T.StringType()),
        T.StructField("status_code", T.LongType()),
        T.StructField("latency_ms", T.LongType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("ingest_batch_id", T.StringType()),
        T.StructField("user_agent", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("is_authenticated", T.BooleanType()),
        T.StructField("_corrupt_record", T.StringType()),
    ]
)


class MissingColumnsError(ValueError):
    """A raw batch lacks columns every event must have."""


class SchemaEvolutionError(Exception):
    """An incoming batch changes a table's schema in a way that needs a person."""


class QualityGateError(Exception):
    """A batch failed the quality gate; ``report`` holds the rows of the report."""

    def __init__(self, report: list, summary: str):
        super().__init__(summary)
        self.report = report
        self.summary = summary
