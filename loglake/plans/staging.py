"""Staging: silver under the names the marts build on."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from loglake.functions.columns import is_client_error, is_server_error


def stg_logs(silver: DataFrame) -> DataFrame:
    status = F.col("status_code")
    return silver.select(
        "event_id",
        F.col("event_time").cast("timestamp").alias("event_ts"),
        F.date_trunc("day", "event_time").alias("event_date"),
        "endpoint",
        "method",
        "status_code",
        is_server_error(status).alias("is_server_error"),
        is_client_error(status).alias("is_client_error"),
        "latency_ms",
        "user_id",
        "country",
        "ingest_batch_id",
        "user_agent",
        "session_id",
        "is_authenticated",
        "_ingested_at",
    )
