"""Column expressions shared by the layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def is_server_error(status: Column) -> Column:
    """True from 500 up; a missing status is no error."""
    return F.coalesce(status >= 500, F.lit(False))


def is_client_error(status: Column) -> Column:
    return F.coalesce((status >= 400) & (status < 500), F.lit(False))


def round_half_up(value: Column, digits: int) -> Column:
    """Round on the decimal digits, so that binary noise below 1e-10 cannot tip a tie."""
    return F.round(value.cast("decimal(38,10)"), digits).cast("double")


def safe_rate(part: Column, whole: Column) -> Column:
    """part / whole to four digits; null where whole is zero."""
    return round_half_up(part.cast("double") / F.nullif(whole, F.lit(0)), 4)


def count_where(condition: Column) -> Column:
    """Number of rows for which the condition is true; 0 on no rows."""
    return F.count(F.when(condition, F.lit(1)))


def latest_first(df: DataFrame) -> list[Column]:
    """Order of versions of one event, newest first, and total.

    Arrival time, then batch, then file; the hash only settles rows that agree
    in all three, so that every run keeps the same one.
    """
    return [
        F.col("_ingested_at").desc_nulls_last(),
        F.col("ingest_batch_id").desc_nulls_last(),
        F.col("_source_file").desc_nulls_last(),
        F.xxhash64(*df.columns).desc(),
    ]
