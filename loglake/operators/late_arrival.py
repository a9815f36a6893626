"""How late events arrive, batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from loglake.functions.columns import safe_rate
from loglake.operators.prefix import running_max_before
from loglake.operators.percentiles import profile, value_counts


def late_arrival_profile(df: DataFrame) -> DataFrame:
    """Per batch: rows, late rows, their share, and the 95th percentile of the delay.

    A row is late when its event is older than the newest event of all earlier
    batches. That newest event is found on one row per batch, by a scan over ranges of
    batches (see ``prefix``), for batches are as many as a lake is old. The delay counts
    whole seconds, so a batch of any size has few distinct delays.
    """
    newest = (
        df.where(F.col("ingest_batch_id").isNotNull())
        .groupBy("ingest_batch_id")
        .agg(F.max("event_time").alias("_newest"))
    )
    seen_before = running_max_before(newest, "ingest_batch_id", "_newest", "_seen").drop("_newest")
    rows = df.select(
        "ingest_batch_id",
        "event_time",
        (F.unix_seconds("_ingested_at") - F.unix_seconds("event_time")).alias("delay_seconds"),
    ).join(seen_before, "ingest_batch_id", "left")
    counts = value_counts(
        rows,
        ["ingest_batch_id"],
        "delay_seconds",
        late=F.when(F.col("event_time") < F.col("_seen"), 1).otherwise(0),
    )
    batches = profile(
        counts, ["ingest_batch_id"], "delay_seconds", [95], F.sum("late").alias("late_rows")
    )
    return batches.select(
        "ingest_batch_id",
        "row_count",
        "late_rows",
        safe_rate(F.col("late_rows"), F.col("row_count")).alias("late_share"),
        "p95_delay_seconds",
    )

