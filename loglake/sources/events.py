"""The supplied ``events`` table in the shape of request logs.

Every event becomes a log row; some arrive late, and some are delivered twice.
Logs carry JSON-like versions: later batches have fields earlier ones lack.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loglake.contract import RAW_SCHEMA
from loglake.operators.cleaning import keep_latest, to_contract

# How the fixture maps events to log fields.
COUNTRIES = ("US", "GB", "DE", "IN", "BR", "JP", "KE", "NG", "CA", "AU")
ROWS_PER_BATCH = 250
FIRST_ARRIVAL = "2024-02-01 00:00:00"
MINUTES_PER_BATCH = 15


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def numbered_logs(events: DataFrame) -> DataFrame:
    """Bronze-like rows, with the event's number ``n`` and its ``arrival_no``."""
    n, k = F.col("n"), F.col("k")
    number = events.select(
        F.col("event_id").alias("n"),
        "ts",
        "user_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.floor(F.col("event_id") / F.lit(float(ROWS_PER_BATCH))).alias("batch_no"),
    )
    late = F.when(n % 33 == 0, 1 + n % 3).otherwise(0)
    deliveries = number.select(
        "*",
        F.explode(
            F.when(
                n % 50 == 7,
                F.array(
                    F.struct((F.col("batch_no") + late).alias("arrival_no"), F.lit(0).alias("again")),
                    F.struct((F.col("batch_no") + 4).alias("arrival_no"), F.lit(1).alias("again")),
                ),
            ).otherwise(
                F.array(
                    F.struct((F.col("batch_no") + late).alias("arrival_no"), F.lit(0).alias("again"))
                )
            )
        ).alias("delivery"),
    ).select("*", "delivery.arrival_no", "delivery.again")
    is_error = F.col("event_type") == "error"
    arrival = F.col("arrival_no")
    batch_id = F.concat(F.lit("b_"), F.lpad(arrival.cast("string"), 5, "0"))
    return deliveries.select(
        F.concat(F.lit("e_"), n.cast("string")).alias("event_id"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.concat(F.lit("/api/v1/"), F.col("event_type")).alias("endpoint"),
        F.when(n % 6 < 3, "GET")
        .when(n % 6 == 3, "POST")
        .when(n % 6 == 4, "PUT")
        .otherwise("DELETE")
        .alias("method"),
        F.when(is_error, F.when(n % 4 == 0, 503).otherwise(500))
        .when(k < 4, 404)
        .when(k < 6, 401)
        .when(k < 8, 400)
        .when(k < 11, 201)
        .otherwise(200)
        .cast("int")
        .alias("status_code"),
        (
            F.greatest(F.lit(1).cast("bigint"), F.floor("value"))
            + F.when(is_error, 200 + n * 37 % 1801).otherwise(0)
            + F.col("again")
        )
        .cast("int")
        .alias("latency_ms"),
        F.concat(F.lit("u_"), F.col("user_id").cast("string")).alias("user_id"),
        F.element_at(
            F.array(*map(F.lit, COUNTRIES)), (F.col("user_id") % len(COUNTRIES) + 1).cast("int")
        ).alias("country"),
        batch_id.alias("ingest_batch_id"),
        F.when(arrival >= 1, F.concat(F.lit("ua_"), (n % 4).cast("string"))).alias("user_agent"),
        F.when(arrival >= 2, F.concat(F.lit("s_"), F.col("user_id").cast("string"))).alias("session_id"),
        F.when(arrival >= 2, k >= 30).alias("is_authenticated"),
        F.concat(F.lit("events_"), batch_id, F.lit(".jsonl")).alias("_source_file"),
        (
            F.lit(FIRST_ARRIVAL).cast("timestamp")
            + F.make_dt_interval(mins=(arrival * MINUTES_PER_BATCH).cast("int"))
        ).alias("_ingested_at"),
        F.to_date("ts").alias("ingest_date"),
        n,
        arrival.alias("arrival_no"),
    )


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_contract(numbered_logs(read_events(spark, sf_dir)))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_latest(logs(spark, sf_dir))


def split_at_half(numbered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(earlier, later) half of the batches, each with its newest row per event."""
    half = numbered.agg(F.max("arrival_no") / 2).scalar()
    earlier = to_contract(numbered.where(F.col("arrival_no") <= half))
    later = to_contract(numbered.where(F.col("arrival_no") > half))
    return keep_latest(earlier), keep_latest(later)


def dirty_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logs as text fields with one kind of fault per gate rule spread over them."""
    n = F.col("n")
    return numbered_logs(read_events(spark, sf_dir)).withColumns(
        {
            "event_id": F.when(n % 20 != 3, F.col("event_id")),
            "user_id": F.when(n % 89 != 0, F.col("user_id")),
            "endpoint": F.when(n % 71 == 0, None)
            .when(n % 7 == 0, F.concat(F.lit("  "), F.col("endpoint"), F.lit(" ")))
            .otherwise(F.col("endpoint")),
            "event_time": F.when(n % 61 == 0, "junk").otherwise(
                F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSSSSS")
            ),
            "status_code": F.when(n % 97 == 0, "abc")
            .when(n % 101 == 0, "9999")
            .otherwise(F.col("status_code").cast("string")),
            "method": F.when(n % 103 == 0, "FETCH")
            .when(n % 5 == 0, " get ")
            .otherwise(F.col("method")),
            "latency_ms": F.when(n % 211 == 0, "999999").otherwise(F.col("latency_ms").cast("string")),
        }
    )


def _json(rows: DataFrame) -> Column:
    fields = [f.name for f in RAW_SCHEMA if f.name in rows.columns]
    return F.to_json(F.struct(*fields), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})


def json_lines(rows: DataFrame) -> DataFrame:
    """Rows as the JSON lines a producer would send: raw fields only, nulls left out."""
    return rows.select("_source_file", _json(rows).alias("value"))


def write_json_files(numbered: DataFrame, path: str) -> None:
    """One folder of JSON lines per batch, below one folder per half of the batches.

    Rows are gathered by batch first, so that the folders are dealt out over all tasks,
    however few files the events are in, and a batch is in few files.
    """
    by = ("_half", "_batch")
    half = numbered.agg(F.max("arrival_no") / 2).scalar()
    rows = numbered.select("*", F.when(F.col("arrival_no") <= half, 1).otherwise(2).alias("_half"))
    (
        rows.select("_half", F.col("ingest_batch_id").alias("_batch"), _json(rows).alias("value"))
        .hint("rebalance", *by)
        .write.partitionBy(*by)
        .text(path)
    )
