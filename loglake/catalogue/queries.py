"""One query per operator, over the supplied ``events`` table seen as request logs.

Timestamps leave as plain wall-clock values in UTC.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from loglake.contract import RAW_SCHEMA, SILVER_SCHEMA
from loglake.functions.columns import is_client_error, is_server_error
from loglake.operators import datatests, quality, schema_diff as schemas
from loglake.operators.cleaning import (
    arrived_after,
    arrived_between,
    clean_and_type,
    keep_latest,
    source_files,
    to_contract,
    watermark,
    without_known_files,
)
from loglake.operators.late_arrival import late_arrival_profile
from loglake.operators.upsert import step_counts, upsert, upsert_effect
from loglake.plans import jobs, marts, panels
from loglake.plans.staging import stg_logs
from loglake.session import configure, shared_folder
from loglake.sources import events, ledger, raw, tables
from loglake.streaming.lake import stream_to_bronze, stream_to_silver

Query = Callable[[SparkSession, str], DataFrame]

# Clocks of the queries.
AS_OF = datetime(2024, 1, 31, 12, tzinfo=timezone.utc)
FRESH_AS_OF = datetime(2024, 1, 31, tzinfo=timezone.utc)
INGESTED_AT = datetime(2024, 2, 1, tzinfo=timezone.utc)
INGESTED_NEXT = datetime(2024, 2, 1, 0, 15, tzinfo=timezone.utc)
BACKFILL = (
    datetime(2024, 2, 1, 1, tzinfo=timezone.utc),
    datetime(2024, 2, 1, 3, tzinfo=timezone.utc),
)

QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        result = function(configure(spark), sf_dir)
        clocks = [f.name for f in result.schema if f.dataType.typeName() == "timestamp"]
        return result.withColumns({c: F.col(c).cast("timestamp_ntz") for c in clocks})

    QUERIES[function.__name__] = run
    return function


# --- inputs ------------------------------------------------------------------

_written: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """Path of a table derived from the supplied ones, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        path = _new_folder(spark, name)
        write(path)
        _written[key] = path
    return _written[key]


def _new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/loglake-queries/{name}-{uuid.uuid4().hex}"


def stored_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver as a stored table, as the marts find it."""
    path = _once(
        spark, sf_dir, "silver", lambda p: events.silver(spark, sf_dir).write.parquet(p)
    )
    return spark.read.schema(SILVER_SCHEMA).parquet(path)


def _raw_files(spark: SparkSession, sf_dir: str) -> str:
    numbered = events.numbered_logs(events.read_events(spark, sf_dir))
    return _once(spark, sf_dir, "raw", lambda p: events.write_json_files(numbered, p))


def _staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stg_logs(stored_silver(spark, sf_dir))


def _numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.numbered_logs(events.read_events(spark, sf_dir))


def _cleaned_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_contract(clean_and_type(events.dirty_logs(spark, sf_dir)))


def _stored_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The faulty batch cleaned, reduced and staged, as the gate finds it."""

    def write(path: str) -> None:
        keep_latest(_cleaned_dirty(spark, sf_dir)).write.parquet(path)

    return spark.read.schema(SILVER_SCHEMA).parquet(_once(spark, sf_dir, "dirty", write))


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Silver after half of the batches, stored, and the rest as a staged batch."""
    target, source = events.split_at_half(_numbered(spark, sf_dir))
    paths = (
        _once(spark, sf_dir, "target", lambda p: target.write.parquet(p)),
        _once(spark, sf_dir, "source", lambda p: source.write.parquet(p)),
    )
    stored, staged = (spark.read.schema(SILVER_SCHEMA).parquet(p) for p in paths)
    return stored, staged


def _early_files(numbered: DataFrame) -> DataFrame:
    half = numbered.agg(F.max("arrival_no") / 2).scalar()
    return source_files(numbered.where(F.col("arrival_no") <= half))


# --- raw, cleaning, increments -----------------------------------------------


@_query
def raw_provenance(spark, sf_dir):
    files = raw.read_json_lines(spark, _raw_files(spark, sf_dir), RAW_SCHEMA)
    rows = raw.with_provenance(files, INGESTED_AT)
    batch = F.regexp_extract("_source_file", "_batch=([^/]+)/", 1)
    return rows.select("event_id", "latency_ms", "_ingested_at", "ingest_date", batch.alias("file_batch"))


@_query
def json_ingest_roundtrip(spark, sf_dir):
    bronze = _new_folder(spark, "bronze")
    jobs.ingest_raw(spark, _raw_files(spark, sf_dir), bronze, INGESTED_AT)
    return to_contract(clean_and_type(tables.read_appended(spark, bronze))).drop("_source_file")


@_query
def clean_and_typed(spark, sf_dir):
    return _cleaned_dirty(spark, sf_dir)


@_query
def dedupe_keep_latest(spark, sf_dir):
    return keep_latest(events.logs(spark, sf_dir))


@_query
def dedupe_with_missing_ids(spark, sf_dir):
    return keep_latest(_cleaned_dirty(spark, sf_dir))


@_query
def file_level_anti_join(spark, sf_dir):
    numbered = _numbered(spark, sf_dir)
    return to_contract(without_known_files(numbered, _early_files(numbered)))


@_query
def distinct_source_files(spark, sf_dir):
    return source_files(events.logs(spark, sf_dir))


@_query
def silver_watermark(spark, sf_dir):
    return watermark(stored_silver(spark, sf_dir))


@_query
def incremental_rows(spark, sf_dir):
    target, _ = _halves(spark, sf_dir)
    return arrived_after(events.logs(spark, sf_dir), watermark(target).scalar())


@_query
def backfill_rows(spark, sf_dir):
    start, end = (F.lit(t).cast("timestamp") for t in BACKFILL)
    return keep_latest(arrived_between(events.logs(spark, sf_dir), start, end))


@_query
def silver_upsert(spark, sf_dir):
    return upsert(*_halves(spark, sf_dir))


@_query
def upsert_effects(spark, sf_dir):
    return upsert_effect(*_halves(spark, sf_dir))


@_query
def row_counts(spark, sf_dir):
    numbered = _numbered(spark, sf_dir)
    target, source = _halves(spark, sf_dir)
    new = without_known_files(numbered, _early_files(numbered))
    candidate = arrived_after(to_contract(numbered), watermark(target).scalar())
    return step_counts(numbered, new, candidate, source)


# --- staging and marts -------------------------------------------------------


@_query
def staging_logs(spark, sf_dir):
    return _staging(spark, sf_dir)


@_query
def error_flags(spark, sf_dir):
    status = F.col("status_code")
    flags = _cleaned_dirty(spark, sf_dir).groupBy(
        "status_code",
        is_server_error(status).alias("is_server_error"),
        is_client_error(status).alias("is_client_error"),
    )
    return flags.agg(F.count("*").alias("row_count"))


@_query
def daily_request_count(spark, sf_dir):
    return _staging(spark, sf_dir).groupBy("event_date").agg(F.count("*").alias("request_count"))


@_query
def daily_unique_users(spark, sf_dir):
    return marts.daily_unique_users(_staging(spark, sf_dir))


@_query
def user_sketches(spark, sf_dir):
    """Users of each day and of all days, and whether their sketches come within 3 per cent."""
    logs = _staging(spark, sf_dir)
    sketches = marts.daily_user_sketches(logs)
    by_day = sketches.select("event_date", F.hll_sketch_estimate("users").alias("about"))
    days = marts.daily_unique_users(logs).join(by_day, "event_date").select(F.col("event_date").cast("string").alias("span"), "unique_users", "about")
    overall = logs.agg(F.count_distinct("user_id").alias("unique_users"))
    about = marts.users_of_span(sketches).withColumnRenamed("unique_users", "about").scalar()
    spans = days.unionByName(overall.select(F.lit("all days").alias("span"), "unique_users", about.alias("about")))
    near = 100 * F.abs(F.col("about") - F.col("unique_users")) <= 3 * F.col("unique_users")
    return spans.select("span", "unique_users", near.alias("sketch_is_near"))


@_query
def daily_error_rates(spark, sf_dir):
    return marts.fct_requests_daily(_staging(spark, sf_dir)).select(
        "event_date", "server_error_count", "client_error_count", "server_error_rate"
    )


@_query
def daily_latency(spark, sf_dir):
    return marts.fct_requests_daily(_staging(spark, sf_dir)).select(
        "event_date", "avg_latency_ms", "p50_latency_ms", "p95_latency_ms", "p99_latency_ms"
    )


@_query
def fct_requests_daily(spark, sf_dir):
    return panels.daily_series(marts.fct_requests_daily(_staging(spark, sf_dir)))


@_query
def fct_with_missing_values(spark, sf_dir):
    return marts.fct_requests_daily(stg_logs(_stored_dirty(spark, sf_dir)))


@_query
def endpoint_rollup(spark, sf_dir):
    return marts.endpoint_rollup(_staging(spark, sf_dir))


@_query
def dim_endpoints(spark, sf_dir):
    return marts.dim_endpoints(_staging(spark, sf_dir))


@_query
def user_traffic_rank(spark, sf_dir):
    """The rank of dim_endpoints on a key with many more groups and ties."""
    users = _staging(spark, sf_dir).groupBy("user_id", "country")
    return marts.with_traffic_rank(users.agg(F.count("*").alias("request_count")))


@_query
def latest_day_kpis(spark, sf_dir):
    return panels.latest_day_kpis(marts.fct_requests_daily(_staging(spark, sf_dir)))


@_query
def panel_traffic(spark, sf_dir):
    return panels.panel_traffic(marts.fct_requests_daily(_staging(spark, sf_dir)))


@_query
def panel_error_rate(spark, sf_dir):
    return panels.panel_error_rate(marts.fct_requests_daily(_staging(spark, sf_dir)))


@_query
def panel_latency(spark, sf_dir):
    return panels.panel_latency(marts.fct_requests_daily(_staging(spark, sf_dir)))


@_query
def top_endpoints(spark, sf_dir):
    return panels.top_endpoints(marts.dim_endpoints(_staging(spark, sf_dir)))


@_query
def top_endpoint_bars(spark, sf_dir):
    return panels.top_endpoint_bars(marts.dim_endpoints(_staging(spark, sf_dir)))


@_query
def requests_per_endpoint(spark, sf_dir):
    return panels.requests_per_endpoint(marts.endpoint_rollup(_staging(spark, sf_dir)))


# --- gate --------------------------------------------------------------------


@_query
def quality_stats(spark, sf_dir):
    return quality.batch_stats(_stored_dirty(spark, sf_dir))


@_query
def quality_report_clean(spark, sf_dir):
    return quality.gate_report(quality.batch_stats(stored_silver(spark, sf_dir)))


@_query
def quality_report_dirty(spark, sf_dir):
    return quality.gate_report(quality.batch_stats(_stored_dirty(spark, sf_dir)))


@_query
def quality_report_before_dedupe(spark, sf_dir):
    return quality.gate_report(quality.batch_stats(events.logs(spark, sf_dir)))


@_query
def quality_report_empty(spark, sf_dir):
    """A re-run finds nothing after the watermark; its report has one, failed, line."""
    silver = stored_silver(spark, sf_dir)
    nothing_new = arrived_after(silver, watermark(silver).scalar())
    return quality.gate_report(quality.batch_stats(nothing_new))


@_query
def quality_report_many_bad_values(spark, sf_dir):
    """Hundreds of different bad codes and methods, all of them in the report."""
    n = F.regexp_extract("event_id", "([0-9]+)", 1).cast("long")
    faulty = stored_silver(spark, sf_dir).withColumns(
        {
            "status_code": F.when(n % 3 == 0, (n % 700 + 600).cast("int")).otherwise(F.col("status_code")),
            "method": F.when(n % 5 == 0, F.concat(F.lit("M"), (n % 900).cast("string"))).otherwise(F.col("method")),
        }
    )
    return quality.gate_report(quality.batch_stats(faulty))


@_query
def quality_summary(spark, sf_dir):
    stats = quality.batch_stats(_stored_dirty(spark, sf_dir))
    return quality.report_summary(quality.gate_report(stats))


@_query
def bad_values(spark, sf_dir):
    return quality.bad_values(_cleaned_dirty(spark, sf_dir)).drop("number")


@_query
def rows_by_broken_rule(spark, sf_dir):
    return quality.rows_by_broken_rule(_stored_dirty(spark, sf_dir))


# --- data tests --------------------------------------------------------------


@_query
def test_unique(spark, sf_dir):
    return datatests.failing_unique(events.logs(spark, sf_dir), "event_id")


@_query
def test_not_null(spark, sf_dir):
    rows = datatests.failing_not_null(_cleaned_dirty(spark, sf_dir), "status_code")
    return rows.select("event_id", "method", "latency_ms", "_source_file")


@_query
def test_accepted_values(spark, sf_dir):
    return datatests.failing_accepted_values(
        _cleaned_dirty(spark, sf_dir), "method", datatests.VALID_METHODS
    )


@_query
def test_accepted_range(spark, sf_dir):
    """Days on which more than a fifth of the requests failed."""
    daily = marts.fct_requests_daily(_staging(spark, sf_dir))
    failing = datatests.failing_accepted_range(daily, "server_error_rate", 0.0, 0.2)
    return failing.select("event_date", "server_error_rate")


@_query
def test_freshness(spark, sf_dir):
    stale = datatests.failing_freshness(_staging(spark, sf_dir), AS_OF)
    seconds = F.col("staleness").cast("interval second").cast("decimal(18,6)").cast("double")
    return stale.withColumn("staleness", seconds)


def _models(silver: DataFrame) -> dict[str, DataFrame]:
    logs = stg_logs(silver)
    return {
        "silver_events": silver,
        "stg_logs": logs,
        "fct_requests_daily": marts.fct_requests_daily(logs),
        "dim_endpoints": marts.dim_endpoints(logs),
    }


@_query
def data_test_suite(spark, sf_dir):
    return datatests.run_data_tests(_models(stored_silver(spark, sf_dir)), AS_OF)


@_query
def data_test_suite_dirty(spark, sf_dir):
    return datatests.run_data_tests(_models(_stored_dirty(spark, sf_dir)), AS_OF)


@_query
def data_test_status(spark, sf_dir):
    results = datatests.run_data_tests(_models(stored_silver(spark, sf_dir)), AS_OF)
    return datatests.suite_status(results)


# --- schemas -----------------------------------------------------------------


def _fields_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields per file of the logs as JSON, with one unreadable line in every file."""
    lines = events.json_lines(events.logs(spark, sf_dir))
    unreadable = lines.select("_source_file").distinct().withColumn("value", F.lit("{not json"))
    return schemas.json_fields(lines.unionByName(unreadable))


@_query
def schema_drift_by_file(spark, sf_dir):
    return _fields_by_file(spark, sf_dir)


@_query
def field_history(spark, sf_dir):
    return schemas.field_history(_fields_by_file(spark, sf_dir))


def _clean_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields per file, found once: a row per file and field, however long the files."""

    def write(path: str) -> None:
        schemas.json_fields(events.json_lines(events.logs(spark, sf_dir))).write.parquet(path)

    return spark.read.parquet(_once(spark, sf_dir, "fields", write))


def _first_file_against_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_file = _clean_fields(spark, sf_dir)
    first = by_file.where(F.col("_source_file") == by_file.agg(F.min("_source_file")).scalar())
    return schemas.schema_diff(schemas.merged_fields(first), schemas.merged_fields(by_file))


def _clean_against_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = _clean_fields(spark, sf_dir)
    dirty = schemas.json_fields(events.json_lines(events.dirty_logs(spark, sf_dir).drop("country")))
    return schemas.schema_diff(schemas.merged_fields(clean), schemas.merged_fields(dirty))


@_query
def schema_diff(spark, sf_dir):
    return _first_file_against_all(spark, sf_dir)


@_query
def schema_diff_breaking(spark, sf_dir):
    return _clean_against_dirty(spark, sf_dir)


@_query
def schema_classes(spark, sf_dir):
    additive = schemas.classify(_first_file_against_all(spark, sf_dir))
    breaking = schemas.classify(_clean_against_dirty(spark, sf_dir))
    return additive.select(F.lit("later files").alias("change"), "classification").unionByName(
        breaking.select(F.lit("text fields").alias("change"), "classification")
    )


@_query
def evolving_append(spark, sf_dir):
    """Batches of three schema versions appended one after the other."""
    path = _new_folder(spark, "evolving")
    numbered = _numbered(spark, sf_dir).drop("n")
    arrival = F.col("arrival_no")
    version_3 = ("session_id", "is_authenticated")
    tables.append_with_evolution(
        numbered.where(arrival == 0).drop("user_agent", *version_3), path, ["ingest_date"]
    )
    tables.append_with_evolution(numbered.where(arrival == 1).drop(*version_3), path, ["ingest_date"])
    tables.append_with_evolution(numbered.where(arrival >= 2), path, ["ingest_date"])
    return to_contract(tables.read_appended(spark, path))


@_query
def widening_append(spark, sf_dir):
    """A latency that turns from whole numbers to fractions half-way."""
    path = _new_folder(spark, "widening")
    early, late = _halves(spark, sf_dir)
    tables.append_with_evolution(early.select("event_id", "latency_ms", "_ingested_at"), path)
    half_more = late.withColumn("latency_ms", F.col("latency_ms") + F.lit(0.5).cast("double"))
    tables.append_with_evolution(half_more.select("event_id", "latency_ms", "_ingested_at"), path)
    return tables.read_appended(spark, path)


@_query
def schema_changes_of_appends(spark, sf_dir):
    """What the appends of four schema versions change, and one that is refused.

    A log of whole latencies gains fields, then fractions; then a producer drops the country
    and writes statuses as text.
    """
    path = _new_folder(spark, "versions")
    numbered = _numbered(spark, sf_dir).drop("n")
    arrival, version_3 = F.col("arrival_no"), ("session_id", "is_authenticated")
    later = numbered.where(arrival >= 2)
    for rows in (
        numbered.where(arrival == 0).drop("user_agent", *version_3),
        numbered.where(arrival == 1).drop(*version_3),
        later.where(arrival < 4),
        later.where(arrival >= 4).withColumn("latency_ms", F.col("latency_ms") / F.lit(2.0)),
    ):
        tables.append_with_evolution(rows, path)
    refused = later.drop("country").withColumn("status_code", F.col("status_code").cast("string"))
    last = tables.table_schema(spark, path)
    breaking = tables.changed_fields(spark, last, refused.withColumn("latency_ms", F.lit(0.0)).schema)
    return tables.schema_history(spark, path).unionByName(breaking.select(F.lit(4).cast("long").alias("version"), "*"))


@_query
def ingest_after_half_commit(spark, sf_dir):
    """A run that died while its rows were being written: its files come whole, and once."""
    bronze, files = _new_folder(spark, "bronze"), _raw_files(spark, sf_dir)
    jobs.ingest_raw(spark, f"{files}/_half=1", bronze, INGESTED_AT)
    lost = jobs.bronze_rows(raw.read_json_lines(spark, f"{files}/_half=2", RAW_SCHEMA), INGESTED_AT)
    some = lost.where(F.pmod(F.xxhash64("event_id"), F.lit(3)) == 0).drop("_corrupt_record")
    tables.append_with_evolution(some, bronze, jobs.BRONZE_PARTITIONS, ledger.begin_run(spark, bronze))
    jobs.ingest_raw(spark, files, bronze, INGESTED_AT)
    return to_contract(clean_and_type(jobs.read_bronze(spark, bronze))).drop("_source_file")


@_query
def ledger_of_files(spark, sf_dir):
    """Rows that each file brought, as the ledger has it."""
    bronze = _new_folder(spark, "bronze")
    jobs.ingest_raw(spark, _raw_files(spark, sf_dir), bronze, INGESTED_AT)
    batch = F.regexp_extract("_source_file", "_batch=([^/]+)/", 1).alias("file_batch")
    return ledger.ledger(spark, bronze).groupBy(batch).agg(F.sum("rows").alias("row_count"))


# --- late data, tables, whole runs -------------------------------------------


@_query
def late_arrivals(spark, sf_dir):
    return late_arrival_profile(events.logs(spark, sf_dir))


@_query
def quarantine_append(spark, sf_dir):
    """A failed batch quarantined twice is there once."""
    path = _new_folder(spark, "quarantine")
    batch = _stored_dirty(spark, sf_dir)
    for _ in range(2):
        tables.append_new_rows(batch, path)
    return tables.read_appended(spark, path).drop("_arrival_date")


def _lake_of_two_runs(spark: SparkSession, sf_dir: str) -> str:
    """Both halves of the raw files taken through every step, one run each."""

    def write(lake: str) -> None:
        files = _raw_files(spark, sf_dir)
        jobs.run_all(spark, f"{files}/_half=1", lake, FRESH_AS_OF, "first run", INGESTED_AT)
        jobs.run_all(spark, files, lake, FRESH_AS_OF, "second run", INGESTED_NEXT)

    return _once(spark, sf_dir, "lake", write)


@_query
def lake_silver(spark, sf_dir):
    lake = _lake_of_two_runs(spark, sf_dir)
    return tables.read_silver(spark, f"{lake}/silver").drop("_source_file")


def _lake_out_of_order(spark: SparkSession, sf_dir: str) -> str:
    """Two arrivals of the raw files, the second processed first, and the first once more.

    Silver after each of the last two steps is kept.
    """

    def write(lake: str) -> None:
        files = _raw_files(spark, sf_dir)
        bronze, silver, quarantine = (f"{lake}/{t}" for t in ("bronze", "silver", "quarantine"))
        jobs.ingest_raw(spark, f"{files}/_half=1", bronze, INGESTED_AT)
        jobs.ingest_raw(spark, files, bronze, INGESTED_NEXT)
        second = (INGESTED_NEXT, INGESTED_NEXT + timedelta(seconds=1))
        jobs.bronze_to_silver(spark, bronze, silver, quarantine, arrived=second)
        jobs.bronze_to_silver(spark, bronze, silver, quarantine)
        tables.read_silver(spark, silver).write.parquet(f"{lake}/caught_up")
        first = (INGESTED_AT, INGESTED_AT + timedelta(seconds=1))
        jobs.bronze_to_silver(spark, bronze, silver, quarantine, arrived=first)
        tables.read_silver(spark, silver).write.parquet(f"{lake}/replayed")

    return _once(spark, sf_dir, "lake-out-of-order", write)


@_query
def backfill_then_increment(spark, sf_dir):
    """A window out of order, then a normal run: nothing is passed over."""
    lake = _lake_out_of_order(spark, sf_dir)
    return spark.read.schema(SILVER_SCHEMA).parquet(f"{lake}/caught_up").drop("_source_file")


@_query
def backfill_older_window(spark, sf_dir):
    """The older window processed again: no row is set back, none repeated."""
    lake = _lake_out_of_order(spark, sf_dir)
    return spark.read.schema(SILVER_SCHEMA).parquet(f"{lake}/replayed").drop("_source_file")


@_query
def lake_daily_facts(spark, sf_dir):
    return jobs.read_mart(spark, f"{_lake_of_two_runs(spark, sf_dir)}/marts", "fct_requests_daily")


@_query
def lake_endpoints(spark, sf_dir):
    return jobs.read_mart(spark, f"{_lake_of_two_runs(spark, sf_dir)}/marts", "dim_endpoints")


@_query
def lake_run_log(spark, sf_dir):
    """A run that ends on data too old for the freshness test is not marked."""
    return tables.read_appended(spark, f"{_lake_of_two_runs(spark, sf_dir)}/run_log")


@_query
def stream_ingest(spark, sf_dir):
    bronze, checkpoint = _new_folder(spark, "bronze"), _new_folder(spark, "checkpoint")
    stream_to_bronze(
        spark, _raw_files(spark, sf_dir), bronze, checkpoint, INGESTED_AT
    ).awaitTermination()
    return to_contract(clean_and_type(tables.read_appended(spark, bronze))).drop("_source_file")


@_query
def stream_silver(spark, sf_dir):
    lake, checkpoint = _new_folder(spark, "lake"), _new_folder(spark, "checkpoint")
    stream_to_silver(spark, _raw_files(spark, sf_dir), lake, checkpoint).awaitTermination()
    return tables.read_silver(spark, f"{lake}/silver").drop("_source_file", "_ingested_at")
