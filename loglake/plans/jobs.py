"""The lake's jobs: raw to bronze, bronze to silver, silver to marts and tests."""

from __future__ import annotations

import logging
from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import datetime, timezone
from itertools import islice

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from loglake.contract import (
    MAX_LATENCY_MS,
    NO_RUN_TEXT,
    NULL_RATE_THRESHOLD,
    RAW_SCHEMA,
    QualityGateError,
)
from loglake.operators.cleaning import (
    arrived_after,
    arrived_between,
    clean_and_type,
    keep_latest,
    to_contract,
    watermark,
)
from loglake.operators.datatests import run_data_tests
from loglake.operators.quality import check_batch
from loglake.operators.schema_diff import SEVERITY, merged_type, observed_schema
from loglake.operators.upsert import not_set_back
from loglake.plans.marts import (
    daily_from_cube,
    request_cube,
    rollup_from_cube,
    with_traffic_rank,
)
from loglake.plans.staging import stg_logs
from loglake.sources.ledger import adopt, begin_run, close_run, closed_rows, not_taken_in
from loglake.sources.raw import (
    as_paths,
    list_files,
    read_json_lines,
    read_lines,
    require_event_columns,
    with_provenance,
)
from loglake.sources.tables import (
    NOTHING_MERGED,
    UNREADABLE,
    append_new_rows,
    append_with_evolution,
    apply_pending,
    changed_days,
    changed_fields,
    empty_partitions,
    on_days,
    overwrite_partitions,
    read_appended,
    read_if_exists,
    read_run,
    read_silver,
    schema_change,
    scratch_table,
    stage_batch,
    stop_if_breaking,
    store_watermark,
    stored_watermark,
    table_schema,
    upsert_staged,
    write_table,
)

logger = logging.getLogger("loglake")

# Bronze is laid out by day of arrival, which is what the next step selects by,
# and below that by day of the event.
BRONZE_PARTITIONS = ("_arrival_date", "ingest_date")
NOT_RAW = {"_source_file", "_ingested_at", "_run", *BRONZE_PARTITIONS}


#: Names of new files that are on the driver at once; more are taken in by further runs.
FILES_AT_ONCE = 100_000


@dataclass(frozen=True)
class IngestResult:
    files_listed: int
    files_new: int
    rows_new: int
    schema_change: str
    changed_fields: tuple[str, ...] = field(default=(), compare=False)


@dataclass(frozen=True)
class SilverResult:
    candidate_rows: int
    merged_rows: int


def _without_void(dtype: T.DataType) -> T.DataType:
    """What is null throughout within a field is text, as for JSON inference."""
    if isinstance(dtype, T.NullType):
        return T.StringType()
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_without_void(dtype.elementType))
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, _without_void(f.dataType)) for f in dtype])
    return dtype


def merged_schema(existing: T.StructType | None, observed: T.StructType, unreadable: bool, others_there: bool) -> T.StructType:
    """Schema of new files and those known read together, as JSON inference would have it.

    ``others_there``: files known are still in the raw folder, and have the fields of the table.
    Types are merged with the table's in any case. A field that is null throughout the new
    files is there with the type it has in the table, or else in the contract; one that has
    none is left out until it has a value.
    """
    known = {} if existing is None else {f.name: f.dataType for f in existing if f.name not in NOT_RAW}
    contract = {f.name: f.dataType for f in RAW_SCHEMA}
    merged = dict(known) if others_there else {}
    for found in observed:
        name, dtype = found.name, found.dataType
        if isinstance(dtype, T.NullType):
            dtype = known.get(name) or contract.get(name)
            if dtype is None:
                continue
        else:
            dtype = _without_void(dtype)
        before = known.get(name, dtype)
        if before != dtype:
            numeric = {before.simpleString(), dtype.simpleString()} <= {"bigint", "double"}
            dtype = T.DoubleType() if numeric else T.StringType()
        merged[name] = dtype
    if unreadable or UNREADABLE in known:
        merged[UNREADABLE] = T.StringType()
    return T.StructType([T.StructField(name, dtype) for name, dtype in merged.items()])


def bronze_rows(raw: DataFrame, ingested_at: datetime | None = None) -> DataFrame:
    rows = with_provenance(raw, ingested_at)
    return rows.withColumn("_arrival_date", F.to_date("_ingested_at"))


def new_files(spark: SparkSession, raw_path: str, bronze_path: str) -> tuple[DataFrame, DataFrame]:
    """Names of all files below ``raw_path``, and of those that bronze has not taken in."""
    adopt(spark, bronze_path)
    listed = list_files(spark, raw_path)
    return listed, not_taken_in(listed, bronze_path)


def incoming_schema(
    spark: SparkSession,
    names: Iterable[str],
    others_there: bool,
    bronze_path: str,
    files_at_once: int = FILES_AT_ONCE,
) -> T.StructType:
    """Schema of the named new files together with the known ones (see ``merged_schema``).

    Only the new files are read, each once, ``files_at_once`` of them at a time; the bronze
    schema stands for the fields of the others.
    """
    existing = table_schema(spark, bronze_path)
    names, observed, unreadable = iter(names), None, False
    while some := list(islice(names, files_at_once)):
        found, broken = observed_schema(read_lines(spark, as_paths(some)))
        observed = found if observed is None else merged_type(observed, found)
        unreadable |= broken
    if observed is None:
        return RAW_SCHEMA if existing is None else _raw_part(existing)
    return merged_schema(existing, observed, unreadable, others_there)


def ingest_raw(
    spark: SparkSession,
    raw_path: str,
    bronze_path: str,
    ingested_at: datetime | None = None,
    schema: T.StructType | None = None,
    files_at_once: int = FILES_AT_ONCE,
) -> IngestResult:
    """Take in the files not taken in before. Running it again does nothing.

    Known files are left out by name, from the ledger, before anything is read. A given
    ``schema`` spares the pass over the new files that infers it. More than ``files_at_once``
    new files are taken in by several runs, one after the other.
    """
    listed, fresh = new_files(spark, raw_path, bronze_path)
    fresh = scratch_table(fresh, "new-files")
    files_listed, files_new = listed.count(), fresh.count()
    if not files_new:
        logger.info("files listed=%d, new=0: nothing to ingest", files_listed)
        return IngestResult(files_listed, 0, 0, "none")
    ingested_at = ingested_at or datetime.now(timezone.utc)
    rows, changes, others_there = 0, [], files_new < files_listed
    names = (r._source_file for r in fresh.orderBy("_source_file").toLocalIterator())
    while some := list(islice(names, files_at_once)):
        found = schema or incoming_schema(spark, some, others_there, bronze_path)
        change, added = _ingest_files(spark, some, found, bronze_path, ingested_at)
        rows, others_there = rows + added, True
        changes.append(change)
    described = tuple(text for _, texts in changes for text in texts)
    worst = max((kind for kind, _ in changes), key=SEVERITY.get)
    result = IngestResult(files_listed, files_new, rows, worst, described)
    logger.info("%s", result)
    return result


def _ingest_files(
    spark: SparkSession, names: list[str], schema: T.StructType, bronze_path: str, ingested_at: datetime
) -> tuple[tuple[str, tuple[str, ...]], int]:
    """One run: the kind of change, the fields changed, and the number of rows."""
    raw = read_json_lines(spark, as_paths(names), schema)
    require_event_columns(raw)
    rows = bronze_rows(raw, ingested_at)
    existing = table_schema(spark, bronze_path)
    changed = ()
    if schema_change(spark, existing, rows.schema) != "none":
        stop_if_breaking(spark, existing, rows.schema, bronze_path)
        changed = _described(changed_fields(spark, existing, rows.schema))
    run = begin_run(spark, bronze_path)
    observed = Observation()
    rows = rows.observe(observed, F.count(F.lit(1)).alias("rows"))
    change = append_with_evolution(rows, bronze_path, BRONZE_PARTITIONS, run)
    counts = _counts_of_run(spark, bronze_path, run, ingested_at)
    files = spark.createDataFrame([(name,) for name in names], "_source_file string")
    close_run(files.join(counts, "_source_file", "left").fillna(0, ["rows"]), bronze_path, run)
    return (change, changed), observed.get["rows"]


def _counts_of_run(spark: SparkSession, bronze_path: str, run: str, ingested_at: datetime) -> DataFrame:
    """Rows of each file that a run has written; reads one column of that run."""
    day = spark.range(1).select(F.to_date(F.lit(ingested_at).cast("timestamp")).alias("day")).first().day
    try:
        written = read_run(spark, bronze_path, run, "_arrival_date", day)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":  # no file had a row
            raise
        return spark.createDataFrame([], "_source_file string, rows long")
    return written.groupBy("_source_file").agg(F.count("*").alias("rows"))


def _described(changes: DataFrame) -> tuple[str, ...]:
    """Changed fields as text: one for each field, so as few as a schema has."""
    return tuple(f"{r.change} {r.field}: {r.old_type} -> {r.new_type}" for r in changes.orderBy("field").collect())


def read_bronze(spark: SparkSession, path: str) -> DataFrame | None:
    """Bronze without the rows of runs that died, or None before the first append."""
    table = read_appended(spark, path)
    return None if table is None else closed_rows(table, path)


def _raw_part(schema: T.StructType) -> T.StructType:
    return T.StructType([f for f in schema if f.name not in NOT_RAW])


def bronze_to_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    quarantine_path: str,
    null_rate_threshold: float = NULL_RATE_THRESHOLD,
    max_latency_ms: int = MAX_LATENCY_MS,
    arrived: tuple[datetime, datetime] | None = None,
    event_times_fixed: bool = False,
) -> SilverResult:
    """Clean what arrived since the watermark, gate it, and upsert or quarantine it.

    A batch that fails the gate goes whole into quarantine and raises; as the
    watermark stays, so do the rows behind it until someone mends the batch.
    ``arrived`` names a window of arrival times to process instead, which leaves the
    watermark where it is: arrivals passed over are still to come, and rows of the
    window that come again change nothing. A row never replaces a newer one.
    ``event_times_fixed`` is explained at ``upsert_staged``.
    """
    apply_pending(spark, silver_path)
    bronze = read_bronze(spark, bronze_path)
    silver = read_silver(spark, silver_path)
    if bronze is None:
        return SilverResult(0, 0)
    newest = _watermark(silver)
    stored = stored_watermark(spark, silver_path)
    merged_until = newest if stored is None else stored
    if arrived is None:
        candidates = arrived_after(bronze, _timestamp(merged_until))
    else:
        candidates = arrived_between(bronze, *(F.lit(t).cast("timestamp") for t in arrived))
    found = candidates.count()
    if found == 0:
        logger.info("nothing new since the last run")
        return SilverResult(0, 0)

    # Only after a window was named can silver hold newer rows than those that come.
    again = silver is not None and newest is not None and (arrived is not None or newest != merged_until)
    fresh = keep_latest(to_contract(clean_and_type(candidates)))
    batch = stage_batch(fresh, silver_path, "arrived" if again else "batch")
    limits = {"null_rate_threshold": null_rate_threshold, "max_latency_ms": max_latency_ms}
    passed, report, summary = check_batch(batch, ids_are_unique=True, **limits)
    logger.info("quality report:\n%s", summary)
    if not passed:
        append_new_rows(batch, quarantine_path)
        raise QualityGateError(report, summary)

    if again:
        batch = stage_batch(not_set_back(batch, silver), silver_path)
    if arrived is not None and stored is None:
        store_watermark(spark, silver_path, merged_until)
    result = SilverResult(found, batch.count())
    if result.merged_rows:
        upsert_staged(spark, silver_path, event_times_fixed)
    if arrived is None and stored is not None:
        store_watermark(spark, silver_path, _watermark(candidates))
    logger.info("%s", result)
    return result


def _watermark(rows: DataFrame | None) -> int | None:
    """Newest arrival among the rows, in microseconds."""
    if rows is None:
        return None
    return watermark(rows).select(F.unix_micros("watermark").alias("micros")).first().micros


def _timestamp(micros: int | None) -> Column | None:
    """A literal exact to the microsecond in any time zone."""
    return None if micros in (None, NOTHING_MERGED) else F.timestamp_micros(F.lit(micros))


def build_marts(
    spark: SparkSession, silver_path: str, marts_path: str, full: bool = False
) -> dict[str, DataFrame]:
    """Bring the marts up to date; returns silver, staging and marts by name.

    Only the days that silver changed since the last build are read again (all of
    them the first time, or with ``full``). A build that dies is repeated by the
    next, for its days count as built only at the end.
    """
    silver = read_silver(spark, silver_path)
    if silver is None:
        raise FileNotFoundError(f"no silver table at {silver_path}")
    stg_logs(silver).createOrReplaceTempView("stg_logs")
    changes = changed_days(spark, silver_path)
    newest = 0 if changes is None else changes.agg(F.max("change").alias("newest")).first().newest
    built = None if full or changes is None else _built_change(spark, marts_path)
    if built is None or built < newest:
        since = None if built is None else changes.where(F.col("change") > built)
        _refresh_marts(spark, silver, marts_path, since)
        marker = spark.range(1).select(F.lit(newest).alias("change"))
        marker.coalesce(1).write.mode("append").json(f"{marts_path}/_built")
    return read_models(spark, silver_path, marts_path)


def read_models(spark: SparkSession, silver_path: str, marts_path: str) -> dict[str, DataFrame]:
    """Silver, staging and marts by name, as the data tests take them."""
    silver = read_silver(spark, silver_path)
    marts = ("fct_requests_daily", "dim_endpoints")
    return {
        "silver_events": silver,
        "stg_logs": stg_logs(silver),
        **{name: read_mart(spark, marts_path, name) for name in marts},
    }


def _built_change(spark: SparkSession, marts_path: str) -> int | None:
    marker = T.StructType([T.StructField("change", T.LongType())])
    built = read_if_exists(spark, f"{marts_path}/_built", marker, "json")
    return None if built is None else built.agg(F.max("change").alias("last")).first()["last"]


def _refresh_marts(
    spark: SparkSession, silver: DataFrame, marts_path: str, changes: DataFrame | None
) -> None:
    cube_path, daily_path = f"{marts_path}/request_cube", f"{marts_path}/fct_requests_daily"
    if changes is None:
        logs = stg_logs(silver)
        cube = write_table(request_cube(logs), cube_path, "event_day")
        write_table(daily_from_cube(cube, logs), daily_path, "event_day")
    else:
        days = changes.select(F.col("ingest_date").alias("event_day")).distinct()
        listed = [r.event_day for r in days.collect()]
        logs = stg_logs(silver.where(on_days("ingest_date", listed)))
        schema = spark.read.parquet(cube_path).schema
        overwrite_partitions(request_cube(logs), cube_path, ["event_day"])
        # A day may have lost its last row to another day.
        held = silver.where(on_days("ingest_date", listed)).select("ingest_date").distinct()
        gone = days.join(held, F.col("event_day").eqNullSafe(F.col("ingest_date")), "left_anti")
        empty_partitions(cube_path, schema, gone)
        cube = spark.read.schema(schema).parquet(cube_path).where(on_days("event_day", listed))
        schema = spark.read.parquet(daily_path).schema
        overwrite_partitions(daily_from_cube(cube, logs), daily_path, ["event_day"])
        empty_partitions(daily_path, schema, gone)
    rollup = scratch_table(rollup_from_cube(spark.read.parquet(cube_path)), "endpoint_rollup")
    write_table(with_traffic_rank(rollup), f"{marts_path}/dim_endpoints")


def read_mart(spark: SparkSession, marts_path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{marts_path}/{name}").drop("event_day")


def record_run(log_path: str, run: str, finished_at: datetime, silver: DataFrame) -> None:
    """Mark a run in which every step succeeded, with the rows silver then holds."""
    marker = silver.agg(
        F.lit(run).alias("run"),
        F.lit(finished_at).cast("timestamp").alias("finished_at"),
        F.count("*").alias("silver_rows"),
    )
    append_with_evolution(marker, log_path)


def last_run(spark: SparkSession, log_path: str) -> str:
    """The latest marked run, or a text that says there is none."""
    log = read_appended(spark, log_path)
    newest = None if log is None else log.agg(F.max_by("run", "finished_at").alias("run")).first()
    return NO_RUN_TEXT if newest is None or newest.run is None else newest.run


def run_all(
    spark: SparkSession,
    raw_path: str,
    lake_path: str,
    as_of: datetime,
    run: str,
    ingested_at: datetime | None = None,
    **limits,
) -> DataFrame:
    """Every step in order. Stops at the first that fails; a warning does not stop it.

    ``limits`` are those of the gate: null_rate_threshold and max_latency_ms.

    Returns the results of the data tests; the run is marked if none is an error.
    """
    ingest_raw(spark, raw_path, f"{lake_path}/bronze", ingested_at)
    bronze_to_silver(spark, f"{lake_path}/bronze", f"{lake_path}/silver", f"{lake_path}/quarantine", **limits)
    models = build_marts(spark, f"{lake_path}/silver", f"{lake_path}/marts")
    results = write_table(run_data_tests(models, as_of), f"{lake_path}/data_tests")
    if results.where("status = 'error'").isEmpty():
        record_run(f"{lake_path}/run_log", run, as_of, models["silver_events"])
    return results
