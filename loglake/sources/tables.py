"""Lake tables as partitioned Parquet.

Two kinds: appended tables whose schema may grow (bronze, quarantine, run log),
and silver, which has one row per event and is upserted.

A directory write is not a transaction: readers may see a table while a driver
renames files into it. One writer at a time, as for the watermark.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from datetime import date
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from loglake.contract import SILVER_SCHEMA, SchemaEvolutionError
from loglake.operators.schema_diff import classify, fields, schema_diff
from loglake.operators.upsert import with_few_keys, without_few_keys
from loglake.session import shared_folder


def read_if_exists(
    spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet"
) -> DataFrame | None:
    """The table at ``path``, or None if there is nothing there. Other errors are raised."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


# --- appended tables ---------------------------------------------------------
#
# <path>/_schema        one line per schema the table has had
# <path>/_epoch=<n>/    data files; a new epoch starts when a column's type widens or
#                       runs get partitions of their own, so files never need
#                       rewriting: each epoch is read under its own last schema
#                       and cast to the newest

_SCHEMA_LOG = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("epoch", T.LongType()),
        T.StructField("schema", T.StringType()),
    ]
)


def _schemas(spark: SparkSession, path: str) -> list[tuple[int, int, T.StructType]]:
    """(version, epoch, schema) of the table, oldest first; one entry per change."""
    log = read_if_exists(spark, f"{path}/_schema", _SCHEMA_LOG, "json")
    if log is None:
        return []
    rows = log.orderBy("version").collect()
    return [(r.version, r.epoch, T.StructType.fromJson(json.loads(r.schema))) for r in rows]


def table_schema(spark: SparkSession, path: str) -> T.StructType | None:
    schemas = _schemas(spark, path)
    return schemas[-1][2] if schemas else None


def read_appended(spark: SparkSession, path: str) -> DataFrame | None:
    """The whole table under its newest schema; None before the first append."""
    schemas = _schemas(spark, path)
    if not schemas:
        return None
    newest = schemas[-1][2]
    table = None
    for epoch, schema in {epoch: schema for _, epoch, schema in schemas}.items():
        files = read_if_exists(spark, f"{path}/_epoch={epoch}", schema)
        if files is None:
            continue
        part = files.select(
            *(
                (F.col(f.name) if f.name in files.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in newest
            )
        )
        table = part if table is None else table.unionByName(part)
    return table


def _types(schema: T.StructType) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in schema}


_HISTORY = "version long, field string, old_type string, new_type string, change string, severity string"
#: Holds what could not be read. It comes and goes with such lines and is no change of schema.
UNREADABLE = "_corrupt_record"


def _compared(schema: T.StructType) -> T.StructType:
    return T.StructType([f for f in schema if f.name not in (UNREADABLE, "_run")])


def schema_change(spark: SparkSession, existing: T.StructType | None, incoming: T.StructType) -> str:
    """none, additive, widening or breaking; none when there is no table yet."""
    if existing is None or _types(_compared(existing)) == _types(_compared(incoming)):
        return "none"
    return classify(changed_fields(spark, existing, incoming)).first()["classification"]


def changed_fields(spark: SparkSession, existing: T.StructType, incoming: T.StructType) -> DataFrame:
    """(field, old_type, new_type, change, severity) of what an append of ``incoming`` would change."""
    return schema_diff(fields(spark, _compared(existing)), fields(spark, _compared(incoming)))


def stop_if_breaking(spark: SparkSession, existing: T.StructType | None, incoming: T.StructType, path: str) -> None:
    """Raise if an append of ``incoming`` would break the table."""
    if schema_change(spark, existing, incoming) == "breaking":
        changes = changed_fields(spark, existing, incoming).where("severity = 'breaking'").orderBy("field")
        found = ", ".join(f"{r.field}: {r.old_type} -> {r.new_type}" for r in changes.collect())
        raise SchemaEvolutionError(f"breaking schema change on {path}: {found}")


def schema_history(spark: SparkSession, path: str) -> DataFrame:
    """(version, field, old_type, new_type, change, severity): what each append changed, from version 1."""
    schemas = _schemas(spark, path)
    changes = None
    for (_, _, old), (version, _, new) in zip(schemas, schemas[1:], strict=False):
        part = changed_fields(spark, old, new).select(F.lit(version).cast("long").alias("version"), "*")
        changes = part if changes is None else changes.unionByName(part)
    return spark.createDataFrame([], _HISTORY) if changes is None else changes


def append_with_evolution(df: DataFrame, path: str, partition_by: Sequence[str] = (), run: str | None = None) -> str:
    """Append, letting the table take on new columns and safely wider types.

    A breaking change raises and writes nothing. Returns the kind of change. Rows of a ``run``
    go to partitions of its own (``_run``). Rows are gathered by partition first, or every
    task would write a file for every day it has a row of.
    """
    spark = df.sparkSession
    if run is not None:
        df, partition_by = df.withColumn("_run", F.lit(run)), (*partition_by, "_run")
    schemas = _schemas(spark, path)
    version, epoch, existing = schemas[-1] if schemas else (-1, 0, None)
    if existing is not None and UNREADABLE in existing.names and UNREADABLE not in df.columns:
        df = df.withColumn(UNREADABLE, F.lit(None).cast("string"))
    change = schema_change(spark, existing, df.schema)
    stop_if_breaking(spark, existing, df.schema, path)
    if existing is None or _types(existing) != _types(df.schema):
        # Folders of one epoch have the same partition columns.
        epoch += existing is not None and (change == "widening" or ("_run" in df.columns) != ("_run" in existing.names))
        line = spark.range(1).select(
            F.lit(version + 1).cast("long").alias("version"),
            F.lit(epoch).cast("long").alias("epoch"),
            F.lit(df.schema.json()).alias("schema"),
        )
        line.coalesce(1).write.mode("append").json(f"{path}/_schema")
    rows = df.hint("rebalance", *partition_by) if partition_by else df
    rows.write.mode("append").partitionBy(*partition_by).parquet(f"{path}/_epoch={epoch}")
    return change


def read_run(spark: SparkSession, path: str, run: str, day_column: str, day: date) -> DataFrame:
    """What a run has just appended on one day; only that day's folder is listed."""
    _, epoch, schema = _schemas(spark, path)[-1]
    folder = f"{path}/_epoch={epoch}"
    rows = spark.read.schema(schema).option("basePath", folder).parquet(f"{folder}/{day_column}={day}")
    return rows.where(F.col("_run") == run)


def append_new_rows(df: DataFrame, path: str, arrived: str = "_ingested_at") -> None:
    """Append the rows the table does not hold yet, as often as the batch has more of them.

    The table is laid out by day of arrival, and only the days of the batch are read. Rows
    are compared whole, so a batch that comes again adds nothing, and rows that are alike
    within a batch are all kept.
    """
    rows = df.withColumn("_arrival_date", F.to_date(arrived))
    held = read_appended(df.sparkSession, path)
    if held is not None:
        days = [r[0] for r in rows.select("_arrival_date").distinct().collect()]
        rows = rows.exceptAll(held.where(on_days("_arrival_date", days)).select(*rows.columns))
    append_with_evolution(rows, path, ["_arrival_date"])


# --- silver ------------------------------------------------------------------
#
# <path>/ingest_date=<day>/_run=<id>/   rows that run <id> brought for that day
#
# A run writes its rows to directories of its own and rewrites only those
# directories of earlier runs that hold rows it replaces. Everything it will
# write is first staged in <path>_staging and then marked pending; applying
# it overwrites whole directories, so it may be repeated after a crash.

_STORED_SCHEMA = T.StructType([*SILVER_SCHEMA.fields, T.StructField("_run", T.StringType())])
_DIRECTORY = ("ingest_date", "_run")
_DIRECTORY_SCHEMA = T.StructType([_STORED_SCHEMA[c] for c in _DIRECTORY])


def read_silver(spark: SparkSession, path: str) -> DataFrame | None:
    stored = read_if_exists(spark, path, _STORED_SCHEMA)
    return None if stored is None else stored.select(*SILVER_SCHEMA.names)


def staging_folder(path: str) -> str:
    """Beside the table, so that whoever finds the table finds what is pending."""
    return f"{path.rstrip('/')}_staging"


def stage_batch(batch: DataFrame, path: str, name: str = "batch") -> DataFrame:
    """Write the cleaned batch once; the gate and the upsert read it from there.

    ``upsert_staged`` brings in what is staged under the name ``batch``.
    """
    spark = batch.sparkSession
    folder = f"{staging_folder(path)}/{name}"
    batch.write.mode("overwrite").parquet(folder)
    return spark.read.schema(SILVER_SCHEMA).parquet(folder)


def _directory() -> Column:
    day = F.coalesce(F.col("ingest_date").cast("string"), F.lit("none"))
    return F.concat_ws("|", day, "_run")


def on_days(column: str, days: list) -> Column:
    """Predicate on a partition column; events without a time have a day of their own."""
    known = F.col(column).isin([day for day in days if day is not None])
    return (known | F.col(column).isNull()) if None in days else known


def _mark(spark: SparkSession, path: str, state: str, run: str) -> None:
    row = spark.range(1).select(F.lit(state).alias("state"), F.lit(run).alias("run"))
    row.coalesce(1).write.mode("overwrite").json(f"{staging_folder(path)}/state")


def upsert_staged(spark: SparkSession, path: str, event_times_fixed: bool = False) -> None:
    """Upsert the staged batch, one row per event id, into the table at ``path``.

    An event may come again with another time, so rows to replace are looked for in
    all days. Where producers never change the time of an event,
    ``event_times_fixed`` keeps the search to the days of the batch.
    """
    folder = staging_folder(path)
    staged = spark.read.schema(SILVER_SCHEMA).parquet(f"{folder}/batch")
    stored = read_if_exists(spark, path, _STORED_SCHEMA)
    if stored is None:
        stored = spark.createDataFrame([], _STORED_SCHEMA)
    keys = staged.where(F.col("event_id").isNotNull()).select("event_id")

    # Which directories hold rows to be replaced: reads the ids of the table only, and of
    # these only such as the batch may have are shuffled.
    if event_times_fixed:
        days = [r.ingest_date for r in staged.select("ingest_date").distinct().collect()]
        stored = stored.where(on_days("ingest_date", days))
    held = with_few_keys(stored.select("event_id", *_DIRECTORY), keys)
    held.select(*_DIRECTORY).distinct().write.mode("overwrite").parquet(f"{folder}/rewritten")
    rewritten = spark.read.schema(_DIRECTORY_SCHEMA).parquet(f"{folder}/rewritten")
    names = [r.name for r in rewritten.select(_directory().alias("name")).collect()]

    # What stays in them. The predicate is on partition columns, so nothing else is read.
    touched = stored.where(_directory().isin(names) if names else F.lit(False))
    without_few_keys(touched, keys).write.mode("overwrite").parquet(f"{folder}/kept")

    _mark(spark, path, "pending", f"r{uuid.uuid4().hex}")
    apply_pending(spark, path)


def apply_pending(spark: SparkSession, path: str) -> bool:
    """Bring a staged upsert into the table, also one that an earlier run left undone."""
    folder = staging_folder(path)
    state = read_if_exists(spark, f"{folder}/state", fmt="json")
    row = None if state is None else state.first()
    if row is None or row.state != "pending":
        return False
    kept = spark.read.schema(_STORED_SCHEMA).parquet(f"{folder}/kept")
    batch = spark.read.schema(SILVER_SCHEMA).parquet(f"{folder}/batch")
    overwrite_partitions(kept.unionByName(batch.withColumn("_run", F.lit(row.run))), path, _DIRECTORY)
    rewritten = spark.read.schema(_DIRECTORY_SCHEMA).parquet(f"{folder}/rewritten")
    still_used = kept.select(_directory().alias("name")).distinct()
    emptied = rewritten.withColumn("name", _directory()).join(still_used, "name", "left_anti")
    empty_partitions(path, _STORED_SCHEMA, emptied.select(*_DIRECTORY))
    _log_changed_days(
        path, rewritten.select("ingest_date").unionByName(batch.select("ingest_date")).distinct()
    )
    _mark(spark, path, "done", row.run)
    return True


# The newest arrival up to which all were merged. Needed once a window of arrivals was
# processed out of order; until then it is the newest arrival in the table. It only
# grows, so the largest entry holds.

_MERGED = T.StructType([T.StructField("micros", T.LongType())])
NOTHING_MERGED = -(2**62)


def stored_watermark(spark: SparkSession, path: str) -> int | None:
    """Microseconds, if a watermark was stored; before all arrivals if nothing was merged."""
    log = read_if_exists(spark, f"{path}/_merged", _MERGED, "json")
    return None if log is None else log.agg(F.max("micros").alias("m")).first().m


def store_watermark(spark: SparkSession, path: str, micros: int | None) -> None:
    row = spark.range(1).select(F.lit(NOTHING_MERGED if micros is None else micros).alias("micros"))
    row.coalesce(1).write.mode("append").json(f"{path}/_merged")


# Days whose rows an upsert changed, numbered by upsert, so that what is built on
# silver need only read those. Logged once the rows are in place and before the
# upsert counts as done: a day may be logged twice, but never missed.

_CHANGES = T.StructType(
    [T.StructField("ingest_date", T.DateType()), T.StructField("change", T.LongType())]
)


def changed_days(spark: SparkSession, path: str) -> DataFrame | None:
    return read_if_exists(spark, f"{path}/_changes", _CHANGES)


def _log_changed_days(path: str, days: DataFrame) -> None:
    known = changed_days(days.sparkSession, path)
    last = 0 if known is None else known.agg(F.max("change").alias("last")).first().last or 0
    numbered = days.withColumn("change", F.lit(last + 1).cast("bigint"))
    numbered.coalesce(1).write.mode("append").partitionBy("change").parquet(f"{path}/_changes")


def overwrite_partitions(rows: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace the partitions that ``rows`` fall in and leave the others.

    Rebalancing first gathers a partition's rows into few files, and Spark splits
    a partition that is too large for one task.
    """
    (
        rows.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def empty_partitions(path: str, schema: T.StructType, partitions: DataFrame) -> None:
    """Leave no rows in the given partitions, which no new row overwrites."""
    by = partitions.columns
    nothing = partitions.sparkSession.createDataFrame(
        [], T.StructType([f for f in schema if f.name not in by])
    )
    for values in partitions.collect():
        folder = "/".join(
            f"{c}={'__HIVE_DEFAULT_PARTITION__' if values[c] is None else values[c]}" for c in by
        )
        nothing.write.mode("overwrite").parquet(f"{path}/{folder}")


def merge_into(staged: DataFrame, table: str) -> None:
    """The upsert as one MERGE, for a catalog table whose format supports it."""
    same_event = F.expr(f"{table}.event_id = batch.event_id")
    merge = staged.alias("batch").mergeInto(table, same_event)
    merge.whenMatched().updateAll().whenNotMatched().insertAll().merge()


# --- marts -------------------------------------------------------------------


def write_table(df: DataFrame, path: str, by: str | None = None) -> DataFrame:
    """Full refresh of a table from data outside it; returns the stored rows."""
    rows = df if by is None else df.hint("rebalance", by)
    rows.write.mode("overwrite").partitionBy(*([by] if by else [])).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result to the shared folder and go on from there."""
    return write_table(df, f"{shared_folder(df.sparkSession)}/loglake-scratch/{name}-{uuid.uuid4().hex}")


def clear_scratch(table: DataFrame) -> None:
    """Leave no rows of a scratch table that nothing will be read from any more.

    What was made of it must be stored by then, or a lost executor could not be made up for.
    """
    files = table.inputFiles()
    if files:
        nothing = table.sparkSession.createDataFrame([], table.schema)
        nothing.write.mode("overwrite").parquet(unquote(files[0].rsplit("/", 1)[0]))
