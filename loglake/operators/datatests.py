"""Declarative data tests on silver, staging and marts.

Each test selects its failing rows (or failing values); the suite counts them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from loglake.contract import FRESHNESS_HOURS, KNOWN_STATUS_CODES, VALID_METHODS
from loglake.functions.columns import count_where


def failing_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("string").alias("value"))
        .agg(F.count("*").alias("row_count"))
        .where(F.col("row_count") > 1)
    )


def failing_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def _unaccepted(column: str, values: Sequence) -> Column:
    return ~F.col(column).isin(*values)


def failing_accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list, with their rows. A missing value is not tested."""
    return (
        df.where(_unaccepted(column, values))
        .groupBy(F.col(column).cast("string").alias("value"))
        .agg(F.count("*").alias("row_count"))
    )


def _outside(column: str, low: float, high: float) -> Column:
    return ~F.col(column).between(low, high)


def failing_accepted_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Rows outside [low, high]. A missing value is not tested."""
    return df.where(_outside(column, low, high))


def _oldest(as_of: datetime, hours: int) -> Column:
    return F.lit(as_of).cast("timestamp") - F.make_dt_interval(hours=F.lit(hours))


def failing_freshness(
    df: DataFrame, as_of: datetime, hours: int = FRESHNESS_HOURS, require_rows: bool = False
) -> DataFrame:
    """One row when the newest event is more than ``hours`` older than ``as_of``, and by how much.

    An empty table passes, unless ``require_rows``; its staleness is null.
    """
    stale = F.coalesce(F.col("most_recent_event") < _oldest(as_of, hours), F.lit(require_rows))
    newest = df.agg(F.max("event_ts").alias("most_recent_event"))
    staleness = F.lit(as_of).cast("timestamp") - F.col("most_recent_event")
    return newest.withColumn("staleness", staleness).where(stale)


class DataTest(NamedTuple):
    model: str
    column: str
    kind: str  # unique, not_null, accepted_values, accepted_range, freshness
    severity: str = "error"
    values: tuple = ()


# The tests, by model and column. Unknown status codes only warn.
DATA_TESTS = (
    DataTest("silver_events", "event_id", "unique"),
    DataTest("silver_events", "event_id", "not_null"),
    DataTest("silver_events", "event_time", "not_null"),
    DataTest("silver_events", "endpoint", "not_null"),
    DataTest("silver_events", "status_code", "not_null"),
    DataTest("stg_logs", "event_id", "unique"),
    DataTest("stg_logs", "event_id", "not_null"),
    DataTest("stg_logs", "status_code", "not_null"),
    DataTest("stg_logs", "status_code", "accepted_values", "warn", KNOWN_STATUS_CODES),
    DataTest("stg_logs", "method", "not_null"),
    DataTest("stg_logs", "method", "accepted_values", "error", VALID_METHODS),
    DataTest("stg_logs", "event_ts", "not_null"),
    DataTest("fct_requests_daily", "event_date", "unique"),
    DataTest("fct_requests_daily", "event_date", "not_null"),
    DataTest("fct_requests_daily", "request_count", "not_null"),
    DataTest("fct_requests_daily", "server_error_rate", "not_null"),
    DataTest("fct_requests_daily", "server_error_rate", "accepted_range", "error", (0.0, 1.0)),
    DataTest("dim_endpoints", "endpoint", "not_null"),
    DataTest("dim_endpoints", "request_count", "not_null"),
    DataTest("dim_endpoints", "traffic_rank", "not_null"),
    DataTest("stg_logs", "event_ts", "freshness"),
)


def _failures(test: DataTest, as_of: datetime, require_rows: bool) -> Column | None:
    """Count of failing rows or values as one aggregate; None for tests that need a shuffle of their own."""
    column = F.col(test.column)
    if test.kind == "not_null":
        return count_where(column.isNull())
    if test.kind == "accepted_range":
        return count_where(_outside(test.column, *test.values))
    if test.kind == "accepted_values":
        return F.count_distinct(F.when(_unaccepted(test.column, test.values), column.cast("string")))
    if test.kind == "freshness":
        return F.coalesce(F.max(column) < _oldest(as_of, FRESHNESS_HOURS), F.lit(require_rows)).cast("bigint")
    return None


def _result(test: DataTest, failures: Column) -> Column:
    failed = F.when(failures > 0, test.severity).otherwise("pass")
    return F.struct(
        F.lit(test.model).alias("model"),
        F.lit(test.column).alias("column_name"),
        F.lit(test.kind).alias("test"),
        F.lit(test.severity).alias("severity"),
        failures.cast("bigint").alias("failures"),
        failed.alias("status"),
    )


def run_data_tests(
    models: Mapping[str, DataFrame],
    as_of: datetime,
    tests: Sequence[DataTest] = DATA_TESTS,
    require_rows: bool = False,
) -> DataFrame:
    """One row per test: failures, severity and status (pass, warn or error).

    All tests of a model but those for unique values share one scan and one aggregate;
    those read their column only.
    """
    results = None
    for model, frame in models.items():
        mine = [t for t in tests if t.model == model]
        parts = []
        counted = {f"_{i}": (t, c) for i, t in enumerate(mine) if (c := _failures(t, as_of, require_rows)) is not None}
        if counted:
            counts = frame.agg(*(count.alias(name) for name, (_, count) in counted.items()))
            rows = F.array(*(_result(t, F.col(name)) for name, (t, _) in counted.items()))
            parts.append(counts.select(F.inline(rows)))
        for test in (t for t in mine if t.kind == "unique"):
            count = failing_unique(frame, test.column).agg(F.count("*").alias("_n"))
            parts.append(count.select(F.inline(F.array(_result(test, F.col("_n"))))))
        for part in parts:
            results = part if results is None else results.unionByName(part)
    return results


def suite_status(results: DataFrame) -> DataFrame:
    """One row: error if any test failed as an error, else warn, else pass."""
    worst = F.max(F.when(F.col("status") == "error", 2).when(F.col("status") == "warn", 1).otherwise(0))
    return results.agg(
        F.count("*").alias("tests"),
        F.count(F.when(F.col("failures") > 0, 1)).alias("failed"),
        F.when(worst == 2, "error").when(worst == 1, "warn").otherwise("pass").alias("status"),
    )
