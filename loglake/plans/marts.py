"""Marts: daily facts and the endpoint rollup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from loglake.operators.percentiles import latency_counts, recount, request_profile
from loglake.operators.ranking import rank_by_count

SKETCH_PRECISION = 14
ERRORS = ("server_errors", "client_errors")


def daily_unique_users(logs: DataFrame) -> DataFrame:
    """Exact distinct users per day; Spark first removes repeats per (day, user)."""
    return logs.groupBy("event_date").agg(F.count_distinct("user_id").alias("unique_users"))


def daily_facts(counts: DataFrame, users: DataFrame) -> DataFrame:
    """One row per day, from latency counts by day and the users of each day."""
    daily = request_profile(counts, ["event_date"], [50, 95, 99]).alias("daily")
    same_day = F.col("daily.event_date").eqNullSafe(F.col("users.event_date"))
    return daily.join(users.alias("users"), same_day).select(
        "daily.event_date",
        "request_count",
        "unique_users",
        "server_error_count",
        "client_error_count",
        "server_error_rate",
        "avg_latency_ms",
        "p50_latency_ms",
        "p95_latency_ms",
        "p99_latency_ms",
    )


def daily_user_sketches(logs: DataFrame, precision: int = SKETCH_PRECISION) -> DataFrame:
    """One sketch of the users of each day (2**precision bytes at most), beside the exact counts.

    Sketches merge, so the users of any span of days come from as many small rows, without the
    logs; see ``users_of_span``. At the default precision the standard error is 0.8 per cent.
    """
    return logs.groupBy("event_date").agg(F.hll_sketch_agg("user_id", precision).alias("users"))


def users_of_span(sketches: DataFrame, first: Column | None = None, last: Column | None = None) -> DataFrame:
    """One row: about how many users the days from ``first`` to ``last`` have together."""
    if first is not None:
        sketches = sketches.where(F.col("event_date") >= first)
    if last is not None:
        sketches = sketches.where(F.col("event_date") <= last)
    return sketches.agg(F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("users")), F.lit(0)).alias("unique_users"))


def fct_requests_daily(logs: DataFrame) -> DataFrame:
    """One row per day.

    Users and latencies are reduced apart: in one aggregation the latency buffers
    would be kept, and shuffled, per (day, user).
    """
    return daily_facts(latency_counts(logs, ["event_date"]), daily_unique_users(logs))


def endpoint_facts(counts: DataFrame) -> DataFrame:
    """One row per (endpoint, method), not yet ranked, from latency counts by both."""
    return request_profile(counts, ["endpoint", "method"], [95]).select(
        "endpoint",
        "method",
        "request_count",
        "server_error_count",
        "server_error_rate",
        "avg_latency_ms",
        "p95_latency_ms",
    )


def endpoint_rollup(logs: DataFrame) -> DataFrame:
    return endpoint_facts(latency_counts(logs, ["endpoint", "method"]))


def with_traffic_rank(rollup: DataFrame) -> DataFrame:
    return rank_by_count(rollup, "request_count", "traffic_rank").select(*rollup.columns, "traffic_rank")


def dim_endpoints(logs: DataFrame) -> DataFrame:
    """One row per (endpoint, method) with its rank by traffic.

    The rank reads the rollup a second time. A job that writes the mart writes the
    rollup first and ranks the written rows (see ``jobs.build_marts``).
    """
    return with_traffic_rank(endpoint_rollup(logs))


# Stored marts are kept up by day. The cube holds latency counts per day, endpoint
# and method; both marts follow from it, except for the users of a day.


def request_cube(logs: DataFrame) -> DataFrame:
    cube = latency_counts(logs, ["event_date", "endpoint", "method"])
    return cube.withColumn("event_day", F.to_date("event_date"))


def daily_from_cube(cube: DataFrame, logs: DataFrame) -> DataFrame:
    counts = recount(cube, ["event_date"], "latency_ms", *ERRORS)
    return daily_facts(counts, daily_unique_users(logs)).withColumn("event_day", F.to_date("event_date"))


def rollup_from_cube(cube: DataFrame) -> DataFrame:
    return endpoint_facts(recount(cube, ["endpoint", "method"], "latency_ms", *ERRORS))
