"""The questions the dashboard asks of the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from loglake.contract import TOP_ENDPOINTS


def daily_series(daily: DataFrame) -> DataFrame:
    return daily.orderBy("event_date")


def panel_traffic(daily: DataFrame) -> DataFrame:
    return daily.select("event_date", "request_count").orderBy("event_date")


def panel_error_rate(daily: DataFrame) -> DataFrame:
    return daily.select("event_date", "server_error_rate").orderBy("event_date")


def panel_latency(daily: DataFrame) -> DataFrame:
    return daily.select("event_date", "p50_latency_ms", "p95_latency_ms", "p99_latency_ms").orderBy(
        "event_date"
    )


def latest_day_kpis(daily: DataFrame) -> DataFrame:
    """Headline numbers of the last day; no row when there is no day."""
    return (
        daily.orderBy(F.col("event_date").desc_nulls_last())
        .limit(1)
        .select(
            "event_date",
            "request_count",
            (F.col("server_error_rate") * 100).alias("server_error_percent"),
            "p95_latency_ms",
            "unique_users",
        )
    )


def top_endpoints(endpoints: DataFrame, n: int = TOP_ENDPOINTS) -> DataFrame:
    """The busiest endpoints; names settle ties."""
    return (
        endpoints.select(
            "endpoint",
            "method",
            "request_count",
            "server_error_rate",
            "avg_latency_ms",
            "p95_latency_ms",
            "traffic_rank",
        )
        .orderBy(F.desc("request_count"), "endpoint", "method")
        .limit(n)
    )


def top_endpoint_bars(endpoints: DataFrame, n: int = TOP_ENDPOINTS) -> DataFrame:
    """Bars of the busiest endpoints, one per table row, keyed by endpoint alone."""
    return top_endpoints(endpoints, n).select("endpoint", "request_count")


def requests_per_endpoint(endpoints: DataFrame) -> DataFrame:
    """Requests per endpoint over all its methods."""
    return endpoints.groupBy("endpoint").agg(F.sum("request_count").alias("request_count"))
