"""Exact group profiles of an integer measure, by way of its distinct values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from loglake.functions.columns import round_half_up, safe_rate


def value_counts(df: DataFrame, keys: Sequence[str], value: str, **sums: Column) -> DataFrame:
    """Rows per (keys, value), with further sums.

    All buffers are plain longs, so each map task reduces its rows to the distinct
    values of a group before the shuffle, however many rows the group has.
    """
    return df.groupBy(*keys, value).agg(
        F.count("*").alias("n"), *(F.sum(column).alias(name) for name, column in sums.items())
    )


def _at_percent(value: str, percent: int) -> Column:
    """Linear interpolation between the two ranks around ``percent``.

    The position is kept in hundredths of a rank, as whole numbers, so it stays
    exact for any number of rows.
    """
    hundredths = (F.col("_total") - 1) * percent
    low = F.expr(f"((_total - 1) * {percent}) div 100")
    weight = hundredths % 100

    def value_at(rank: Column) -> Column:
        covers = (F.col("_before") <= rank) & (rank < F.col("_upto"))
        return F.max(F.when(covers, F.col(value)))

    lower, upper = value_at(low), value_at(low + F.when(weight > 0, 1).otherwise(0))
    part = F.max(weight)
    return (lower * (100 - part) + upper * part).cast("decimal(38,10)") / 100


def profile(
    counts: DataFrame, keys: Sequence[str], value: str, percents: Sequence[int], *extra: Column
) -> DataFrame:
    """Per group: row count, average and exact percentiles of ``value``, and ``extra``.

    ``counts`` comes from :func:`value_counts`. A group is ranked by a running sum
    over its distinct values, which spills rather than filling memory; for
    whole milliseconds under the gate's limit there are some thirty thousand.
    """
    present = F.when(F.col(value).isNotNull(), F.col("n")).otherwise(0)
    group = Window.partitionBy(*keys)
    running = group.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = (
        counts.withColumn("_present", present)
        .withColumn("_upto", F.sum("_present").over(running))
        .withColumn("_total", F.sum("_present").over(group))
        .withColumn("_before", F.col("_upto") - F.col("_present"))
    )
    average = F.sum(F.col(value).cast("bigint") * F.col("_present")) / F.nullif(
        F.sum("_present"), F.lit(0)
    )
    return ranked.groupBy(*keys).agg(
        F.sum("n").alias("row_count"),
        *extra,
        round_half_up(average, 1).alias(f"avg_{value}"),
        *(round_half_up(_at_percent(value, p), 1).alias(f"p{p}_{value}") for p in percents),
    )


def recount(counts: DataFrame, keys: Sequence[str], value: str, *sums: str) -> DataFrame:
    """The same counts by fewer keys."""
    return counts.groupBy(*keys, value).agg(F.sum("n").alias("n"), *(F.sum(c).alias(c) for c in sums))


def latency_counts(logs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Requests and errors per (keys, latency)."""
    return value_counts(
        logs,
        keys,
        "latency_ms",
        server_errors=F.col("is_server_error").cast("int"),
        client_errors=F.col("is_client_error").cast("int"),
    )


def request_profile(counts: DataFrame, keys: Sequence[str], percents: Sequence[int]) -> DataFrame:
    """Traffic, errors and latency of requests per group of ``keys``, from latency counts."""
    totals = profile(
        counts,
        keys,
        "latency_ms",
        percents,
        F.sum("server_errors").alias("server_error_count"),
        F.sum("client_errors").alias("client_error_count"),
    )
    return totals.withColumnRenamed("row_count", "request_count").withColumn(
        "server_error_rate", safe_rate(F.col("server_error_count"), F.col("request_count"))
    )
