"""What comes before a row in a global order, without bringing all rows to one task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from loglake.sources.tables import scratch_table


def _running_before(
    df: DataFrame, order: str, value: str, name: str, total: Callable[[Column], Column], both: Callable[[Column, Column], Column]
) -> DataFrame:
    """``total`` of the values of all rows before each one; null where there is none.

    Rows are parted by ranges of ``order``, which has no value twice, and stored, lest the
    ranges be drawn anew. Only the totals of the parts, a row for each, meet in one task;
    what the parts before a row's own come to is joined back.
    """
    ranged = df.repartitionByRange(F.col(order).asc_nulls_first()).withColumn("_part", F.spark_partition_id())
    stored = scratch_table(ranged, "ranges")
    up_to = (Window.unboundedPreceding, -1)
    in_part = Window.partitionBy("_part").orderBy(F.col(order).asc_nulls_first()).rowsBetween(*up_to)
    parts = stored.groupBy("_part").agg(total(F.col(value)).alias("_total"))
    carried = parts.select("_part", total(F.col("_total")).over(Window.orderBy("_part").rowsBetween(*up_to)).alias("_carried"))
    rows = stored.withColumn("_own", total(F.col(value)).over(in_part)).join(carried, "_part")
    return rows.withColumn(name, both(F.col("_own"), F.col("_carried"))).drop("_part", "_own", "_carried")


def running_max_before(df: DataFrame, order: str, value: str, name: str) -> DataFrame:
    """The rows with ``name``, the greatest value of all rows before in the order of a distinct column."""
    return _running_before(df, order, value, name, F.max, F.greatest)


def running_sum_before(df: DataFrame, order: str, value: str, name: str) -> DataFrame:
    """The rows with ``name``, the sum of the values of all rows before; null for none."""

    def add(a: Column, b: Column) -> Column:
        return F.coalesce(a + b, a, b)

    return _running_before(df, order, value, name, F.sum, add)
