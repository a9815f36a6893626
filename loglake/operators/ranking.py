"""Rank over a whole table without sorting it in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def rank_by_count(df: DataFrame, count: str, rank: str) -> DataFrame:
    """rank() over (order by ``count`` desc), gaps on ties.

    The rank of a row is one more than the number of rows with a higher count, so
    it is enough to order the distinct counts. Counts that add up to N rows of
    input have fewer than sqrt(2N) distinct values: about 1.4 million for 10^12
    rows, which one task sorts in seconds and Spark may broadcast by its measure.
    """
    groups = df.groupBy(count).agg(F.count("*").alias("_groups"))
    above = Window.orderBy(F.col(count).desc()).rowsBetween(Window.unboundedPreceding, -1)
    ranks = groups.select(
        F.col(count), (F.coalesce(F.sum("_groups").over(above), F.lit(0)) + 1).alias(rank)
    )
    return df.join(ranks, count)
