"""Keyed upsert as a relational operation: target without the replaced rows, plus source."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from loglake.operators.reducer import key_filter, split_by_filter


def without_keys(target: DataFrame, keys: DataFrame, key: str = "event_id") -> DataFrame:
    """Target rows whose key is not in ``keys``.

    Rows with a null key match nothing. They go round the join, where they would
    all hash to one task; the column statistics let the scan for them skip files.
    """
    keyed = target.where(F.col(key).isNotNull()).join(keys.select(key), key, "left_anti")
    return keyed.unionByName(target.where(F.col(key).isNull()))


def without_few_keys(target: DataFrame, keys: DataFrame, key: str = "event_id") -> DataFrame:
    """The same for a target with many more keys than ``keys``, which is read twice.

    Only rows whose key may be among the others are shuffled (see ``reducer``). The keys are
    not broadcast: by the size of their files, of which one column is read, Spark would take
    millions of them for a small table.
    """
    suspects, others = split_by_filter(target, key, key_filter(keys, key))
    return suspects.join(keys.select(key).hint("merge"), key, "left_anti").unionByName(others)


def with_few_keys(target: DataFrame, keys: DataFrame, key: str = "event_id") -> DataFrame:
    """Target rows whose key is in ``keys``, likewise."""
    suspects, _ = split_by_filter(target, key, key_filter(keys, key))
    return suspects.join(keys.select(key).hint("merge"), key, "left_semi")


def upsert(target: DataFrame, source: DataFrame, key: str = "event_id") -> DataFrame:
    """Replace matched rows, insert the rest. ``source`` has one row per key."""
    return without_keys(target, source, key).unionByName(source, allowMissingColumns=True)


def not_set_back(source: DataFrame, target: DataFrame, key: str = "event_id") -> DataFrame:
    """Source rows for an upsert that may bring old arrivals again.

    Left out are rows of which the target holds a newer version (by arrival, batch and
    file), and rows without a key from files and arrivals whose rows without a key the
    target holds: such rows come together, so those of one arrival are all there.
    """
    version = ("_ingested_at", "ingest_batch_id", "_source_file")
    held = target.where(F.col(key).isNotNull()).select(
        F.col(key).alias("_key"), F.struct(*version).alias("_version")
    )
    newer = (F.col(key) == F.col("_key")) & (F.col("_version") > F.struct(*version))
    few = key_filter(source, key)
    held, _ = split_by_filter(held.withColumnRenamed("_key", key), key, few)
    held = held.withColumnRenamed(key, "_key").hint("merge")  # not broadcast, as above
    keyed = source.where(F.col(key).isNotNull()).join(held, newer, "left_anti")
    arrivals = target.where(F.col(key).isNull()).select(
        F.col("_source_file").alias("_file"), F.col("_ingested_at").alias("_at")
    )
    same = F.col("_source_file").eqNullSafe(F.col("_file")) & F.col("_ingested_at").eqNullSafe(F.col("_at"))
    without_key = source.where(F.col(key).isNull()).join(arrivals.distinct(), same, "left_anti")
    return keyed.unionByName(without_key)


def upsert_effect(target: DataFrame, source: DataFrame, key: str = "event_id") -> DataFrame:
    """How many source rows an upsert inserts and how many it updates.

    Source keys may be null; those rows are inserts and skip the join.
    """
    keyed = source.where(F.col(key).isNotNull()).select(key)
    updated = keyed.join(target.select(key), key, "left_semi").agg(
        F.count("*").alias("updated"), F.lit(0).cast("bigint").alias("total")
    )
    total = source.agg(F.lit(0).cast("bigint").alias("updated"), F.count("*").alias("total"))
    sums = updated.unionByName(total).agg(F.sum("updated").alias("u"), F.sum("total").alias("t"))
    return sums.select(
        F.inline(
            F.array(
                F.struct(F.lit("inserted").alias("action"), (F.col("t") - F.col("u")).alias("row_count")),
                F.struct(F.lit("updated").alias("action"), F.col("u").alias("row_count")),
            )
        )
    )


def step_counts(read: DataFrame, new: DataFrame, candidate: DataFrame, merged: DataFrame) -> DataFrame:
    """Row counts around the steps of a run, one row per step."""
    steps = {"read": read, "new": new, "candidate": candidate, "merged": merged}
    counts = None
    for step, frame in steps.items():
        row = frame.agg(F.count("*").alias("row_count")).select(F.lit(step).alias("step"), "row_count")
        counts = row if counts is None else counts.unionByName(row)
    return counts

