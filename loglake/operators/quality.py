"""The quality gate: statistics of a batch, and the report on them.

Statistics and report are DataFrames. Only the report, ten rows at most, is ever
brought to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, functions as F

from loglake.contract import (
    MAX_LATENCY_MS,
    MAX_STATUS,
    MIN_STATUS,
    NULL_CHECKED_COLUMNS,
    NULL_RATE_THRESHOLD,
    VALID_METHODS,
)
from loglake.functions.columns import count_where

# Names of the rules and wording of their details.
RULE_NON_EMPTY = "non_empty_batch"
RULE_NULL_RATE = "null_rate::"
RULE_STATUS = "status_code_range"
RULE_METHOD = "method_whitelist"
RULE_LATENCY = "latency_sanity"
RULE_DUPLICATES = "no_duplicate_event_ids"
DETAIL_NON_EMPTY = "row_count=%d"
DETAIL_NULL_RATE = "%d/%d = %s (threshold %s)"
DETAIL_STATUS = "invalid codes found=[%s]"
DETAIL_STATUS_OK = "all codes in 100-599"
DETAIL_METHOD = "unknown methods=[%s]"
DETAIL_METHOD_OK = "all methods known"
DETAIL_LATENCY = "max_latency_ms=%d (limit %d)"
DETAIL_DUPLICATES = "duplicate_event_ids=%d"
LINE = "[%s] %s: %s"


def bad_status() -> Column:
    """Out of range; a missing status counts as bad."""
    return ~F.coalesce(F.col("status_code").between(MIN_STATUS, MAX_STATUS), F.lit(False))


def bad_method() -> Column:
    return ~F.coalesce(F.col("method").isin(*VALID_METHODS), F.lit(False))


def bad_values(df: DataFrame) -> DataFrame:
    """Every distinct bad status code and method with its number of rows."""
    status = F.struct(
        F.lit(RULE_STATUS).alias("rule"),
        F.coalesce(F.col("status_code").cast("string"), F.lit("NULL")).alias("value"),
        F.col("status_code").cast("bigint").alias("number"),
    )
    method = F.struct(
        F.lit(RULE_METHOD).alias("rule"),
        F.coalesce(F.concat(F.lit("'"), "method", F.lit("'")), F.lit("NULL")).alias("value"),
        F.lit(None).cast("bigint").alias("number"),
    )
    found = F.array_compact(F.array(F.when(bad_status(), status), F.when(bad_method(), method)))
    return (
        df.where(bad_status() | bad_method())
        .select(F.inline(found))
        .groupBy("rule", "value", "number")
        .agg(F.count("*").alias("row_count"))
    )


def _shown_values(df: DataFrame) -> DataFrame:
    """One row: the bad values of each rule as text, in order, null last.

    Every distinct value is in the line, as the report is read by a person who mends the batch;
    rows are counted by value before they meet.
    """
    def listed(rule: str) -> Column:
        entry = F.when(F.col("rule") == rule, F.struct(F.col("value") == "NULL", F.coalesce("number", F.lit(0)), "value"))
        entries = F.array_sort(F.collect_list(entry))
        return F.nullif(F.array_join(F.transform(entries, lambda e: e["value"]), ", "), F.lit(""))

    return bad_values(df).agg(
        listed(RULE_STATUS).alias("bad_status_codes"), listed(RULE_METHOD).alias("bad_methods")
    )


def _duplicate_ids(df: DataFrame) -> DataFrame:
    """One row: how many event ids occur more than once. Missing ids are not ids."""
    repeated = (
        df.where(F.col("event_id").isNotNull())
        .groupBy("event_id")
        .agg(F.count("*").alias("copies"))
        .where(F.col("copies") > 1)
    )
    return repeated.agg(F.count("*").alias("duplicate_event_ids"))


def batch_stats(df: DataFrame, ids_are_unique: bool = False) -> DataFrame:
    """One row of statistics on a batch.

    Three narrow reads, none of which moves whole rows: totals (no shuffle on a
    key), repeated ids (ids only), and bad values (bad rows only). A hot id or bad
    value is counted before it is shuffled. ``ids_are_unique`` is for batches that
    ``keep_latest`` has just made so, and spares the shuffle of ids.
    """
    totals = df.agg(
        F.count("*").alias("row_count"),
        *(count_where(F.col(c).isNull()).alias(f"null_{c}") for c in NULL_CHECKED_COLUMNS),
        F.coalesce(F.max("latency_ms"), F.lit(0)).cast("bigint").alias("max_latency_ms"),
        F.min("event_time").alias("min_event_time"),
        F.max("event_time").alias("max_event_time"),
    )
    if ids_are_unique:
        totals = totals.withColumn("duplicate_event_ids", F.lit(0).cast("bigint"))
        parts = totals.unionByName(_shown_values(df), allowMissingColumns=True)
    else:
        parts = totals.unionByName(_duplicate_ids(df), allowMissingColumns=True).unionByName(
            _shown_values(df), allowMissingColumns=True
        )
    return parts.agg(*(F.max(c).alias(c) for c in parts.columns))


def gate_report(
    stats: DataFrame,
    null_rate_threshold: float = NULL_RATE_THRESHOLD,
    max_latency_ms: int = MAX_LATENCY_MS,
) -> DataFrame:
    """Report rows (position, name, passed, detail) from one row of statistics.

    An empty batch fails the first rule and is not put to the others.
    """
    rows = F.col("row_count")

    def line(position: int, name: str, passed: Column, detail: Column) -> Column:
        return F.struct(
            F.lit(position).alias("position"),
            F.lit(name).alias("name"),
            F.coalesce(passed, F.lit(False)).alias("passed"),
            detail.alias("detail"),
        )

    def null_rate(position: int, column: str) -> Column:
        nulls = F.col(f"null_{column}")
        rate = nulls / F.nullif(rows, F.lit(0))
        shown = F.round(rate.cast("decimal(38,10)"), 4).cast("decimal(10,4)").cast("string")
        return line(
            position,
            RULE_NULL_RATE + column,
            rate <= null_rate_threshold,
            F.format_string(DETAIL_NULL_RATE, nulls, rows, shown, F.lit(str(null_rate_threshold))),
        )

    def no_bad_values(position: int, name: str, values: Column, bad: str, ok: str) -> Column:
        detail = F.when(values.isNull(), ok).otherwise(F.format_string(bad, values))
        return line(position, name, values.isNull(), detail)

    after_nulls = 2 + len(NULL_CHECKED_COLUMNS)
    lines = F.array(
        line(1, RULE_NON_EMPTY, rows > 0, F.format_string(DETAIL_NON_EMPTY, rows)),
        *(null_rate(2 + i, column) for i, column in enumerate(NULL_CHECKED_COLUMNS)),
        no_bad_values(
            after_nulls, RULE_STATUS, F.col("bad_status_codes"), DETAIL_STATUS, DETAIL_STATUS_OK
        ),
        no_bad_values(
            after_nulls + 1, RULE_METHOD, F.col("bad_methods"), DETAIL_METHOD, DETAIL_METHOD_OK
        ),
        line(
            after_nulls + 2,
            RULE_LATENCY,
            F.col("max_latency_ms") <= max_latency_ms,
            F.format_string(
                DETAIL_LATENCY, F.col("max_latency_ms"), F.lit(max_latency_ms).cast("bigint")
            ),
        ),
        line(
            after_nulls + 3,
            RULE_DUPLICATES,
            F.col("duplicate_event_ids") == 0,
            F.format_string(DETAIL_DUPLICATES, F.col("duplicate_event_ids")),
        ),
    )
    applicable = F.when(rows > 0, lines).otherwise(F.slice(lines, 1, 1))
    return stats.select(F.inline(applicable))


def with_text(report: DataFrame) -> DataFrame:
    """The report with each line as text."""
    mark = F.when(F.col("passed"), "PASS").otherwise("FAIL")
    return report.withColumn("text", F.format_string(LINE, mark, "name", "detail"))


def report_summary(report: DataFrame) -> DataFrame:
    """One row: whether all rules passed, the failed ones, and the report as text."""
    entries = F.array_sort(F.collect_list(F.struct("position", "name", "passed", "text")))
    failed = F.filter(entries, lambda e: ~e["passed"])
    return with_text(report).agg(
        F.bool_and("passed").alias("passed"),
        F.array_join(F.transform(failed, lambda e: e["name"]), ",").alias("failures"),
        F.array_join(F.transform(entries, lambda e: e["text"]), "\n").alias("summary"),
    )


def check_batch(df: DataFrame, ids_are_unique: bool = False, **limits) -> tuple[bool, list[Row], str]:
    """Run the gate: (passed, report rows, text)."""
    report = gate_report(batch_stats(df, ids_are_unique), **limits)
    rows = with_text(report).orderBy("position").collect()  # ten at most
    return all(r.passed for r in rows), rows, "\n".join(r.text for r in rows)


def broken_rules(df: DataFrame, max_latency_ms: int = MAX_LATENCY_MS) -> DataFrame:
    """Every row with the list of rules it breaks by itself, so a quarantine explains itself.

    Null rates and duplicates are properties of a batch; a row carries the null
    that adds to a rate.
    """
    tags = [
        *(F.when(F.col(c).isNull(), RULE_NULL_RATE + c) for c in NULL_CHECKED_COLUMNS),
        F.when(bad_status(), RULE_STATUS),
        F.when(bad_method(), RULE_METHOD),
        F.when(F.col("latency_ms") > max_latency_ms, RULE_LATENCY),
    ]
    return df.withColumn("broken_rules", F.array_compact(F.array(*tags)))


def rows_by_broken_rule(df: DataFrame) -> DataFrame:
    tagged = broken_rules(df).select(F.explode("broken_rules").alias("rule"))
    return tagged.groupBy("rule").agg(F.count("*").alias("row_count"))
