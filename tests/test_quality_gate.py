"""Gate rules, first on given statistics, then on rows with a single fault."""

import pytest

from loglake.contract import MAX_LATENCY_MS, MAX_STATUS, NULL_CHECKED_COLUMNS, NULL_RATE_THRESHOLD
from loglake.operators.cleaning import keep_latest
from loglake.operators.quality import (
    RULE_DUPLICATES,
    RULE_LATENCY,
    RULE_METHOD,
    RULE_NULL_RATE,
    RULE_STATUS,
    bad_values,
    batch_stats,
    broken_rules,
    check_batch,
    gate_report,
    report_summary,
)

STATS = (
    "row_count bigint, null_event_id bigint, null_event_time bigint, null_endpoint bigint,"
    "null_status_code bigint, null_user_id bigint, max_latency_ms bigint,"
    "duplicate_event_ids bigint, bad_status_codes string, bad_methods string"
)
ROWS = 5_000
ALLOWED = int(ROWS * NULL_RATE_THRESHOLD)
CLEAN = {
    "row_count": ROWS,
    **{f"null_{c}": 0 for c in NULL_CHECKED_COLUMNS},
    "max_latency_ms": 0,
    "duplicate_event_ids": 0,
    "bad_status_codes": None,
    "bad_methods": None,
}


def _cases():
    """Each limit of the contract just below, at and above it."""
    yield "nothing wrong", {}, []
    for column in NULL_CHECKED_COLUMNS:
        rule = f"{RULE_NULL_RATE}{column}"
        for nulls, failures in ((ALLOWED - 1, []), (ALLOWED, []), (ALLOWED + 1, [rule]), (ROWS, [rule])):
            yield f"{nulls} of {column} missing", {f"null_{column}": nulls}, failures
    for latency, failures in ((MAX_LATENCY_MS - 1, []), (MAX_LATENCY_MS, []), (MAX_LATENCY_MS + 1, [RULE_LATENCY])):
        yield f"latency {latency}", {"max_latency_ms": latency}, failures
    yield "one id twice", {"duplicate_event_ids": 1}, [RULE_DUPLICATES]
    yield "a code", {"bad_status_codes": str(MAX_STATUS + 1)}, [RULE_STATUS]
    yield "a method", {"bad_methods": "'?'"}, [RULE_METHOD]
    everything = {k: ROWS for k in CLEAN if k.startswith("null_")} | {"bad_methods": "NULL", "bad_status_codes": "NULL"}
    yield "everything missing", everything, [f"{RULE_NULL_RATE}{c}" for c in NULL_CHECKED_COLUMNS] + [RULE_STATUS, RULE_METHOD]


CASES = {name: rest for name, *rest in _cases()}


def report_on(spark, **changes):
    stats = {**CLEAN, **changes}
    return gate_report(spark.createDataFrame([tuple(stats.values())], STATS))


@pytest.mark.parametrize("case", list(CASES))
def test_rules_on_statistics(spark, case):
    changes, failures = CASES[case]
    report = report_on(spark, **changes).orderBy("position").collect()
    assert [r.name for r in report if not r.passed] == failures
    assert len(report) == 10


def test_empty_batch_has_one_failed_line(spark):
    report = report_on(spark, row_count=0).collect()
    assert [(r.name, r.passed) for r in report] == [("non_empty_batch", False)]


def test_summary_text(spark):
    summary = report_summary(report_on(spark, null_event_id=5, max_latency_ms=4500)).first()
    assert summary.passed and summary.failures == ""
    lines = summary.summary.split("\n")
    assert lines[0] == "[PASS] non_empty_batch: row_count=5000"
    assert lines[1] == "[PASS] null_rate::event_id: 5/5000 = 0.0010 (threshold 0.01)"
    assert lines[-2] == "[PASS] latency_sanity: max_latency_ms=4500 (limit 30000)"


FAULTS = {
    "null event_id": ({"event_id": None}, ["null_rate::event_id"]),
    "null event_time": ({"event_time": None}, ["null_rate::event_time"]),
    "null endpoint": ({"endpoint": None}, ["null_rate::endpoint"]),
    "null user": ({"user_id": None}, ["null_rate::user_id"]),
    "null status": ({"status_code": None}, ["null_rate::status_code", "status_code_range"]),
    "status too high": ({"status_code": 600}, ["status_code_range"]),
    "status too low": ({"status_code": 99}, ["status_code_range"]),
    "null method": ({"method": None}, ["method_whitelist"]),
    "unknown method": ({"method": "FETCH"}, ["method_whitelist"]),
    "slow": ({"latency_ms": 30_001}, ["latency_sanity"]),
    "negative latency": ({"latency_ms": -5}, []),
}


@pytest.mark.parametrize("fault", list(FAULTS))
def test_single_fault_fails_its_rules_only(silver_rows, fault):
    change, failures = FAULTS[fault]
    batch = silver_rows({}, change, {})
    passed, report, text = check_batch(batch)
    assert [r.name for r in report if not r.passed] == failures
    assert passed == (not failures)
    tags = {r.event_id: r.broken_rules for r in broken_rules(batch).collect()}
    assert tags["e_0"] == []
    assert sorted(tags[change.get("event_id", "e_1")]) == sorted(failures)


def test_duplicates_are_counted_per_id_and_nulls_are_not_ids(silver_rows):
    rows = [{"event_id": i} for i in ("a", "a", "a", "b", "b", "c", None, None)]
    batch = silver_rows(*rows)
    assert batch_stats(batch).first().duplicate_event_ids == 2
    kept = keep_latest(batch)
    assert sorted(str(r.event_id) for r in kept.collect()) == ["None", "None", "a", "b", "c"]
    report = check_batch(kept)[1]
    assert next(r.passed for r in report if r.name == RULE_DUPLICATES)


def test_bad_values_are_sorted_and_complete(silver_rows):
    statuses = [*range(600, 750), None]
    batch = silver_rows(*({"status_code": s} for s in statuses), {"method": "B"}, {"method": "A"})
    stats = batch_stats(batch).first()
    shown = stats.bad_status_codes.split(", ")
    assert shown == [*map(str, range(600, 750)), "NULL"]
    assert stats.bad_methods == "'A', 'B'"
    assert bad_values(batch).count() == 151 + 2


def test_null_is_listed_after_the_values(silver_rows):
    batch = silver_rows({"status_code": None}, {"status_code": 9999}, {"status_code": 1000})
    assert batch_stats(batch).first().bad_status_codes == "1000, 9999, NULL"


def test_empty_frame(silver_rows):
    passed, report, _ = check_batch(silver_rows({}).where("false"))
    assert not passed and len(report) == 1


def test_limits_are_parameters(silver_rows):
    batch = silver_rows({}, {"user_id": None}, {"latency_ms": 40_000})
    assert check_batch(batch, null_rate_threshold=0.5, max_latency_ms=50_000)[0]


def test_unique_ids_spare_nothing_but_the_count(silver_rows):
    batch = silver_rows({}, {"status_code": 700}, {"user_id": None})
    assert batch_stats(batch, ids_are_unique=True).select(
        "row_count", "null_user_id", "bad_status_codes", "duplicate_event_ids"
    ).first() == (3, 1, "700", 0)
