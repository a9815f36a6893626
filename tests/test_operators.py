"""Operators against brute force on small, awkward inputs."""

import random
from datetime import timedelta

import numpy as np
import pytest
from conftest import utc
from pyspark.sql import functions as F

from loglake.operators.cleaning import arrived_after, arrived_between, clean_and_type, keep_latest
from loglake.operators.datatests import (
    failing_accepted_range,
    failing_accepted_values,
    failing_freshness,
    failing_not_null,
    failing_unique,
    run_data_tests,
    suite_status,
)
from loglake.operators.late_arrival import late_arrival_profile
from loglake.operators.percentiles import profile, value_counts
from loglake.operators.ranking import rank_by_count
from loglake.operators.upsert import upsert, upsert_effect
from loglake.plans import marts, panels
from loglake.plans.staging import stg_logs


def half_up(value: float, digits: int) -> float:
    from decimal import ROUND_HALF_UP, Decimal

    return float(Decimal(repr(round(value, 9))).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


@pytest.mark.parametrize("seed", range(4))
def test_percentiles_equal_numpy(spark, seed):
    rng = random.Random(seed)
    rows = [
        (rng.choice("abc"), rng.choice([None, *range(-3, 3), rng.randint(0, 40_000)]))
        for _ in range(rng.choice([5, 50, 700]))
    ]
    rows += [("one", 7), ("two", 1), ("two", 4), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v int")
    result = profile(value_counts(df, ["g"], "v"), ["g"], "v", [0, 50, 95, 99, 100])
    found = {r.g: r for r in result.collect()}
    assert set(found) == {g for g, _ in rows}
    for g, r in found.items():
        values = [v for k, v in rows if k == g and v is not None]
        assert r.row_count == sum(k == g for k, _ in rows)
        if not values:
            assert r.avg_v is None and r.p50_v is None
            continue
        assert r.avg_v == half_up(sum(values) / len(values), 1)
        for p in (0, 50, 95, 99, 100):
            assert r[f"p{p}_v"] == half_up(float(np.percentile(values, p)), 1), (g, p)


@pytest.mark.parametrize("seed", range(3))
def test_rank_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    counts = [rng.choice([1, 1, 1, 2, 5, rng.randint(1, 9)]) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(counts)), "id int, n bigint")
    ranked = rank_by_count(df, "n", "rank").collect()
    assert len(ranked) == len(counts)
    for r in ranked:
        assert r["rank"] == 1 + sum(c > r.n for c in counts)


def test_hot_key_is_cut_to_one_row_before_the_shuffle(silver_rows):
    plan = keep_latest(silver_rows({})).explain
    import contextlib
    import io

    with contextlib.redirect_stdout(io.StringIO()) as out:
        plan("formatted")
    tree = out.getvalue().split("\n\n")[0]
    assert tree.count("WindowGroupLimit") == 2
    first_limit, exchange = tree.rindex("WindowGroupLimit"), tree.index("Exchange")
    assert exchange < first_limit  # printed top-down: the limit runs below the exchange


def test_latest_wins_by_arrival_then_batch_then_file(silver_rows):
    early, late = utc("2024-02-01T00:00:00"), utc("2024-02-01T00:15:00")
    batch = silver_rows(
        {"event_id": "a", "_ingested_at": early, "latency_ms": 1, "ingest_batch_id": "b_9"},
        {"event_id": "a", "_ingested_at": late, "latency_ms": 2},
        {"event_id": "b", "ingest_batch_id": "b_1", "latency_ms": 1, "_source_file": "z"},
        {"event_id": "b", "ingest_batch_id": "b_2", "latency_ms": 2},
        {"event_id": "c", "_source_file": "f_1", "latency_ms": 1},
        {"event_id": "c", "_source_file": "f_2", "latency_ms": 2},
    )
    assert {r.event_id: r.latency_ms for r in keep_latest(batch).collect()} == dict.fromkeys("abc", 2)


def test_survivor_does_not_depend_on_partitioning(silver_rows):
    batch = silver_rows(*({"event_id": "a", "latency_ms": i} for i in range(50)))
    kept = {keep_latest(batch.repartition(n)).first().latency_ms for n in (1, 3, 7)}
    assert len(kept) == 1


def test_clean_and_type(spark):
    raw = spark.createDataFrame(
        [
            ("2024-01-01T23:30:00-02:00", " get ", "201", "12", " /a "),
            ("junk", None, "abc", "1e9", None),
            ("2024-01-01T00:00:00+00:00", "Post", "99999999999", " 7 ", "/b"),
        ],
        "event_time string, method string, status_code string, latency_ms string, endpoint string",
    )
    rows = clean_and_type(raw).withColumn("t", F.col("event_time").cast("string")).collect()
    assert [tuple(r[c] for c in ("t", "method", "status_code", "latency_ms", "endpoint")) for r in rows] == [
        ("2024-01-02 01:30:00", "GET", 201, 12, "/a"),
        (None, None, None, None, None),
        ("2024-01-01 00:00:00", "POST", None, 7, "/b"),
    ]
    # the day is that of the UTC time, not the one written
    assert [str(r.ingest_date) for r in rows] == ["2024-01-02", "None", "2024-01-01"]


def test_watermark_is_strict_and_none_takes_all(silver_rows):
    early, late = utc("2024-02-01T00:00:00"), utc("2024-02-01T00:15:00")
    rows = silver_rows({"_ingested_at": early}, {"_ingested_at": late})
    assert arrived_after(rows, None).count() == 2
    assert [r.event_id for r in arrived_after(rows, F.lit(early)).collect()] == ["e_1"]
    assert arrived_after(rows, F.lit(late)).count() == 0
    assert [r.event_id for r in arrived_between(rows, F.lit(early), F.lit(late)).collect()] == ["e_0"]


def test_upsert_replaces_inserts_and_lets_null_keys_in(silver_rows):
    target = silver_rows({"event_id": "a", "latency_ms": 1}, {"event_id": "b", "latency_ms": 1}, {"event_id": None})
    source = silver_rows({"event_id": "b", "latency_ms": 2}, {"event_id": "c", "latency_ms": 2}, {"event_id": None})
    result = upsert(target, source).collect()
    assert sorted((str(r.event_id), r.latency_ms) for r in result) == [
        ("None", 10),
        ("None", 10),
        ("a", 1),
        ("b", 2),
        ("c", 2),
    ]
    effect = {r.action: r.row_count for r in upsert_effect(target, source).collect()}
    assert effect == {"inserted": 2, "updated": 1}


def test_upsert_effect_of_nothing(silver_rows):
    rows = silver_rows({})
    effect = {r.action: r.row_count for r in upsert_effect(rows, rows.where("false")).collect()}
    assert effect == {"inserted": 0, "updated": 0}


def test_error_flags_have_no_upper_bound_and_no_nulls(silver_rows):
    codes = [None, 399, 400, 499, 500, 999]
    rows = stg_logs(silver_rows(*({"status_code": c} for c in codes))).collect()
    flags = [(r.is_server_error, r.is_client_error) for r in sorted(rows, key=lambda r: r.event_id)]
    assert flags == [(False, False)] * 2 + [(False, True)] * 2 + [(True, False)] * 2


def test_marts_on_missing_values(silver_rows):
    logs = stg_logs(
        silver_rows(
            {"event_time": None, "latency_ms": None, "user_id": None},
            {"status_code": 503, "latency_ms": 5, "endpoint": None},
            {"status_code": 404, "latency_ms": None},
        )
    )
    daily = {str(r.event_date): r for r in marts.fct_requests_daily(logs).collect()}
    assert set(daily) == {"None", "2024-01-10 00:00:00"}
    assert daily["None"].request_count == 1 and daily["None"].unique_users == 0
    assert daily["None"].p95_latency_ms is None
    day = daily["2024-01-10 00:00:00"]
    assert (day.request_count, day.server_error_count, day.client_error_count) == (2, 1, 1)
    assert (day.server_error_rate, day.avg_latency_ms, day.p99_latency_ms) == (0.5, 5.0, 5.0)
    ranks = {(r.endpoint, r.request_count): r.traffic_rank for r in marts.dim_endpoints(logs).collect()}
    assert ranks == {("/a", 2): 1, (None, 1): 2}


def test_daily_counts_add_up_to_silver(spark, sf_dir):
    from loglake.catalogue.queries import stored_silver

    silver = stored_silver(spark, sf_dir)
    daily = marts.fct_requests_daily(stg_logs(silver))
    assert daily.agg(F.sum("request_count")).first()[0] == silver.count()


def test_panels_of_an_empty_mart(silver_rows):
    daily = marts.fct_requests_daily(stg_logs(silver_rows({}).where("false")))
    assert panels.latest_day_kpis(daily).count() == 0
    assert panels.panel_latency(daily).count() == 0


def test_top_endpoints_is_a_report_of_fifteen(spark, silver_rows):
    logs = stg_logs(silver_rows(*({"endpoint": f"/{i:02}"} for i in range(20))))
    top = panels.top_endpoints(marts.dim_endpoints(logs)).collect()
    assert [r.endpoint for r in top] == [f"/{i:02}" for i in range(15)]
    assert {r.traffic_rank for r in top} == {1}


def test_late_arrivals(silver_rows):
    noon = utc("2024-01-10T12:00:00")
    arrival = noon + timedelta(minutes=30)
    profile_rows = late_arrival_profile(
        silver_rows(
            {"ingest_batch_id": "b_1", "event_time": noon, "_ingested_at": arrival},
            {"ingest_batch_id": "b_2", "event_time": noon - timedelta(minutes=1), "_ingested_at": arrival},
            {"ingest_batch_id": "b_2", "event_time": noon + timedelta(minutes=5), "_ingested_at": arrival},
            {"ingest_batch_id": "b_3", "event_time": noon + timedelta(minutes=4), "_ingested_at": arrival},
            {"ingest_batch_id": None, "event_time": noon - timedelta(days=9), "_ingested_at": arrival},
        )
    )
    found = {r.ingest_batch_id: (r.row_count, r.late_rows, r.late_share) for r in profile_rows.collect()}
    assert found == {"b_1": (1, 0, 0.0), "b_2": (2, 1, 0.5), "b_3": (1, 1, 1.0), None: (1, 0, 0.0)}


def test_data_tests_select_what_fails(silver_rows):
    rows = silver_rows(
        {"event_id": "a"}, {"event_id": "a"}, {"event_id": None}, {"event_id": None}, {"method": "X"}
    )
    assert [tuple(r) for r in failing_unique(rows, "event_id").collect()] == [("a", 2)]
    assert failing_not_null(rows, "event_id").count() == 2
    assert [tuple(r) for r in failing_accepted_values(rows, "method", ["GET"]).collect()] == [("X", 1)]
    with_null = silver_rows({"method": None}, {"latency_ms": None}, {"latency_ms": 11})
    assert failing_accepted_values(with_null, "method", ["GET"]).count() == 0
    assert failing_accepted_range(with_null, "latency_ms", 0, 10).count() == 1


def test_freshness(silver_rows):
    logs = stg_logs(silver_rows({"event_time": utc("2024-01-10T12:00:00")}))
    assert failing_freshness(logs, utc("2024-01-10T14:00:00")).count() == 0
    assert failing_freshness(logs, utc("2024-01-10T14:00:01")).count() == 1
    empty = logs.where("false")
    assert failing_freshness(empty, utc("2024-01-10T14:00:00")).count() == 0
    assert failing_freshness(empty, utc("2024-01-10T14:00:00"), require_rows=True).count() == 1


def test_suite_warns_on_unknown_status_and_fails_on_unknown_method(silver_rows):
    def status(**change):
        silver = silver_rows({}, change)
        logs = stg_logs(silver)
        models = {
            "silver_events": silver,
            "stg_logs": logs,
            "fct_requests_daily": marts.fct_requests_daily(logs),
            "dim_endpoints": marts.dim_endpoints(logs),
        }
        results = run_data_tests(models, utc("2024-01-10T13:00:00"))
        assert results.count() == 21
        return suite_status(results).first().status

    assert status() == "pass"
    assert status(status_code=418) == "warn"
    assert status(method="FETCH") == "error"


def test_running_totals_before_a_row(spark):
    import random

    from loglake.operators.prefix import running_max_before, running_sum_before

    rng = random.Random(2)
    keys = rng.sample(range(10_000), 400)
    values = [None if rng.random() < 0.3 else rng.randrange(1000) for _ in keys]
    df = spark.createDataFrame(list(zip(keys, values)), "k long, v long").repartition(7)
    in_order = [v for _, v in sorted(zip(keys, values))]
    for scan, total in ((running_max_before, max), (running_sum_before, sum)):
        rows = scan(df, "k", "v", "before").orderBy("k").collect()
        expected = [total(x) if (x := [v for v in in_order[:i] if v is not None]) else None for i in range(400)]
        assert [r.before for r in rows] == expected and [r.v for r in rows] == in_order
        assert scan(df.where("false"), "k", "v", "before").count() == 0


def test_key_filter_never_loses_a_key(spark):
    from loglake.operators.reducer import key_filter, split_by_filter
    from loglake.operators.upsert import with_few_keys, without_few_keys

    keys = spark.range(0, 3000, 3).selectExpr("cast(id as string) event_id")
    target = spark.range(0, 60_000).selectExpr("if(id % 1000 = 1, null, cast(id as string)) event_id", "id n")
    may, not_in = split_by_filter(target, "event_id", key_filter(keys, "event_id"))
    assert may.join(keys, "event_id", "left_semi").count() == 999 and may.count() < 1200
    assert may.count() + not_in.count() == 60_000
    crowded = split_by_filter(target, "event_id", key_filter(keys, "event_id", 2), 2)
    assert crowded[0].join(keys, "event_id", "left_semi").count() == 999
    assert with_few_keys(target, keys).count() == 999
    rest = without_few_keys(target, keys)
    assert rest.count() == 59_001 and rest.where("event_id IS NULL").count() == 60
    nothing = keys.where("false")
    assert with_few_keys(target, nothing).count() == 0 and without_few_keys(target, nothing).count() == 60_000


def test_sketches_of_users_merge(spark):
    from loglake.plans.marts import daily_user_sketches, users_of_span

    rows = spark.range(40_000).selectExpr("date_add(date'2024-01-01', cast(id % 4 as int)) event_date", "concat('u', id % 10000) user_id")
    sketches = daily_user_sketches(rows)
    day = F.lit("2024-01-02").cast("date")
    assert abs(users_of_span(sketches).first().unique_users - 10_000) < 300
    assert abs(users_of_span(sketches, day, day).first().unique_users - 2500) < 75
    assert users_of_span(sketches.where("false")).first().unique_users == 0
