"""Plans that must hold at any size: pruning, pushdown and narrow reads."""

import contextlib
import io
import re

import pytest
from conftest import utc
from pyspark.sql import functions as F

from loglake.operators.cleaning import arrived_after, clean_and_type, keep_latest, to_contract
from loglake.operators.quality import batch_stats
from loglake.plans import jobs, marts
from loglake.plans.staging import stg_logs
from loglake.sources import events, tables


def plan(df) -> str:
    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain("formatted")
    return out.getvalue()


def reads(df) -> list[set]:
    schemas = re.findall(r"ReadSchema: struct<(.*)>", plan(df))
    return [{c.split(":")[0] for c in s.split(",") if c} for s in schemas]


@pytest.fixture(scope="module")
def bronze(spark, tmp_path_factory):
    from conftest import SF_DIR

    path = f"{tmp_path_factory.mktemp('plans')}/bronze"
    logs = events.logs(spark, SF_DIR).withColumn("_arrival_date", F.to_date("_ingested_at"))
    tables.append_with_evolution(logs, path, jobs.BRONZE_PARTITIONS)
    return tables.read_appended(spark, path)


@pytest.fixture(scope="module")
def silver(spark, bronze, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('plans')}/silver"
    tables.stage_batch(keep_latest(to_contract(bronze)), path)
    tables.upsert_staged(spark, path)
    return tables.read_silver(spark, path)


def test_increment_prunes_days_and_pushes_the_watermark(bronze):
    newest = F.lit(utc("2024-02-01T01:00:00")).cast("timestamp")
    text = plan(arrived_after(bronze, newest))
    assert re.search(r"PartitionFilters: .*_arrival_date#\d+ >= 2024-02-01", text)
    assert re.search(r"PushedFilters: .*GreaterThan\(_ingested_at,", text)


def test_rows_without_id_are_found_by_statistics(bronze):
    text = plan(keep_latest(to_contract(clean_and_type(bronze))))
    assert "PushedFilters: [IsNotNull(event_id)]" in text
    assert "PushedFilters: [IsNull(event_id)]" in text
    assert text.split("\n\n")[0].count("Exchange") == 1


def test_gate_reads_few_columns_and_shuffles_ids_only(silver):
    for columns in reads(batch_stats(silver)):
        assert columns <= {
            "event_id", "event_time", "endpoint", "status_code", "user_id", "latency_ms", "method"
        }
    assert reads(batch_stats(silver)).count({"event_id"}) == 1
    assert {"event_id"} not in reads(batch_stats(silver, ids_are_unique=True))


def test_marts_read_few_columns(silver):
    logs = stg_logs(silver)
    assert reads(marts.fct_requests_daily(logs)) == [
        {"event_time", "status_code", "latency_ms"},
        {"event_time", "user_id"},
    ]
    assert {"endpoint", "method", "status_code", "latency_ms"} in reads(marts.dim_endpoints(logs))


def test_days_prune_silver(silver):
    day = utc("2024-01-05T00:00:00").date()
    text = plan(silver.where(tables.on_days("ingest_date", [day, None])))
    assert re.search(r"PartitionFilters: \[.*ingest_date#\d+", text)
    assert "PushedFilters" not in text or "ingest_date" not in text.split("PushedFilters")[1].split("\n")[0]


def test_tests_of_a_model_share_a_scan(silver):
    from loglake.operators.datatests import run_data_tests

    results = run_data_tests({"stg_logs": stg_logs(silver)}, utc("2024-01-31T00:00:00"))
    assert sorted(map(len, reads(results))) == [1, 4]


def test_ids_of_silver_are_reduced_before_they_are_shuffled(spark, silver):
    from loglake.operators.upsert import with_few_keys

    text = plan(with_few_keys(silver.select("event_id", "ingest_date"), silver.limit(5).select("event_id")))
    assert "BroadcastHashJoin LeftOuter" in text


def test_ids_of_a_batch_are_not_broadcast_by_the_size_of_its_files(silver):
    from loglake.operators.upsert import not_set_back, with_few_keys, without_few_keys

    ids = silver.select("event_id")
    assert "SortMergeJoin LeftSemi" in plan(with_few_keys(ids, ids))
    assert "SortMergeJoin LeftAnti" in plan(without_few_keys(silver, ids))
    rows = not_set_back(silver, silver)
    rows.collect()  # the plan as it ran, after Spark measured
    assert "SortMergeJoin LeftAnti" in plan(rows).split("Initial Plan")[0]
