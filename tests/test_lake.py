"""Jobs and tables on real files."""

import json
import os

import pytest
from conftest import utc
from pyspark.errors import UnsupportedOperationException
from pyspark.sql import functions as F

from loglake.contract import (
    NO_RUN_TEXT,
    MissingColumnsError,
    QualityGateError,
    SchemaEvolutionError,
)
from loglake.operators.cleaning import keep_latest
from loglake.plans import jobs
from loglake.sources import events, ledger, tables
from loglake.sources.raw import list_files, read_json_lines

T0, T1, T2 = utc("2024-02-01T00:00:00"), utc("2024-02-01T00:15:00"), utc("2024-02-01T00:30:00")


def event(i, **changes):
    row = {
        "event_id": f"e_{i}",
        "event_time": "2024-01-10T12:00:00+00:00",
        "endpoint": "/a",
        "method": "GET",
        "status_code": 200,
        "latency_ms": 10 + i,
        "user_id": "u_1",
        "country": "US",
        "ingest_batch_id": "b_1",
    }
    row.update(changes)
    return {k: v for k, v in row.items() if v != "omit"}


class Lake:
    def __init__(self, spark, root):
        self.spark, self.root = spark, str(root)
        self.raw, self.bronze = f"{root}/raw events [1]", f"{root}/bronze"
        self.silver, self.quarantine = f"{root}/silver", f"{root}/quarantine"

    def put(self, name, *lines):
        path = f"{self.raw}/{name}"
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as f:
            f.writelines((x if isinstance(x, str) else json.dumps(x)) + "\n" for x in lines)

    def ingest(self, at=T0, **kw):
        # the folder's own name holds glob characters; those in `path` are the caller's to escape
        return jobs.ingest_raw(self.spark, self.raw.replace("[", "\\[").replace("]", "\\]"), self.bronze, at, **kw)

    def refine(self, **kw):
        return jobs.bronze_to_silver(self.spark, self.bronze, self.silver, self.quarantine, **kw)

    def rows(self, *columns):
        silver = tables.read_silver(self.spark, self.silver)
        return sorted(tuple(r) for r in silver.select(*columns).collect())

    def directories(self):
        return sorted(d for d in os.listdir(self.silver) if d.startswith("ingest_date="))


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, tmp_path)


def test_only_new_files_are_ingested(lake):
    lake.put("2024/01/a b%20.jsonl", event(1), event(2))
    assert lake.ingest() == jobs.IngestResult(1, 1, 2, "none")
    assert lake.ingest(T1) == jobs.IngestResult(1, 0, 0, "none")
    lake.put("2024/02/{x}[1].jsonl", event(3))
    assert lake.ingest(T1) == jobs.IngestResult(2, 1, 1, "none")
    bronze = tables.read_appended(lake.spark, lake.bronze)
    assert bronze.count() == 3
    assert {str(r[0]) for r in bronze.select("ingest_date").distinct().collect()} == {"2024-01-10"}
    assert bronze.select("_source_file").distinct().count() == 2


def test_half_a_commit_does_not_count_and_its_files_come_whole(lake, monkeypatch):
    lake.put("a.jsonl", event(1))
    lake.ingest(T0)
    lake.put("b.jsonl", event(2), event(3, event_time="2024-01-15T00:00:00+00:00"))

    close = jobs.close_run
    monkeypatch.setattr(jobs, "close_run", lambda *a: (_ for _ in ()).throw(OSError("driver lost")))
    for _ in range(2):  # lost twice
        with pytest.raises(OSError):
            lake.ingest(T1)
    monkeypatch.setattr(jobs, "close_run", close)
    assert jobs.read_bronze(lake.spark, lake.bronze).count() == 1
    lake.refine()
    assert lake.rows("event_id") == [("e_1",)]
    lake.put("c.jsonl", event(4))
    assert lake.ingest(T2) == jobs.IngestResult(3, 2, 3, "none")
    assert jobs.read_bronze(lake.spark, lake.bronze).count() == 4
    lake.refine()
    assert lake.rows("event_id") == [("e_1",), ("e_2",), ("e_3",), ("e_4",)]
    assert lake.ingest(T2) == jobs.IngestResult(3, 0, 0, "none")


def test_files_without_rows_are_known(lake, spark):
    lake.put("a.jsonl", event(1))
    lake.put("blank.jsonl", "", " ")
    lake.put("empty.jsonl")
    assert lake.ingest() == jobs.IngestResult(2, 2, 1, "none")  # no bytes, no file yet
    assert lake.ingest() == jobs.IngestResult(2, 0, 0, "none")
    found = {r._source_file.rsplit("/", 1)[1]: r.rows for r in ledger.ledger(spark, lake.bronze).collect()}
    assert found == {"a.jsonl": 1, "blank.jsonl": 0}
    lake.put("empty.jsonl", event(2))
    assert lake.ingest().rows_new == 1


def test_many_files_are_taken_in_by_several_runs(lake, spark):
    for i in range(7):
        lake.put(f"{i}.jsonl", event(i, **({"user_agent": "ua"} if i == 5 else {})))
    assert lake.ingest(files_at_once=3) == jobs.IngestResult(7, 7, 7, "additive")
    assert ledger.ledger(spark, lake.bronze).select("_run").distinct().count() == 3
    assert jobs.read_bronze(spark, lake.bronze).select("event_id").distinct().count() == 7


def test_a_rerun_reads_names_only(lake, spark):
    lake.put("a.jsonl", event(1))
    lake.ingest()
    listed, fresh = jobs.new_files(spark, lake.raw.replace("[", "\\[").replace("]", "\\]"), lake.bronze)
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "_epoch" not in plan and "ReadSchema: struct<>" in plan
    assert (listed.count(), fresh.count()) == (1, 0)


def test_a_table_from_before_ledgers_gets_one(lake, spark):
    lake.put("a.jsonl", event(1))
    rows = jobs.bronze_rows(read_json_lines(spark, lake.raw.replace("[", "\\[").replace("]", "\\]")), T0)
    tables.append_with_evolution(rows, lake.bronze, jobs.BRONZE_PARTITIONS)
    assert lake.ingest(T1) == jobs.IngestResult(1, 0, 0, "none")
    lake.put("b.jsonl", event(2))
    assert lake.ingest(T1) == jobs.IngestResult(2, 1, 1, "none")
    assert jobs.read_bronze(spark, lake.bronze).count() == 2


@pytest.mark.parametrize("others", [True, False])
def test_no_false_alarms(lake, spark, tmp_path, others):
    """All-null fields and bad lines break nothing, whether or not older files are still there."""
    lake.put("a.jsonl", event(1, is_authenticated=True), "{broken")
    lake.ingest()
    if not others:
        other = Lake(spark, tmp_path / "other")
        other.bronze, lake = lake.bronze, other
    lake.put("b.jsonl", event(2, is_authenticated=None, latency_ms=1.5))
    result = lake.ingest()
    assert result.schema_change == "widening"
    assert result.changed_fields == ("type_changed latency_ms: bigint -> double",)
    lake.put("c.jsonl", event(3, is_authenticated=False, colour=None))
    assert lake.ingest().schema_change == "none"
    lake.put("d.jsonl", event(4, is_authenticated=False, colour="red"))
    assert lake.ingest().changed_fields == ("added colour: None -> string",)
    rows = {r.event_id: (r.is_authenticated, r.latency_ms) for r in jobs.read_bronze(spark, lake.bronze).collect()}
    assert rows == {None: (None, None), "e_1": (True, 11.0), "e_2": (None, 1.5), "e_3": (False, 13.0), "e_4": (False, 14.0)}


def test_unreadable_line_is_kept_in_bronze_and_counted_by_the_gate(lake):
    lake.put("a.jsonl", "{broken", *(event(i) for i in range(199)))
    assert lake.ingest().rows_new == 200
    bronze = tables.read_appended(lake.spark, lake.bronze)
    assert bronze.where(F.col("_corrupt_record") == "{broken").count() == 1
    with pytest.raises(QualityGateError, match="status_code_range"):
        lake.refine()


def test_missing_required_column(lake):
    lake.put("a.jsonl", event(1, country="omit", user_id="omit"))
    with pytest.raises(MissingColumnsError, match="country, user_id"):
        lake.ingest()


def test_new_fields_are_taken_on_and_older_files_still_fit(lake):
    lake.put("a.jsonl", event(1))
    lake.ingest()
    lake.put("b.jsonl", event(2, user_agent="ua"))
    assert lake.ingest().schema_change == "additive"
    lake.put("c.jsonl", event(3))  # an older producer: the field is not gone, b.jsonl has it
    assert lake.ingest().schema_change == "none"
    lake.put("d.jsonl", event(4, latency_ms=1.5))
    assert lake.ingest().schema_change == "widening"
    lake.put("e.jsonl", event(5, user_agent=None, latency_ms=7))
    assert lake.ingest().schema_change == "none"
    bronze = tables.read_appended(lake.spark, lake.bronze)
    found = {r.event_id: (r.user_agent, r.latency_ms) for r in bronze.collect()}
    assert found == {
        "e_1": (None, 11.0),
        "e_2": ("ua", 12.0),
        "e_3": (None, 13.0),
        "e_4": (None, 1.5),
        "e_5": (None, 7.0),
    }


def test_field_that_is_null_throughout_a_batch_keeps_its_type(lake):
    lake.put("a.jsonl", event(1, is_authenticated=True))
    lake.ingest()
    lake.put("b.jsonl", event(2, is_authenticated=None))
    assert lake.ingest().schema_change == "none"


def test_breaking_change_stops_ingest(lake):
    lake.put("a.jsonl", event(1))
    lake.ingest()
    lake.put("b.jsonl", event(2, status_code={"code": 200}))
    with pytest.raises(SchemaEvolutionError, match="status_code"):
        lake.ingest()
    assert tables.read_appended(lake.spark, lake.bronze).count() == 1


def test_field_gone_with_the_files_that_had_it_is_breaking(lake, spark, tmp_path):
    lake.put("a.jsonl", event(1, user_agent="ua"))
    lake.ingest()
    other = Lake(spark, tmp_path / "other")
    other.bronze = lake.bronze
    other.put("b.jsonl", event(2))
    with pytest.raises(SchemaEvolutionError, match="user_agent"):
        other.ingest()


def test_silver_run_twice_is_a_no_op(lake):
    lake.put("a.jsonl", event(1), event(1, latency_ms=99, ingest_batch_id="b_2"), event(2))
    lake.ingest()
    assert lake.refine() == jobs.SilverResult(3, 2)
    assert lake.refine() == jobs.SilverResult(0, 0)
    assert lake.rows("event_id", "latency_ms") == [("e_1", 99), ("e_2", 12)]


def test_redelivery_updates_and_moves_days(lake):
    lake.put("a.jsonl", event(1), event(2, event_time="2024-01-11T01:00:00+00:00"))
    lake.ingest(T0)
    lake.refine()
    # the only event of the 11th turns out to be of the 12th, and a new one comes
    lake.put("b.jsonl", event(2, event_time="2024-01-12T01:00:00+00:00", latency_ms=77), event(3))
    lake.ingest(T1)
    assert lake.refine() == jobs.SilverResult(2, 2)
    assert lake.rows("event_id", "latency_ms", F.col("ingest_date").cast("string")) == [
        ("e_1", 11, "2024-01-10"),
        ("e_2", 77, "2024-01-12"),
        ("e_3", 13, "2024-01-10"),
    ]


def test_untouched_directories_are_not_rewritten(lake):
    days = [f"2024-01-1{d}T00:00:00+00:00" for d in range(4)]
    lake.put("a.jsonl", *(event(i, event_time=t) for i, t in enumerate(days)))
    lake.ingest(T0)
    lake.refine()

    def files():
        return {
            os.path.join(folder, f)
            for folder, _, names in os.walk(lake.silver)
            for f in names
            if f.endswith(".parquet")
        }

    before = files()
    lake.put("b.jsonl", event(2, event_time=days[2], latency_ms=500))
    lake.ingest(T1)
    lake.refine()
    gone = before - files()
    assert gone and all("ingest_date=2024-01-12" in f for f in gone)
    assert len(lake.rows("event_id")) == 4


def test_events_without_time_go_to_a_day_of_their_own(lake):
    lake.put("a.jsonl", event(0, event_time="junk"), *(event(i) for i in range(1, 200)))
    lake.ingest(T0)
    lake.refine()
    lake.put("b.jsonl", event(0), *(event(i) for i in range(200, 400)))
    lake.ingest(T1)
    lake.refine()
    assert len(lake.rows("event_id")) == 400
    assert tables.read_silver(lake.spark, lake.silver).where("event_time IS NULL").count() == 0


def test_events_without_id_are_all_inserted(lake):
    lake.put("a.jsonl", event(0, event_id=None), *(event(i) for i in range(1, 200)))
    lake.ingest(T0)
    lake.refine()
    lake.put("b.jsonl", event(0, event_id=None), *(event(i) for i in range(100, 300)))
    lake.ingest(T1)
    lake.refine()
    silver = tables.read_silver(lake.spark, lake.silver)
    assert silver.where("event_id IS NULL").count() == 2 and silver.count() == 301


def test_failed_batch_is_quarantined_once_and_blocks(lake):
    lake.put("a.jsonl", event(1))
    lake.ingest(T0)
    lake.refine()
    lake.put("b.jsonl", event(2, status_code=9999))
    lake.ingest(T1)
    for _ in range(2):
        with pytest.raises(QualityGateError) as failure:
            lake.refine()
        assert [r.name for r in failure.value.report if not r.passed] == ["status_code_range"]
    lake.put("c.jsonl", event(3))
    lake.ingest(T2)
    with pytest.raises(QualityGateError):
        lake.refine()
    held = tables.read_appended(lake.spark, lake.quarantine)
    assert sorted(r.event_id for r in held.collect()) == ["e_2", "e_3"]
    assert lake.rows("event_id") == [("e_1",)]
    # the way on is a window that leaves the bad arrival out
    assert lake.refine(arrived=(T2, utc("2024-02-01T00:31:00"))).merged_rows == 1
    assert lake.rows("event_id") == [("e_1",), ("e_3",)]


def test_quarantine_keeps_repeats_of_a_batch_and_reads_its_days_only(spark, tmp_path, silver_rows):
    path = f"{tmp_path}/quarantine"
    alike = {"event_id": "a", "status_code": 9999}
    batch = silver_rows(alike, alike, {"event_id": None}, {"event_id": None}, {"event_id": "b", "_ingested_at": T1})
    for rows in (batch, batch, silver_rows(alike, alike, alike, {"_ingested_at": utc("2024-02-03T00:00:00")})):
        tables.append_new_rows(rows, path)
    held = tables.read_appended(spark, path)
    assert sorted(str(r.event_id) for r in held.collect()) == ["None", "None", "a", "a", "a", "b", "e_3"]
    plan = held.where(tables.on_days("_arrival_date", [T0.date()]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_arrival_date" in plan


def test_backfill_of_a_window_changes_nothing_that_is_right(lake):
    for n, at in enumerate((T0, T1, T2)):
        lake.put(f"{n}.jsonl", *(event(i) for i in range(n * 5, n * 5 + 6)))
        lake.ingest(at)
        lake.refine()
    before = lake.rows("event_id", "latency_ms", "_ingested_at")
    assert lake.refine(arrived=(T2, utc("2024-02-01T00:31:00"))).merged_rows == 6
    assert lake.rows("event_id", "latency_ms", "_ingested_at") == before


def test_older_window_sets_no_row_back_and_repeats_none(lake):
    def held():
        rows = tables.read_silver(lake.spark, lake.silver).select("event_id", "latency_ms", "_source_file").collect()
        return sorted(map(str, rows))

    lake.put("a.jsonl", event(1, latency_ms=1), event(0, event_id=None), event(0, event_id=None), *(event(i) for i in range(200, 400)))
    lake.ingest(T0)
    lake.refine()
    lake.put("b.jsonl", event(1, latency_ms=2), event(8))
    lake.ingest(T1)
    lake.refine()
    before = held()
    lake.refine(arrived=(T0, T1))
    assert held() == before and len(before) == 204
    assert [r.latency_ms for r in tables.read_silver(lake.spark, lake.silver).where("event_id = 'e_1'").collect()] == [2]


def test_arrivals_passed_over_by_a_window_still_come(lake):
    for n, at in enumerate((T0, T1, T2)):
        lake.put(f"{n}.jsonl", event(n), event(9, latency_ms=n + 1))
        lake.ingest(at)
    lake.refine(arrived=(T2, utc("2024-02-01T00:31:00")))
    assert lake.rows("event_id", "latency_ms") == [("e_2", 12), ("e_9", 3)]
    assert lake.refine().candidate_rows == 6
    assert lake.rows("event_id", "latency_ms") == [("e_0", 10), ("e_1", 11), ("e_2", 12), ("e_9", 3)]
    assert lake.refine().candidate_rows == 0
    lake.put("3.jsonl", event(3))
    lake.ingest(utc("2024-02-01T00:45:00"))
    assert lake.refine().candidate_rows == 1


def test_run_that_died_while_writing_silver_is_finished_by_the_next(lake, monkeypatch):
    lake.put("a.jsonl", *(event(i) for i in range(5)))
    lake.ingest(T0)
    lake.refine()
    lake.put("b.jsonl", event(1, latency_ms=500), event(9, event_time="2024-01-15T00:00:00+00:00"))
    lake.ingest(T1)

    apply = tables.apply_pending
    monkeypatch.setattr(tables, "apply_pending", lambda *a: (_ for _ in ()).throw(OSError("driver lost")))
    with pytest.raises(OSError):
        lake.refine()
    monkeypatch.setattr(tables, "apply_pending", apply)
    # half of the directories are there already: the new day, but not the changed one
    folder = tables.staging_folder(lake.silver)
    half = lake.spark.read.parquet(f"{folder}/batch").where("ingest_date = '2024-01-15'")
    run = lake.spark.read.json(f"{folder}/state").first().run
    half.withColumn("_run", F.lit(run)).write.mode("append").partitionBy("ingest_date", "_run").parquet(lake.silver)

    lake.refine()
    assert lake.rows("event_id", "latency_ms") == [
        ("e_0", 10),
        ("e_1", 500),
        ("e_2", 12),
        ("e_3", 13),
        ("e_4", 14),
        ("e_9", 19),
    ]
    assert not apply(lake.spark, lake.silver)


@pytest.mark.parametrize("cuts", [(), (4,), (1, 2, 6)])
def test_any_split_into_batches_gives_the_same_silver(spark, sf_dir, tmp_path, cuts):
    numbered = events.numbered_logs(events.read_events(spark, sf_dir))
    bronze, silver = f"{tmp_path}/bronze", f"{tmp_path}/silver"
    bounds = [-1, *cuts, 10**6]
    for low, high in zip(bounds, bounds[1:]):
        part = numbered.where((F.col("arrival_no") > low) & (F.col("arrival_no") <= high))
        part = part.drop("n", "arrival_no").withColumn("_arrival_date", F.to_date("_ingested_at"))
        tables.append_with_evolution(part, bronze, jobs.BRONZE_PARTITIONS)
        jobs.bronze_to_silver(spark, bronze, silver, f"{tmp_path}/quarantine")
    expected = keep_latest(events.logs(spark, sf_dir))
    found = tables.read_silver(spark, silver)
    assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()


def test_run_marker(spark, tmp_path, silver_rows):
    log = f"{tmp_path}/run_log"
    assert jobs.last_run(spark, log) == NO_RUN_TEXT
    jobs.record_run(log, "first", T0, silver_rows({}))
    jobs.record_run(log, "second", T1, silver_rows({}, {}))
    assert jobs.last_run(spark, log) == "second"


def test_whole_run(lake, spark):
    lake.put("a.jsonl", *(event(i, user_agent="ua") for i in range(20)))
    raw = lake.raw.replace("[", "\\[").replace("]", "\\]")
    root = f"{lake.root}/lake"
    results = jobs.run_all(spark, raw, root, utc("2024-01-10T13:00:00"), "run 1", T0)
    assert results.count() == 21 and results.where("status <> 'pass'").isEmpty()
    assert jobs.last_run(spark, f"{root}/run_log") == "run 1"
    stale = jobs.run_all(spark, raw, root, utc("2024-01-12T13:00:00"), "run 2", T1)
    assert [r.test for r in stale.where("status = 'error'").collect()] == ["freshness"]
    assert jobs.last_run(spark, f"{root}/run_log") == "run 1"
    assert jobs.read_mart(spark, f"{root}/marts", "dim_endpoints").first().request_count == 20
    assert spark.table("stg_logs").count() == 20


def test_listing_names_equal_the_names_of_rows(lake, spark):
    lake.put("x y/ü+%.jsonl", event(1))
    path = lake.raw.replace("[", "\\[").replace("]", "\\]")
    rows = jobs.bronze_rows(read_json_lines(spark, path), T0)
    assert rows.select("_source_file").collect() == list_files(spark, path).collect()


def test_many_folders_are_listed_by_few_tasks(lake, spark):
    for i in range(150):
        lake.put(f"batch={i}/a.jsonl", event(i))
    context, group = spark.sparkContext, f"listing {lake.raw}"
    context.setJobGroup(group, "listing")
    try:
        files = list_files(spark, lake.raw.replace("[", "\\[").replace("]", "\\]"))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = [s for job in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(job).stageIds]
    tasks = [tracker.getStageInfo(s).numTasks for s in stages]
    assert tasks and max(tasks) <= max(64, 4 * context.defaultParallelism)
    assert files.count() == 150


def test_a_batch_of_raw_files_is_written_by_one_task(spark, tmp_path):
    rows = [(i, utc("2024-01-10T12:00:00"), i % 7, "view", 1.0, '{"k": 40}') for i in range(2000)]
    table = spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string")
    numbered = events.numbered_logs(table.repartition(5))
    events.write_json_files(numbered, f"{tmp_path}/raw")
    files = [p for p in (tmp_path / "raw").rglob("part-*")]
    assert len(files) == len({p.parent for p in files}) == numbered.select("ingest_batch_id").distinct().count()
    assert spark.read.json(f"{tmp_path}/raw").count() == numbered.count()


def test_absent_table_is_none_and_other_errors_show(spark, tmp_path):
    assert tables.read_appended(spark, f"{tmp_path}/none") is None
    assert tables.read_silver(spark, f"{tmp_path}/none") is None
    with pytest.raises(Exception, match="DATA_SOURCE_NOT_FOUND"):
        tables.read_if_exists(spark, f"{tmp_path}/none", fmt="no_such_format")
    with pytest.raises(FileNotFoundError):
        jobs.build_marts(spark, f"{tmp_path}/none", f"{tmp_path}/marts")


def test_marts_are_kept_up_by_the_days_that_changed(lake, spark):
    marts = f"{lake.root}/marts"

    def check():
        built = jobs.build_marts(spark, lake.silver, marts)
        fresh = jobs.build_marts(spark, lake.silver, f"{lake.root}/fresh", full=True)
        for name in ("fct_requests_daily", "dim_endpoints"):
            assert built[name].exceptAll(fresh[name]).isEmpty()
            assert fresh[name].exceptAll(built[name]).isEmpty()
        return {str(r.event_date)[:10]: r.request_count for r in built["fct_requests_daily"].collect()}

    def day(n):
        return f"2024-01-{n}T10:00:00+00:00"

    def files(table):
        return set(spark.read.parquet(f"{marts}/{table}").inputFiles())

    lake.put("a.jsonl", event(1, event_time=day(10)), *(event(i, event_time=day(11)) for i in range(2, 300)))
    lake.ingest(T0)
    lake.refine()
    assert check() == {"2024-01-10": 1, "2024-01-11": 298}
    before = files("request_cube")
    assert check() and files("request_cube") == before

    # the one event of the 10th moves to the 12th, and one without a time arrives
    lake.put("b.jsonl", event(1, event_time=day(12)), event(900, event_time=None), *(
        event(i, event_time=day(12), endpoint="/b", status_code=503) for i in range(300, 500)
    ))
    lake.ingest(T1)
    lake.refine()
    assert check() == {"2024-01-11": 298, "2024-01-12": 201, "None": 1}
    kept = {f for f in before if "event_day=2024-01-11" in f}
    assert kept and kept <= files("request_cube")

    # and gets its time
    lake.put("c.jsonl", event(900, event_time=day(13)))
    lake.ingest(T2)
    lake.refine()
    assert check() == {"2024-01-11": 298, "2024-01-12": 201, "2024-01-13": 1}


def test_event_times_fixed_searches_the_days_of_the_batch(lake, monkeypatch):
    days = [f"2024-01-1{d}T00:00:00+00:00" for d in range(3)]
    lake.put("a.jsonl", *(event(i, event_time=t) for i, t in enumerate(days)))
    lake.ingest(T0)
    lake.refine(event_times_fixed=True)
    lake.put("b.jsonl", event(1, event_time=days[1], latency_ms=500), event(5, event_time=days[2]))
    lake.ingest(T1)
    lake.refine(event_times_fixed=True)
    assert lake.rows("event_id", "latency_ms") == [("e_0", 10), ("e_1", 500), ("e_2", 12), ("e_5", 15)]


def test_merge_needs_a_table_that_supports_it(spark, silver_rows):
    spark.sql("CREATE OR REPLACE TEMP VIEW no_merge AS SELECT 'e_0' AS event_id")
    with pytest.raises(UnsupportedOperationException):
        tables.merge_into(silver_rows({}).select("event_id"), "no_merge")
