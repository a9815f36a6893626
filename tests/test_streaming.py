"""Streams end with the tables the batch jobs make."""

import json
from functools import reduce

import pytest
from conftest import utc
from pyspark.errors import StreamingQueryException

from loglake.operators.cleaning import clean_and_type, keep_latest, to_contract
from loglake.operators.schema_diff import merged_type, observed_schema
from loglake.sources import events, tables
from loglake.streaming import lake
from loglake.streaming.lake import append_bronze, stream_to_bronze, stream_to_silver


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    from conftest import SF_DIR

    path = f"{tmp_path_factory.mktemp('raw')}/events"
    events.write_json_files(events.numbered_logs(events.read_events(spark, SF_DIR)), path)
    return path


EVENT = {
    "event_id": "e",
    "event_time": "2024-01-01T00:00:00Z",
    "endpoint": "/a",
    "method": "GET",
    "status_code": 200,
    "latency_ms": 5,
    "user_id": "u",
    "country": "US",
    "ingest_batch_id": "b",
}


def same(left, right):
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_stream_to_bronze_in_micro_batches(spark, sf_dir, raw, tmp_path):
    bronze, checkpoint = f"{tmp_path}/bronze", f"{tmp_path}/checkpoint"
    at = utc("2024-02-01T00:00:00")
    query = stream_to_bronze(spark, raw, bronze, checkpoint, at, maxFilesPerTrigger=3)
    query.awaitTermination()
    assert len(query.recentProgress) > 1
    volatile = ("_source_file", "_ingested_at")
    expected = events.logs(spark, sf_dir).drop(*volatile)
    found = to_contract(clean_and_type(tables.read_appended(spark, bronze))).drop(*volatile)
    assert same(found, expected)
    # nothing is left to do, and a repeated micro-batch adds nothing
    stream_to_bronze(spark, raw, bronze, checkpoint, at).awaitTermination()
    append_bronze(tables.read_appended(spark, bronze), bronze)
    assert tables.read_appended(spark, bronze).count() == expected.count()


def test_stream_to_silver_equals_batch(spark, sf_dir, raw, tmp_path):
    lake = f"{tmp_path}/lake"
    query = stream_to_silver(spark, raw, lake, f"{tmp_path}/checkpoint", maxFilesPerTrigger=100)
    query.awaitTermination()
    volatile = ("_source_file", "_ingested_at")
    expected = keep_latest(events.logs(spark, sf_dir)).drop(*volatile)
    assert same(tables.read_silver(spark, f"{lake}/silver").drop(*volatile), expected)


def test_failed_gate_stops_the_stream_and_holds_the_batch(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a.jsonl").write_text(json.dumps({**EVENT, "status_code": 9999}) + "\n")
    lake = f"{tmp_path}/lake"
    for _ in range(2):
        with pytest.raises(StreamingQueryException, match="status_code_range"):
            stream_to_silver(spark, f"{tmp_path}/raw", lake, f"{tmp_path}/cp").awaitTermination()
    assert tables.read_appended(spark, f"{lake}/quarantine").count() == 1
    assert tables.read_appended(spark, f"{lake}/bronze").count() == 1
    assert tables.read_silver(spark, f"{lake}/silver") is None


def test_stream_takes_on_new_fields(spark, tmp_path):
    raw, bronze, checkpoint = tmp_path / "raw", f"{tmp_path}/bronze", f"{tmp_path}/cp"
    raw.mkdir()
    (raw / "a.jsonl").write_text(json.dumps(EVENT) + "\n")
    stream_to_bronze(spark, str(raw), bronze, checkpoint).awaitTermination()
    (raw / "b.jsonl").write_text(json.dumps({**EVENT, "event_id": "f", "region": "eu", "latency_ms": 1.5}) + "\n")
    stream_to_bronze(spark, str(raw), bronze, checkpoint).awaitTermination()
    rows = tables.read_appended(spark, bronze).select("event_id", "region", "latency_ms").collect()
    assert sorted(map(tuple, rows)) == [("e", None, 5.0), ("f", "eu", 1.5)]
    # a stream that lost its checkpoint meets known files only
    stream_to_bronze(spark, str(raw), bronze, f"{tmp_path}/new").awaitTermination()
    assert tables.read_appended(spark, bronze).count() == 2


def test_all_files_set_the_schema_of_a_stream(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lake, "FILES_AT_ONCE", 1)
    raw, bronze = tmp_path / "raw", f"{tmp_path}/bronze"
    raw.mkdir()
    more = ({"region": "eu"}, {"latency_ms": 1.5}, {"retries": None}, {"retries": 2, "client": {"os": None}})
    for i, fields in enumerate((*more, {"client": {"os": "x", "build": 7}})):
        (raw / f"{i}.jsonl").write_text(json.dumps({**EVENT, "event_id": f"e{i}", **fields}) + "\n")
    stream_to_bronze(spark, str(raw), bronze, f"{tmp_path}/cp").awaitTermination()
    rows = tables.read_appended(spark, bronze).orderBy("event_id")
    found = rows.select("region", "latency_ms", "retries", "client.os", "client.build").collect()
    none = (None, 5.0, None, None, None)
    assert [*map(tuple, found)] == [
        ("eu", *none[1:]), (None, 1.5, *none[2:]), none, (None, 5.0, 2, None, None), (None, 5.0, None, "x", 7)
    ]


def test_parts_of_a_batch_have_the_schema_of_all(spark):
    lines = ['{"a":1,"b":null,"c":{"x":null}}', '{"a":1.5,"c":{"y":[1]}}', '{"b":true,"c":{"y":[2.5]}}', '{"a":null,"c":{"x":"s"},"d":[]}', "[1]"]
    for some in (lines, [*lines, '{"a":true,"c":"s","b":7}']):
        whole, *parts = (
            observed_schema(spark.createDataFrame([(x,) for x in part], "value string"))[0]
            for part in (some, *([x] for x in some))
        )
        assert reduce(merged_type, parts) == whole
