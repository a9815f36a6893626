import json

import pytest

from loglake.__main__ import main


@pytest.fixture
def paths(tmp_path, spark):
    (tmp_path / "raw").mkdir()
    return {k: f"{tmp_path}/{k}" for k in ("raw", "bronze", "silver", "quarantine", "marts", "lake")}


def put(paths, name, **changes):
    row = {
        "event_id": f"e_{name}",
        "event_time": "2024-01-10T12:00:00+00:00",
        "endpoint": "/a",
        "method": "GET",
        "status_code": 503,
        "latency_ms": 10,
        "user_id": "u_1",
        "country": "US",
        "ingest_batch_id": "b_1",
        **changes,
    }
    with open(f"{paths['raw']}/{name}.jsonl", "w") as f:
        f.write(json.dumps({k: v for k, v in row.items() if v is not None}) + "\n")


def run(step, paths, *names, more=()):
    return main([step, *(x for n in names for x in (f"--{n}-path", paths[n])), *more])


def test_steps_one_by_one(paths, capsys):
    put(paths, "1")
    silver = ("bronze", "silver", "quarantine")
    assert run("ingest", paths, "raw", "bronze") == 0
    assert run("silver", paths, *silver) == 0
    assert run("marts", paths, "silver", "marts") == 0
    assert run("test", paths, "silver", "marts", more=["--as-of", "2024-01-10T13:00:00"]) == 0
    assert run("test", paths, "silver", "marts", more=["--as-of", "2024-01-11"]) == 1
    assert "error stg_logs.event_ts freshness: 1 failing" in capsys.readouterr().out
    assert run("panel", paths, "marts", more=["kpis"]) == 0
    assert "100.0" in capsys.readouterr().out
    assert run("drift", paths, "raw") == 0

    put(paths, "2", status_code=9999)
    assert run("ingest", paths, "raw", "bronze") == 0
    assert run("silver", paths, *silver) == 1

    put(paths, "3", status_code="not a number")
    assert run("ingest", paths, "raw", "bronze") == 1


def test_whole_run_and_marker(paths, capsys):
    put(paths, "1")
    assert run("last-run", paths, "lake") == 0
    assert "no successful run recorded yet" in capsys.readouterr().out
    assert run("run", paths, "raw", "lake", more=["--as-of", "2024-01-10T13:00:00Z"]) == 0
    capsys.readouterr()
    assert run("last-run", paths, "lake") == 0
    assert capsys.readouterr().out.strip().startswith("20")


def test_missing_columns(paths):
    put(paths, "1", country=None)
    assert run("ingest", paths, "raw", "bronze") == 1
