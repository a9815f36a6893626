import os
import sys
from datetime import datetime, timezone

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from loglake.contract import SILVER_SCHEMA  # noqa: E402
from loglake.session import build_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def utc(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.python.sql.dataFrameDebugging.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sf_dir():
    return SF_DIR


@pytest.fixture
def silver_rows(spark):
    """Rows of the silver contract; fields not named take a valid default."""

    def make(*rows: dict):
        defaults = {
            "event_time": utc("2024-01-10T12:00:00"),
            "endpoint": "/a",
            "method": "GET",
            "status_code": 200,
            "latency_ms": 10,
            "user_id": "u_1",
            "country": "US",
            "ingest_batch_id": "b_1",
            "user_agent": None,
            "session_id": None,
            "is_authenticated": None,
            "_source_file": "f_1",
            "_ingested_at": utc("2024-02-01T00:00:00"),
            "ingest_date": utc("2024-01-10T12:00:00").date(),
        }
        complete = []
        for i, row in enumerate(rows):
            row = {"event_id": f"e_{i}", **defaults, **row}
            if "event_time" in row and "ingest_date" not in rows[i]:
                row["ingest_date"] = row["event_time"] and row["event_time"].date()
            complete.append(tuple(row[name] for name in SILVER_SCHEMA.names))
        return spark.createDataFrame(complete, SILVER_SCHEMA)

    return make
