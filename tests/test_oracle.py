"""Every query of the catalogue against SQL over the same tables."""

import importlib.util
import os
from datetime import date

import duckdb
import pandas as pd
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_spec = importlib.util.spec_from_file_location("spark_entry", f"{ROOT}/__spark_entry__.py")
entry_points = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(entry_points)

QUERIES, ORACLE = entry_points.QUERIES, entry_points.ORACLE_SQL
SQL_TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "TIMESTAMP": "timestamp_ntz",
    "DATE": "date",
    "BOOLEAN": "boolean",
}


def comparable(value):
    if pd.isna(value):
        return ""
    if type(value) is date:
        return str(pd.Timestamp(value))
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return repr(float(value))
    return str(value)


def rows_of(frame: pd.DataFrame, columns: list) -> list:
    return sorted(map(tuple, frame[columns].map(comparable).values.tolist()))


@pytest.fixture(scope="module")
def duck():
    from conftest import SF_DIR

    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for file in os.listdir(SF_DIR):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{file}'")
    return connection


def test_every_query_of_the_catalogue_has_sql():
    assert set(entry_points.QUERIES) == set(entry_points.ORACLE_SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    result = QUERIES[name](spark, sf_dir)
    plan = result._jdf.queryExecution().executedPlan().toString()
    for costly in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython"):
        assert costly not in plan
    expected = duck.execute(ORACLE[name]).fetch_df()
    columns = sorted(result.columns)
    assert columns == sorted(expected.columns)
    described = duck.execute(f"SELECT column_name, column_type FROM (DESCRIBE {ORACLE[name]})")
    types = {c: SQL_TYPES[t] for c, t in described.fetchall()}
    assert {f.name: f.dataType.simpleString() for f in result.schema} == types
    assert rows_of(result.toPandas(), columns) == rows_of(expected, columns)


def test_entry_has_a_row_per_day(spark):
    assert entry_points.entry(spark).count() == 30
