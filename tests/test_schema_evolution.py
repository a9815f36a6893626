import pytest
from pyspark.sql import functions as F

from loglake.contract import RAW_SCHEMA, SAFE_WIDENING, TYPE_ALIASES, SchemaEvolutionError
from loglake.operators.schema_diff import classify, json_fields, merged_fields, observed_schema, schema_diff
from loglake.sources.tables import append_with_evolution, read_appended, table_schema


def field_rows(spark, fields: dict):
    return spark.createDataFrame(list(fields.items()), "field string, type string")


RAW = {f.name: f.dataType.simpleString() for f in RAW_SCHEMA}
WIDENINGS = [(old, new) for old, new in SAFE_WIDENING]


def _cases():
    """Derived from the contract: every widening and its reverse, every raw field dropped or new."""
    yield "as the contract", RAW, RAW, "none", {}
    for alias, name in TYPE_ALIASES.items():
        yield f"{alias} for {name}", {"x": alias}, {"x": name}, "none", {}
    for old, new in WIDENINGS:
        yield f"{old} to {new}", {**RAW, "x": old}, {**RAW, "x": new}, "widening", {"x": "type_changed"}
        yield f"{new} to {old}", {**RAW, "x": new}, {**RAW, "x": old}, "breaking", {"x": "type_changed"}
        yield f"{old} to text", {"x": old}, {"x": "string"}, "breaking", {"x": "type_changed"}
        both = {"x": "type_changed", "y": "added"}
        yield f"{old} to {new}, and a field", {"x": old}, {"x": new, "y": "date"}, "widening", both
    for field in RAW:
        without = {k: v for k, v in RAW.items() if k != field}
        yield f"{field} is new", without, RAW, "additive", {field: "added"}
        yield f"{field} is gone", RAW, without, "breaking", {field: "removed"}
        yield f"{field} is renamed", RAW, {**without, "other": RAW[field]}, "breaking", {field: "removed", "other": "added"}


CASES = {name: rest for name, *rest in _cases()}


@pytest.mark.parametrize("case", list(CASES))
def test_diff_and_classification(spark, case):
    existing, incoming, classification, changes = CASES[case]
    diff = schema_diff(field_rows(spark, existing), field_rows(spark, incoming))
    assert {r.field: r.change for r in diff.collect()} == changes
    assert classify(diff).first().classification == classification


def test_first_write_is_no_change(spark, tmp_path):
    df = spark.createDataFrame([("e",)], "event_id string")
    assert append_with_evolution(df, f"{tmp_path}/t") == "none"


def test_breaking_append_raises_and_writes_nothing(spark, tmp_path):
    path = f"{tmp_path}/t"
    append_with_evolution(spark.createDataFrame([("e", 200)], "event_id string, status_code int"), path)
    with pytest.raises(SchemaEvolutionError, match="status_code: int -> None"):
        append_with_evolution(spark.createDataFrame([("f",)], "event_id string"), path)
    assert read_appended(spark, path).count() == 1


def test_additive_append_fills_old_rows_with_null(spark, tmp_path):
    path = f"{tmp_path}/t"
    append_with_evolution(spark.createDataFrame([("e",)], "event_id string"), path)
    wider = spark.createDataFrame([("ua", "f")], "user_agent string, event_id string")
    assert append_with_evolution(wider, path) == "additive"
    rows = read_appended(spark, path).select("event_id", "user_agent").orderBy("event_id").collect()
    assert [tuple(r) for r in rows] == [("e", None), ("f", "ua")]


@pytest.mark.parametrize(
    "old, new", [("int", "bigint"), ("int", "double"), ("bigint", "double"), ("float", "double")]
)
def test_widened_column_reads_back_under_the_wide_type(spark, tmp_path, old, new):
    path = f"{tmp_path}/t"
    append_with_evolution(spark.range(3).select(F.col("id").cast(old).alias("x")), path)
    assert append_with_evolution(spark.range(3, 5).select(F.col("id").cast(new).alias("x")), path) == "widening"
    table = read_appended(spark, path)
    assert table.schema["x"].dataType.simpleString() == new
    assert sorted(r.x for r in table.collect()) == [0, 1, 2, 3, 4]


def test_new_column_survives_a_later_widening(spark, tmp_path):
    path = f"{tmp_path}/t"
    append_with_evolution(spark.range(1).selectExpr("id x"), path)
    append_with_evolution(spark.range(1).selectExpr("id x", "'b' y"), path)
    append_with_evolution(spark.range(1).selectExpr("1.5D x", "'c' y"), path)
    rows = {(r.x, r.y) for r in read_appended(spark, path).collect()}
    assert rows == {(0.0, None), (0.0, "b"), (1.5, "c")}
    assert table_schema(spark, path).simpleString() == "struct<x:double,y:string>"


def test_fields_of_json_lines(spark):
    lines = spark.createDataFrame(
        [
            ("f1", '{"a": 1, "b": "x"}'),
            ("f1", '{"a": 2, "b": null}'),
            ("f2", '{"a": 1.5, "c": true}'),
            ("f2", "{broken"),
            ("f3", '{"a": "text"}'),
        ],
        "_source_file string, value string",
    )
    by_file = json_fields(lines)
    found = {(r._source_file, r.field, r.type): r.row_count for r in by_file.collect()}
    assert found == {
        ("f1", "a", "bigint"): 2,
        ("f1", "b", "string"): 1,
        ("f1", "b", "void"): 1,
        ("f2", "a", "double"): 1,
        ("f2", "c", "boolean"): 1,
        ("f2", "_corrupt_record", "string"): 1,
        ("f3", "a", "string"): 1,
    }
    two = merged_fields(by_file.where("_source_file <> 'f3'"))
    assert {r.field: r.type for r in two.collect()}["a"] == "double"
    assert {r.field: r.type for r in merged_fields(by_file).collect()}["a"] == "string"


def test_json_that_is_no_object_is_unreadable(spark):
    lines = spark.createDataFrame(
        [("f", x) for x in ("5", "[1, 2]", '"a"', "null", "[]", '[{"a": 1}]', "{broken", '{"a": {"b": [1.5]}}', "{}")],
        "_source_file string, value string",
    )
    found = {(r.field, r.type): r.row_count for r in json_fields(lines).collect()}
    assert found == {("_corrupt_record", "string"): 7, ("a", "object<b: array<decimal(2,1)>>"): 1}


def test_observed_schema(spark):
    def observed(*lines):
        schema, unreadable = observed_schema(spark.createDataFrame([(x,) for x in lines], "value string"))
        return schema.simpleString(), unreadable

    assert observed('{"a": 1, "b": null, "f `DECIMAL(1,1)": "x"}', "", " ") == ("struct<a:bigint,b:void,f `DECIMAL(1,1):string>", False)
    assert observed('{"a": 1}', '{"a": 1.5}', '{"a": null, "c": {"d": 1}}', "{x") == ("struct<a:double,c:struct<d:bigint>>", True)
    assert observed('{"a": 1}', '{"a": "x"}') == ("struct<a:string>", False)
    assert observed("5") == ("struct<>", True)
    assert observed() == ("struct<>", False)
