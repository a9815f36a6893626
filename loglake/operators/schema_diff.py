"""Schemas as rows: what changed between two of them, and which file brought what."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from loglake.contract import SAFE_WIDENING, TYPE_ALIASES

SEVERITY = {"none": 0, "additive": 1, "widening": 2, "breaking": 3}


def fields(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """Top-level fields of a schema as rows (field, type)."""
    rows = [
        F.struct(F.lit(f.name).alias("field"), F.lit(f.dataType.simpleString()).alias("type"))
        for f in schema
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _type_name(column: str) -> Column:
    spelled = F.lower(F.col(column))
    aliases = F.create_map(*(F.lit(x) for pair in TYPE_ALIASES.items() for x in pair))
    return F.coalesce(aliases[spelled], spelled)


def schema_diff(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Fields that differ: added, removed or type_changed, and how grave that is."""
    old = existing.select("field", _type_name("type").alias("old_type"))
    new = incoming.select("field", _type_name("type").alias("new_type"))
    change = (
        F.when(F.col("old_type").isNull(), "added")
        .when(F.col("new_type").isNull(), "removed")
        .otherwise("type_changed")
    )
    widens = F.concat_ws(">", "old_type", "new_type").isin(*(">".join(p) for p in SAFE_WIDENING))
    grade = (
        F.when(F.col("change") == "added", "additive")
        .when((F.col("change") == "type_changed") & widens, "widening")
        .otherwise("breaking")
    )
    return (
        old.join(new, "field", "full_outer")
        .where(~F.col("old_type").eqNullSafe(F.col("new_type")))
        .withColumn("change", change)
        .withColumn("severity", grade)
    )


def classify(diff: DataFrame) -> DataFrame:
    """One row: the gravest change of a diff, or none."""
    levels = F.create_map(*(F.lit(x) for pair in SEVERITY.items() for x in pair))
    worst = F.max(F.struct(levels[F.col("severity")], "severity"))
    return diff.agg(F.coalesce(worst["severity"], F.lit("none")).alias("classification"))


def _object(column: str) -> Column:
    """A text as a JSON object; null if it is none."""
    document = F.try_parse_json(column)
    return F.when(F.schema_of_variant(document).startswith("OBJECT"), document)


def _spark_type(spelled: str) -> str:
    """A variant's type as JSON inference has it: decimals are doubles, what differs is text."""
    quoted = spelled.split("`")  # every second part is a name
    for i in range(0, len(quoted), 2):
        for pattern, name in ((r"\bOBJECT<", "STRUCT<"), (r"\bDECIMAL\(\d+,\s*\d+\)", "DOUBLE"), (r"\bVARIANT\b", "STRING")):
            quoted[i] = re.sub(pattern, name, quoted[i])
    return "`".join(quoted)


def observed_schema(lines: DataFrame) -> tuple[T.StructType, bool]:
    """Fields and types of JSON lines (``value``), and whether some line is not readable.

    One pass and one row of result. A field that is null throughout has the type void.
    """
    parsed = lines.where(F.trim("value") != "").select(_object("value").alias("document"))
    row = parsed.agg(
        F.schema_of_variant_agg("document").alias("type"),
        F.coalesce(F.bool_or(F.col("document").isNull()), F.lit(False)).alias("unreadable"),
    ).first()
    found = T.DataType.fromDDL(_spark_type(row.type)) if row.type.startswith("OBJECT<") else T.StructType()
    return found, row.unreadable


def merged_type(one: T.DataType, other: T.DataType) -> T.DataType:
    """Type of two parts of a batch together, as ``observed_schema`` has it if it sees both."""
    if one == other or isinstance(other, T.NullType):
        return one
    if isinstance(one, T.NullType):
        return other
    if isinstance(one, T.ArrayType) and isinstance(other, T.ArrayType):
        return T.ArrayType(merged_type(one.elementType, other.elementType))
    if isinstance(one, T.StructType) and isinstance(other, T.StructType):
        types = {f.name: f.dataType for f in one}
        for f in other:
            types[f.name] = merged_type(types[f.name], f.dataType) if f.name in types else f.dataType
        return T.StructType([T.StructField(name, types[name]) for name in sorted(types)])
    numeric = {one.simpleString(), other.simpleString()} == {"bigint", "double"}
    return T.DoubleType() if numeric else T.StringType()


def json_fields(lines: DataFrame) -> DataFrame:
    """(_source_file, field, type, rows) of JSON lines; unreadable lines show as a field.

    ``lines`` has ``_source_file`` and ``value``. Types are read from the values
    themselves. A line that is JSON but no object counts as unreadable, as it has no
    fields. Repeats are counted before the shuffle, so one large file is no
    larger here than its number of fields.
    """
    parsed = lines.where(F.col("value").isNotNull()).select("_source_file", _object("value").alias("document"))
    entry = lines.sparkSession.tvf.variant_explode_outer(F.col("document").outer())
    readable = F.col("document").isNotNull()
    counts = (
        parsed.lateralJoin(entry)
        .where(~readable | F.col("key").isNotNull())
        .groupBy(
            "_source_file",
            F.when(readable, F.col("key")).otherwise("_corrupt_record").alias("field"),
            F.when(readable, F.schema_of_variant("value")).otherwise("STRING").alias("type"),
        )
        .agg(F.count("*").alias("n"))
    )
    # The type names are tidied on the counts: decimals of any width are doubles to us.
    plain = F.regexp_replace(F.lower("type"), "^decimal.*", "double")
    return counts.groupBy("_source_file", "field", plain.alias("type")).agg(
        F.sum("n").alias("row_count")
    )


def merged_fields(by_file: DataFrame) -> DataFrame:
    """One type per field over all files, as reading them together would infer it."""
    types = F.array_sort(F.collect_set(F.when(F.col("type") != "void", F.col("type"))))
    one = (
        F.when(F.size(types) == 1, types[0])
        .when(types == F.array(F.lit("bigint"), F.lit("double")), "double")
        .otherwise("string")
    )
    return by_file.groupBy("field").agg(one.alias("type"))


def field_history(by_file: DataFrame) -> DataFrame:
    """When each field and type first appeared (files sort by batch), and in how many files."""
    return by_file.groupBy("field", "type").agg(
        F.min("_source_file").alias("first_file"),
        F.count("*").alias("files"),
        F.sum("row_count").alias("row_count"),
    )
