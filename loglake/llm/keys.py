"""Keys for rows of a documents table whose ids may be missing or repeated.

A row is known by its id (a missing id is a value of its own) and a 64-bit hash of its text.
Rows equal in both are copies of one row, for which operators compute the same result.
The three columns are never null, so plain equality joins find every row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglake.llm.bloom import bloom_table, maybe_in

KEY = ["_no_id", "_id", "_text_hash"]


def with_key(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, text (missing: empty) and the key columns; all other columns are left out."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    return df.select(
        F.col(id_column).alias("doc_id"),
        text.alias("text"),
        F.col(id_column).isNull().alias("_no_id"),
        F.coalesce(F.col(id_column).cast("long"), F.lit(0)).alias("_id"),
        F.xxhash64(text).alias("_text_hash"),
    )


def plain(df: DataFrame) -> DataFrame:
    """Without columns that begin with an underscore: such names are the operators' own."""
    return df.select(*(F.col(f"`{c}`") for c in df.columns if not c.startswith("_")))


def add_key(df: DataFrame) -> DataFrame:
    """All plain columns of documents and the key columns."""
    return plain(df).withColumns(
        {
            "_no_id": F.col("doc_id").isNull(),
            "_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)),
            "_text_hash": F.xxhash64(F.coalesce("text", F.lit(""))),
        }
    )


def without_rows(df: DataFrame, keys: DataFrame) -> DataFrame:
    """The documents, plain columns, whose key is not among `keys`.

    Only rows that a Bloom filter of the keys may hold are shuffled.
    """
    columns = [F.col(f"`{c}`") for c in plain(df).columns]
    probed = maybe_in(add_key(df), "_text_hash", bloom_table(keys, "_text_hash"))
    stay = probed.where("_maybe").join(keys.select(*KEY), KEY, "left_anti")
    return probed.where("NOT _maybe").select(*columns).unionByName(stay.select(*columns))


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z; all other letters stay."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
