"""Leave out of a shuffle the rows whose key is surely not among some others.

The others' keys go into a blocked Bloom filter: a table of at most ``blocks`` rows of eight 64-bit
words, so it may be broadcast however many keys went in. With more keys than it is made for
more rows pass, and the join behind it decides as ever.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

#: 2**16 blocks of 512 bits, 4.7 MB, made for some three million keys.
BLOCKS = 1 << 16
WORDS = 8


def _block(key: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _bits(key: str) -> list[Column]:
    """A bit in each word of the block, from six bits each of a second hash."""
    mixed = F.xxhash64(F.col(key), F.lit("bit"))
    one = F.lit(1).cast("long")
    places = (F.shiftrightunsigned(mixed, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(WORDS))
    return [F.call_function("shiftleft", one, place) for place in places]


def key_filter(keys: DataFrame, key: str, blocks: int = BLOCKS) -> DataFrame:
    """The filter of a column of keys; one small aggregation, combined before it is shuffled."""
    words = (F.bit_or(bit).alias(f"_word{i}") for i, bit in enumerate(_bits(key)))
    return keys.where(F.col(key).isNotNull()).groupBy(_block(key, blocks).alias("_block")).agg(*words)


def split_by_filter(df: DataFrame, key: str, made: DataFrame, blocks: int = BLOCKS) -> tuple[DataFrame, DataFrame]:
    """Rows whose key may be among those of the filter, and rows whose key surely is not.

    A missing key is among the latter.
    """
    probed = df.withColumn("_block", _block(key, blocks)).join(F.broadcast(made), "_block", "left")
    present = reduce(lambda a, b: a & b, (F.col(f"_word{i}").bitwiseAND(bit) == bit for i, bit in enumerate(_bits(key))))
    may = F.coalesce(present & F.col(key).isNotNull(), F.lit(False))
    return probed.where(may).select(*df.columns), probed.where(~may).select(*df.columns)
