"""Blocked Bloom filters as tables: a semi-join reducer whose size has a bound.

The filter has at most `blocks` rows of eight 64-bit words (72 bytes a row), however many
keys went in, so it may be broadcast. More keys only mean that more rows pass; an equality
join behind it is what decides.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 2**16 blocks of 512 bits: 4.7 MB at most.
BLOCKS = 1 << 16
WORDS = 8


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _bits(key: Column) -> list[Column]:
    """One bit of each word of the block, by six bits each of a second hash."""
    h = F.xxhash64(key, F.lit(1))
    one = F.lit(1).cast("long")
    return [
        F.call_function("shiftleft", one, F.shiftright(h, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
        for i in range(WORDS)
    ]


def bloom_table(keys: DataFrame, key: str, blocks: int = BLOCKS) -> DataFrame:
    """The filter of a key column: rows (_block, _w0.._w7), made by one small aggregation."""
    words = [F.bit_or(bit).alias(f"_w{i}") for i, bit in enumerate(_bits(F.col(key)))]
    return keys.groupBy(_block(F.col(key), blocks).alias("_block")).agg(*words)


def maybe_in(df: DataFrame, key: str, bloom: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """The rows with `_maybe`: false if the key is surely not among those of the filter."""
    bits = _bits(F.col(key))
    present = reduce(
        lambda a, b: a & b, (F.col(f"_w{i}").bitwiseAND(bit) == bit for i, bit in enumerate(bits))
    )
    probed = df.withColumn("_block", _block(F.col(key), blocks)).join(F.broadcast(bloom), "_block", "left")
    hit = F.coalesce(present & F.col(key).isNotNull(), F.lit(False))
    return probed.withColumn("_maybe", hit).drop("_block", *(f"_w{i}" for i in range(WORDS)))


#: Probes of a bitmap; each takes other bits of the key.
SHIFTS = (0, 20, 39)


def bitmap(keys: DataFrame, key: str, bits: int) -> np.ndarray:
    """A Bloom filter of a column of hashes for use in Python, of 2**bits bits whatever their number.

    One row per 64-bit word that has bits comes to the driver, so a bounded number of them.
    """
    places = F.array(
        *(F.shiftrightunsigned(F.col(key), s).bitwiseAND(F.lit((1 << bits) - 1)) for s in SHIFTS)
    )
    one = F.lit(1).cast("long")
    words = (
        keys.select(F.explode(places).alias("bit"))
        .groupBy(F.shiftright("bit", 6).alias("word"))
        .agg(F.bit_or(F.call_function("shiftleft", one, F.col("bit").bitwiseAND(F.lit(63)).cast("int"))).alias("bits"))
    )
    found = words.toArrow()
    made = np.zeros(1 << (bits - 6), np.int64)
    made[found["word"].to_numpy()] = found["bits"].to_numpy()
    return made.view(np.uint8)


def in_bitmap(values: np.ndarray, made: np.ndarray) -> np.ndarray:
    """False where a hash is surely not among those of the bitmap."""
    last, hit = np.uint64(len(made) * 8 - 1), np.ones(len(values), bool)
    for shift in SHIFTS:
        bit = (values >> np.uint64(shift)) & last
        hit &= (made[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return hit
