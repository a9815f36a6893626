"""Document fingerprints by winnowing: minima of k-gram hashes over a sliding window.

Units are words: a run of characters other than white space, or a single character of a
script written without spaces. Hashes of `k` consecutive units are taken at every place; of
each `window` consecutive ones the smallest is kept, of equal ones the rightmost, with its
place. Texts that share k + window - 1 consecutive units share a fingerprint. A text of
fewer units than k is one gram; of fewer grams than a window, one window.

All of it runs in one pass over arrays within a row: no explosion and no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loglake.llm.keys import KEY, with_key
from loglake.sources.tables import scratch_table

UNIT = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]|[^\x00-\x20\u0085\p{Z}\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]+"
K = 4
WINDOW = 16
#: Low bits of a packed hash hold the place, counted from the top so that the rightmost of
#: equal hashes is the smallest.
PLACE_BITS = 31
LAST_PLACE = (1 << PLACE_BITS) - 1


def _let(value: Column, body) -> Column:
    """body(value), with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _grams(units: Column, k: int) -> Column:
    """Packed (32-bit hash, place) of each k consecutive units."""

    def packed(hashes: Column) -> Column:
        count = F.greatest(F.size(hashes) - F.lit(k - 1), F.least(F.size(hashes), F.lit(1)))
        places = F.slice(hashes, F.lit(1), count)
        return F.transform(
            places,
            lambda h, i: F.shiftleft(
                F.xxhash64(h, *(F.get(hashes, i + F.lit(j)) for j in range(1, k))).bitwiseAND(F.lit(0xFFFFFFFF)),
                PLACE_BITS,
            ).bitwiseOR(F.lit(LAST_PLACE) - i.cast("long")),
        )

    return _let(F.transform(units, lambda u: F.xxhash64(u)), packed)


def _minima(grams: Column, window: int) -> Column:
    """Smallest of each `window` consecutive values, by doubling: windows of 1, 2, 4, ..."""

    def wider(values: Column, step: int) -> Column:
        return _let(values, lambda r: F.transform(r, lambda x, i: F.least(x, F.get(r, i + F.lit(step)))))

    width, result = 1, grams
    while width < window:
        step = min(width, window - width)
        result = wider(result, step)
        width += step
    return _let(
        result,
        lambda r: F.slice(r, F.lit(1), F.greatest(F.size(r) - F.lit(window - 1), F.least(F.size(r), F.lit(1)))),
    )


def fingerprint(text: Column, k: int = K, window: int = WINDOW) -> Column:
    """Array of (hash, place) packed as longs, by place; empty for a text without units."""
    units = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(UNIT), F.lit(0))
    return F.array_distinct(_minima(_grams(units, k), window))


def hashes(packed: Column) -> Column:
    """The distinct hashes of a fingerprint, as signed ints."""
    return F.array_distinct(
        F.transform(packed, lambda p: (F.shiftrightunsigned(p, PLACE_BITS) - F.lit(1 << 31)).cast("int"))
    )


def fingerprint_text(packed: Column) -> Column:
    """hash@place, hash in hexadecimal and place in units, space-joined."""
    return F.array_join(
        F.transform(
            packed,
            lambda p: F.concat_ws(
                "@",
                F.lower(F.hex(F.shiftrightunsigned(p, PLACE_BITS))),
                (F.lit(LAST_PLACE) - p.bitwiseAND(F.lit(LAST_PLACE))).cast("string"),
            ),
        ),
        " ",
    )


def likeness(a: Column, b: Column) -> Column:
    """Shared hashes over all hashes of two sets, 0 to 1; 1 for two empty sets."""
    shared = F.size(F.array_intersect(a, b))
    total = F.size(a) + F.size(b) - shared
    return F.when(total == 0, F.lit(1.0)).otherwise(shared / total)


def fingerprints(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """doc_id and `fingerprint` (array of packed longs) for each row; a missing text is empty."""
    return docs.select("doc_id", fingerprint(F.col("text"), k, window).alias("fingerprint"))


def neighbours(keyed: DataFrame) -> DataFrame:
    """One row per key with the number of its rows, its text's length, and the key that comes
    before it in descending order (`_to_*`; of the first, the last), with that text's length.

    Only keys are sorted, over all partitions; what crosses from one partition to the next
    is one row per partition.
    """
    rows = keyed.groupBy(*KEY).agg(F.count("*").alias("_copies"), F.first("_size").alias("_size"))
    order = [F.col("_no_id"), F.col("_id").desc(), F.col("_text_hash")]
    dealt = rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    dealt = scratch_table(dealt, "ordered-keys")
    entry = F.struct(*KEY, "_size")
    edges = dealt.groupBy("_part").agg(F.max_by(entry, F.struct("_no_id", -F.col("_id"), "_text_hash")).alias("_last"))
    around = Window.orderBy("_part")
    last = F.last("_last").over(around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    edges = edges.select("_part", F.coalesce(F.lag("_last").over(around), last).alias("_edge"))
    within = Window.partitionBy("_part").orderBy(*order)
    return (
        dealt.withColumn("_before", F.lag(entry).over(within))
        .join(F.broadcast(edges), "_part")
        .withColumn("_to", F.coalesce("_before", "_edge"))
        .select(*KEY, "_copies", *(F.col(f"_to.{c}").alias(f"_to{c}") for c in KEY), F.col("_to._size").alias("_to_size"))
    )


def compare_edited(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """Each document beside its edited text and the next document.

    The edited text replaces the last half (rounded down, in code points) by the start of the
    next document in descending doc_id, as long or whole. Rows with equal ids are ordered by a
    hash of their text, missing ids come last, copies of a row follow each other; after the
    last row comes the first. One row per input row: doc_id, n_chars, edited text,
    fingerprints of both (packed), likeness to the edited text and to the next document.

    Texts are shuffled once by key, and once more the part that goes into another text.
    """
    # Both sides of the second join read one shuffle of (key, text): what else they need is
    # made behind it.
    keyed = with_key(docs).select(*KEY, "text")
    plan = neighbours(keyed.withColumn("_size", F.length("text")))
    copy = Window.partitionBy(*KEY).orderBy(F.lit(0))
    rows = keyed.join(plan, KEY).withColumn("_copy", F.row_number().over(copy))
    given = rows.where("_copy = 1").select(
        F.substring(F.col("text"), F.lit(1), F.floor(F.col("_to_size") / 2).cast("int")).alias("_head"),
        hashes(fingerprint(F.col("text"), k, window)).alias("_next"),
        *(F.col(f"_to{c}").alias(c) for c in KEY),
    )
    rows = rows.withColumn("_size", F.length("text")).withColumn("fingerprint", fingerprint(F.col("text"), k, window))
    half = F.floor(F.col("_size") / 2).cast("int")
    own = hashes(F.col("fingerprint"))
    last_copy = F.col("_copy") == F.col("_copies")
    both = rows.join(given, KEY).select(
        F.when(~F.col("_no_id"), F.col("_id")).alias("doc_id"),
        F.col("_size").cast("long").alias("n_chars"),
        "fingerprint",
        F.concat(
            F.substring(F.col("text"), F.lit(1), F.col("_size") - half),
            F.when(last_copy, F.col("_head")).otherwise(F.substring(F.col("text"), F.lit(1), half)),
        ).alias("edited"),
        F.when(last_copy, F.col("_next")).otherwise(own).alias("_next"),
    )
    return both.withColumn("edited_fingerprint", fingerprint(F.col("edited"), k, window)).select(
        "doc_id",
        "n_chars",
        "edited",
        "fingerprint",
        "edited_fingerprint",
        likeness(hashes(F.col("fingerprint")), hashes(F.col("edited_fingerprint"))).alias("near_edited"),
        likeness(hashes(F.col("fingerprint")), F.col("_next")).alias("near_next"),
    )
