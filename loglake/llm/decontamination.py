"""Benchmark decontamination by winnowing: passages that documents share with test items.

Item and document words are hashed in grams of `K`; of each window of consecutive grams the
smallest hash is its fingerprint. A window of grams spans exactly `length` words, so every
shared run of that many words has the same fingerprint on both sides: none is missed. An
item of fewer words is one window, its fingerprint the hash of all of it.

Training fingerprints are probed against a bitmap of the test fingerprints, of a fixed size
whatever the number of items; those that pass are extended to all windows they stand for,
which join the windows of the items by a 128-bit hash of their words. So only windows that
very likely occur in an item are shuffled, and the join decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglake.llm import numeric
from loglake.llm.bloom import bitmap, in_bitmap
from loglake.llm.keys import KEY, with_key
from loglake.sources.tables import scratch_table

LENGTH = 10
#: Words of a gram; windows have LENGTH - K + 1 grams.
K = 5
#: Bits of the bitmap of test fingerprints: 1 MB.
BITMAP_BITS = 23
BETWEEN_WORDS = ((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
HIT = "at int, size int, h1 long, h2 long"


def _windows(words: tuple[np.ndarray, np.ndarray], size: int, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprint and two hashes of each `size` consecutive words, of words hashed twice."""
    h1, h2 = (numeric.gram_hash(w, size, salt=i) for i, w in enumerate(words))
    if size < length:
        return h1, h1, h2
    grams = numeric.gram_hash(words[0], K, salt=3)
    count = len(h1)
    prints = grams[:count].copy()
    for j in range(1, length - K + 1):
        np.minimum(prints, grams[j : j + count], out=prints)
    return prints, h1, h2


class _Words:
    """Words of stretches of rows: their bounds by row, and two hashes of each."""

    def __init__(self) -> None:
        self.table, self.hash = numeric.class_table(*BETWEEN_WORDS), (numeric.SpanHash(), numeric.SpanHash(1))

    def __call__(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, tuple[np.ndarray, np.ndarray]]]:
        for first, _, data, bounds in numeric.stretches(texts):
            data = numeric.LOWER[data]
            starts, ends = numeric.runs(self.table[data], bounds)
            yield first, np.searchsorted(starts, bounds), tuple(h(data, starts, ends) for h in self.hash)


def _inside(at: np.ndarray, size: int, count: int) -> np.ndarray:
    """Places at which `size` words begin that all belong to one row."""
    ends = np.repeat(at[1:], np.diff(at))[:count]
    return np.arange(count) + size <= ends


def _item_windows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Windows of each item: id, size, fingerprint and hashes."""
    split = _Words()
    for batch in batches:
        for first, at, words in split(batch.column("text")):
            n = np.diff(at)
            ids = batch.column("item_id").slice(first, len(n))
            for size in range(1, length + 1):
                prints, h1, h2 = _windows(words, size, length)
                if not len(h1):
                    continue
                row = np.repeat(np.arange(len(n)), n)[: len(h1)]
                here = _inside(at, size, len(h1)) & ((n[row] == size) if size < length else True)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(row[here])), pa.array(np.full(here.sum(), size, np.int32))]
                    + [numeric.longs(x[here]) for x in (prints, h1, h2)],
                    names=["item_id", "size", "print", "h1", "h2"],
                )


def _candidates(batches: Iterator[pa.RecordBatch], length: int, sizes: list[int], made: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Each document's number of words, and its windows whose fingerprint is in the bitmap."""
    split = _Words()
    for batch in batches:
        for first, at, words in split(batch.column("text")):
            found = []
            for size in sizes:
                prints, h1, h2 = _windows(words, size, length)
                place = np.flatnonzero(_inside(at, size, len(h1)) & in_bitmap(prints, made))
                found.append((place, np.full(len(place), size), h1[place].view(np.int64), h2[place].view(np.int64)))
            place, size, h1, h2 = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 4
            row = np.searchsorted(at, place, "right") - 1
            order = np.argsort(row, kind="stable")
            struct = pa.StructArray.from_arrays(
                [pa.array((place - at[row])[order], pa.int32()), pa.array(size[order], pa.int32()), pa.array(h1[order]), pa.array(h2[order])],
                names=["at", "size", "h1", "h2"],
            )
            rows = len(at) - 1
            hits = numeric.lists(np.bincount(row, minlength=rows), struct)
            kept = [batch.column(c).slice(first, rows) for c in ("doc_id", *KEY)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(np.diff(at), pa.int64()), hits], names=["doc_id", *KEY, "n_words", "hits"])


def find_contamination(docs: DataFrame, benchmark: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per document: doc_id, its key, n_words, n_hit, items and `spans`.

    Words are runs of ASCII letters and digits and of all non-ASCII characters, A-Z in lower
    case. A word is hit inside any occurrence of a window of an item; `spans` are the hit
    windows as (first word, words). `items` are the ids of items with an occurring window; an
    item without an id hits but is not among them. Missing or empty texts have no words and
    items without words no window; repeated rows each get the result; other columns are left out.
    """
    if length < K:
        raise ValueError(f"windows need {K} words or more")
    items = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = benchmark.schema["item_id"].dataType.simpleString()
    windows = scratch_table(
        items.mapInArrow(partial(_item_windows, length=length), f"item_id {kind}, size int, print long, h1 long, h2 long").distinct(),
        "item-windows",
    )
    sizes = [r["size"] for r in windows.select("size").distinct().orderBy("size").collect()]
    made = docs.sparkSession.sparkContext.broadcast(bitmap(windows, "print", BITMAP_BITS))

    def scan(batches):
        return _candidates(batches, length, sizes, made.value)

    scanned = scratch_table(
        with_key(docs).mapInArrow(scan, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, _no_id boolean, _id long, _text_hash long, n_words long, hits array<struct<{HIT.replace(' ', ':').replace(',:', ',')}>>"),
        "document-windows",
    )
    placed = (
        scanned.select(*KEY, F.inline("hits"))
        .join(windows.select("item_id", "size", "h1", "h2"), ["size", "h1", "h2"])
        .groupBy(*KEY)
        .agg(F.array_sort(F.collect_set(F.struct("at", "size"))).alias("spans"), F.collect_set("item_id").alias("items"))
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("until"), F.lit(0).cast("long").alias("n")),
        lambda acc, s: F.struct(
            F.greatest(acc["until"], s["at"] + s["size"]).alias("until"),
            (acc["n"] + F.greatest(F.lit(0), s["at"] + s["size"] - F.greatest(acc["until"], s["at"]))).alias("n"),
        ),
        lambda acc: acc["n"],
    )
    none = F.array().cast(f"array<{kind}>")
    return (
        scanned.select("doc_id", *KEY, "n_words")
        .join(placed.withColumn("n_hit", covered), KEY, "left")
        .select(
            "doc_id",
            *KEY,
            "n_words",
            F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce("items", none).alias("items"),
            F.coalesce("spans", F.array().cast("array<struct<at:int,size:int>>")).alias("spans"),
        )
    )
