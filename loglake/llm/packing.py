"""Best-fit decreasing packing of token pieces into sequences of a fixed length.

Texts become token ids in parallel, are cut into pieces of at most `capacity`, and stored
with their number among the pieces of their length, first within their task, then (by the
counts of the tasks before) in the corpus. Packing itself needs only how many pieces of each
length there are, at most `capacity` counts however large the corpus: pieces of a length are
alike. Best-fit decreasing takes lengths from long to short and finds the open sequence with
the least room that suffices by a segment tree over remaining room; all pieces that go the
same way move as one range. Every piece then finds its place from its number.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loglake.llm.tokens import PieceEncoder
from loglake.sources.tables import scratch_table

CAPACITY = 1024
END_ID = 2
PIECES = "doc_id {kind}, piece int, start long, length int, ids binary, ids_crc32 long, part int, number long"


class Room:
    """Which amounts of room open sequences have, as a segment tree over 0..capacity."""

    def __init__(self, capacity: int) -> None:
        self.leaves = 1 << capacity.bit_length()
        self.used = np.zeros(2 * self.leaves, bool)

    def mark(self, room: int, there: bool) -> None:
        node = room + self.leaves
        self.used[node] = there
        while node > 1:
            node //= 2
            self.used[node] = self.used[2 * node] or self.used[2 * node + 1]

    def tightest(self, least: int) -> int | None:
        """The smallest amount of at least `least`, in logarithmic time."""
        node = least + self.leaves
        if self.used[node]:
            return least
        while node > 1:
            if node % 2 == 0 and self.used[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.used[2 * node] else 2 * node + 1
                return node - self.leaves
            node //= 2
        return None


class Placed(NamedTuple):
    """Pieces `number` .. `number + count - 1` of a length: `each` to a sequence, side by side."""

    length: int
    number: int
    count: int
    sequence: int
    each: int
    offset: int


def best_fit_decreasing(counts: dict[int, int], capacity: int = CAPACITY) -> list[Placed]:
    """Where the pieces go, for counts of pieces by length; alike pieces move as ranges.

    Into the tightest sequence a piece of the same length follows at once while it fits,
    for that sequence is then tighter still. So a range takes room // length of them each.
    """
    room, open_ranges = Room(capacity), {}
    placed: list[Placed] = []
    sequences = 0

    def add(left: int, first: int, count: int) -> None:
        if left and count:
            open_ranges.setdefault(left, []).append((first, count))
            room.mark(left, True)

    for length in sorted(counts, reverse=True):
        number, rest = 0, counts[length]
        while rest:
            left = room.tightest(length)
            if left is None:
                left, first, there = capacity, sequences, -(-rest // (capacity // length))
                sequences += there
            else:
                first, there = open_ranges[left].pop()
                if not open_ranges[left]:
                    room.mark(left, False)
            each = left // length
            full = min(there, rest // each)
            if full:
                placed.append(Placed(length, number, full * each, first, each, capacity - left))
                add(left - each * length, first, full)
                number, rest = number + full * each, rest - full * each
            some = rest if full < there else 0
            if some:  # fewer than one sequence takes
                placed.append(Placed(length, number, some, first + full, each, capacity - left))
                add(left - some * length, first + full, 1)
                number, rest = number + some, 0
            add(left, first + full + bool(some), there - full - bool(some))
    return placed


def cut_points(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, start and length of the pieces of documents; the first piece takes the rest."""
    pieces = -(-sizes // capacity)
    doc = np.repeat(np.arange(len(sizes)), pieces)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = (sizes - capacity * (pieces - 1))[doc]
    start = np.where(piece == 0, 0, first + (piece - 1) * capacity)
    return doc, start, np.where(piece == 0, first, capacity)


def _tokenize(batches: Iterator[pa.RecordBatch], ranks: bytes, capacity: int) -> Iterator[pa.RecordBatch]:
    part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
    encoder = None
    for batch in batches:
        encoder = encoder or PieceEncoder(ranks)
        for first, ids, bounds in encoder(batch.column("text")):
            ids = np.insert(ids.astype("<u4"), bounds[1:], END_ID)
            ends = bounds[1:] + np.arange(1, len(bounds))
            doc, start, length = cut_points(np.diff(np.concatenate(([0], ends))), capacity)
            begins = np.concatenate(([0], np.cumsum(length)))
            order = np.argsort(length, kind="stable")
            ranked = length[order]
            number = np.empty(len(length), np.int64)
            number[order] = np.arange(len(length)) - np.searchsorted(ranked, ranked) + seen[ranked]
            np.add.at(seen, length, 1)
            raw = pa.Array.from_buffers(
                pa.binary(), len(length), [None, pa.py_buffer((begins * 4).astype(np.int32).tobytes()), pa.py_buffer(ids.tobytes())]
            )
            sums = [zlib.crc32(x.as_buffer()) for x in raw]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(first, len(bounds) - 1).take(pa.array(doc)),
                    pa.array(np.where(start == 0, 0, -(-start // capacity)).astype(np.int32)),
                    pa.array(start),
                    pa.array(length.astype(np.int32)),
                    raw,
                    pa.array(sums, pa.int64()),
                    pa.array(np.full(len(length), part, np.int32)),
                    pa.array(number),
                ],
                names=["doc_id", "piece", "start", "length", "ids", "ids_crc32", "part", "number"],
            )


def pack_documents(docs: DataFrame, ranks_path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids, ids_crc32, sequence_id, offset.

    `ids` are little-endian unsigned 32-bit ids: those of the text, then the end id. Only
    documents of more than `capacity` ids are cut, into pieces of that length, of which the
    first may be shorter. A missing text is empty: the end id alone. Repeated rows are packed
    each for itself; other columns are left out. `ranks_path` is a file of base64 tokens and
    their ids on the driver (default: the public 50k byte-level vocabulary).
    """
    with open(ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = docs.sparkSession.sparkContext.broadcast(file.read())

    def tokenize(batches):
        return _tokenize(batches, ranks.value, capacity)

    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    pieces = scratch_table(texts.mapInArrow(tokenize, PIECES.format(kind=kind)), "pieces")
    by_part = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    by_part = scratch_table(
        by_part.select("length", "part", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")), "piece-counts"
    )
    counts = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    ranges = docs.sparkSession.createDataFrame(
        best_fit_decreasing(counts, capacity) or [Placed(1, 0, 0, 0, 1, 0)],
        "length int, first long, count long, sequence long, each int, offset int",
    )
    ranges = ranges.groupBy("length").agg(F.sort_array(F.collect_list(F.struct("first", "count", "sequence", "each", "offset"))).alias("ranges"))
    place = F.col("_number") - F.col("_range.first")
    return (
        pieces.join(by_part.drop("n"), ["length", "part"])
        .withColumn("_number", F.col("number") + F.col("before"))
        .join(F.broadcast(ranges), "length")  # a row per length at most
        .withColumn(
            "_range",
            F.element_at(F.filter("ranges", lambda r: (r["first"] <= F.col("_number")) & (F.col("_number") < r["first"] + r["count"])), 1),
        )
        .select(
            "doc_id",
            "piece",
            "start",
            F.col("length").cast("long").alias("length"),
            "ids",
            "ids_crc32",
            (F.col("_range.sequence") + F.floor(place / F.col("_range.each"))).alias("sequence_id"),
            (F.col("_range.offset") + F.pmod(place, F.col("_range.each")) * F.col("length")).cast("long").alias("offset"),
        )
    )
