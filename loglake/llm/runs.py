"""Periodic runs of words, by Kruskal over common prefixes in descending length.

The suffixes of a text that share a prefix of l words are a class. With l falling from the
longest common prefix of neighbouring suffixes, classes are united by union-find; each keeps
the ordered set of its places. Two places that become neighbours in such a set at a distance of
q <= l mark a stretch that repeats itself every q words, l + q words long; it is a run if the word
before does not go on with it. The distance is the smallest period: places of a smaller one would
lie between them and were united before.

Only runs of `least` words and `times` periods count, so pairs of suffixes with a prefix too short
for any of them are not sorted at all.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F, types as T

from loglake.llm import numeric
from loglake.llm.keys import plain

LEAST = 6
TIMES = 4
#: Bytes between words: the blank, and tab to carriage return.
BLANKS = ((0x20, 0x20), (0x09, 0x0D))
RUNS = T.ArrayType(T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")]))


def _word_codes(data: np.ndarray, inside: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Equal numbers for equal words."""
    offsets = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
    return words.dictionary_encode().indices.to_numpy().astype(np.int64)


def _suffixes(codes: np.ndarray, text: np.ndarray, end: np.ndarray, prefix: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffixes of all texts in order, and by power of two the class of each one's first words.

    Prefix doubling: what is not alone in its class is sorted by its class and that of the suffix
    2**k words on. A class is numbered by its first place in the order, so that one which has
    become single keeps its number. `prefix` is the length from which common prefixes matter:
    classes are refined only while there are some of two suffixes or more. Texts never share
    classes, and a suffix shorter than 2**k is in one of its own.
    """
    size = len(codes)
    order = np.lexsort((codes, text))
    changed = (codes[order][1:] != codes[order][:-1]) | (text[order][1:] != text[order][:-1])
    begins = np.concatenate(([True], changed))
    rank = np.empty(size + 1, np.int64)
    rank[order] = np.maximum.accumulate(np.where(begins, np.arange(size), 0))
    rank[size] = -1
    levels, width = [rank.copy()], 1
    while True:
        sizes = np.bincount(rank[:size], minlength=size)
        open_ = np.flatnonzero(sizes[rank[order]] > 1)  # places in the order
        if not len(open_):
            return order, levels
        members = order[open_]
        ahead = members + width
        second = rank[np.where(ahead < end[members], ahead, size)]
        sort = np.lexsort((second, rank[members]))
        members, second = members[sort], second[sort]
        own = rank[members]
        order[open_] = members
        # The end of a text differs from all words, its own end included: it has no second class.
        fresh = np.concatenate(([True], (own[1:] != own[:-1]) | (second[1:] != second[:-1]) | (second[1:] < 0)))
        rank[members] = np.maximum.accumulate(np.where(fresh, open_, 0))
        width *= 2
        levels.append(rank.copy())


def _common(order: np.ndarray, levels: list[np.ndarray], prefix: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbouring suffixes in the order with a common prefix of `prefix` words or more, and its length."""
    sure = min(prefix.bit_length() - 1, len(levels) - 1)
    ranks = levels[sure][order]
    at = np.flatnonzero(ranks[1:] == ranks[:-1])
    a, b = order[at], order[at + 1]
    length, open_ = np.zeros(len(at), np.int64), np.ones(len(at), bool)
    last = len(levels[0]) - 1
    for k in range(len(levels) - 1, -1, -1):
        x, y = np.minimum(a + length, last), np.minimum(b + length, last)
        same = open_ & (levels[k][x] == levels[k][y]) & (x < last) & (y < last)
        length += same.astype(np.int64) << k
    enough = length >= prefix
    return a[enough], b[enough], length[enough]


def _kruskal(a: np.ndarray, b: np.ndarray, length: np.ndarray, times: int, least: int) -> list[tuple[int, int, int]]:
    """(place, distance, common prefix) of places that become neighbours close enough for a run."""
    order = np.argsort(-length, kind="stable")
    root: dict[int, int] = {}
    places: dict[int, list[int]] = {}
    found: list[tuple[int, int, int]] = []

    def find(x: int) -> int:
        top = root.setdefault(x, x)
        while root[top] != top:
            top = root[top]
        while root[x] != top:
            root[x], x = top, root[x]
        return top

    for x, y, common in zip(a[order].tolist(), b[order].tolist(), length[order].tolist(), strict=True):
        x, y = find(x), find(y)
        large, small = places.get(x) or [x], places.get(y) or [y]
        if len(large) < len(small):
            x, y, large, small = y, x, small, large
        root[y] = x
        places.pop(y, None)
        places[x] = large
        for p in small:
            insort(large, p)
        new = set(small) if len(small) > 1 else ()
        most = common // (times - 1)
        for p in small:
            i = bisect_left(large, p)
            if i and large[i - 1] not in new and p - large[i - 1] <= most and common + p - large[i - 1] >= least:
                found.append((large[i - 1], p - large[i - 1], common))
            if i + 1 < len(large) and large[i + 1] not in new and large[i + 1] - p <= most and common + large[i + 1] - p >= least:
                found.append((p, large[i + 1] - p, common))
    return found


def find_runs(codes: np.ndarray, bounds: np.ndarray, least: int = LEAST, times: int = TIMES) -> tuple[np.ndarray, ...]:
    """(text, start, length, period) of all runs of texts of word codes, by text, start and period.

    Starts are numbers of words within the text. `bounds` are those of texts within the codes.
    """
    if times < 2:
        raise ValueError("a run has two periods at least")
    none = (np.zeros(0, np.int64),) * 4
    if not len(codes):
        return none
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    # A run of `least` words and `times` periods of q: its first two places share at least this many words.
    prefix = max(1, min(max(least - q, (times - 1) * q) for q in range(1, least + 1)))
    order, levels = _suffixes(codes, text, bounds[1:][text], prefix)
    seeds = _kruskal(*_common(order, levels, prefix), times, least)
    if not seeds:
        return none
    place, period, common = np.array(seeds, np.int64).T
    own = text[place]
    before = place - 1
    goes_on = (place > bounds[own]) & (codes[before] == codes[before + period])
    own, start, length, period = (x[~goes_on] for x in (own, place - bounds[own], common + period, period))
    order = np.lexsort((period, start, own))
    return own[order], start[order], length[order], period[order]


def _collapsed(data: np.ndarray, bounds: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray, kept: np.ndarray) -> pa.Array:
    """The kept words of each text joined by one blank."""
    starts, ends = starts[kept], ends[kept]
    row = np.searchsorted(rows, np.flatnonzero(kept), "right") - 1
    follows = np.zeros(len(row), bool)
    follows[1:] = row[1:] == row[:-1]
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts] += 1
    inside[ends] -= 1
    mask = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    gaps = starts[follows] - 1  # never inside a word: a word follows white space
    mask[gaps] = True
    made = data.copy()
    made[gaps] = 0x20
    offsets = np.concatenate(([0], np.cumsum(mask)))[bounds].astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(made[mask])])


def _collapse(batches: Iterator[pa.RecordBatch], columns: list[str], least: int, times: int) -> Iterator[pa.RecordBatch]:
    word = numeric.class_table(*BLANKS)
    for batch in batches:
        for first, end, data, bounds in numeric.stretches(batch.column("_text")):
            inside = word[data]
            starts, ends = numeric.runs(inside, bounds)
            rows = np.searchsorted(starts, bounds)
            found, start, length, period = find_runs(_word_codes(data, inside, starts, ends), rows, least, times)
            depth = np.zeros(len(starts) + 1, np.int32)
            np.add.at(depth, rows[found] + start + period, 1)
            np.add.at(depth, rows[found] + start + length, -1)
            kept = np.cumsum(depth[:-1]) == 0
            structs = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], names=["start", "length", "period"])
            count = len(bounds) - 1
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c).slice(first, end - first) for c in columns),
                    pa.array(np.diff(rows)),
                    numeric.lists(np.bincount(found, minlength=count), structs),
                    _collapsed(data, bounds, starts, ends, rows, kept),
                ],
                names=[*columns, "_n_words", "_runs", "_collapsed"],
            )


def collapse_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """Plain columns of documents but `text`, `_n_words`, `_runs` and `_collapsed`.

    A run is a stretch of consecutive words with smallest period q (words q apart are equal), of
    `least` words and `times` periods at least, that no neighbouring word extends; `_runs` has
    them by start (word number from 0), then period. `_collapsed` is the text without the words
    that any run contains after its first q, words joined by one blank. Words are what white
    space of ASCII leaves. A missing text is empty: no words, no runs, an empty collapsed text.
    Repeated rows and missing ids are taken each for itself, texts as a whole whatever their
    length. Nothing is shuffled.
    """
    columns = [c for c in plain(docs).columns if c != "text"]
    schema = docs.select(*(f"`{c}`" for c in columns)).schema
    schema = schema.add("_n_words", "long").add("_runs", RUNS).add("_collapsed", "string")

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _collapse(batches, columns, least, times)

    texts = docs.select(*(F.col(f"`{c}`") for c in columns), F.coalesce("text", F.lit("")).alias("_text"))
    return texts.mapInArrow(collapse, schema)
