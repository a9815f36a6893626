"""Byte-level BPE ids of many texts at once, equal to those of the tokenizer's own library.

The pattern that cuts texts into pieces is applied to whole stretches of text as arrays of
code points; each distinct piece is looked up by a 64-bit hash in a table of pieces seen, and
only new ones are encoded by the library.
"""

from __future__ import annotations

import base64
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken

from loglake.llm import numeric

LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 4
SLOTS = 1 << 20
#: The pattern of the vocabulary, and the endings that it splits off.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
#: White space as Unicode's property of that name has it.
WHITE_SPACE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)


class _Classes:
    """Class of a code point, worked out when first seen."""

    def __init__(self) -> None:
        self.table = np.zeros(0x110000, np.uint8)

    def __call__(self, points: np.ndarray) -> np.ndarray:
        found = self.table[points]
        for point in np.unique(points[found == 0]):
            general = unicodedata.category(chr(point))[0]
            self.table[point] = SPACE if point in WHITE_SPACE else {"L": LETTER, "N": NUMBER}.get(general, OTHER)
        return self.table[points]


def piece_starts(points: np.ndarray, kinds: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where the pieces of PATTERN begin in rows of code points, given their classes.

    A piece is a run of one class, with the one blank before it. White space before
    something else leaves its last character: as that blank, or as a piece of its own.
    An apostrophe that begins a piece takes an ending in ENDINGS from the letters behind it.
    """
    size = len(points)
    first = np.zeros(size + 1, bool)
    first[bounds] = True
    first = first[:size]
    start = first.copy()
    start[1:] |= kinds[1:] != kinds[:-1]
    space = kinds == SPACE
    # Last of a run of white space with something behind it in the same row.
    last = np.zeros(size, bool)
    last[:-1] = space[:-1] & ~space[1:] & ~first[1:]
    start |= last
    blank = last & (points == 0x20)
    after = np.flatnonzero(blank) + 1
    start[after] = False
    quote = np.flatnonzero((points == 0x27) & start)
    if len(quote):
        for ending in ENDINGS:
            here = quote[quote + len(ending) < size]
            fits = start[here + 1] & ~first[here + 1]
            for j, letter in enumerate(ending, 1):
                fits &= (points[here + j] == ord(letter)) & ~first[here + j]
            here = here[fits]
            start[here + 1] = False
            end = here + 1 + len(ending)
            end = end[end < size]
            start[end] = True
    return np.flatnonzero(start)


class PieceEncoder:
    """Ids of the texts of a batch."""

    def __init__(self, ranks: bytes) -> None:
        """`ranks`: lines of a token in base64 and its id."""
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.encode = tiktoken.Encoding("pieces", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.classes, self.hash = _Classes(), numeric.SpanHash()
        self._forget()

    def _forget(self) -> None:
        self.keys, self.at, self.sizes = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.int64), np.zeros(SLOTS, np.int64)
        self.pool, self.used = np.zeros(1 << 20, np.uint16), 0

    def _learn(self, slots: np.ndarray, keys: np.ndarray, texts: list[str]) -> None:
        for slot, key, text in zip(slots, keys, texts, strict=True):
            ids = self.encode(text)
            if self.used + len(ids) > len(self.pool):
                self.pool = np.concatenate((self.pool, np.zeros(max(len(self.pool), len(ids)), np.uint16)))
            self.pool[self.used : self.used + len(ids)] = ids
            self.keys[slot], self.at[slot], self.sizes[slot] = key, self.used, len(ids)
            self.used += len(ids)

    def __call__(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, ids, bounds of rows within the ids) for stretches of rows."""
        for first, _, data, bounds in numeric.stretches(texts):
            points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
            begins = np.flatnonzero((data & 0xC0) != 0x80)
            row_points = np.searchsorted(begins, bounds)
            if not len(points):
                yield first, np.zeros(0, np.uint16), np.zeros(len(bounds), np.int64)
                continue
            starts = piece_starts(points, self.classes(points), row_points[:-1])
            starts, ends = begins[starts], begins[np.append(starts[1:], 0)]
            ends[-1] = len(data)
            at, sizes, ids = self._ids(data, starts, ends)
            total = np.concatenate(([0], np.cumsum(sizes)))
            yield first, ids, total[np.searchsorted(starts, bounds)]

    def _ids(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.used > 1 << 24:
            self._forget()
        keys = self.hash(data, starts, ends)
        slots = (keys >> np.uint64(44)).astype(np.int64) & (SLOTS - 1)
        at, sizes = np.empty(len(keys), np.int64), np.empty(len(keys), np.int64)
        todo = np.arange(len(keys))
        while len(todo):  # pieces that share a slot take turns
            slot, key = slots[todo], keys[todo]
            known = self.keys[slot] == key
            at[todo[known]], sizes[todo[known]] = self.at[slot[known]], self.sizes[slot[known]]
            todo = todo[~known]
            if len(todo):
                _, one = np.unique(slots[todo], return_index=True)
                new = todo[one]
                raw = data.tobytes() if len(new) > 64 else None
                words = [(raw[s:e] if raw else data[s:e].tobytes()).decode() for s, e in zip(starts[new], ends[new], strict=True)]
                self._learn(slots[new], keys[new], words)
        offsets = np.concatenate(([0], np.cumsum(sizes)))
        index = np.arange(offsets[-1]) + np.repeat(at - offsets[:-1], sizes)
        return at, sizes, self.pool[index]
