"""Byte-level BPE by corpus-level merge replay, and its inverse.

Texts of a task are cut into pieces by the vocabulary's pattern. The distinct pieces of a
stretch of the corpus lie side by side in one array of tokens, at first a token per byte. An
inverted index has, for each rank of a merge, the places of the pairs that it would join.
Merges are applied in rank order, each to all its places at once; only the pairs to the left and
right of a place are looked up anew. At the end every occurrence of a piece takes its ids.

A piece that is itself a token is that token, whatever merges would make of it, as in the
library whose ids these are.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from loglake.llm import numeric
from loglake.llm.keys import plain
from loglake.llm.tokens import LETTER, NUMBER, OTHER, SPACE, piece_starts

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Bytes of text whose pieces are encoded together; a longer text comes alone.
CORPUS = 1 << 23
NONE = np.iinfo(np.int32).max


class Vocabulary:
    """Tokens by id, and which token two neighbours make."""

    def __init__(self, lines: bytes) -> None:
        """`lines`: a token in base64 and its id each. Every single byte must be a token."""
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.splitlines())}
        missing = [b for b in range(256) if bytes([b]) not in self.ranks]
        if missing:
            raise ValueError(f"bytes that are no tokens: {missing}")
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        sizes = np.zeros(max(self.ranks.values()) + 1, np.int64)
        for token, rank in self.ranks.items():
            sizes[rank] = len(token)
        self.sizes, self.starts = sizes, np.cumsum(sizes) - sizes
        by_rank = sorted((rank, token) for token, rank in self.ranks.items())
        self.bytes = np.frombuffer(b"".join(token for _, token in by_rank), np.uint8)

    @cached_property
    def kinds(self) -> _Kinds:
        return _Kinds(self.ranks)

    @cached_property
    def merges(self) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of tokens that make a token, in order, and its rank; the last is none."""
        ranks = self.ranks
        halves = ((t[:i], t[i:], rank) for t, rank in ranks.items() for i in range(1, len(t)))
        pairs = sorted((ranks[a] << 32 | ranks[b], rank) for a, b, rank in halves if a in ranks and b in ranks)
        return np.array([p for p, _ in pairs] + [np.iinfo(np.int64).max], np.int64), np.array([r for _, r in pairs] + [NONE], np.int32)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of neighbours, NONE where there is none."""
        pairs, made = self.merges
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        at = np.searchsorted(pairs, keys)
        return np.where(pairs[at] == keys, made[at], NONE)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the tokens, one after the other, and where each begins and the last ends."""
        sizes = self.sizes[ids]
        begins = np.concatenate(([0], np.cumsum(sizes)))
        return self.bytes[np.arange(begins[-1]) + np.repeat(self.starts[ids] - begins[:-1], sizes)], begins


class _Kinds:
    """Class of a code point as the library's own patterns have it, asked when first seen."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.table = np.zeros(0x110000, np.uint8)
        self.matches = {
            kind: tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
            for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s"))
        }

    def __call__(self, points: np.ndarray) -> np.ndarray:
        found = self.table[points]
        if not found.all():
            for point in np.unique(points[found == 0]):
                one = chr(point)
                self.table[point] = next((k for k, matches in self.matches.items() if matches(one)), OTHER)
            found = self.table[points]
        return found


def _leftmost(where: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of places in order, those to merge: of places that follow each other every second one."""
    chained = np.concatenate(([False], after[where[:-1]] == where[1:]))
    if not chained.any():
        return where
    at = np.arange(len(where))
    return where[(at - np.maximum.accumulate(np.where(chained, 0, at))) % 2 == 0]


def replay(vocabulary: Vocabulary, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pieces, one after the other, and where each piece's begin and the last's end.

    In every piece the pair of least rank is merged next, the leftmost of several. Pieces do
    not touch each other, so a merge is applied to all pieces at once, unless one of its
    places makes a pair that comes before it; then the piece goes on with that first.
    """
    size = len(data)
    token = np.concatenate((vocabulary.single[data], [-1]))  # the last is the end of all pieces
    piece = np.repeat(np.arange(len(bounds) - 1, dtype=np.int32), np.diff(bounds))
    after, before = np.arange(1, size + 2), np.arange(-1, size)
    after[bounds[1:][np.diff(bounds) > 0] - 1] = size
    before[bounds[:-1]] = size
    before = np.append(before, size)[: size + 1]
    ranks = vocabulary.rank(token[:-1], token[after[:-1]]) if size else np.zeros(0, np.int32)
    ranks = np.append(ranks, NONE).astype(np.int32)
    ranks[token < 0] = NONE

    index: dict[int, list[np.ndarray]] = {}
    queue: list[int] = []

    def enter(values: np.ndarray, places: np.ndarray) -> None:
        there = values != NONE
        if not there.any():
            return
        values, places = values[there], places[there]
        order = np.argsort(values, kind="stable")
        values, places = values[order], places[order]
        cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
        for rank, part in zip(values[np.concatenate(([0], cuts))].tolist(), np.split(places, cuts), strict=True):
            if rank not in index:
                index[rank] = []
                heapq.heappush(queue, rank)
            index[rank].append(part)

    enter(ranks[:-1], np.arange(size))
    while queue:
        rank = heapq.heappop(queue)
        parts = index.pop(rank)
        where = np.unique(np.concatenate(parts)) if len(parts) > 1 else parts[0]
        where = where[ranks[where] == rank]
        if not len(where):
            continue
        where = _leftmost(where, after)
        middle, left = after[where], before[where]
        right = after[middle]
        # What stands left of a place once those before it are merged.
        lefts = token[left]
        lefts[1:][left[1:] == middle[:-1]] = rank
        made = np.full(len(where), rank, np.int32)
        early = (vocabulary.rank(lefts, made) < rank) | (vocabulary.rank(made, token[right]) < rank)
        if early.any():
            own = piece[where]
            first = np.concatenate(([True], own[1:] != own[:-1]))
            now = first | ~np.isin(own, own[early])
            enter(made[~now], where[~now])
            where, middle, left, right = where[now], middle[now], left[now], right[now]
        token[where] = rank
        token[middle] = -1
        ranks[middle] = NONE
        after[where] = right
        before[right] = where
        ranks[where] = vocabulary.rank(token[where], token[after[where]])
        left = before[where]
        left = left[left < size]
        ranks[left] = vocabulary.rank(token[left], token[after[left]])
        touched = np.concatenate((where, left))
        enter(ranks[touched], touched)
    alive = np.flatnonzero(token[:-1] >= 0)
    return token[alive], np.searchsorted(alive, bounds)


class CorpusEncoder:
    """Ids of the texts of batches, a stretch of the corpus at a time."""

    def __init__(self, vocabulary: Vocabulary, corpus: int = CORPUS) -> None:
        self.vocabulary, self.corpus = vocabulary, corpus

    def _pieces(self, data: np.ndarray, bounds: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray]:
        """The pieces of some texts, and how many come before each text."""
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        begins = np.flatnonzero((data & 0xC0) != 0x80)
        starts = np.zeros(0, np.int64)
        if len(points):
            starts = begins[piece_starts(points, self.vocabulary.kinds(points), np.searchsorted(begins, bounds)[:-1])]
        offsets = np.append(starts, len(data)).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
        return pieces.dictionary_encode(), np.searchsorted(starts, bounds)

    def _ids(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pieces, one after the other, and how many each has."""
        ranks = self.vocabulary.ranks
        whole = np.array([ranks.get(p, -1) for p in distinct.to_pylist()], np.int32)
        others = distinct.take(pa.array(np.flatnonzero(whole < 0)))
        offsets = np.frombuffer(others.buffers()[1], np.int32)[others.offset : others.offset + len(others) + 1].astype(np.int64)
        data = np.frombuffer(others.buffers()[2], np.uint8) if others.buffers()[2] is not None else np.zeros(0, np.uint8)
        ids, bounds = replay(self.vocabulary, data[offsets[0] : offsets[-1]], offsets - offsets[0])
        sizes = np.ones(len(distinct), np.int64)
        sizes[whole < 0] = np.diff(bounds)
        result = np.empty(sizes.sum(), np.int32)
        inside = np.repeat(whole < 0, sizes)
        result[inside], result[~inside] = ids, whole[whole >= 0]
        return result, sizes

    def __call__(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, ids, bounds of the rows within the ids) for stretches of rows."""
        held, bytes_held = [], 0
        for first, _, data, bounds in numeric.stretches(texts):
            held.append((first, *self._pieces(data, bounds)))
            bytes_held += len(data)
            if bytes_held >= self.corpus:
                yield from self._flush(held)
                held, bytes_held = [], 0
        yield from self._flush(held)

    def _flush(self, held: list) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        if not held:
            return
        merged = pa.chunked_array([pieces for _, pieces, _ in held]).unify_dictionaries()
        ids, sizes = self._ids(merged.chunk(merged.num_chunks - 1).dictionary if merged.num_chunks else pa.array([], pa.binary()))
        starts = np.cumsum(sizes) - sizes
        for (first, _, rows), pieces in zip(held, merged.chunks, strict=True):
            codes = pieces.indices.to_numpy()
            each = sizes[codes]
            begins = np.concatenate(([0], np.cumsum(each)))
            yield first, ids[np.arange(begins[-1]) + np.repeat(starts[codes] - begins[:-1], each)], begins[rows]


@lru_cache(maxsize=1)
def _vocabulary(lines: bytes) -> Vocabulary:
    """Made once in a Python worker."""
    return Vocabulary(lines)


def _shared_lines(df: DataFrame, ranks_path: str | None):
    with open(ranks_path or public_tokenizers.path(VOCABULARY), "rb") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def encode_texts(docs: DataFrame, ranks_path: str | None = None, corpus: int = CORPUS) -> DataFrame:
    """Plain columns of documents but `text`, and `_ids`, an array of the ids of the whole text.

    Each match of the vocabulary's pattern is encoded by itself; special tokens are ordinary
    text. A missing or empty text has no ids. Repeated rows and missing or repeated ids are
    encoded each for itself, and a text of any length as a whole. Nothing is shuffled.
    `ranks_path` is a file of base64 tokens and ids on the driver (some 1 MB, sent to all tasks).
    """
    lines = _shared_lines(docs, ranks_path)
    columns = [c for c in plain(docs).columns if c != "text"]
    schema = docs.select(*(f"`{c}`" for c in columns)).schema.add("_ids", T.ArrayType(T.IntegerType()))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = CorpusEncoder(_vocabulary(lines.value), corpus)
        for batch in batches:
            for first, ids, bounds in encoder(pc.fill_null(batch.column("text"), "")):
                rows = batch.slice(first, len(bounds) - 1)
                lists = numeric.lists(np.diff(bounds), pa.array(ids))
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in columns), lists], names=schema.names)

    return plain(docs).mapInArrow(encode, schema)


def decode_ids(encoded: DataFrame, ranks_path: str | None = None) -> DataFrame:
    """All columns but `_ids`, and `_bytes`, what the ids stand for one after the other.

    Bytes, for ids cut at any place need not be whole characters. No or missing ids are
    no bytes. An id that the vocabulary does not have stops the query.
    """
    lines = _shared_lines(encoded, ranks_path)
    columns = [c for c in encoded.columns if c != "_ids"]
    schema = encoded.drop("_ids").schema.add("_bytes", "binary")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(lines.value)
        for batch in batches:
            column = batch.column("_ids")
            rows = 0
            while rows < batch.num_rows:  # so many rows that their ids are no more than a stretch
                some = column.slice(rows)
                counts = np.cumsum(pc.fill_null(pc.list_value_length(some), 0).to_numpy(zero_copy_only=False))
                end = rows + max(1, int(np.searchsorted(counts, numeric.STRETCH, "right")))
                part = column.slice(rows, end - rows)
                sizes = pc.fill_null(pc.list_value_length(part), 0).to_numpy(zero_copy_only=False)
                ids = part.flatten().to_numpy(zero_copy_only=False)
                if len(ids) and (ids.min() < 0 or ids.max() >= len(vocabulary.sizes) or not vocabulary.sizes[ids].all()):
                    raise ValueError("an id that is not in the vocabulary")
                data, begins = vocabulary.decode(ids)
                offsets = begins[np.concatenate(([0], np.cumsum(sizes)))].astype(np.int32)
                texts = pa.Array.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(rows, len(part)) for c in columns), texts], names=schema.names)
                rows = end

    return encoded.mapInArrow(decode, schema)
