"""Phrases whose words belong together, from exact counts of all phrases that are frequent.

A phrase of k + 1 words is a pair of phrases of k words, one a word further on. Level by level
tasks count the pairs of frequent phrases in their texts. The most frequent phrases of a level
have ids by frequency: their pairs fall in square tiles of ids, and a tile with many pairs is
counted by direct address. Pairs of tiles with few, and of rarer phrases, are sorted and counted.
The sums over all tasks are exact; those that are frequent are ranked anew as the next level's
words.

What tasks get to know of a level has a bound: its head of HEAD phrases, and a bitmap of all
frequent ones, which may let others pass. These are then counted for nothing, no more.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loglake.llm import numeric
from loglake.llm.bloom import bitmap, in_bitmap
from loglake.sources.tables import scratch_table

LONGEST = 4
LEAST = 30
#: A phrase goes if a longer one has this many per cent of its occurrences.
COVERED = 80
NO_LANGUAGE = "und"
#: Phrases with ids by frequency, and ids to a side of a tile.
HEAD = 1 << 14
TILE = 1 << 9
#: A tile is counted by direct address from this many pairs on: one for so many places.
PLACES_A_PAIR = 16
BITMAP_BITS = 25
#: Bytes of text whose pairs are counted together; a longer text comes alone.
CORPUS = 1 << 21
#: Rows of counts in a batch that leaves a task.
BATCH = 1 << 16
#: Parts in which the best of a language are chosen before they meet.
PARTS = 64
#: Bytes that end a piece, and those between words.
ENDS = (*b".,;:!?", *range(0x0A, 0x0E))
BLANKS = (0x20, 0x09)


class Level(NamedTuple):
    """What tasks know of the frequent phrases of a number of words."""

    size: int
    wanted: np.ndarray  # bitmap of the hashes
    languages: pa.Array  # of the head, by id
    phrases: pa.Array


class Words(NamedTuple):
    """The words of some texts: for each its language, code and hash; for each place if the next is of the same piece."""

    names: pa.Array
    languages: pa.Array
    language: np.ndarray
    code: np.ndarray
    hash: np.ndarray
    linked: np.ndarray


def _language_hash(languages: pa.Array) -> np.ndarray:
    raw = [x.encode() for x in languages.to_pylist()]
    bounds = np.concatenate(([0], np.cumsum([len(x) for x in raw]))).astype(np.int64)
    return numeric.SpanHash(1)(np.frombuffer(b"".join(raw), np.uint8), bounds[:-1], bounds[1:])


class _Cutter:
    def __init__(self) -> None:
        inside, ends = np.ones(256, bool), np.zeros(256, bool)
        inside[[*ENDS, *BLANKS]] = False
        ends[[*ENDS]] = True
        self.inside, self.ends, self.hash = inside, ends, numeric.SpanHash()

    def part(self, data: np.ndarray, bounds: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray]:
        """Words of some texts, row of each, and whether the next word is of the same piece."""
        data = numeric.LOWER[data]
        inside = self.inside[data]
        starts, ends = numeric.runs(inside, bounds)
        row = np.searchsorted(bounds, starts, "right") - 1
        piece = np.cumsum(self.ends[data])[starts] if len(starts) else starts
        linked = np.zeros(len(starts), bool)
        linked[:-1] = (piece[1:] == piece[:-1]) & (row[1:] == row[:-1])
        offsets = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int32)
        words = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
        return words.dictionary_encode(), row, linked

    def words(self, parts: list, languages: pa.Array, rows: list[np.ndarray]) -> Words:
        merged = pa.chunked_array([p for p, _, _ in parts]).unify_dictionaries()
        names = merged.chunk(0).dictionary
        code = np.concatenate([c.indices.to_numpy() for c in merged.chunks]).astype(np.int64)
        language = np.concatenate(rows)
        offsets = np.frombuffer(names.buffers()[1], np.int32)[names.offset : names.offset + len(names) + 1].astype(np.int64)
        raw = names.buffers()[2]
        raw = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
        hashes = self.hash(raw, offsets[:-1], offsets[1:])
        return Words(
            names, languages, language, code, numeric.mix(hashes[code] + _language_hash(languages)[language]), np.concatenate([x for _, _, x in parts])
        )


def _corpora(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    """The words of the texts of a task, so many texts at a time."""
    cutter = _Cutter()
    for batch in batches:
        coded = batch.column("lang").dictionary_encode()
        of_row = coded.indices.to_numpy()
        parts, rows, held = [], [], 0
        for first, end, data, bounds in numeric.stretches(batch.column("text")):
            parts.append(cutter.part(data, bounds))
            rows.append(of_row[first + parts[-1][1]])
            held += len(data)
            if held >= CORPUS or end == batch.num_rows:
                yield cutter.words(parts, coded.dictionary, rows)
                parts, rows, held = [], [], 0
                pa.default_memory_pool().release_unused()


def gram_hash(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the phrases of so many words, by the place of their first."""
    return words if size == 1 else numeric.gram_hash(words, size)


def _rows(languages: pa.Array, phrases: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([languages, phrases, pa.array(counts.astype(np.int64))], names=["lang", "phrase", "f"])


def _in_batches(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in found:
        for first in range(0, rows.num_rows, BATCH):
            yield rows.slice(first, BATCH)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of words by language; the empty phrase stands for all words."""
    for words in _corpora(batches):
        several = len(words.names)
        found, counts = np.unique(words.language * np.int64(several) + words.code, return_counts=True)
        language = found // max(several, 1)
        yield from _in_batches([_rows(words.languages.take(pa.array(language)), words.names.take(pa.array(found % max(several, 1))), counts)])
        total = np.bincount(language, counts, len(words.languages)).astype(np.int64)
        yield _rows(words.languages, pa.repeat("", len(total)), total)


class _PairCounter:
    """Pairs of frequent phrases of a level: tiles of the head, and what is sorted."""

    def __init__(self, level: Level) -> None:
        self.level = level
        words = [p.split(" ") for p in level.phrases.to_pylist()]
        self.flat = pa.array([w for p in words for w in p], pa.string())
        self.last = pa.array([p[-1] for p in words], pa.string())
        self.order = self.hashes = None
        if words:
            cutter = _Cutter()
            self.hashes = phrase_hashes(level.languages, level.phrases, level.size, cutter.hash)
            self.order = np.argsort(self.hashes)

    def _ids(self, words: Words, at: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Id of the phrase at each place, -1 for those not of the head. Hashes find it, codes of words confirm."""
        ids = np.full(len(at), -1, np.int64)
        if self.order is None or not len(at):
            return ids
        found = np.minimum(np.searchsorted(self.hashes, hashes, sorter=self.order), len(self.order) - 1)
        found = self.order[found]
        codes = pc.fill_null(pc.index_in(self.flat, value_set=words.names), -1).to_numpy().reshape(-1, self.level.size)
        own = pc.fill_null(pc.index_in(self.level.languages, value_set=words.languages), -1).to_numpy()
        same = own[found] == words.language[at]
        for j in range(self.level.size):
            same &= codes[found, j] == words.code[at + j]
        ids[same] = found[same]
        return ids

    def __call__(self, words: Words) -> Iterator[pa.RecordBatch]:
        size, total = self.level.size, len(words.code)
        if total <= size:
            return
        # Places of phrases that may be frequent, then those that another follows within the piece.
        whole = words.linked.copy()
        for j in range(1, size - 1):
            whole[:-j] &= words.linked[j:]
        last = total - size + 1
        there = np.ones(last, bool) if size == 1 else whole[:last].copy()
        hashes = gram_hash(words.hash, size)
        there[there] = in_bitmap(hashes[there], self.level.wanted)
        pair = there[:-1] & there[1:] & words.linked[size - 1 : total - 1]
        at = np.flatnonzero(pair)
        if not len(at):
            return
        ids = np.full(last, -1, np.int64)
        used = np.flatnonzero(there)
        ids[used] = self._ids(words, used, hashes[used])
        x, y = ids[at], ids[at + 1]
        both = (x >= 0) & (y >= 0)
        yield from self._tiles(x, y, both)
        yield from self._sorted(words, at[~both])

    def _tiles(self, x: np.ndarray, y: np.ndarray, both: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Counts of tiles with many pairs by direct address. Pairs of the others are left in `both` as false."""
        sides = -(-len(self.level.phrases) // TILE)
        places = np.flatnonzero(both)
        tile = x[places] // TILE * sides + y[places] // TILE
        pairs = np.bincount(tile, minlength=sides * sides)
        dense = pairs * PLACES_A_PAIR >= TILE * TILE
        both[places[~dense[tile]]] = False
        places, tile = places[dense[tile]], tile[dense[tile]]
        by_tile = np.argsort(tile, kind="stable")
        places, tile = places[by_tile], tile[by_tile]
        cuts = np.searchsorted(tile, np.flatnonzero(dense))
        for number, part in zip(np.flatnonzero(dense), np.split(places, cuts[1:]) if len(cuts) else [], strict=True):
            counts = np.bincount(x[part] % TILE * TILE + y[part] % TILE, minlength=TILE * TILE)
            cells = np.flatnonzero(counts)
            first = pa.array(number // sides * TILE + cells // TILE)
            second = pa.array(number % sides * TILE + cells % TILE)
            phrases = pc.binary_join_element_wise(self.level.phrases.take(first), self.last.take(second), " ")
            yield _rows(self.level.languages.take(first), phrases, counts[cells])

    def _sorted(self, words: Words, at: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Counts of the phrases of size + 1 words at these places, from sorted codes."""
        if not len(at):
            return
        several = len(words.names)
        key = words.language[at].astype(np.int64) * several + words.code[at]
        for j in range(1, self.level.size + 1):
            if j > 1:  # numbers of the phrases so far, for the next word to fit in
                key = np.unique(key, return_inverse=True)[1]
            key = key * several + words.code[at + j]
        _, one, counts = np.unique(key, return_index=True, return_counts=True)
        one = at[one]
        parts = [words.names.take(pa.array(words.code[one + j])) for j in range(self.level.size + 1)]
        yield _rows(words.languages.take(pa.array(words.language[one])), pc.binary_join_element_wise(*parts, " "), counts)


def phrase_hashes(languages: pa.Array, phrases: pa.Array, size: int, span_hash: numeric.SpanHash) -> np.ndarray:
    """The hashes that tasks give phrases of so many words in texts."""
    data, offsets = phrases.buffers()[2], np.frombuffer(phrases.buffers()[1], np.int32)[phrases.offset : phrases.offset + len(phrases) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    bounds = (offsets - offsets[0]).astype(np.int64)
    starts, ends = numeric.runs(data != 0x20, bounds)
    coded = languages.dictionary_encode()
    own = _language_hash(coded.dictionary)[coded.indices.to_numpy()]
    words = numeric.mix(span_hash(data, starts, ends) + np.repeat(own, size))
    return gram_hash(words, size)[::size]


def _hashed(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    span_hash = numeric.SpanHash()
    for batch in batches:
        if batch.num_rows:
            yield pa.RecordBatch.from_arrays([numeric.longs(phrase_hashes(batch.column("lang"), batch.column("phrase"), size, span_hash))], names=["hash"])


def _level(counts: DataFrame, size: int) -> Level:
    """Head and bitmap of the frequent phrases of a level: HEAD rows and 4 MB at most."""
    phrases = counts.where("phrase <> ''")
    hashes = phrases.select("lang", "phrase").mapInArrow(lambda b: _hashed(b, size), "hash long")
    head = phrases.orderBy(F.desc("f"), "lang", "phrase").limit(HEAD).toArrow()
    lang, phrase = (pa.concat_arrays([c.cast(pa.string()) for c in head[name].chunks] or [pa.array([], pa.string())]) for name in ("lang", "phrase"))
    return Level(size, bitmap(hashes, "hash", BITMAP_BITS), lang, phrase)


def frequent_phrases(docs: DataFrame, longest: int = LONGEST, least: int = LEAST) -> list[DataFrame]:
    """By number of words from 1: (lang, phrase, f) of the phrases that occur `least` times or more.

    Words are lower-cased (A-Z), pieces end at punctuation and line breaks, phrases lie within
    pieces and are joined by a blank. Occurrences that overlap count. The first table also has
    for each language the number of all its words, as that of the empty phrase. A missing language
    is `und`; a missing text is empty. Repeated rows count each for itself.
    """
    texts = docs.select(F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    schema = "lang string, phrase string, f long"

    def summed(parts: DataFrame, size: int) -> DataFrame:
        counts = parts.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where((F.col("f") >= least) | ((F.col("phrase") == "") & (F.col("f") > 0)))
        return scratch_table(counts, f"phrases-{size}")

    levels = [summed(texts.mapInArrow(_count_words, schema), 1)]
    for size in range(1, longest):
        known = docs.sparkSession.sparkContext.broadcast(_level(levels[-1], size))

        def count_pairs(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            counter = _PairCounter(known.value)
            for words in _corpora(batches):
                yield from _in_batches(counter(words))

        levels.append(summed(texts.mapInArrow(count_pairs, schema), size + 1))
    return levels


def _whole(x: Column, y: Column) -> Column:
    return F.call_function("div", x, y)


def _score(a: Column, both: Column) -> Column:
    """floor(2000000 * a / both), exact while 2000 * both fits in 64 bits."""
    thousands = 1000 * a
    return 2000 * _whole(thousands, both) + _whole(2000 * (thousands % both), both)


def collocations(docs: DataFrame, top: int | None = None, longest: int = LONGEST, least: int = LEAST, covered: int = COVERED) -> DataFrame:
    """lang, phrase, a, cut, l, r, score, n for phrases of 2 to `longest` words, with `rank` if `top` is given.

    Candidates occur a >= `least` times. Cut after k words, a phrase has the counts l of the first
    part and r of the rest, and scores floor(2000000 * a / (l + r)); the cut that scores least
    counts, of several the first. Candidates within a longer one that has `covered` per cent of
    their occurrences go. n is the number of words of the language. With `top`, each language's
    first so many by score, then a (both falling), then phrase. See frequent_phrases for words,
    missing values and repeated rows.
    """
    levels = frequent_phrases(docs, longest, least)
    known = reduce(DataFrame.unionByName, levels)
    totals = levels[0].where("phrase = ''").select("lang", F.col("f").alias("n"))
    counts = known.where("phrase <> ''")
    candidates = scratch_table(reduce(DataFrame.unionByName, levels[1:]), "phrase-candidates")
    split = candidates.withColumn("words", F.split("phrase", " "))

    def joined(first: Column | int, size: Column | int) -> Column:
        return F.array_join(F.slice("words", first, size), " ")

    size = F.size("words")
    cuts = split.select("lang", "phrase", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"), "words")
    sides = F.array(
        F.struct(F.lit(True).alias("first"), joined(1, F.col("k")).alias("part")),
        F.struct(F.lit(False).alias("first"), joined(F.col("k") + 1, size - F.col("k")).alias("part")),
    )
    parts = cuts.select("lang", "phrase", "k", F.inline(sides))
    # Parts that many phrases have are looked up in a table of bounded size, the others by a join.
    by_part = counts.select("lang", F.col("phrase").alias("part"), "f")
    head = scratch_table(by_part.orderBy(F.desc("f"), "lang", "part").limit(HEAD), "phrase-head")
    looked = parts.join(F.broadcast(head), ["lang", "part"], "left")
    rest = looked.where("f IS NULL").drop("f").join(by_part, ["lang", "part"])
    found = looked.where("f IS NOT NULL").unionByName(rest)
    starts = F.explode(F.sequence(F.lit(1), size)).alias("i")
    inner = split.where(size > 2).select("lang", "f", "words", starts).select("lang", "f", "words", "i", F.explode(F.sequence(F.lit(2), size - 1)).alias("m"))
    inner = inner.where(F.col("i") + F.col("m") - 1 <= size).select("lang", joined(F.col("i"), F.col("m")).alias("phrase"), F.col("f").alias("longer"))
    rows = (
        candidates.select("lang", "phrase", F.col("f").alias("a"))
        .unionByName(found.select("lang", "phrase", "k", "first", "f"), allowMissingColumns=True)
        .unionByName(inner, allowMissingColumns=True)
    )

    def count_of(k: int, first: bool) -> Column:
        return F.max(F.when((F.col("k") == k) & (F.col("first") == first), F.col("f")))

    scored = rows.groupBy("lang", "phrase").agg(
        F.max("a").alias("a"),
        F.max("longer").alias("longer"),
        *(count_of(k, first).alias(f"{name}{k}") for k in range(1, longest) for first, name in ((True, "l"), (False, "r"))),
    )
    options = [
        F.when(
            F.col(f"l{k}").isNotNull(),
            F.struct(_score(F.col("a"), F.col(f"l{k}") + F.col(f"r{k}")).alias("score"), F.lit(k).alias("cut"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")),
        )
        for k in range(1, longest)
    ]
    kept = scored.where((F.col("longer").isNull()) | (100 * F.col("longer") < covered * F.col("a")))
    ranked = kept.select("lang", "phrase", "a", F.array_min(F.array(*options)).alias("best")).select("lang", "phrase", "a", "best.*")
    if top is not None:
        order = (F.desc("score"), F.desc("a"), "phrase")
        part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
        chosen = ranked.withColumn("_part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order)))
        chosen = chosen.where(F.col("rank") <= top).drop("_part", "rank")
        ranked = chosen.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang")
