"""Near-duplicate documents: MinHash, banding, verification, connected components.

Texts become sets of word shingles. Documents of equal sets are one node, so copies cost no
pairs. Nodes meet in bands of MinHash minima. In a bucket every node is compared with the
bucket's smallest and largest node only, however large it is; pairs whose signatures agree
enough are confirmed on the full sets, and confirmed links joined to components.

Nodes of one bucket that are then still in different components are settled exactly, by a
join on rare shingles: two sets alike enough must share one of their first few shingles in
order of frequency, at places that leave room for the overlap needed. A template shared by
thousands of documents thus costs pairs only where two of them could really be alike.

Nothing but counts reaches the driver. What is broadcast is a Bloom filter of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loglake.llm import numeric
from loglake.llm.bloom import bloom_table, maybe_in
from loglake.llm.components import components
from loglake.llm.keys import KEY, add_key, plain, with_key
from loglake.sources.tables import scratch_table

#: 40 bands of 6 minima: sets with a similarity of 0.85 share no band once in 10**8 times,
#: of 0.8 once in 10**5; unrelated texts hardly ever meet.
BANDS = 40
ROWS = 6
#: Deviations below the threshold at which a signature still counts as alike enough.
DEVIATIONS = 5.5
WHITE = ((0x20, 0x20), (0x09, 0x0D))


def shingle_sets(texts: pa.Array, size: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, sorted distinct shingle hashes of each row) for stretches of rows.

    A-Z is lower-cased, words are cut at white space, a shingle is `size` consecutive words;
    a text with fewer words has one, of all its words; without words it has none.
    """
    table, spans = numeric.class_table(*WHITE), numeric.SpanHash()
    for first, _, data, bounds in numeric.stretches(texts):
        data = numeric.LOWER[data]
        starts, ends = numeric.runs(table[data], bounds)
        words = spans(data, starts, ends)
        at = np.searchsorted(starts, bounds)
        grams = numeric.gram_hash(words, size)
        sets = []
        for i in range(len(bounds) - 1):
            low, high = at[i], at[i + 1]
            if high - low >= size:
                sets.append(np.unique(grams[low : high - size + 1]))
            elif high > low:
                sets.append(numeric.gram_hash(words[low:high], int(high - low), salt=1))
            else:
                sets.append(np.zeros(0, np.uint64))
        yield first, sets


def _features(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rest = [batch.column(c) for c in ("doc_id", *KEY)]
        for first, sets in shingle_sets(batch.column("text"), size):
            sizes = np.array([len(s) for s in sets])
            full = sizes > 0
            keys, seen = np.zeros((len(sets), BANDS), np.uint64), np.zeros((len(sets), BANDS * ROWS), np.uint8)
            nodes = np.zeros(len(sets), np.uint64)
            if full.any():
                values = np.concatenate(sets)
                starts = np.concatenate(([0], np.cumsum(sizes[full])[:-1]))
                signatures = numeric.minima(values, starts, BANDS * ROWS)
                keys[full] = numeric.band_keys(signatures, ROWS)
                seen[full] = (signatures * np.uint32(0x9E3779B1)) >> np.uint32(24)
                nodes[full] = numeric.mix(np.add.reduceat(numeric.mix(values), starts) + sizes[full].astype(np.uint64))
            bands = numeric.lists(full * BANDS, numeric.longs(keys[full]))
            yield pa.RecordBatch.from_arrays(
                [c.slice(first, len(sets)) for c in rest]
                + [pa.array(sizes, pa.int64()), numeric.longs(nodes), bands, pa.array([s.tobytes() for s in seen])],
                names=["doc_id", *KEY, "n", "node", "bands", "signature"],
            )


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, sets in shingle_sets(batch.column("text"), size):
            yield pa.RecordBatch.from_arrays(
                [batch.column("node").slice(first, len(sets)), pa.array([s.tobytes() for s in sets])],
                names=["node", "shingles"],
            )


def _alike_signatures(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Pairs of which at least so many of the signature bytes agree."""
    for batch in batches:
        a, b = (
            np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, BANDS * ROWS)
            for c in ("signature_a", "signature_b")
        )
        yield batch.select(["a", "b"]).filter(pa.array((a == b).sum(axis=1) >= least))


def _confirmed(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs whose full sets are alike: 100 * intersection >= percent * union."""
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("shingles_a"), batch.column("shingles_b"), strict=True):
            x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * both >= percent * (len(x) + len(y) - both))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per shingle of each set, a bounded number of sets at a time."""
    for batch in batches:
        for first in range(0, batch.num_rows, 256):
            part = batch.slice(first, 256)
            values = [np.frombuffer(s.as_buffer(), np.int64) for s in part.column("shingles")]
            sizes = np.array([len(v) for v in values])
            columns = [np.repeat(part.column(c).to_numpy(), sizes) for c in ("node", "root")]
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, columns), pa.array(np.repeat(sizes, sizes), pa.int64()), pa.array(np.concatenate(values))],
                names=["node", "root", "n", "shingle"],
            )


def _beside(pairs: DataFrame, values: DataFrame, column: str) -> DataFrame:
    """The pairs with a column of each of their nodes."""
    for side in ("a", "b"):
        pairs = pairs.join(values.select(F.col("node").alias(side), F.col(column).alias(f"{column}_{side}")), side)
    return pairs.select("a", "b", f"{column}_a", f"{column}_b")


def _pair(x: Column, y: Column) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _rare_pairs(sets: DataFrame, settled: DataFrame, percent: int) -> DataFrame:
    """Pairs of unsettled nodes of different components that may be alike enough.

    `settled` has node and root. Sets A and B alike enough share at least
    percent * (|A| + |B|) / (100 + percent) shingles, so in any order of all shingles their
    first common one stands where so many can still follow. The order is by rarity.
    Of the largest component only pairs with others are made.
    """
    rows = sets.join(settled, "node").mapInArrow(_one_by_one, "node long, root long, n long, shingle long")
    frequency = rows.groupBy("shingle").agg(F.count("*").alias("f"))
    ordered = rows.join(frequency, "shingle").withColumn(
        "at", F.row_number().over(Window.partitionBy("node").orderBy("f", "shingle")) - 1
    )
    first = ordered.where((F.col("f") > 1) & (100 * (F.col("n") - F.col("at")) >= percent * F.col("n")))
    sizes = settled.groupBy("root").agg(F.count("*").alias("members"))
    largest = sizes.agg(F.max_by("root", "members").alias("largest"))
    first = scratch_table(first.select("node", "root", "n", "shingle", "at"), "rare-shingles")
    x = first.join(F.broadcast(largest), F.col("root") != F.col("largest"), "left_semi").alias("x")
    y = first.alias("y")
    room = F.least(F.col("x.n") - F.col("x.at"), F.col("y.n") - F.col("y.at"))
    return (
        x.join(y, F.col("x.shingle") == F.col("y.shingle"))
        .where(F.col("x.root") != F.col("y.root"))
        .where((100 + percent) * room >= percent * (F.col("x.n") + F.col("y.n")))
        .select(*_pair(F.col("x.node"), F.col("y.node")))
        .distinct()
    )


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, its key, n_shingles, component_id, kept, and `keeper`.

    Documents are linked when 100 * |intersection| >= percent * |union| of their sets of
    `size`-word shingles; component_id is the smallest doc_id reached over links, kept says
    whether that is the document's own. Missing and empty texts have no shingles and no
    links. A component whose documents all lack an id has none, and `kept` is false there;
    `keeper` is true for one row key of each component whatever its ids (the smallest id,
    missing ones last, then by text). Repeated rows share a key. Other columns are left out.
    """
    keyed = with_key(docs)
    stored = scratch_table(
        keyed.mapInArrow(
            partial(_features, size=size),
            "doc_id long, _no_id boolean, _id long, _text_hash long, n long, node long, bands array<long>, signature binary",
        ),
        "near-features",
    )
    named = stored.where("n > 0")
    members = named.select("node", F.explode("bands").alias("band"))
    buckets = members.groupBy("band").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    shared = scratch_table(
        members.join(buckets.where("low <> high"), "band").distinct().select("band", "node", "low", "high"), "near-buckets"
    )
    pairs = (
        shared.select("node", F.explode(F.array("low", "high")).alias("other"))
        .where("node <> other")
        .select(*_pair(F.col("node"), F.col("other")))
        .distinct()
    )
    # What a node needs for its comparisons is fetched by a text of its own, once.
    pairs = scratch_table(pairs, "near-pairs")
    wanted = shared.select("node").distinct()
    owners = named.join(wanted, "node").groupBy("node").agg(F.min(F.struct(*KEY)).alias("key"), F.first("signature").alias("signature"))
    owners = scratch_table(owners.select("node", "key.*", "signature"), "near-owners")
    near = maybe_in(keyed, "_text_hash", bloom_table(owners, "_text_hash")).where("_maybe").select(*KEY, "text")
    texts = near.dropDuplicates(KEY).join(owners.select("node", *KEY), KEY).select("node", "text")
    sets = scratch_table(texts.mapInArrow(partial(_sets, size=size), "node long, shingles binary"), "near-sets")

    count = BANDS * ROWS
    expected = percent / 100
    agree = int(count * expected - DEVIATIONS * (count * expected * (1 - expected)) ** 0.5)
    alike = _beside(pairs, owners, "signature").mapInArrow(partial(_alike_signatures, least=agree), "a long, b long")

    def confirm(candidates: DataFrame) -> DataFrame:
        return _beside(candidates, sets, "shingles").mapInArrow(partial(_confirmed, percent=percent), "a long, b long")

    links = scratch_table(confirm(alike), "near-links")
    roots = components(links)
    root = F.coalesce("root", F.col("node"))
    rooted = shared.join(roots, "node", "left").select("band", "node", root.alias("root"))
    open_bands = (
        rooted.groupBy("band").agg(F.min("root").alias("l"), F.max("root").alias("h")).where("l <> h").select("band")
    )
    unsettled = scratch_table(rooted.join(open_bands, "band").select("node", "root").distinct(), "near-unsettled")
    rest = confirm(_rare_pairs(sets, unsettled, percent))
    roots = components(links.unionByName(rest))

    classed = stored.select("doc_id", *KEY, "n", "node").join(roots, "node", "left")
    # Texts without words stay apart: each key is a class of its own.
    classed = classed.withColumn(
        "class", F.when(F.col("n") > 0, F.struct(root.alias("r"), F.lit(0).cast("long").alias("i"), F.lit(False).alias("o"), F.lit(0).cast("long").alias("h")))
        .otherwise(F.struct(F.lit(0).cast("long").alias("r"), F.col("_id").alias("i"), F.col("_no_id").alias("o"), F.col("_text_hash").alias("h"))),
    ).withColumn("words", F.col("n") > 0)
    best = classed.groupBy("words", "class").agg(
        F.min("doc_id").alias("component_id"), F.min(F.struct(*KEY)).alias("best")
    )
    return classed.join(best, ["words", "class"]).select(
        "doc_id",
        *KEY,
        F.col("n").alias("n_shingles"),
        "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"),
        (F.struct(*KEY) == F.col("best")).alias("keeper"),
    )


def keep_one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The documents, plain columns, with one of each component left, and one of repeated rows.

    Documents without words all stay. Only rows that a Bloom filter of what goes may hold
    are shuffled.
    """
    found = near_duplicates(docs, size, percent)
    by_key = found.groupBy(*KEY).agg(
        F.first("keeper").alias("_keeper"), F.count("*").alias("_copies"), F.first("n_shingles").alias("_n")
    )
    acted = scratch_table(by_key.where("_n > 0 AND (NOT _keeper OR _copies > 1)").drop("_copies", "_n"), "near-decisions")
    columns = [F.col(f"`{c}`") for c in plain(docs).columns]
    keyed = add_key(docs)
    probed = maybe_in(keyed, "_text_hash", bloom_table(acted, "_text_hash"))
    decided = probed.where("_maybe").join(acted, KEY, "left")
    copy = F.row_number().over(Window.partitionBy(*KEY).orderBy(F.lit(0)))
    left = decided.withColumn("_copy", copy).where(F.col("_keeper").isNull() | (F.col("_keeper") & (F.col("_copy") == 1)))
    return probed.where("NOT _maybe").select(*columns).unionByName(left.select(*columns))
