"""Toxicity by compression distance: which of two dictionaries shortens a passage more.

Two zstandard dictionaries are made from labelled texts. Both hold the same ordinary text,
a dictionary trained on windows of ordinary documents; behind it one holds what marks toxic
documents, the other as much of ordinary vocabulary, so that a window without such marks
compresses alike with either. The score of a text comes from all its windows: how many save
how many bytes with the toxic dictionary. A logistic curve over these counts is fitted to
the labels, which sets the thresholds.

What marks toxic documents: words that labelled toxic texts use far more often (a likelihood
ratio test), counted by the distinct words before them, so that copies of one text count
once. Labels teach only from documents with crc32(doc_id) mod 4 other than 2; a score
depends on the text alone.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglake.llm.keys import plain
from loglake.session import bound_batches

HELD_OUT = 2
THRESHOLD = 0.3
#: Bytes after which a window ends with its word; a text is cut in each of these ways.
WINDOWS = (40, 64)
LEVEL = 3
#: Labelled documents that teach, at most, of each label: those with the smallest hash of their id.
TOXIC_ROWS = 6000
ORDINARY_ROWS = 14000
#: Windows of a teaching document that go into the ordinary dictionary, and its size in bytes.
WINDOWS_EACH = 3
ORDINARY_BYTES = 1 << 16
#: Marks at most, and the likelihood ratio and the share of use in ordinary text that make one.
MARKS = 2000
EVIDENCE = 22.0
ORDINARY_SHARE = 0.03
SAVED = (1, 2, 3, 4, 5, 6, 8)
_CUTS = {size: re.compile(rb"\S[\s\S]{0,%d}\S*" % (size - 2)) for size in WINDOWS}


def windows(data: bytes, size: int) -> list[bytes]:
    """Lower-cased text in stretches of whole words; the last may reach back."""
    found = _CUTS[size].findall(data)
    if len(found) > 1 and len(found[-1]) < size // 2:
        tail = data.rstrip()[-size:]
        found[-1] = tail[max(tail.find(b" "), 0) :]
    return [b" %b " % w for w in found]


def held_out(doc_id: Column) -> Column:
    """Whether a document's label may not teach."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(4)) == HELD_OUT


@dataclass(frozen=True)
class ToxicityModel:
    """The two dictionaries and the logistic curve; small enough to go with a task."""

    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...] = ()

    @cached_property
    def compressors(self) -> tuple[zstandard.ZstdCompressor, ...]:
        made = []
        for content in (self.ordinary, self.toxic):
            dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            dictionary.precompute_compress(level=LEVEL)
            made.append(
                zstandard.ZstdCompressor(
                    level=LEVEL, dict_data=dictionary, write_checksum=False, write_content_size=False, write_dict_id=False
                )
            )
        return tuple(made)

    def __getstate__(self) -> dict:
        return {"ordinary": self.ordinary, "toxic": self.toxic, "weights": self.weights}

    def features(self, text: str) -> list[float]:
        ordinary, toxic = (c.compress for c in self.compressors)
        data, features = text.lower().encode(), [1.0]
        for size in WINDOWS:
            saved = np.array([len(ordinary(w)) - len(toxic(w)) for w in windows(data, size)] or [0])
            over = np.array([(saved >= s).sum() for s in SAVED])
            features += [*np.log1p(over), *(over / len(saved)), float(min(max(saved.max(), -4), 24)) / 8]
        return [*features, float(np.log1p(len(data)))]

    def scores(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ np.array(self.weights), -30, 30)))


def _fit_curve(features: np.ndarray, labels: np.ndarray) -> tuple[float, ...]:
    """Weights of a logistic regression with a small penalty, by Newton's method."""
    weights, penalty = np.zeros(features.shape[1]), np.full(features.shape[1], 0.3)
    penalty[0] = 1e-3
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(features @ weights, -30, 30)))
        slope = features.T @ (labels - p) - penalty * weights
        curve = (features * (p * (1 - p))[:, None]).T @ features + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        weights = weights + step
        if np.abs(step).max() < 1e-6:
            break
    return tuple(map(float, weights))


def teaching_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text and toxic (0 or 1) of the labelled documents that teach.

    At most TOXIC_ROWS and ORDINARY_ROWS labels are taken, so that they may be broadcast.
    Labels without id or value are no labels; of several for a document the highest holds, of
    several texts under an id the least, so there are no more rows than labels.
    """
    usable = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out(F.col("doc_id")))
    one = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    picked = [
        one.where(F.col("toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        for value, most in ((1, TOXIC_ROWS), (0, ORDINARY_ROWS))
    ]
    taught = F.broadcast(picked[0].unionByName(picked[1]))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(taught, "doc_id")
    return rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"))


def _words(rows: DataFrame) -> DataFrame:
    """For each word the number of distinct words it follows, in toxic and in ordinary texts."""
    words = F.filter(F.split(F.lower("text"), r"[^\p{L}]+"), lambda w: w != "")
    pairs = rows.select("toxic", words.alias("w")).select(
        "toxic", F.explode(F.arrays_zip(F.col("w"), F.concat(F.array(F.lit("")), F.col("w")).alias("before"))).alias("p")
    )
    each = pairs.select("toxic", F.col("p.w").alias("word"), F.col("p.before").alias("before")).where("word IS NOT NULL").distinct()
    return each.groupBy("word").agg(
        F.count(F.when(F.col("toxic") == 1, 1)).alias("t"), F.count(F.when(F.col("toxic") == 0, 1)).alias("o")
    )


def _marks(words: DataFrame) -> list[str]:
    """The words that mark toxic texts, the strongest last; MARKS at most."""
    total = words.agg(F.sum("t").cast("double").alias("all_t"), F.sum("o").cast("double").alias("all_o"))
    share = F.col("t") / F.col("all_t")
    other = F.col("o") / F.col("all_o")
    mean = (F.col("t") + F.col("o")) / (F.col("all_t") + F.col("all_o"))

    def fit(k: Column, n: Column, p: Column) -> Column:
        return F.when(k > 0, k * F.log(p)).otherwise(0.0) + F.when(n > k, (n - k) * F.log(1 - p)).otherwise(0.0)

    t, o, all_t, all_o = (F.col(c) for c in ("t", "o", "all_t", "all_o"))
    ratio = 2 * (fit(t, all_t, share) + fit(o, all_o, other) - fit(t, all_t, mean) - fit(o, all_o, mean))
    found = (
        words.crossJoin(F.broadcast(total))  # one row of totals
        .where((t >= 3) & (other <= ORDINARY_SHARE * share))
        .select("word", ratio.alias("ratio"))
        .where(F.col("ratio") >= EVIDENCE)
        .orderBy(F.desc("ratio"), "word")
        .limit(MARKS)
    )
    return [r["word"] for r in found.collect()][::-1]


def _sample_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [windows(t.lower().encode(), WINDOWS[-1]) for t in batch.column("text").to_pylist()]
        picked = [w for ws in rows for w in ws[:: max(1, -(-len(ws) // WINDOWS_EACH))]]
        yield pa.RecordBatch.from_arrays([pa.array(picked, pa.binary())], names=["window"])


def fit_toxicity(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """A model of the labels. Without labels of both kinds every text scores 0.

    Teaching windows and the counts of teaching documents come to the driver; both have a
    bound (WINDOWS_EACH windows, one row of counts for each teaching document).
    """
    bound_batches(docs.sparkSession)
    rows = teaching_rows(docs, labels)
    marks = _marks(_words(rows))
    ordinary = rows.where("toxic = 0").select("text").mapInArrow(_sample_windows, "window binary").orderBy("window").collect()
    sample = [bytes(r["window"]) for r in ordinary]
    try:
        base = zstandard.train_dictionary(ORDINARY_BYTES, sample).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text itself
        base = b"".join(sample)[-ORDINARY_BYTES:]
    toxic = "".join(f" {w} " for w in marks).encode()
    vocabulary = sorted({w for text in sample for w in text.split()}, key=lambda w: w[::-1])
    step = max(1, len(vocabulary) * 8 // max(1, len(toxic)))
    control = b"".join(b" %b " % w for w in vocabulary[::step])[: len(toxic)]
    model = ToxicityModel(base + control, base + toxic)

    def measure(batches):
        for batch in batches:
            table = np.array([model.features(t) for t in batch.column("text").to_pylist()] or np.zeros((0, 1)))
            features = pa.array(list(table), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), features], names=["toxic", "features"])

    kind = labels.schema["toxic"].dataType.simpleString()
    measured = rows.select("toxic", "text").mapInArrow(measure, f"toxic {kind}, features array<double>").collect()
    y = np.array([r["toxic"] for r in measured], float)
    if not 0 < y.sum() < len(y):
        return ToxicityModel(model.ordinary, model.toxic, (-30.0, *[0.0] * (len(model.features("")) - 1)))
    return ToxicityModel(model.ordinary, model.toxic, _fit_curve(np.array([r["features"] for r in measured]), y))


def _scorer(model: ToxicityModel):
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            rows = [model.features(t) for t in batch]
            yield pd.Series(model.scores(np.array(rows)) if rows else np.zeros(0))

    return score


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_column: str = "text") -> DataFrame:
    """The documents with a column `_toxicity`, 0 to 1; a missing text counts as empty.

    Plain columns stay as they are (see keys.plain), repeated rows too.
    """

    run = F.pandas_udf(_scorer(model), "double")
    return plain(docs).withColumn("_toxicity", run(F.coalesce(F.col(text_column), F.lit(""))))
