"""Merge replay, periodic runs and collocations against brute force."""

import base64
import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import re
import tiktoken
from hypothesis import given, settings, strategies as st

from loglake.llm import bpe, collocations, numeric, runs
from loglake.llm.queries import QUERIES


@pytest.fixture(scope="module")
def vocabulary():
    with open(public_tokenizers.path(bpe.VOCABULARY), "rb") as file:
        return bpe.Vocabulary(file.read())


def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def ids_of(encoder, texts):
    return [x[b[i] : b[i + 1]].tolist() for _, x, b in encoder(pa.array(texts, pa.string())) for i in range(len(b) - 1)]


TEXT = st.text(st.sampled_from(list(" \n\t'strevmldéA1日!.　́🙂²ʼ\x1c​")), max_size=40)


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=8), st.sampled_from([1, 50, bpe.CORPUS]))
def test_replay_equals_the_library(vocabulary, texts, corpus):
    texts = [*texts, "a" * 500 + " " * 300 + "ab" * 200 + "<|endoftext|>"]
    encode = library(vocabulary.ranks)
    got = ids_of(bpe.CorpusEncoder(vocabulary, corpus), texts)
    assert got == [encode(t) for t in texts]
    for text, ids in zip(texts, got, strict=True):
        assert vocabulary.decode(np.array(ids, np.int64))[0].tobytes() == text.encode()


@settings(max_examples=150, deadline=None)
@given(st.randoms(use_true_random=False), st.lists(st.text("abc", min_size=1, max_size=25), min_size=1, max_size=6))
def test_replay_with_merges_out_of_order(rng, texts):
    """Vocabularies in no order: a merge may make a pair that comes before it."""
    tokens = sorted({"".join(rng.choices("abc", k=rng.randint(2, 5))) for _ in range(25)})
    rng.shuffle(tokens)
    ranks = {bytes([b]): b for b in range(256)} | {t.encode(): 256 + i for i, t in enumerate(tokens)}
    lines = b"\n".join(base64.b64encode(t) + b" %d" % r for t, r in ranks.items())
    encode = library(ranks)
    assert ids_of(bpe.CorpusEncoder(bpe.Vocabulary(lines)), texts) == [encode(t) for t in texts]


def test_a_vocabulary_has_all_bytes():
    with pytest.raises(ValueError, match="no tokens"):
        bpe.Vocabulary(base64.b64encode(b"a") + b" 0")


def test_encode_and_decode_odd_rows(odd_docs, no_docs, vocabulary):
    encode = library(vocabulary.ranks)
    encoded = bpe.encode_texts(odd_docs)
    assert encoded.columns == [*(c for c in odd_docs.columns if c != "text"), "_ids"]
    rows = sorted((str(r.doc_id), list(r._ids)) for r in encoded.collect())
    assert rows == sorted((str(r.doc_id), encode(r.text or "")) for r in odd_docs.collect())
    back = sorted((str(r.doc_id), bytes(r._bytes).decode()) for r in bpe.decode_ids(encoded).collect())
    assert back == sorted((str(r.doc_id), r.text or "") for r in odd_docs.collect())
    assert bpe.decode_ids(bpe.encode_texts(no_docs)).count() == 0


def test_decode_takes_missing_and_unknown_ids(spark):
    ids = spark.createDataFrame([(1, [65, 66]), (2, None), (3, [])], "doc_id long, _ids array<int>")
    with open(public_tokenizers.path(bpe.VOCABULARY), "rb") as file:
        names = bpe.Vocabulary(file.read())
    expected = {1: names.decode(np.array([65, 66]))[0].tobytes(), 2: b"", 3: b""}
    assert {r.doc_id: bytes(r._bytes) for r in bpe.decode_ids(ids).collect()} == expected
    with pytest.raises(Exception, match="not in the vocabulary"):
        bpe.decode_ids(spark.createDataFrame([(1, [70000])], "doc_id long, _ids array<int>")).collect()


def test_byte_bpe_query_equals_the_library(spark, sf_dir, vocabulary):
    encode = library(vocabulary.ranks)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    rows = QUERIES["op13_byte_bpe"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = encode(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), digest(",".join(map(str, ids))), digest(texts[r.doc_id]))


def brute_force_runs(words, least, times):
    found = []
    for period in range(1, len(words) // times + 1):
        place = 0
        while place + period < len(words):
            end = place
            while end + period < len(words) and words[end] == words[end + period]:
                end += 1
            length = end - place + period
            stretch = words[place : end + period]
            smaller = any(stretch[d:] == stretch[:-d] for d in range(1, period))
            if end > place and length >= max(least, times * period) and not smaller:
                found.append((place, length, period))
            place = max(end, place + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


PARTS = st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=5), st.integers(1, 12), st.integers(0, 4))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(PARTS, max_size=5), min_size=1, max_size=4), st.sampled_from([(6, 4), (2, 2), (1, 3), (9, 3), (4, 2)]))
def test_runs_equal_brute_force(texts, limits):
    texts = [[w for words, n, cut in text for w in (words * n)[cut:]] for text in texts]
    codes = np.array([w for t in texts for w in t], np.int64)
    bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    got = [[] for _ in texts]
    for text, *run in zip(*map(np.ndarray.tolist, runs.find_runs(codes, bounds, *limits)), strict=True):
        got[text].append(tuple(run))
    assert got == [brute_force_runs(t, *limits) for t in texts]


def test_a_run_has_two_periods():
    with pytest.raises(ValueError, match="two periods"):
        runs.find_runs(np.array([1, 1]), np.array([0, 2]), 1, 1)


def test_long_periodic_texts_are_quick():
    for codes in (np.zeros(200_000, np.int64), np.arange(200_000) % 7):
        assert len(runs.find_runs(codes, np.array([0, len(codes)]))[0]) == 1


def test_collapse_odd_rows(odd_docs, no_docs, docs_of):
    found = runs.collapse_runs(odd_docs)
    assert found.columns == [*(c for c in odd_docs.columns if c != "text"), "_n_words", "_runs", "_collapsed"]
    for r, text in zip(found.collect(), (r.text or "" for r in odd_docs.collect()), strict=True):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        expected = brute_force_runs(words, 6, 4) if len(words) < 100 else [(0, 24_000, 8)]
        assert (r._n_words, [tuple(x) for x in r._runs]) == (len(words), expected)
        assert r._collapsed == " ".join(words[:8] if len(words) > 100 else words)
    assert runs.collapse_runs(no_docs).count() == 0
    text = " é  b\té b\n\né b é b c " + "x " * 7
    row = runs.collapse_runs(docs_of(text)).first()
    assert (row._collapsed, [tuple(x) for x in row._runs]) == ("é b c x", [(0, 8, 2), (9, 7, 1)])


def phrases_of(docs, longest=4):
    """All counts by (lang, phrase), and the words of each language."""
    found, total = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for size in range(1, longest + 1):
                found.update((lang, " ".join(words[i : i + size])) for i in range(len(words) - size + 1))
    return found, total


def brute_force_collocations(docs, least, covered, top):
    found, total = phrases_of(docs)
    frequent = {key: a for key, a in found.items() if a >= least and " " in key[1]}
    gone = set()
    for (lang, phrase), longer in frequent.items():
        words = phrase.split(" ")
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                inner = lang, " ".join(words[i : i + size])
                if 100 * longer >= covered * frequent[inner]:
                    gone.add(inner)
    rows = []
    for (lang, phrase), a in frequent.items():
        words, cuts = phrase.split(" "), []
        for k in range(1, len(words)):
            left, right = found[lang, " ".join(words[:k])], found[lang, " ".join(words[k:])]
            cuts.append((2000000 * a // (left + right), k, left, right))
        if (lang, phrase) not in gone:
            rows.append((lang, *min(cuts), a, phrase))
    rows.sort(key=lambda r: (r[0], -r[1], -r[5], r[6].encode()))
    ranks, result = Counter(), []
    for lang, score, k, left, right, a, phrase in rows:
        ranks[lang] += 1
        if ranks[lang] <= top:
            result.append((lang, ranks[lang], phrase, a, k, left, right, total[lang], score))
    return result


def as_rows(found):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.cut, r.l, r.r, r.n, r.score) for r in found.collect())


def test_collocations_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    words = ["a", "B", "b", "ça", "Ω", "x\x0cy", "tab\tbed", "the", "of"]
    docs = []
    for i in range(120):
        parts = rng.choice(words, rng.integers(0, 40))
        docs.append((["en", None, "fr", "und", ""][i % 5], " ".join(parts) + str(rng.choice([".", "", ", of the a", "\nb  b b b b"]))))
    docs += [("en", None), ("en", ""), (None, "one"), ("en", "a b " * 400), ("xx", " .,;:!?\n\r\x0b\x0c")]
    table = spark.createDataFrame(docs, "lang string, text string")
    for least, covered, top in ((3, 80, 50), (5, 50, 5)):
        found = collocations.collocations(table, top, least=least, covered=covered)
        assert as_rows(found) == sorted(brute_force_collocations(docs, least, covered, top))
    everything = collocations.collocations(table, None, least=3)
    assert everything.count() == len(brute_force_collocations(docs, 3, 80, 10**9))


def test_collocations_of_odd_tables(odd_docs, no_docs):
    assert collocations.collocations(no_docs, 10).count() == 0
    docs = [(r.lang, r.text) for r in odd_docs.collect()]
    assert as_rows(collocations.collocations(odd_docs, 10)) == sorted(brute_force_collocations(docs, 30, 80, 10))


@pytest.mark.parametrize("tile, places", [(512, 16), (4, 1), (2, 1000), (8, 10**9)])
def test_tiles_and_sorted_pairs_give_all_counts(monkeypatch, tile, places):
    """Whatever part of the pairs is counted by direct address."""
    monkeypatch.setattr(collocations, "TILE", tile)
    monkeypatch.setattr(collocations, "PLACES_A_PAIR", places)
    rng = np.random.default_rng(tile)
    docs = [(str(rng.choice(["en", "fr"])), " ".join(rng.choice(list("abcdefghij"), rng.integers(0, 60))) + ". a b c") for _ in range(60)]
    batch = pa.RecordBatch.from_arrays([pa.array([x for x, _ in docs]), pa.array([x for _, x in docs])], names=["lang", "text"])
    expected, _ = phrases_of(docs)
    for size in (1, 2, 3):
        known = sorted((k for k in expected if k[1].count(" ") == size - 1), key=lambda k: -expected[k])
        wanted = np.full(1 << 10, 255, np.uint8)
        languages, phrases = (pa.array([k[i] for k in known]) for i in (0, 1))
        for head in (0, 7, len(known)):
            counter = collocations._PairCounter(collocations.Level(size, wanted, languages[:head], phrases[:head]))
            got = Counter()
            for words in collocations._corpora([batch]):
                for rows in counter(words):
                    for r in rows.to_pylist():
                        got[r["lang"], r["phrase"]] += r["f"]
            assert got == {k: n for k, n in expected.items() if k[1].count(" ") == size}


def test_hashes_of_phrases_are_those_of_texts():
    batch = pa.RecordBatch.from_arrays([pa.array(["en", "fr"]), pa.array(["the cat sat", "Le chat"])], names=["lang", "text"])
    words = next(collocations._corpora([batch]))
    found = collocations.phrase_hashes(pa.array(["en", "en", "fr"]), pa.array(["the cat", "cat sat", "le chat"]), 2, numeric.SpanHash())
    assert collocations.gram_hash(words.hash, 2)[[0, 1, 3]].tolist() == found.tolist()


def test_scores_are_exact_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    cases = [(30, 60), (10**12, 3 * 10**12 + 7), (2 * 10**15, 4 * 10**15 + 1), (33, 10**15), (1, 3)]
    table = spark.createDataFrame(cases, "a long, s long").select("a", "s", collocations._score(F.col("a"), F.col("s")).alias("score"))
    assert [(r.a, r.s, r.score) for r in table.collect()] == [(a, s, 2000000 * a // s) for a, s in cases]
