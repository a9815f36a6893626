"""Line and document duplicates against brute force."""

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loglake.llm import line_dedup, near_dedup
from loglake.llm.components import components
from loglake.llm.line_dedup import PERCENT, SHINGLE, dedup_lines
from loglake.llm.near_dedup import keep_one_of_each, near_duplicates
from loglake.session import BATCH_BYTES, bound_batches


def classes(sets, percent):
    """Component of each set, as the index of its first member, by comparing all pairs."""
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(sets))]


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


@pytest.fixture
def near_texts():
    """A template with edits around the threshold, chains of edits, copies and strangers."""
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    template = rng.choices(vocabulary, k=120)
    texts = []
    for _ in range(60):
        words = list(template)
        for _ in range(rng.randint(0, 9)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        texts.append(" ".join(words))
    chain = rng.choices(vocabulary, k=100)
    for step in range(15):
        chain[step * 6] = f"x{step}"
        texts.append(" ".join(chain))
    texts += [" ".join(rng.choices(vocabulary, k=rng.randint(1, 80))) for _ in range(40)]
    texts += texts[:5] + ["", "one", "one", "two words", "Two  WORDS"]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_components_equal_those_of_all_pairs(docs_of, near_texts, size, percent):
    expected = classes([shingles(t, size) for t in near_texts], percent)
    found = {r.doc_id: r for r in near_duplicates(docs_of(*near_texts), size, percent).collect()}
    assert [found[i].component_id for i in range(len(near_texts))] == expected
    assert [found[i].n_shingles for i in range(len(near_texts))] == [len(shingles(t, size)) for t in near_texts]
    assert all(r.kept == (r.doc_id == r.component_id) for r in found.values())


def test_links_that_no_pivot_shows_come_from_rare_shingles(docs_of, near_texts, monkeypatch):
    """With every pivot pair refused, the join on rare shingles finds the components alone."""
    kept = near_dedup._alike_signatures
    monkeypatch.setattr(near_dedup, "_alike_signatures", lambda batches, least: kept(batches, least=10**6))
    expected = classes([shingles(t, 3) for t in near_texts], 85)
    found = {r.doc_id: r.component_id for r in near_duplicates(docs_of(*near_texts), 3, 85).collect()}
    assert [found[i] for i in range(len(near_texts))] == expected


def test_odd_rows_have_components(odd_docs, no_docs):
    rows = near_duplicates(odd_docs, 3, 85).collect()
    assert len(rows) == 13
    of = defaultdict(list)
    for r in rows:
        of[r.doc_id].append(r)
    assert [r.component_id for r in of[1]] == [1, 1]
    assert sorted((r.component_id, r.kept) for r in of[2]) == [(1, False), (2, True)]
    assert sorted((r.n_shingles, r.component_id, r.kept) for r in of[None]) == [(0, None, False), (15, 1, False)]
    assert [(r.n_shingles, r.component_id, r.kept) for i in (3, 4, 5) for r in of[i]] == [(0, i, True) for i in (3, 4, 5)]
    assert near_duplicates(no_docs, 3, 85).count() == 0


def test_one_of_each_stays_with_all_columns(odd_docs, no_docs):
    kept = keep_one_of_each(odd_docs, 3, 85)
    assert kept.columns == odd_docs.columns
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
    assert ids == [(False, i) for i in (1, 2, 3, 4, 5, 6, 7, 8)] + [(True, 0)]
    assert keep_one_of_each(no_docs).count() == 0


def test_components_of_random_links(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 480)]
    reach = {n: {n} for pair in links for n in pair}
    for a, b in links:
        joined = reach[a] | reach[b]
        for n in joined:
            reach[n] = joined
    expected = {n: min(s) for n, s in reach.items() if len(s) > 1}
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.root for r in found} == expected and len(found) == len(expected)


def line_set(line):
    return frozenset(line[i : i + SHINGLE] for i in range(max(len(line) - SHINGLE + 1, 1)))


def test_lines_equal_those_of_all_pairs(docs_of, spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").limit(90).collect()
    texts = [r.text for r in rows] + ["a line that is repeated word for word here\nshort\nshort\n\n \t\n\n", "a line that is repeated word for word hare\nab\nab\nshort\n\né"]
    lines = [(d, n, x) for d, t in enumerate(texts) for n, x in enumerate(t.split("\n")) if x.strip(" \t\n\x0b\x0c\r")]
    distinct = list(dict.fromkeys(x for _, _, x in lines))
    of = dict(zip(distinct, classes([line_set(x) for x in distinct], PERCENT), strict=True))
    seen, gone = set(), set()
    for d, n, x in lines:
        if of[x] in seen:
            gone.add((d, n))
        seen.add(of[x])
    expected = {d: "\n".join(x for n, x in enumerate(t.split("\n")) if (d, n) not in gone) for d, t in enumerate(texts)}
    found = {r.doc_id: r._text for r in dedup_lines(docs_of(*texts)).collect()}
    assert found == expected
    assert found[len(texts) - 2].endswith("\nshort\n\n \t\n\n") and found[len(texts) - 1] == "ab\n\né" and len(gone) > 10


def test_pairs_within_a_template_are_found(docs_of):
    """Lines of one template just under the threshold, in pairs above it: most buckets of a pair
    are the template's, whose ends are like neither."""
    rng = random.Random(5)
    letters = [chr(c) for c in range(0x61, 0x7B)]

    def some(count):
        return "".join(rng.choices(letters, k=count))

    template = some(181)
    lines = [template + pair + some(18) for pair in (some(8) for _ in range(60)) for _ in range(2)]
    expected = classes([line_set(x) for x in lines], PERCENT)
    assert expected == [i - i % 2 for i in range(120)]
    found = {r.doc_id: r._gone for r in dedup_lines(docs_of(*lines)).collect()}
    assert [found[i] for i in range(120)] == [i % 2 for i in range(120)]


def family(seed):
    """Lines of one template, in pairs that are alike enough, and others that are not."""
    rng = random.Random(seed)

    def some(count):
        return "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=count))

    template = some(150)
    return [template + pair + some(18) for pair in (some(60) for _ in range(30)) for _ in range(2)]


@pytest.mark.parametrize("crowd", [line_dedup.CROWD, 3])
def test_open_buckets_are_settled_whatever_their_size(docs_of, monkeypatch, crowd):
    """Nodes that the ends of a bucket leave open are compared by their sketches; only those of
    crowded buckets are spread out by shingle, and texts are fetched for few pairs."""
    stored = {}

    def scratch_table(df, name):
        stored[name] = line_dedup_scratch(df, name)
        return stored[name]

    line_dedup_scratch = line_dedup.scratch_table
    monkeypatch.setattr(line_dedup, "scratch_table", scratch_table)
    monkeypatch.setattr(line_dedup, "CROWD", crowd)
    lines = [x for seed in range(3) for x in family(seed)]
    expected = classes([line_set(x) for x in lines], PERCENT)
    assert len(set(expected)) == len(lines) // 2
    found = {r.doc_id: r._gone for r in dedup_lines(docs_of(*lines)).collect()}
    assert [found[i] for i in range(len(lines))] == [int(x != i) for i, x in enumerate(expected)]
    assert ("line-rare-shingles" in stored) == (crowd == 3)
    assert stored["line-pairs"].count() + stored["line-open-pairs"].count() < 2 * len(lines)


def test_batches_of_long_texts_stay_small(spark):
    bound_batches(spark)
    docs = spark.range(0, 64, 1, 1).select(F.repeat(F.lit("x"), 1 << 20).alias("text"))
    sizes = docs.mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"]) for b in batches), "n long")
    assert sizes.agg(F.max("n")).first()[0] < BATCH_BYTES + (2 << 20)


def sketches_of(*sets):
    ordered = np.concatenate([np.sort(np.uint64(i) << np.uint64(44) | x) for i, x in enumerate(sets)])
    return line_dedup._sketches(ordered, len(sets))


def test_sketches_lose_no_pair_and_part_most_others():
    rng = np.random.default_rng(7)
    passed = {}
    for size in (9, 45, 200, 3000):
        for both in (8, 4):  # tenths of the union that both sets have
            hits = []
            for _ in range(200):
                union = np.unique(rng.integers(0, 1 << 44, size, dtype=np.uint64))
                rng.shuffle(union)
                common = -(-len(union) * both // 10)
                cut = common + (len(union) - common) // 2
                x, y = union[:cut], np.concatenate((union[:common], union[cut:]))
                a, b = (line_dedup._unpacked(pa.array([s])) for s in sketches_of(x, y))
                sizes = np.array([len(x)]), np.array([len(y)])
                hits.append(bool(line_dedup._maybe_alike(a, b, *sizes, PERCENT)[0]))
            passed[size, both] = np.mean(hits)
    assert all(passed[size, 8] == 1 for size in (9, 45, 200, 3000))
    assert passed[200, 4] < 0.05 and passed[3000, 4] < 0.02


def test_pairs_of_a_bucket_are_found_across_batches():
    """Each bucket's pairs of different roots, wherever batches begin."""
    x, y = sketches_of(*(np.arange(i, 200, dtype=np.uint64) << np.uint64(36) for i in (0, 100)))
    buckets = [-5, -5, -5, 2, 7, 7, 7, 7]
    columns = [buckets, range(8), [0, 0, 2, 3, 4, 5, 6, 4], [200] * 8, [x, x, x, x, x, x, y, x]]
    table = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 4 + [pa.binary()], strict=True)], names=["bucket", "node", "root", "size", "sketch"])
    for size in (1, 3, 8):
        parts = [table.slice(i, size) for i in range(0, 8, size)]
        found = [tuple(r.values()) for b in line_dedup._likely_inside(iter([*parts, table.slice(0, 0)]), PERCENT) for r in b.to_pylist()]
        assert sorted(found) == [(0, 2), (1, 2), (4, 5), (5, 7)]
    assert not list(line_dedup._likely_inside(iter([table.slice(0, 0)]), PERCENT))


def test_a_line_of_ordinary_length_with_a_small_edit_links(docs_of):
    lines = [f"Copyright {year} Example Works, some rights reserved" for year in (2021, 2022)]
    assert [len(x) for x in lines] == [50, 50]
    found = {r.doc_id: r._text for r in dedup_lines(docs_of(*lines)).collect()}
    assert found == {0: lines[0], 1: ""}


def test_odd_rows_and_lines(odd_docs, no_docs):
    found = dedup_lines(odd_docs)
    assert found.columns == [*odd_docs.columns, "_text", "_gone"]
    rows = found.collect()
    assert len(rows) == 13
    assert [r._gone for r in rows if r.doc_id == 1] == [0, 0]  # repeated rows are one
    assert [r._text for r in rows if r.doc_id == 3] == [None]
    assert sorted(r._gone for r in rows if r.doc_id == 2) == [0, 1]
    assert dedup_lines(no_docs).count() == 0
    assert found.where(F.col("_gone") > 0).count() == 2


@pytest.mark.parametrize("weight", [line_dedup.WEIGHT, 1000])
def test_links_inside_buckets_are_those_that_join_components(monkeypatch, weight):
    """As many links as join what brute force joins, wherever batches begin and however much meets at once."""
    monkeypatch.setattr(line_dedup, "WEIGHT", weight)
    lines = [*family(5)[:20], *(x + "yz" for x in family(5)[:3]), "ab"]
    buckets = [[1, 2] if i < 12 else [2, 3] for i in range(len(lines))]
    columns = [[4] * 20 + [9] * 4, range(24), [0, 0, *range(2, 24)], buckets, [x.encode() for x in lines]]
    types = [pa.int64()] * 3 + [pa.list_(pa.int64()), pa.binary()]
    rows = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["anchor", "node", "root", "buckets", "content"])
    for size in (1, 7, 24):
        parts = [rows.slice(i, size) for i in range(0, 24, size)]
        found = [tuple(r.values()) for b in line_dedup._links_inside(iter([rows.slice(0, 0), *parts]), PERCENT) for r in b.to_pylist()]
        assert sorted(found) == [*((i, i + 1) for i in range(2, 20, 2)), (20, 21)]
    assert not list(line_dedup._links_inside(iter([rows.slice(0, 0)]), PERCENT))


def test_a_bucket_costs_rows_by_its_nodes_not_their_pairs(docs_of, monkeypatch):
    """Lines of a template whose pairs are somewhat alike, but too little: texts meet once, not once a pair."""
    rows, stored = {}, line_dedup.scratch_table

    def scratch_table(df, name):
        table = stored(df, name)
        rows[name] = table.count()
        return table

    monkeypatch.setattr(line_dedup, "scratch_table", scratch_table)
    rng = random.Random(3)
    template = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=160))
    lines = [template + "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=24)) for _ in range(200)]
    assert classes([line_set(x) for x in lines], PERCENT) == list(range(200))
    assert dedup_lines(docs_of(*lines)).where("_gone > 0").isEmpty()
    assert rows["line-inner"] > 500 and rows["line-open-pairs"] == 0
