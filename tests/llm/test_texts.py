"""Tokens, packing, page text and toxicity."""

import bisect
import random
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from loglake.llm import toxicity
from loglake.llm.html_text import extract_text, main_text
from loglake.llm.packing import END_ID, best_fit_decreasing, pack_documents
from loglake.llm.tokens import PieceEncoder


@pytest.fixture(scope="module")
def tokenizer():
    made = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    made.encode_special_tokens = True
    return lambda text: made.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def encode():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        encoder = PieceEncoder(file.read())

    def ids(texts):
        return [x[b[i] : b[i + 1]].tolist() for _, x, b in encoder(pa.array(texts, pa.string())) for i in range(len(b) - 1)]

    return ids


TEXT = st.text(st.sampled_from(list(" \n\t'strevmldéA1日!.\u3000\u0301🙂")), max_size=30)


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=8))
def test_ids_equal_those_of_the_library(encode, tokenizer, texts):
    assert encode(texts) == [tokenizer(t) for t in texts]


def brute_force_bins(lengths, capacity):
    room, bins = [], 0
    for length in sorted(lengths, reverse=True):
        i = bisect.bisect_left(room, length)
        left = room.pop(i) if i < len(room) else capacity
        bins += left == capacity
        bisect.insort(room, left - length)
    return bins


@pytest.mark.parametrize("capacity", [1, 5, 10, 64, 1024])
def test_ranges_pack_like_pieces_one_by_one(capacity):
    rng = random.Random(capacity)
    for _ in range(40):
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 200))]
        placed = best_fit_decreasing(dict(Counter(lengths)), capacity)
        bins = {}
        for p in placed:
            for i in range(p.count):
                bins.setdefault(p.sequence + i // p.each, []).append((p.offset + i % p.each * p.length, p.length))
        for pieces in bins.values():
            at = 0
            for offset, length in sorted(pieces):
                assert offset == at
                at += length
            assert at <= capacity
        assert sorted(x for b in bins.values() for _, x in b) == sorted(lengths)
        assert len(bins) == brute_force_bins(lengths, capacity)


def test_packed_pieces_are_the_documents(spark, sf_dir, tokenizer, odd_docs, no_docs):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = pack_documents(docs).toPandas().sort_values(["doc_id", "piece"])
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert set(found.doc_id) == set(texts)
    for doc, pieces in found.groupby("doc_id"):
        ids = np.array([*tokenizer(texts[doc]), END_ID], "<u4")
        assert b"".join(pieces.ids) == ids.tobytes()
        assert (pieces.length.iloc[1:] == 1024).all() and list(pieces.piece) == list(range(len(pieces)))
        assert list(pieces.start) == [0, *np.cumsum(pieces.length)[:-1]]
        assert [zlib.crc32(x) for x in pieces.ids] == list(pieces.ids_crc32)
    for _, pieces in found.sort_values("offset").groupby("sequence_id"):
        assert list(pieces.offset) == [0, *np.cumsum(pieces.length)[:-1]] and pieces.length.sum() <= 1024
    assert found.sequence_id.nunique() == brute_force_bins(list(found.length), 1024)
    odd = pack_documents(odd_docs).collect()
    assert sum(r.start == 0 for r in odd) == 13
    assert sorted(r.length for r in odd if r.doc_id in (3, 4)) == [1, 1]
    assert pack_documents(no_docs).count() == 0


PAGE = (
    '<html><body class="has-sidebar"><header><a href=/>Home</a></header><nav><a href=/a>menu</a></nav>'
    '<div class="page-with-sidebar">{}</div><aside>side</aside><div class="cookie-notice">We use cookies</div>'
    '<div class="ad">Buy</div><footer>foot</footer></body></html>'
)
PAGES = [
    ("", ""),
    ("plain", "plain"),
    ("<p>a&nbsp;b  c<p>d &amp; e", "a b c d & e"),
    (PAGE.format("<article><header><h1>T</h1></header><p>one\n two<b>three</b></p><p>four</article>"), "T one twothree four"),
    (PAGE.format('<article><p>Text</p><section id="comments"><p>A comment that is much longer than the text</p></section></article>'), "Text"),
    (PAGE.format("<article><p>Text</p><script>var a = '</article><p>no</p>'</script><form>Name <input></form><p>end</article>"), "Text end"),
    (
        '<div id="menu"><a href=1>one</a> <a href=2>two</a></div><div id="c"><p>A first paragraph with some words in it.</p>'
        "<p>A second paragraph, as long as the one before.</p></div>",
        "A first paragraph with some words in it. A second paragraph, as long as the one before.",
    ),
    ("<!-- x --><b>un<i>clo</b>sed</i> tail", "unclosed tail"),
    ("<p>1 < 2 & 3 > 2</p>", "1 < 2 & 3 > 2"),
    ("<div>" * 4000 + "deep", "deep"),
    ("<h1>Only</h1>text<br>more", "Only text more"),
    ("<style>p{}</style><script>x", ""),
]


STORY = "<p>A paragraph of the story with a good many words in it, so that it is dense enough to be read.</p>"
LINKS = "<ul>" + "".join(f"<li><a href=/{i}>Another story number {i}</a></li>" for i in range(5)) + "</ul>"
READ = STORY[3:-4]
#: Pages whose elements do not say what the article is: densities and the threshold do.
DENSE = [
    (f"<article><h1>T</h1>{STORY}{STORY}{LINKS}<p>end</p></article>", f"T {READ} {READ} end"),
    (f"<article><h1>T</h1>{STORY * 2}</article><article>{STORY * 2}</article><article><h2><a href=1>Teaser</a></h2><a href=1>more</a></article>",
     f"T {READ} {READ} {READ} {READ}"),
    (f"<div><a href=1>one</a><a href=2>two</a></div><div><h1>T</h1>{STORY}<p>Short.</p>{STORY}</div><div><a href=1>x</a> | <a href=2>y</a></div>",
     f"T {READ} Short. {READ}"),
    (f"<div>{STORY * 2}</div><article><p>Tiny.</p></article>", f"{READ} {READ}"),
    (f"<article><h2><a href=1>Linked title</a></h2>{STORY}<p><a href=2>One link</a></p></article>", f"Linked title {READ} One link"),
    ("<ul><li><a href=1>only</a><li><a href=2>links</a></ul>", "only links"),
]


@pytest.mark.parametrize(("body", "text"), DENSE)
def test_densities_choose_the_article(body, text):
    assert main_text(f"<html><body>{body}</body></html>") == text


@pytest.mark.parametrize(
    "page",
    ["<a '" * 20000, "<b <" * 20000, "<div>" * 20000, "<b>" * 20000 + "</x>" * 20000, "<div><table>" + "<b>" * 20000 + "</div>" * 20000,
     "<article>" * 20000, "<noscript>" * 20000, "<b>" * 10000 + "<p>" * 20000],
)
def test_broken_markup_takes_linear_time(page):
    begun = time.process_time()
    main_text(page)
    assert time.process_time() - begun < 3  # half a second, on a machine that has nothing else to do


def test_quotes_in_tags():
    assert main_text("<p title='a > b'>one</p><p title=\"c > d\">two</p>") == "one two"
    assert main_text("<p>one<p title='>two</p>") == "one two"
    assert main_text("<p>one <p title='two") == "one <p title='two"


@pytest.mark.parametrize(("page", "text"), PAGES)
def test_main_text(page, text):
    assert main_text(page) == text


def test_pages_of_the_table_give_their_article(spark, sf_dir):
    """Articles of the table, taken apart by their own marks."""
    import html
    import re

    rows = extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet")).collect()
    for r in rows:
        inside = re.search(r"<article>(.*?)</article>", r.html, re.DOTALL)[1]
        inside = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)\b[^>]*>", " ", inside))
        assert r._text == " ".join(html.unescape(inside).split())


def test_odd_pages(spark):
    pages = spark.createDataFrame([(None, None, "x"), (1, "", "y"), (1, "", "y")], "page_id int, html string, _text string")
    found = extract_text(pages)
    assert found.columns == ["page_id", "html", "_text"]
    assert [r._text for r in found.collect()] == ["", "", ""]
    assert extract_text(pages.limit(0)).count() == 0


def test_toxicity_on_documents_held_out(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit_toxicity(docs, labels)
    held = docs.join(labels, "doc_id").where(toxicity.held_out(docs["doc_id"]))
    rows = toxicity.score_toxicity(held, model).select("toxic", "_toxicity").toPandas()
    toxic, clean = rows[rows.toxic == 1]._toxicity, rows[rows.toxic == 0]._toxicity
    above = sum((clean < t).mean() for t in toxic) / len(toxic)
    # Some six in a hundred toxic labels of this small table stand on texts without any mark.
    assert len(toxic) > 50 and above > 0.94
    caught, flagged = (toxic >= toxicity.THRESHOLD).sum(), (rows._toxicity >= toxicity.THRESHOLD).sum()
    assert caught / len(toxic) > 0.65 and caught / flagged > 0.75


def test_held_out_labels_do_not_teach(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    held = [r.doc_id for r in labels.where(toxicity.held_out(labels["doc_id"])).collect()]
    assert held and all(zlib.crc32(str(i).encode()) % 4 == 2 for i in held)
    other = labels.where(~labels["doc_id"].isin(held))
    assert toxicity.fit_toxicity(docs, labels) == toxicity.fit_toxicity(docs, other)


def test_a_label_teaches_once(spark, sf_dir):
    """However many rows have its id, and whatever their texts are."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.select("doc_id", "text")
    again = docs.unionByName(docs).unionByName(docs.selectExpr("doc_id", "concat(text, ' again') AS text"))
    once = toxicity.teaching_rows(docs, labels)
    assert once.count() > 20
    assert toxicity.teaching_rows(again, labels).exceptAll(once).isEmpty() and once.exceptAll(toxicity.teaching_rows(again, labels)).isEmpty()


def test_toxicity_without_labels_and_on_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (8, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    for given_labels in (labels, labels.limit(0)):
        model = toxicity.fit_toxicity(odd_docs, given_labels)
        scored = toxicity.score_toxicity(odd_docs, model)
        assert scored.columns == [*odd_docs.columns, "_toxicity"]
        assert all(0 <= r._toxicity <= 1 for r in scored.collect())
        assert toxicity.score_toxicity(no_docs, model).count() == 0
    assert toxicity.fit_toxicity(no_docs, labels).weights[0] == -30.0
