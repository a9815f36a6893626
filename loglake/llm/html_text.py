"""Main text of web pages by composite text density.

A page becomes a tree of elements. Of each, the composite density is the number of characters
a tag carries, adjusted for how much of them are link text; a node's score is the sum of its
children's densities, and the node with the largest score holds the article. The threshold is the
least density on the path from the body to that node: what is at least as dense belongs to the article too,
and lists of links that fall below it do not.

What a page marks as something else (navigation, forms, comments, notices, ...) goes first,
by element and by the words of its class and id.
"""

import html
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglake.llm.keys import plain

#: Fixed values of HTML: elements without content, with text that is not markup, that start a
#: new block, and what ends an open element of another kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol optgroup option p pre search section "
    "summary table tbody td tfoot th thead tr ul".split()
)
ENDED_BY = {
    "p": BLOCKS - {"br", "body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "optgroup"},
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "option": {"option", "optgroup"},
    "tr": {"tr", "tbody", "tfoot", "thead"},
    "td": {"td", "th", "tr", "tbody", "tfoot", "thead"},
    "th": {"td", "th", "tr", "tbody", "tfoot", "thead"},
    "head": {"body"},
}
#: An open element of these kinds keeps the end tags inside it from closing what is outside.
SCOPES = frozenset("html body table td th caption button object template".split())
#: Elements that are never part of an article.
OUTSIDE = frozenset(
    "aside audio button canvas dialog embed footer form head iframe input label menu nav noscript object option "
    "script select style svg template textarea title video".split()
)
#: Words of a class, id or role that say what is not the article.
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
    "commentlist consent cookie cookies disqus footer gdpr masthead menu menubar modal nav navbar navigation newsletter "
    "notice notification popup promo promoted promotion recommended related replies reply respond rss share sharing "
    "shoutbox sidebar sitemap skip skyscraper social sponsor sponsored subscribe subscription subnav teaser toolbar "
    "topbar widget widgets complementary contentinfo search alert alertdialog disclaimer paywall signup".split()
)
#: Asides outside an article, titles and the like within one.
HEADER_WORDS = frozenset("header head hero top".split())
ARTICLES = ("article", "main")
#: Blocks that hold a paragraph of an article, not an article.
PARAGRAPHS = frozenset("address blockquote br caption dd dt figcaption figure h1 h2 h3 h4 h5 h6 hr li p pre summary td th tr".split())
_NAME = re.compile(r"</?([A-Za-z][^\s/>]*)")
_PLAIN = re.compile(r"[^>\"']*")
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|style|aria-hidden|itemprop)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?(?=[\s/]|$)", re.IGNORECASE)
_WORDS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"([a-z])([A-Z])")
_SPACE = re.compile(r"\s+")


class Node:
    """An element: its name, attributes that matter, and children, text among them."""

    __slots__ = ("name", "aside", "children", "chars", "tags", "link_chars", "link_tags", "density", "score")

    def __init__(self, name: str, aside: bool = False) -> None:
        self.name, self.aside, self.children = name, aside, []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.score = 0.0


def _is_aside(name: str, attributes: str, in_article: bool) -> bool:
    """Whether an element says it is no part of an article."""
    if name in OUTSIDE or (name == "header" and not in_article):
        return True
    if not attributes or name in ("html", "body", "main"):
        return False
    for key, *values in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), "".join(values)
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return True
        if key == "style":
            if re.search(r"display\s*:\s*none", value):
                return True
        else:
            words = set(_WORDS.findall(_CAMEL.sub(r"\1 \2", html.unescape(value)).lower()))
            if words & ASIDE_WORDS or (words & HEADER_WORDS and not in_article):
                return True
    return False


class _Tags:
    """Tags and comments of a page in one forward scan: (start, end, closing, name, attributes), name None for what is no tag.

    A quoted `>` does not end a tag. Once a tag is open to the end of the page, its quotes are broken: from
    there on the next `>` ends a tag, quoted or not.
    """

    def __init__(self, page: str) -> None:
        self.page, self.quotes = page, True

    def _end(self, at: int) -> int:
        """Where the tag whose attributes begin at `at` has its `>`; -1 if nowhere."""
        page, begin = self.page, at
        while self.quotes:
            at = _PLAIN.match(page, at).end()
            if at < len(page) and page[at] == ">":
                return at
            closed = page.find(page[at], at + 1) if at < len(page) else -1
            self.quotes = closed >= 0
            at = closed + 1
        return page.find(">", begin)

    def after(self, at: int) -> tuple[int, int, bool, str | None, str] | None:
        """The first tag or comment that starts at `at` or behind it."""
        page = self.page
        while (at := page.find("<", at)) >= 0:
            if page.startswith("<!--", at) or page.startswith("<![CDATA[", at):
                last = "-->" if page.startswith("<!--", at) else "]]>"
                end = page.find(last, at + 4)
                return at, end + 3 if end >= 0 else len(page), False, None, ""
            if page[at + 1 : at + 2] in ("!", "?"):
                return at, page.find(">", at) + 1 or len(page), False, None, ""
            name = _NAME.match(page, at)
            if name:
                end = self._end(name.end())
                if end < 0:  # no further tag ends
                    return None
                return at, end + 1, page[at + 1] == "/", name[1].lower(), page[name.end() : end]
            at += 1
        return None


class _Open:
    """The open elements, the innermost last, and where those of a kind are among them."""

    def __init__(self, root: Node) -> None:
        self.stack, self.places = [root], {}

    def push(self, node: Node) -> None:
        for kind in self._kinds(node.name):
            self.places.setdefault(kind, []).append(len(self.stack))
        self.stack.append(node)

    def cut(self, depth: int) -> None:
        """Closes the element at a depth and all inside it."""
        while len(self.stack) > depth:
            for kind in self._kinds(self.stack.pop().name):
                self.places[kind].pop()

    def last(self, kind: str) -> int:
        """Depth of the innermost element of a name or kind; 0 if none is open."""
        places = self.places.get(kind)
        return places[-1] if places else 0

    @staticmethod
    def _kinds(name: str) -> Iterator[str]:
        yield name
        if name in SCOPES:
            yield "*scope"
        if name in BLOCKS or name == "head":
            yield "*block"
        if name in ARTICLES:
            yield "*article"


def parse(page: str) -> Node:
    """The tree of a page, in time linear in its size. Missing and misplaced end tags are mended as browsers do."""
    root = Node("html")
    tags, opened = _Tags(page), _Open(root)
    holding: set[int] = set()  # elements known to hold an article
    unclosed: set[str] = set()
    at = 0
    while found := tags.after(at):
        start, stop, closing, name, attributes = found
        if start > at:
            opened.stack[-1].children.append(page[at:start])
        at = stop
        if name is None:
            continue
        if closing:
            depth = opened.last(name)
            if depth and (depth >= opened.last("*scope") or name in ("table", "body", "html", "tr", "tbody")):
                opened.cut(depth)
            continue
        if name == "html" or (name == "body" and opened.last("body")):
            continue
        if name in BLOCKS or name in ENDED_BY:
            depth = opened.last("*block")
            if depth and name in ENDED_BY.get(opened.stack[depth].name, ()):
                opened.cut(depth)
        node = Node(name, _is_aside(name, attributes, opened.last("*article") > 0))
        if name in ARTICLES and not node.aside:
            for outer in reversed(opened.stack):  # what holds an article is no aside, whatever its class says
                if id(outer) in holding:
                    break
                holding.add(id(outer))
                outer.aside = outer.aside and outer.name in OUTSIDE
        opened.stack[-1].children.append(node)
        if name in RAW:
            end = None if name in unclosed else re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.IGNORECASE).search(page, at)
            if end:
                node.children.append(page[at : end.start()])
                at = page.find(">", end.start()) + 1 or len(page)
            elif name == "noscript":
                unclosed.add(name)
            else:
                node.children.append(page[at:])
                at = len(page)
        elif name not in VOID and (name in BLOCKS or not attributes.rstrip().endswith("/")):
            opened.push(node)
    if at < len(page):
        opened.stack[-1].children.append(page[at:])
    return root


def _order(root: Node) -> list[Node]:
    """All nodes that may be article, parents before children, without recursion."""
    found, todo = [], [root]
    while todo:
        node = todo.pop()
        found.append(node)
        todo.extend(c for c in node.children if isinstance(c, Node) and not c.aside)
    return found


def _density(chars: int, tags: int, link_chars: int, link_tags: int, page_links: float) -> float:
    """Composite text density: characters per tag, less where they are links."""
    if not chars:
        return 0.0
    tags, links, link_tags, plain = max(tags, 1), max(link_chars, 1), max(link_tags, 1), max(chars - link_chars, 1)
    base = math.log(chars * link_chars / plain + page_links * chars + math.e)
    return chars / tags * math.log(chars * tags / (links * link_tags) + 1) / math.log(base + math.e - 1)


def measure(body: Node) -> list[Node]:
    """Counts, composite densities and density sums of all nodes, in page order.

    Text beside elements counts in the sum of its node like an element that holds it.
    """
    order = _order(body)
    for node in reversed(order):
        for child in node.children:
            if isinstance(child, str):
                node.chars += len(_SPACE.sub(" ", child).strip())
            elif not child.aside:
                node.chars += child.chars
                node.tags += child.tags + 1
                node.link_chars += child.link_chars
                node.link_tags += child.link_tags + (child.name == "a")
        if node.name == "a":
            node.link_chars = node.chars
    page_links = body.link_chars / body.chars if body.chars else 0.0
    for node in reversed(order):
        node.density = _density(node.chars, node.tags, node.link_chars, node.link_tags, page_links)
        node.score = sum(c.density for c in node.children if isinstance(c, Node) and not c.aside)
        own = sum(len(_SPACE.sub(" ", c).strip()) for c in node.children if isinstance(c, str))
        node.score += _density(own, 1, own if node.name == "a" else 0, int(node.name == "a"), page_links)
    return order


def content_nodes(body: Node) -> tuple[set[int], set[int]]:
    """Ids of the nodes whose subtrees are the article, and of nodes in them that are not.

    The node with the largest sum is the densest part. If it is no more than a paragraph, what
    holds the paragraph is taken, and with it an article element around. The least density on
    the path from the densest part to the body is the threshold. Of every other node at least
    as dense, the subtree with the largest sum belongs to the article too, whatever it is in; lists of
    links below the threshold do not, wherever they are.
    """
    order = measure(body)
    best = max(order, key=lambda n: n.score)
    parents = {id(c): n for n in order for c in n.children if isinstance(c, Node)}
    path = [best]
    while id(path[-1]) in parents:
        path.append(parents[id(path[-1])])
    threshold = min(n.density for n in path)
    holder = next((n for n in path if n.name in BLOCKS and n.name not in PARAGRAPHS), path[-1])
    around = next((n for n in path if n.name in ARTICLES), holder)
    largest: dict[int, Node] = {}
    for node in reversed(order):  # children first
        below = (largest[id(c)] for c in node.children if isinstance(c, Node) and not c.aside)
        largest[id(node)] = max([node, *below], key=lambda n: n.score)
    wanted = {id(n) for n in (best, holder, around)}
    wanted |= {id(largest[id(n)]) for n in order if n.density >= threshold and n.density}
    held = {id(n) for n in path} | wanted
    lists = {
        id(n)
        for n in order
        if n.name in BLOCKS and id(n) not in held and n.link_tags > 1 and 2 * n.link_chars > n.chars and n.density < threshold
    }
    return wanted, lists


def main_text(page: str) -> str:
    """The article of a page; empty if there is none."""
    if not page:
        return ""
    root = parse(page)
    body = next((n for n in _order(root) if n.name == "body"), root)
    wanted, lists = content_nodes(body)
    blocks, current = [], []

    def end() -> None:
        block = _SPACE.sub(" ", html.unescape("".join(current))).strip()
        if block:
            blocks.append(block)
        current.clear()

    todo: list = [(body, False)]
    while todo:
        item, inside = todo.pop()
        if item is None:
            end()
        elif isinstance(item, str):
            if inside:
                current.append(item)
        elif not item.aside:
            inside = (inside and id(item) not in lists) or id(item) in wanted
            if item.name in BLOCKS:
                end()
                todo.append((None, inside))
            todo.extend((c, inside) for c in reversed(item.children))
    end()
    return " ".join(blocks)


def _extract(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in pages:
        yield batch.map(main_text)


def extract_text(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """The pages with a column `_text`, the main text of the whole html; missing html is empty.

    Character references are decoded, white space inside a block is one space, blocks are
    joined in page order by one space. Plain columns stay as they are (see keys.plain), repeated
    rows too.
    """
    run = F.pandas_udf(_extract, "string")
    return plain(pages).withColumn("_text", run(F.coalesce(F.col(html_column), F.lit(""))))
