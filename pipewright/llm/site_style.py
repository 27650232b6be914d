r"""HTML main-text extraction with a site style tree.

The pages of a host are merged into one tree.  A node of it is an element path:
tags with their class, id and role, and for a block without these whether it is the
first, the last or another of its kind under its parent (paragraphs, items, rows and
cells of a parent are one node).  On each page that has the
node, its presentation is the sequence of its child elements and its content the
words of its own text.
Node importance is the entropy, over the pages, of the presentations or of the
contents, whichever is larger, on a scale from 0 (the same everywhere) to 1
(different everywhere).  A branch is removed from a page if all nodes of it that
the page has are of low importance.

What HTML itself says comes before the statistics: elements that are navigation,
page header or footer, sidebar, form, script and so on, or that have a class, id or
role whose word says such a thing (menu, site-header, cookie_notice, commentList; not
widget-guide), are of importance 0; the article (or main) element is kept, as is what
holds it, and where a page has one, what stands outside it goes.  Within the article
the tree decides on every block: its heading and paragraphs stay as their contents
differ from page to page, lines that the host's articles share go.

Text: character references decoded; white space within a block is one space;
blocks, trimmed, in page order, joined by one line end.  Nothing else is dropped.

Defined results: null or empty html gives the empty text; unclosed, misnested
and cut-off markup is read as far as it goes; a null or odd url has the host "";
rows that repeat are each extracted; pages of a host with the same article (without
one: with the same html) count once in the statistics; a host with fewer than
``LEAST_PAGES`` different pages has no low nodes.  Very long and broken pages are read
in time that grows with their length; elements nested deeper than ``DEEPEST`` are read
as if they were empty and followed by what they hold.

Scale: pages are parsed twice and stay where they are; what is exchanged are
hashes of (host, node, feature), counted in each task first and spread by
feature, so a host with a third of all pages is no group; importance comes from
sums of such counts.  The low nodes of a host (bounded by its templates, not its
pages) are joined to its pages.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import sliced, stored, table

LOW, LEAST_PAGES = 0.2, 5

# fixed values of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math object select".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong "
                   "sub sup time tt u var wbr br img".split())
SAME_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table tr tbody thead tfoot div article section main body aside nav header footer form blockquote".split())
#: blocks that come in runs: one node for all of a kind under a parent
RUNS = frozenset("p li dt dd tr td th option thead tbody tfoot".split())
BOILERPLATE = frozenset("nav header footer aside form button input select menu dialog script style noscript template iframe svg math object head title".split())
MAIN = frozenset({"article", "main"})
PAGE = frozenset({"html", "body"})
# words of class, id and role that name what is not the article, in the singular
NAMES = frozenset("nav navbar navigation menu breadcrumb header masthead footer sidebar ad advert advertisement adbox banner sponsor sponsored promo "
                  "notice cookie consent gdpr popup modal newsletter subscribe signup login search form comment disqus reply replie respond share sharing "
                  "social related recommended widget copyright pagination pager skip complementary contentinfo alert alertdialog".split())
# those of them that also hold for an article by its tag, or after a word of ITS
REMARKS = frozenset("comment reply replie related advert sponsor sponsored promo".split())
# words that say where or in what shape: they name nothing by themselves
SHAPES = frozenset("site main page top bottom left right primary secondary global mobile desktop sticky fixed bar box list link item wrap wrapper container "
                   "inner outer section block area group row column col panel content button icon slot unit side to post article story storie media text title".split())
# words that say the rest is the article's own, or isn't there
ITS, NOT = frozenset({"post", "entry", "article"}), frozenset("no not has have with without hide hidden".split())

DEEPEST = 512
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_ATTRIBUTES = re.compile(r"[^>\"']*")
_NAME = re.compile(r"[a-zA-Z][^\s>/]*")
_LABEL = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


@lru_cache(1 << 14)
def named(label: str) -> tuple[bool, bool]:
    """(a class, id or role names what is not the article, or reader comments and the like)."""
    found = remarks = False
    for token in label.split():
        words = [w.lower() for w in _WORD.findall(token.rpartition("=")[2])]
        words = [w[:-1] if w.endswith("s") and w[:-1] in NAMES | SHAPES else w for w in words]
        if not words or words[0] in NOT:
            continue
        # the last word says what it is, unless all words only say where or in what shape something named is
        names = NAMES.intersection(words[-1:] if words[-1] not in SHAPES else words if NAMES.union(SHAPES).issuperset(words) else ())
        names |= NAMES & {"".join(words)}
        if words[0] in ITS:
            names &= REMARKS
        found |= bool(names)
        remarks |= bool(names & REMARKS)
    return found, remarks


class Node:
    __slots__ = ("tag", "label", "parent", "path", "children", "low", "main", "holds", "weak")

    def __init__(self, tag: str, label: str, parent: Node | None):
        self.tag, self.label, self.parent, self.path = tag, label, parent, 0
        self.children: list = []  # nodes and strings, in page order
        self.holds = self.weak = False  # holds an article; a branch of low importance
        found, remarks = named(label) if label else (False, False)
        if tag in MAIN or "role=main" in label.lower():
            self.low, self.main = remarks, not remarks
        else:
            self.main = False
            self.low = tag in BOILERPLATE or found and tag not in PAGE


def _start_tag(page: str, at: int, unclosed: dict[str, int]) -> int:
    """Where the attributes from ``at`` on end: at a > outside of quotes, or at the page's end.

    A quote that nothing closes is a character like others; ``unclosed`` remembers
    from where on there are none, so that no stretch is searched twice.
    """
    while True:
        at = _ATTRIBUTES.match(page, at).end()
        if at >= len(page) or page[at] == ">":
            return at
        quote = page[at]
        close = page.find(quote, at + 1) if at < unclosed.get(quote, len(page)) else -1
        if close < 0:
            unclosed[quote] = min(at, unclosed.get(quote, at))
        at = max(close, at) + 1


def parse(page: str) -> list[Node]:
    """The elements, whatever the markup is like: the root first, parents before children."""
    root = Node("", "", None)
    nodes, stack, at, end = [root], [root], 0, len(page)
    counts: dict[str, int] = {}  # open elements by tag
    unclosed: dict[str, int] = {}

    def cut(i: int) -> None:
        for n in stack[i:]:
            counts[n.tag] -= 1
        del stack[i:]

    def after(mark: str, start: int) -> int:
        found = page.find(mark, start)
        return end if found < 0 else found + len(mark)

    while at < end:
        start = page.find("<", at)
        if start < 0:
            start = end
        if start > at:
            stack[-1].children.append(page[at:start])
        if start == end:
            break
        mark = page[start + 1:start + 2]
        if mark in ("!", "?") and mark:
            at = after("-->", start + 4) if page.startswith("<!--", start) else after("]]>", start + 9) if page.startswith("<![CDATA[", start) else after(">", start)
            continue
        name = _NAME.match(page, start + 2 if mark == "/" else start + 1)
        if not name:
            stack[-1].children.append("<")
            at = start + 1
            continue
        tag = name[0].lower()
        if mark == "/":
            at = after(">", name.end())
            if counts.get(tag):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == tag:
                        cut(i)
                        break
                    if tag in INLINE and stack[i].tag in SCOPE:
                        break  # an inline end tag doesn't close the block around it
            continue
        stop = _start_tag(page, name.end(), unclosed)
        attributes, at = page[name.end():stop], min(stop + 1, end)
        _close_before(stack, tag, counts, cut)
        label = " ".join(f"{k.lower()}={a or b or c}" for k, a, b, c in _LABEL.findall(attributes)) if attributes else ""
        node = Node(tag, label, stack[-1])
        nodes.append(node)
        stack[-1].children.append(node)
        if node.main:
            above = node
            while above and not above.holds:
                above.holds = True
                above = above.parent
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            at = close.end() if close else end
        elif tag not in VOID and not attributes.endswith("/") and len(stack) < DEEPEST:
            stack.append(node)
            counts[tag] = counts.get(tag, 0) + 1
    _set_paths(nodes)
    return nodes


def _set_paths(nodes: list[Node]) -> None:
    for node in nodes:
        bare: dict[str, list[Node]] = {}
        for c in node.children:
            if type(c) is Node:
                if c.label or c.tag in INLINE or c.tag in RUNS:
                    c.path = xxhash.xxh64_intdigest(f"{node.path}>{c.tag} {c.label}")
                else:
                    bare.setdefault(c.tag, []).append(c)
        for tag, same in bare.items():
            places = {place: xxhash.xxh64_intdigest(f"{node.path}>{tag} {place}") for place in ("", "first", "last")}
            for c in same:
                c.path = places[""]
            same[-1].path = places["last"]
            same[0].path = places["first"]


def _close_before(stack: list[Node], tag: str, counts: dict[str, int], cut: Callable[[int], None]) -> None:
    """Ends the elements that a start tag ends without saying so: p before a block, li before li, ..."""
    if tag not in INLINE and counts.get("p"):
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag == "p":
                cut(i)
                break
            if stack[i].tag not in INLINE:
                break
    closed = SAME_CLOSES.get(tag, ())
    if any(counts.get(t) for t in closed):
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in closed:
                cut(i)
                break
            if stack[i].tag in SCOPE and not (tag in ("td", "th") and stack[i].tag == "tr"):
                break


def style(nodes: list[Node]) -> dict[int, tuple[int, int]]:
    """For each node path: (hash of the presentation, hash of the content) on this page."""
    shape, content = {}, {}
    for node in nodes[1:]:
        shape.setdefault(node.path, []).append(",".join(f"{c.tag} {c.label}" for c in node.children if type(c) is Node))
        content.setdefault(node.path, []).append(" ".join(c for c in node.children if type(c) is str))
    digest = lambda parts: xxhash.xxh64_intdigest(" ".join("|".join(parts).split())) >> 1
    return {p: (digest(shape[p]), digest(content[p])) for p in shape}


def article(page: str, nodes: list[Node]) -> int:
    """A hash of the words of the page's article elements, or of the page if it has none."""
    if not nodes[0].holds:
        return xxhash.xxh64_intdigest(page) >> 1
    words, inside = xxhash.xxh64(), set()
    for node in nodes:
        if node.main or id(node.parent) in inside:
            inside.add(id(node))
            words.update(" ".join(" ".join(c for c in node.children if type(c) is str).split()))
    return words.intdigest() >> 1


def text_of(page: str | None, low: frozenset | set = frozenset()) -> str:
    """The main text of a page; low: paths of low importance on its host."""
    if not page:
        return ""
    nodes = parse(page)
    root = nodes[0]
    only_main = root.holds
    # a branch is weak if all its nodes are of low importance, and none is the article; children come after parents
    for node in reversed(nodes) if low else ():
        node.weak = not node.main and node.path >> 1 in low and all(c.weak for c in node.children if type(c) is Node)
    blocks: list[str] = []
    now: list[str] = []

    def flush() -> None:
        block = " ".join(entities.unescape("".join(now)).split())
        if block:
            blocks.append(block)
        now.clear()

    # explicit stack: (node, inside the article); None marks the end of a block
    stack: list = [(root, not only_main)]
    while stack:
        node, inside = stack.pop()
        if node is None:
            flush()
        elif type(node) is str:
            if inside:
                now.append(node)
        else:
            if node.low and not node.holds or node.weak and inside and node.tag not in INLINE:
                if node.tag not in INLINE:
                    flush()
                continue
            if node.tag == "br":
                now.append(" ")
                continue
            if node.tag not in INLINE:
                flush()
                stack.append((None, False))
            stack.extend((c, inside or node.main) for c in reversed(node.children))
    flush()
    return "\n".join(blocks)


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def importance(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, path, n_pages, importance) of the nodes of each host's style tree.

    Importance: the larger of the entropies of presentations and of contents, in
    units of the logarithm of the number of different pages that have the node.
    """
    source = pages.select(host(F.col(url_col)).alias("host"), F.col(html_col).alias("html")).where("html <> ''")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "html"):
            hosts, pages_, paths, kinds, features = [], [], [], [], []
            for name, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                nodes = parse(page)
                copy = article(page, nodes)
                for path, found in style(nodes).items():
                    for kind in (0, 1):
                        hosts.append(name)
                        pages_.append(copy)
                        paths.append(path >> 1)
                        kinds.append(kind)
                        features.append(found[kind])
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(pages_, pa.int64()), pa.array(paths, pa.int64()), pa.array(kinds, pa.int32()),
                                              pa.array(features, pa.int64())], names=["host", "page", "path", "kind", "feature"])

    seen = source.mapInArrow(run, "host string, page long, path long, kind int, feature long")
    # pages of one article fall together; then pages per feature; then the sums the entropy is made of
    per_feature = seen.groupBy("host", "path", "kind", "feature", "page").agg(F.lit(1).alias("one")) \
        .groupBy("host", "path", "kind", "feature").agg(F.count(F.lit(1)).alias("n"))
    n = F.col("n").cast("double")
    return per_feature.groupBy("host", "path", "kind").agg(F.sum("n").alias("m"), F.sum(n * F.ln(n)).alias("s")) \
        .withColumn("entropy", F.when(F.col("m") < 2, 1.0).otherwise((F.ln("m") - F.col("s") / F.col("m")) / F.ln("m"))) \
        .groupBy("host", "path").agg(F.max("m").alias("n_pages"), F.max("entropy").alias("importance"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", low: float = LOW, least: int = LEAST_PAGES) -> DataFrame:
    """(page_id, url, text) of every row of ``pages``."""
    weak = importance(pages, url_col, html_col).where((F.col("importance") < low) & (F.col("n_pages") >= least))
    of_host = stored(weak.groupBy("host").agg(F.collect_set("path").alias("low")), "low-nodes")
    source = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host(F.col(url_col)).alias("host"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "html"):
            low_of = [frozenset(x or ()) for x in batch.column("low").to_pylist()]
            texts = [text_of(page, low) for page, low in zip(batch.column("html").to_pylist(), low_of, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    kind = source.schema["page_id"].dataType.simpleString()
    return source.join(of_host, "host", "left").select("page_id", "url", "html", "low").mapInArrow(run, f"page_id {kind}, url string, text string")


def op1_site_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))
