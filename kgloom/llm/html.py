"""Main text of web pages: site templates, then the article.

Pages are parsed into trees.  The subtrees of containers are hashed and counted per host in
Spark; one that recurs on TEMPLATE_PAGES pages of its host, each with other article text
around it, is template and is deleted, so copies of one article do not make it template.  What is left
loses menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader
comments by element or role, and by whole class names and ids; names that can also mean a part
of an article count only where most of the text is in links or there are controls.  Of main
and article elements the outermost with the page's main heading is the article, or all
outermost ones if none has it, or the page; stories inside it that are cards go.

Scale.  A page sends each distinct subtree hash once, with a hash of the text around it; these
are counted apart before hosts and hashes are, so a host with a third of all pages is no hot
key.  Templates are rows of host and hash.  Up to TEMPLATE_ROWS of them go to the workers;
beyond, they are joined to the pages' own hashes and only what a page has goes to it.

Paragraphs, headings, list items and table rows inside an article are never template: an
article may quote another.  Elsewhere an item is deleted if most of its list or row recurs.
Defined cases: null or empty html gives an empty text; a null url belongs to the host "";
unclosed elements close where the HTML rules imply it; repeated rows are separate pages.  Time
grows with the page: elements nested deeper than DEPTH stand beside their parent (no text goes),
a `<` without a `>` behind it is text, and text in links is summed up once.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tokens import tokens
from .common import slices, stored

TEMPLATE_PAGES = 10
TEMPLATE_ROWS = 50_000
# The deepest nesting that is kept.
DEPTH = 256

_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
_ITEMS = frozenset("li td th dt dd tr thead tbody tfoot".split())
_LEAVES = _ITEMS | frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote caption figcaption".split())
_PAGE = frozenset("html body article main".split())
_DROPPED = frozenset("head title script style noscript template nav header footer aside form button select option textarea input iframe object svg canvas dialog menu".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
# Whole class names and ids of what is not the article.
_CERTAIN = frozenset({
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "ad-container", "ad-slot", "ad-banner", "sponsored",
    "cookie", "cookies", "cookie-banner", "cookie-notice", "cookie-consent", "consent", "gdpr",
    "sidebar", "sidebars", "side-bar", "left-sidebar", "right-sidebar", "widget-area",
    "menu", "menus", "main-menu", "nav", "navbar", "main-nav", "navigation", "breadcrumb", "breadcrumbs", "pagination", "pager", "toolbar",
    "masthead", "site-header", "page-header", "site-footer", "page-footer",
    "comments", "comment-list", "commentlist", "comments-area", "comment-form", "comment-section", "disqus", "disqus-thread",
    "share-buttons", "social-share", "social-links", "social-icons", "sharing",
    "related-posts", "related-articles", "newsletter-signup", "subscribe-form", "search-form", "login-form", "popup", "modal",
})
# Names, and parts of names, that need support.
_LIKELY = frozenset({
    "banner", "promo", "promotion", "sponsor", "notice", "notices", "alert", "widget", "widgets", "header", "footer", "copyright", "disclaimer",
    "comment", "discussion", "replies", "share", "social", "related", "recommended", "newsletter", "subscribe", "subscription", "login", "search", "form",
})
_CARDS = frozenset({"card", "teaser", "comment", "related", "recommended", "promo", "post-preview"})
_CONTROLS = frozenset({"form", "button", "input", "select", "textarea", "option", "label"})
# A start tag of the key closes an open element of the value.
_CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
}
_SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "tbody": {"table"}, "tfoot": {"table"}, "option": {"select"}}
_SPLIT = re.compile(r"[^a-z0-9]+")


class Node:
    """`holds`: it has a page's main heading or main part inside, so its class cannot drop it.
    text, linked, controls: characters inside, those in links, and whether there are controls."""

    __slots__ = ("attributes", "controls", "hash", "holds", "linked", "parts", "tag", "text")

    def __init__(self, tag: str, attributes: str = "") -> None:
        self.tag, self.attributes, self.parts, self.hash, self.holds = tag, attributes, [], 0, False
        self.text, self.linked, self.controls = -1, 0, False


class _Builder:
    """Open elements, counted by tag.  What is nested deeper than DEPTH stands beside its parent, and
    its end tag closes nothing."""

    def __init__(self) -> None:
        self.root = Node("#")
        self.stack, self.open, self.owed = [self.root], Counter(), Counter()

    def leave(self, at: int) -> None:
        """Close the elements from place `at` on."""
        self.open.subtract(n.tag for n in self.stack[at:])
        del self.stack[at:]

    def close(self, tags: set[str], scope: set[str]) -> None:
        if not any(self.open[t] for t in tags):
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag in tags:
                self.leave(i)
                return
            if self.stack[i].tag in scope:
                return

    def end(self, tag: str) -> None:
        if self.owed[tag]:
            self.owed[tag] -= 1
        elif self.open[tag]:
            at = len(self.stack) - 1
            while self.stack[at].tag != tag:
                at -= 1
            self.leave(at)

    def start(self, tag: str, attributes: str) -> None:
        if tag not in _INLINE and tag != "br":
            self.close({"p"}, {"table", "td", "th", "button", "object"})
        if tag in _CLOSES:
            for _ in range(2 if tag in ("tr", "tbody", "tfoot") else 1):
                self.close(_CLOSES[tag], _SCOPES[tag])
        empty = tag in _VOID or attributes.endswith("/")
        if not empty and len(self.stack) > DEPTH:
            self.owed[self.stack[-1].tag] += 1
            self.leave(len(self.stack) - 1)
        node = Node(tag, attributes)
        self.stack[-1].parts.append(node)
        if tag in ("h1", "main"):
            for above in reversed(self.stack):
                if above.holds:
                    break
                above.holds = True
        if not empty:
            self.stack.append(node)
            self.open[tag] += 1


def parse(page: str) -> Node:
    """The page's tree: parts of a node are strings (character references decoded) and nodes."""
    builder, raw = _Builder(), False
    for kind, what, rest in tokens(page, _RAW):
        if kind == "start":
            builder.start(what, rest)
            raw = what in _RAW
        elif kind == "end":
            builder.end(what)
            raw = False
        elif not raw:  # the content of these elements is no text of the page
            builder.stack[-1].parts.append(what)
    return builder.root


def measured(root: Node) -> None:
    """Sum up text, linked and controls from the leaves, once."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [p for p in node.parts if isinstance(p, Node)]
    for node in reversed(order):
        node.text, node.linked, node.controls = 0, 0, False
        for p in node.parts:
            if isinstance(p, str):
                node.text += sum(map(len, p.split()))
            else:
                node.text += p.text
                node.linked += p.text if p.tag == "a" else p.linked
                node.controls = node.controls or p.controls or p.tag in _CONTROLS


def hashed(root: Node) -> None:
    """Give every node the hash of its subtree: tag, words and children."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [p for p in node.parts if isinstance(p, Node)]
    for node in reversed(order):
        inside = "\x01".join(f"\x02{p.hash:x}" if isinstance(p, Node) else " ".join(p.split()) for p in node.parts)
        node.hash = xxhash.xxh64_intdigest(f"{node.tag}\x03{inside}") - (1 << 63)


def containers(root: Node) -> Iterator[Node]:
    """Nodes that can be template: not the page's frame, not inline, no paragraph of an article."""
    todo = [(root, False)]
    while todo:
        node, inside = todo.pop()
        tag = node.tag
        if node is not root and tag not in _PAGE and tag not in _INLINE and tag not in _VOID and not (inside and tag in _LEAVES) and node.parts:
            yield node
        inside = inside or tag in ("article", "main")
        todo += [(p, inside) for p in node.parts if isinstance(p, Node)]


def _dense(node: Node) -> bool:
    """Controls, or over half of the text in links."""
    if node.text < 0:
        measured(node)
    return node.controls or 2 * node.linked > node.text


def _names(node: Node) -> set[str]:
    """Whole class names and ids."""
    return {w for m in _ATTRIBUTE.finditer(node.attributes) if m[1].lower() in ("class", "id") for w in (m[2] or m[3] or m[4] or "").lower().replace("_", "-").split()}


def _unwanted(node: Node, inside: bool) -> bool:
    if node.tag in _DROPPED:
        return not (node.tag == "header" and inside and any(isinstance(p, Node) and p.tag in ("h1", "h2") for p in node.parts))
    if not node.attributes or node.holds or node.tag in ("html", "body", "main"):
        return False
    for m in _ATTRIBUTE.finditer(node.attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if (name == "role" and value.strip() in _ROLES) or name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style" and "display:none" in value.replace(" ", ""):
            return True
    names = _names(node)
    if names & _CERTAIN or (inside and node.tag == "article" and names & _CARDS):
        return True
    return any(w in _LIKELY or w in _CERTAIN for n in names for w in _SPLIT.split(n)) and _dense(node)


def _articles(root: Node, template: frozenset) -> list[Node]:
    """The outermost main or article element with the first main heading; without one, all
    outermost article elements, else main, else the whole page."""
    found, heading, todo = [], None, [(root, None)]
    while todo:
        node, top = todo.pop()
        if node.tag in ("main", "article") and not (top and top.tag == "main" and node.tag == "main"):
            if top is None:
                found.append(node)
            top = top or node
        if node.tag == "h1" and heading is None and top is not None:
            heading = top
        todo += [(p, top) for p in reversed(node.parts) if isinstance(p, Node) and p.hash not in template and not _unwanted(p, top is not None)]
    if heading is not None:
        return [heading]
    return [n for n in found if n.tag == "article"] or found or [root]


def _recurring(root: Node, template: frozenset) -> set[int]:
    """Ids of the nodes to delete; items only where most of their parent's items recur."""
    found = {id(n): n for n in containers(root) if n.hash in template}
    items = {i for i, n in found.items() if n.tag in _ITEMS}
    todo = [root] if items else []
    while todo:
        node = todo.pop()
        below = [p for p in node.parts if isinstance(p, Node)]
        todo += below
        mine = [p for p in below if p.tag in _ITEMS and p.parts]
        if 2 * sum(id(p) in items for p in mine) <= len(mine):
            for p in mine:
                found.pop(id(p), None)
    return set(found)


def around(root: Node) -> tuple[int, dict[int, int]]:
    """A sum of hashes of the article's texts, and the part of it in each node (0 if not there)."""
    order, within = [], {}
    for article in _articles(root, frozenset()):
        todo = [article]
        while todo:
            node = todo.pop()
            order.append(node)
            within[id(node)] = sum(xxhash.xxh64_intdigest(" ".join(p.split())) for p in node.parts if isinstance(p, str) and not p.isspace())
            todo += [p for p in node.parts if isinstance(p, Node) and not _unwanted(p, True)]
    for node in reversed(order):
        within[id(node)] += sum(within.get(id(p), 0) for p in node.parts if isinstance(p, Node))
    # Above an article, a node has what its articles have.
    above, todo = [], [root]
    while todo:
        node = todo.pop()
        if id(node) not in within:
            above.append(node)
            todo += [p for p in node.parts if isinstance(p, Node)]
    for node in reversed(above):
        within[id(node)] = sum(within[id(p)] for p in node.parts if isinstance(p, Node))
    return within[id(root)], within


def main_text(root: Node, template: frozenset = frozenset()) -> str:
    """Blocks of the article, joined by an empty line."""
    blocks, words = [], []

    def end() -> None:
        text = " ".join("".join(words).split())
        words.clear()
        if text:
            blocks.append(text)

    allowed = _recurring(root, template) if template else set()
    for article in _articles(root, template):
        todo: list = [article]
        while todo:
            part = todo.pop()
            if part is None:
                end()
            elif isinstance(part, str):
                words.append(part)
            elif part.tag == "br":
                words.append(" ")
            elif id(part) not in allowed and not (part is not article and _unwanted(part, True)):
                if part.tag in _INLINE:
                    todo += reversed(part.parts)
                else:
                    end()
                    todo += [None, *reversed(part.parts)]
        end()
    return "\n\n".join(blocks)


def _host() -> F.Column:
    return F.coalesce(F.lower(F.regexp_extract(F.col("url").cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def _key(host: str, page: str | None) -> int:
    return xxhash.xxh64_intdigest(f"{host}\x00{page or ''}") - (1 << 63)


def _seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The subtrees of each page, with the page and the article's text around them as hashes."""
    for batch in slices(batches):
        keys, hosts, hashes, texts = [], [], [], []
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            root = parse(page or "")
            hashed(root)
            total, within = around(root)
            found: dict = {}
            for n in containers(root):
                found[n.hash] = found.get(n.hash, 0) + within[id(n)]
            keys += [_key(host, page)] * len(found)
            hosts += [host] * len(found)
            hashes += found
            texts += [(total - part) % (1 << 64) - (1 << 63) for part in found.values()]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(hosts, pa.string()), pa.array(hashes, pa.int64()), pa.array(texts, pa.int64())], names=["page", "host", "hash", "around"])


def subtrees(pages: DataFrame) -> DataFrame:
    """page, host, hash, around: each distinct subtree of each page."""
    rows = pages.select(_host().alias("host"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(_seen, "page long, host string, hash long, around long")


def templates(pages: DataFrame, least: int = TEMPLATE_PAGES) -> DataFrame:
    """host, hash: the subtrees that `least` different article texts of the host have around them."""
    apart = subtrees(pages).select("host", "hash", "around").distinct()
    return apart.groupBy("host", "hash").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("host", "hash")


def _extracted(of: dict[str, frozenset] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = []
            own = batch.column(3).to_pylist()
            for page, mine in zip(batch.column(2).to_pylist(), own, strict=True):
                root = parse(page or "")
                template = frozenset(mine or ()) if of is None else of.get(mine, frozenset())
                if template:
                    hashed(root)
                texts.append(main_text(root, template))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return run


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        keys = [_key(host, page) for page, host in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.int64())], names=["page_id", "url", "html", "host", "page"])


def extract(pages: DataFrame, least: int = TEMPLATE_PAGES, few: int = TEMPLATE_ROWS) -> DataFrame:
    """page_id, url, text, n_chars: one row per row of pages; `few` does not change them."""
    found = stored(templates(pages, least), "templates")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"), _host().alias("host"))
    made = "page_id long, url string, text string, n_chars long"
    if found.count() <= few:
        of: dict = {}
        for r in found.collect():
            of.setdefault(r["host"], set()).add(r["hash"])
        return rows.mapInArrow(_extracted({k: frozenset(v) for k, v in of.items()}), made)
    own = subtrees(pages).join(found, ["host", "hash"], "left_semi").groupBy("page").agg(F.collect_set("hash").alias("hashes"))
    keyed = rows.mapInArrow(_keyed, "page_id long, url string, html string, host string, page long")
    return keyed.join(own, "page", "left").select("page_id", "url", "html", "hashes").mapInArrow(_extracted(None), made)
