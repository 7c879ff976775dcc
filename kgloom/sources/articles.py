"""HTML pages to articles, glossaries and tables of contents.

One Python pass per page builds the tree once and returns a wide row; everything after is
DataFrame work.  `Site` holds what belongs to one web site.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import urljoin, urlparse

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import text
from ..model import ARTICLE_RECORD
from . import markdown
from .dom import Element, has_class, parse


@dataclass(frozen=True)
class Site:
    """Brand domain, title suffixes, and the shape of the guide's URLs and glossary."""

    domain: str = "example.com"
    suffixes: tuple[str, ...] = ()
    guide: str = "/guide/"


# Elements without text, promotional classes, links and texts.
EMPTY_TAGS = frozenset({
    "style", "script", "noscript", "svg", "object", "embed", "canvas", "map", "audio", "video", "source", "track", "template",
})
PROMO_CLASS = r"avia-buttonrow|avia-button(?!-no)"
PROMO_LINK = re.compile(r"/trial/|/demo/|/pricing/|/contact/|/request/|#form", re.I)
PROMO_TEXT = re.compile(r"free\s+\d+-day\s+trial|book\s+a\s+demo|request\s+a\s+demo|ready\s+to\s+find\s+out\s+more|get\s+started\s+today|schedule\s+a\s+demo|contact\s+us\s+today", re.I)
CONTENT_SELECTORS = ("article", ".post-content", ".entry-content", ".content-area", "main", "#main-content", ".main-content")
VIDEO_ID = re.compile(r"(?:youtube\.com/embed/|youtube\.com/watch\?v=|youtu\.be/)([A-Za-z0-9_-]+)")
STOP_WORDS = frozenset({
    "the", "a", "an", "and", "or", "but", "in", "on", "at", "to", "for", "of", "is", "are", "was", "were", "be", "been", "being", "have", "has",
    "had", "do", "does", "did", "will", "would", "could", "should", "may", "might", "must", "shall", "can", "need", "dare", "ought", "used", "how",
    "what", "why", "when", "where", "who", "which", "whom", "whose", "that", "this", "these", "those", "it", "its", "you", "your", "we", "our",
    "they", "their", "i", "my", "me", "he", "she", "him", "her", "his", "with", "from", "by", "about", "into", "through", "during", "before",
    "after", "above", "below", "between", "under", "again", "further", "then", "once",
})
MAX_CONCEPTS, SHORT, LONG, LEAST_TITLE = 20, 2, 50, 10


def title(page: Element, site: Site) -> str:
    """The first h1, else the title without the site's suffixes, else Untitled."""
    if head := page.first("h1"):
        return head.text()
    if tag := page.first("title"):
        out = tag.text()
        for suffix in site.suffixes:
            out = out.removesuffix(suffix)
        return out
    return "Untitled"


def is_promotion(section: Element) -> bool:
    """A call to action: a button, a trial or demo link, or such a text or heading."""
    words = section.text()
    if "RELATED ARTICLE" in words.upper():
        return False
    links = (e.attrs["href"] for e in section.all("a") if "href" in e.attrs)
    return bool(
        section.where(lambda e: has_class(e, r"avia-button(?!-no)"))
        or any("/blog/" not in h and PROMO_LINK.search(h) for h in links)
        or PROMO_TEXT.search(words)
        or any(p in h.text().lower() for h in section.all("h2", "h3", "h4") for p in ("find out more", "book a demo", "get started"))
    )


def _select(page: Element, selector: str) -> Element | None:
    test = {".": lambda e: selector[1:] in e.classes, "#": lambda e: e.attrs.get("id") == selector[1:]}.get(selector[0], lambda e: e.tag == selector)
    return next(iter(page.where(test)), None)


def content(page: Element) -> Element | None:
    """The second inner cell less a promotional last section, the second cell, the first of
    the usual selectors, or the body."""
    inner = page.where(lambda e: "flex_cell_inner" in e.classes)
    if len(inner) >= 2:
        sections = [c for c in inner[1].children if isinstance(c, Element) and c.tag == "section"]
        if sections and is_promotion(sections[-1]):
            sections[-1].remove()
        return inner[1]
    cells = page.where(lambda e: "flex_cell" in e.classes)
    if len(cells) >= 2:
        return cells[1]
    return next((e for s in CONTENT_SELECTORS if (e := _select(page, s))), None) or page.first("body")


def clean(root: Element) -> None:
    """Drop elements without text, hidden ones, and promotional buttons and links."""
    hidden = lambda e: "display:none" in e.attrs.get("style", "").replace(" ", "").lower()
    promo = lambda e: has_class(e, PROMO_CLASS) and (e.tag != "a" or PROMO_LINK.search(e.attrs.get("href", "")))
    Element.remove_all(root.where(lambda e: e.tag in EMPTY_TAGS or hidden(e) or bool(promo(e))))


def cross_references(root: Element, url: str, site: Site) -> list[dict]:
    out = []
    for a in root.all("a"):
        href = a.attrs.get("href", "")
        image = a.first("img")
        words = a.text() or (image and (image.attrs.get("title") or image.attrs.get("alt"))) or ""
        if not href or not words or href.startswith(("#", "javascript:")):
            continue
        full = urljoin(url, href)
        place = urlparse(full)
        internal = place.netloc == urlparse(url).netloc or site.domain in place.netloc
        section = None
        if internal and site.guide in place.path:
            parts = [p for p in place.path.split(site.guide, 1)[1].split("/") if p]
            section = f"{parts[0]}/{parts[1] if len(parts) > 1 else 'overview'}" if parts else None
        out.append({"text": words, "url": full, "is_internal": internal, "section_id": section})
    return out


def images(root: Element, url: str) -> list[dict]:
    """Images distinct by source, with the nearest heading before them."""
    out, seen, heading = [], set(), None
    for e in root.walk():
        if e.tag in ("h2", "h3", "h4"):
            heading = e
        if e.tag != "img":
            continue
        src = e.attrs.get("src", "")
        if not src or src.startswith("data:"):
            src = e.attrs.get("data-src") or e.attrs.get("data-lazy-src") or ""
        full = urljoin(url, src)
        if not src or full in seen:
            continue
        seen.add(full)
        figure = e.closest("figure")
        caption = figure.first("figcaption") if figure else None
        out.append({"src": full, "alt": e.attrs.get("alt"), "title": e.attrs.get("title"), "caption": caption.text() if caption else None, "context": heading.text() if heading else None})
    return out


def videos(root: Element) -> list[dict]:
    found = [m[1] for e in root.all("iframe", "a") if (m := VIDEO_ID.search(e.attrs.get("src") or e.attrs.get("href") or ""))]
    return [{"video_id": v, "url": f"https://www.youtube.com/watch?v={v}"} for v in dict.fromkeys(found)]


def _column_before(e: Element) -> Element | None:
    """The column left of the one that e stands in."""
    own = e if "div" == e.tag and has_class(e, "flex_column") else e.closest_where(lambda x: x.tag == "div" and has_class(x, "flex_column"))
    if own is None or own.parent is None:
        return None
    before = own.parent.children[: next(i for i, c in enumerate(own.parent.children) if c is own)]
    return next((c for c in reversed(before) if isinstance(c, Element) and c.tag == "div" and has_class(c, "flex_column")), None)


def _announcements(root: Element, tags: tuple[str, ...]) -> list[tuple[Element, Element]]:
    """(element with the announcement, column with the webinar's link) pairs."""
    out = []
    for e in root.where(lambda e: any(isinstance(c, str) and "in this webinar" in c.lower() for c in e.children)):
        holder, column = e if e.tag in tags else e.closest(*tags), _column_before(e)
        if holder is not None and column is not None:
            out.append((holder, column))
    return out


def _is_webinar(href: str, site: Site) -> bool:
    return f"{site.domain}/webinar/" in href.lower()


def webinars(root: Element, url: str, site: Site) -> list[dict]:
    """Links to webinars, distinct by URL.  Title: the link's text, its image's title or alt
    text, the URL's last part, the first sentence of the next paragraph."""
    described = {}
    for holder, column in _announcements(root, ("h3", "h4", "p", "div")):
        link = next((a for a in column.all("a") if _is_webinar(a.attrs.get("href", ""), site)), None)
        if link is not None:
            described[urljoin(url, link.attrs["href"])] = holder.text()
    out, seen, heading = [], set(), None
    for e in root.walk():
        if e.tag in ("h2", "h3", "h4"):
            heading = e
        href = e.attrs.get("href", "") if e.tag == "a" else ""
        full = urljoin(url, href)
        if not _is_webinar(href, site) or full in seen:
            continue
        seen.add(full)
        image, name, thumbnail = e.first("img"), e.text(), None
        if image:
            picture = image.attrs.get("title", "").strip() or image.attrs.get("alt", "").strip()
            name = name or (picture if len(picture) > LEAST_TITLE else "")
            source = image.attrs.get("data-lazy-src") or image.attrs.get("data-src") or image.attrs.get("src") or ""
            thumbnail = urljoin(url, source) if source and not source.startswith("data:") else None
        slug = re.search(r"/webinar/([^/?#]+)", href)
        name = name or ("Webinar: " + slug[1].replace("-", " ").title() if slug else "")
        if not name:
            after = e.parent.children[next(i for i, c in enumerate(e.parent.children) if c is e) :] if e.parent else []
            words = next((c.text() for c in after if isinstance(c, Element) and c.tag == "p"), "")
            name = words.split(".")[0].strip() if len(words) > LEAST_TITLE else ""
        context = heading.text() if heading else None
        context = None if not context or "In This Webinar" in context else context
        out.append({"url": full, "title": name or "Webinar", "description": described.get(full), "thumbnail": thumbnail, "context": context})
    return out


def link_webinars(root: Element, found: list[dict]) -> None:
    """Put links to the webinars where their images and announcements stand."""
    def of(href: str) -> dict | None:
        return next((w for w in found if "/webinar/" in href and (href in w["url"] or w["url"] in href)), None)

    for box in root.where(lambda e: e.tag == "div" and has_class(e, "avia-image-container")):
        link = next((a for a in box.all("a") if a.attrs.get("href")), None)
        if link is not None and (w := of(link.attrs["href"])):
            box.replace(f"\n\n**\U0001f4f9 [{w['title']}]({w['url']})**\n\n")
    for holder, column in _announcements(root, ("h2", "h3", "h4", "h5", "h6", "p", "div")):
        link = next((a for a in column.all("a") if "/webinar/" in a.attrs.get("href", "").lower()), None)
        if link is not None and (w := of(link.attrs["href"])):
            holder.replace(f"\n\n**[{holder.text()}]({w['url']})**\n\n")


def related(root: Element, url: str) -> list[dict]:
    """Callouts to related articles, distinct by URL."""
    out = {}
    for box in root.where(lambda e: e.tag == "div" and has_class(e, "av_promobox")):
        link = next((a for a in box.all("a") if a.attrs.get("href")), None)
        if "RELATED ARTICLE" in box.text().upper() and link and link.text():
            out.setdefault(urljoin(url, link.attrs["href"]), link.text())
    return [{"url": u, "title": t} for u, t in out.items()]


def sections(root: Element) -> list[dict]:
    """Headings h2 to h4 in order, each with the paragraphs up to the next."""
    out: list[dict] = []
    for e in root.walk():
        if e.tag in ("h2", "h3", "h4"):
            out.append({"heading": e.text(), "level": int(e.tag[1]), "content": []})
        elif e.tag == "p" and out and e.text():
            out[-1]["content"].append(e.text())
    return [s | {"content": "\n\n".join(s["content"])} for s in out]


def key_concepts(root: Element, name: str) -> list[str]:
    """Capitalised phrases of the title, emphasised terms, defined terms: 20 at most, sorted."""
    found = {w for w in re.findall(r"\b[A-Z][a-z]+(?:\s+[A-Z][a-z]+)*\b", name) if w.lower() not in STOP_WORDS and len(w) > SHORT}
    found |= {t for e in root.all("strong", "b", "em") if SHORT < len(t := e.brief()) < LONG and t.lower() not in STOP_WORDS}
    for words in root.strings():
        if (m := re.match(r"([A-Z][a-zA-Z\s]+?)\s+(?:is|are|refers?\s+to|means?)\s+", words.strip())) and len(m[1].strip()) < LONG:
            found.add(m[1].strip())
    return sorted(found)[:MAX_CONCEPTS]


def og_image(page: Element) -> str | None:
    metas = page.where(lambda e: e.tag == "meta" and e.attrs.get("property") == "og:image")
    return next((c for e in metas[:1] if (c := e.attrs.get("content", "").strip())), None)


def article(page: str | None, url: str, site: Site) -> dict:
    """All outputs of one page; without a content element they are empty, the title stays."""
    tree = parse(page)
    name, root = title(tree, site), content(tree)
    if root is None:
        return {"title": name, "og_image": og_image(tree), "markdown_content": "", "sections": [], "key_concepts": [], "cross_references": [], "images": [], "videos": [], "webinars": [], "related": []}
    clean(root)
    out = {"og_image": og_image(tree), "cross_references": cross_references(root, url, site), "images": images(root, url), "videos": videos(root), "webinars": webinars(root, url, site), "related": related(root, url)}
    link_webinars(root, out["webinars"])
    return out | {"title": name, "markdown_content": markdown.without_promotion(markdown.block(root), PROMO_TEXT), "sections": sections(root), "key_concepts": key_concepts(root, name)}


EMPTY = {"title": "Untitled", "og_image": None, "markdown_content": ""} | {k: [] for k in ("sections", "key_concepts", "cross_references", "images", "videos", "webinars", "related")}


def tried(page: str | None, url: str, site: Site) -> dict:
    """article(), or empty outputs and the error of a page that it cannot take."""
    try:
        return article(page, url, site) | {"error": None}
    except Exception as error:  # noqa: BLE001  one bad page must not end a job
        return EMPTY | {"error": f"{type(error).__name__}: {error}"[:200]}


def articles(pages: DataFrame, site: Site | None = None) -> DataFrame:
    """article_id, title, url, content_type, markdown_content, sections, key_concepts,
    cross_references, images, videos, webinars, related, og_image, error of each page; null
    html gives empty outputs."""
    site = site or Site()
    names = [f.name for f in StructType.fromDDL(ARTICLE_RECORD)]
    made = [n for n in names if n not in ("article_id", "url", "content_type")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = pd.DataFrame([tried(h, u or "", site) for h, u in zip(rows["html"], rows["url"], strict=True)], columns=made)
            yield out.assign(article_id=list(rows["article_id"]), url=list(rows["url"]), content_type=list(rows["content_type"]))[names]

    rows = pages.select(F.col("page_id").cast("string").alias("article_id"), "url", F.lit("article").alias("content_type"), "html")
    kind = lambda r: text.source_type(r["url"], site.domain, site.guide).alias("source_type")
    return rows.mapInPandas(run, ARTICLE_RECORD).withColumn("related", F.transform("related", lambda r: F.struct(r["url"].alias("url"), r["title"].alias("title"), kind(r))))


def contents(page: str) -> list[dict]:
    """Chapters and articles of a table of contents; raises if it has none."""
    menu = next(iter(parse(page).where(lambda e: e.tag == "div" and e.attrs.get("id") == "chapter-menu")), None)
    if menu is None:
        raise ValueError("no chapter menu")
    out = []
    for item in menu.where(lambda e: e.tag == "li" and "expand" in e.classes and "glossary" not in e.classes):
        strong = item.first("strong")
        number = strong.text().rstrip(".") if strong else ""
        if not number.isdigit():
            continue
        own = "".join(c for c in item.children if isinstance(c, str)).replace("\xa0", " ").strip()
        for a in item.all("a"):
            if not a.attrs.get("href"):
                continue
            border = next(iter(a.where(lambda e: e.tag == "span" and "border" in e.classes)), None)
            label = (border.text() if border else "").rpartition(".")[2]
            name = "".join(c for c in a.strings()).replace("\xa0", " ").strip()
            name = name.removeprefix(border.text()).strip() if border else name
            out.append({"chapter_number": int(number), "chapter_title": own, "article_number": int(label) if label.isdigit() else 0, "title": name, "url": a.attrs["href"]})
    return out


def glossary(page: str) -> list[dict]:
    """Terms by the first strategy that yields any: table, definition list, headings, strong."""
    root = content(parse(page)) or parse(page)
    return next((found for way in (_from_table, _from_list, _from_headings, _from_strong) if (found := way(root))), [])


def _rows_of(pages: DataFrame, parse_page: Callable[[str], list[dict]], schema: str) -> DataFrame:
    names = [f.name for f in StructType.fromDDL(schema)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = [{"page_id": i, "ord": n} | x for i, page in zip(rows["page_id"], rows["html"], strict=True) if page for n, x in enumerate(parse_page(page))]
            yield pd.DataFrame(out, columns=names)

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "html").mapInPandas(run, schema)


def contents_table(pages: DataFrame) -> DataFrame:
    """page_id, ord and the chapters and articles of tables of contents."""
    return _rows_of(pages, contents, "page_id long, ord int, chapter_number int, chapter_title string, article_number int, title string, url string")


def glossary_table(pages: DataFrame) -> DataFrame:
    """page_id, ord, term, acronym, definition of glossary pages."""
    return _rows_of(pages, glossary, "page_id long, ord int, term string, acronym string, definition string")


def _term(term: str, definition: str, acronym: str | None = None) -> list[dict]:
    return [{"term": term, "definition": definition, "acronym": acronym or None}] if term and definition else []


def _from_table(root: Element) -> list[dict]:
    for table in root.all("table"):
        rows = [[c.text() for c in tr.all("td", "th")] for tr in table.all("tr")]
        head = [c.upper() for c in rows[0]] if rows else []
        at = {k: next((i for i, c in enumerate(head) if k in c), None) for k in ("TERM", "DEFINITION", "ACRONYM")}
        if at["TERM"] is not None and at["DEFINITION"] is not None:
            cell = lambda r, k, at=at: r[at[k]] if at[k] is not None and at[k] < len(r) else ""
            return [t for r in rows[1:] for t in _term(cell(r, "TERM"), cell(r, "DEFINITION"), cell(r, "ACRONYM"))]
    return []


def _from_list(root: Element) -> list[dict]:
    return [t for dl in root.all("dl") for a, b in zip(dl.all("dt"), dl.all("dd"), strict=False) for t in _term(a.text(), b.text())]


def _from_headings(root: Element) -> list[dict]:
    out, term = [], ""
    for e in root.walk():
        if e.tag in ("h2", "h3", "h4"):
            term = e.text()
        elif e.tag == "p" and term:
            out += _term(term, e.text())
            term = ""
    return out


def _from_strong(root: Element) -> list[dict]:
    out = []
    for e in root.all("strong", "b"):
        after = e.parent.children[e.parent.children.index(e) + 1 :] if e.parent else []
        rest = "".join(c if isinstance(c, str) else c.text() for c in after).strip(" :-–\n\t")
        out += _term(e.text().rstrip(":"), rest)
    return out


def glossary_markdown(terms: DataFrame) -> DataFrame:
    """One document from terms (term, definition, acronym, ord)."""
    line = F.concat(F.lit("## "), "term", F.when(F.coalesce("acronym", F.lit("")) != "", F.concat(F.lit("\n\n**Acronym**: "), "acronym")).otherwise(""), F.lit("\n\n"), "definition")
    rows = terms.select(F.struct("ord", line.alias("line")).alias("x"))
    return rows.agg(F.concat(F.lit("# Glossary\n\n"), F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["line"]), "\n\n")).alias("markdown"))
