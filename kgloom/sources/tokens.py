"""HTML to tokens in one pass whose cost grows with the page, however broken it is.

A tag is recognised only where it can end: text behind the last `>` is text, a tag whose quote
never closes is text up to that quote, and a tag has at most PIECES runs and quoted values.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

PIECES = 512
# Elements whose content is text up to their own end tag; in the first kind without references.
RAW = frozenset("script style xmp iframe noembed noframes".split())
RAW_TEXT = frozenset("textarea title".split())

_MARK = re.compile(r"<(?:(/?)([A-Za-z][^\s/>]*+)|(!--)|([!?]))")
_REST = re.compile(rf"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+'){{0,{PIECES}}}+>")
_RUN = re.compile(r"[^>\"']*+")
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_ENDS: dict[str, re.Pattern] = {}


def attributes(text: str) -> Iterator[tuple[str, str]]:
    """Lower-case names and values, references decoded."""
    for m in _ATTRIBUTE.finditer(text):
        yield m[1].lower(), html.unescape(m[2] or m[3] or m[4] or "")


def tokens(page: str, raw: frozenset = RAW | RAW_TEXT) -> Iterator[tuple[str, str, str]]:
    """("text", text, ""), ("start", tag, what follows the name) and ("end", tag, "")."""
    last = page.rfind(">")
    closing = {q: page.rfind(q) for q in "\"'"}
    done = at = 0
    while at <= last and (m := _MARK.search(page, at, last + 1)):
        start = m.start()
        if m[3]:
            end = page.find("-->", m.end()) + 3
            end = len(page) if end < 3 else end
        elif m[4]:
            end = page.find(">", m.end()) + 1
        else:
            rest = _REST.match(page, m.end())
            if not rest:
                # Every tag before a quote that never closes ends there too.
                stop = _RUN.match(page, m.end()).end()
                at = stop + 1 if stop == closing.get(page[stop : stop + 1]) else start + 1
                continue
            end = rest.end()
        if start > done:
            yield "text", html.unescape(page[done:start]), ""
        done = at = end
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            yield "end", tag, ""
            continue
        yield "start", tag, page[m.end() : end - 1]
        if tag in raw:
            if tag not in _ENDS:
                _ENDS[tag] = re.compile(rf"</{re.escape(tag)}[^>]*+>", re.I)
            stop = _ENDS[tag].search(page, end, last + 1)
            content = page[end : stop.start() if stop else len(page)]
            if content:
                yield "text", html.unescape(content) if tag in RAW_TEXT else content, ""
            yield "end", tag, ""
            done = at = stop.end() if stop else len(page)
    if done < len(page):
        yield "text", html.unescape(page[done:]), ""
