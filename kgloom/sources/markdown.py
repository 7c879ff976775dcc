"""Trees to Markdown, and the filter of promotional lines."""

from __future__ import annotations

import re

from .dom import Element

_HEADINGS = {f"h{i}": "#" * i for i in range(1, 7)}
_MARKS = {"strong": "**", "b": "**", "em": "*", "i": "*", "code": "`", "u": "__"}
_INLINE = frozenset([*_MARKS, "a", "br", "img", "span", "sub", "sup", "small", "mark", "abbr"])


def inline(e: Element) -> str:
    out = []
    for c in e.children:
        if isinstance(c, str):
            out.append(re.sub(r"\s+", " ", c))
        elif c.tag == "br":
            out.append("\n")
        elif c.tag == "img":
            out.append(_image(c))
        elif c.tag == "a":
            words = inline(c).strip()
            out.append(f"[{words}]({c.attrs['href']})" if words and c.attrs.get("href") else words)
        elif c.tag in _MARKS:
            words = inline(c).strip()
            out.append(f"{_MARKS[c.tag]}{words}{_MARKS[c.tag]}" if words else "")
        else:
            out.append(inline(c))
    return "".join(out)


def _image(e: Element) -> str:
    src = e.attrs.get("src") or e.attrs.get("data-src") or ""
    return f"![{e.attrs.get('alt', '')}]({src})" if src and not src.startswith("data:") else ""


def _table(e: Element) -> str:
    rows = [[inline(c).strip().replace("|", "\\|") for c in tr.own("td", "th")] for tr in e.own("tr")]
    if not rows:
        return ""
    wide = max(map(len, rows))
    lines = ["| " + " | ".join(r + [""] * (wide - len(r))) + " |" for r in rows]
    return "\n".join([lines[0], "|" + " --- |" * wide, *lines[1:]])


def _blocks(e: Element) -> list[str]:
    out: list[str] = []
    words: list[str] = []

    def flush() -> None:
        if line := "".join(words).strip():
            out.append(line)
        words.clear()

    for c in e.children:
        if isinstance(c, str):
            words.append(re.sub(r"\s+", " ", c))
        elif c.tag in _INLINE:
            holder = Element("span")
            holder.children = [c]
            words.append(inline(holder))
        else:
            flush()
            out += _block(c)
    flush()
    return out


def _block(e: Element) -> list[str]:
    if e.tag in _HEADINGS:
        words = inline(e).strip()
        return [f"{_HEADINGS[e.tag]} {words}"] if words else []
    if e.tag == "p":
        words = inline(e).strip()
        return [words] if words else []
    if e.tag in ("ul", "ol"):
        items = [c for c in e.children if isinstance(c, Element) and c.tag == "li"]
        lines = [(f"{i}. " if e.tag == "ol" else "- ") + inline(c).strip() for i, c in enumerate(items, 1)]
        return ["\n".join(lines)] if lines else []
    if e.tag == "blockquote":
        words = "\n\n".join(_blocks(e))
        return ["\n".join(f"> {line}".rstrip() for line in words.split("\n"))] if words else []
    if e.tag == "pre":
        code = e.first("code")
        language = next((c.removeprefix("language-") for c in (code.classes if code else []) if c.startswith("language-")), "")
        return ["```" + language + "\n" + "".join(e.strings()).strip("\n") + "\n```"]
    if e.tag == "table":
        return [t] if (t := _table(e)) else []
    if e.tag == "iframe":
        return [f"[Video]({e.attrs['src']})"] if e.attrs.get("src") else []
    return _blocks(e)


def block(root: Element) -> str:
    return re.sub(r"\n{3,}", "\n\n", "\n\n".join(_blocks(root))).strip()


def without_promotion(text: str, promo: re.Pattern) -> str:
    """Lines that promote go; a promotional heading takes all up to the next other heading."""
    kept, skip = [], False
    for line in text.split("\n"):
        if re.match(r"#{1,4}\s*(Ready to Find Out More|Book a Demo)", line, re.I):
            skip = True
            continue
        if skip and re.match(r"#{1,4}\s+", line) and not re.search(r"demo|trial|contact|pricing", line, re.I):
            skip = False
        if not skip and not promo.search(line):
            kept.append(line)
    return re.sub(r"\n{3,}", "\n\n", "\n".join(kept)).strip()
