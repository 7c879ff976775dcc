"""A small tree over the tokens of a page."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

from .tokens import attributes, tokens

# The deepest nesting that is kept.
DEPTH = 100
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_SIBLINGS = {"a": ("a", {"table", "td", "th", "button", "object"}), "li": ("li", {"ul", "ol"}), "dt": ("dt dd", {"dl"}), "dd": ("dt dd", {"dl"}), "tr": ("tr", {"table"}), "td": ("td th", {"tr", "table"}), "th": ("td th", {"tr", "table"})}


class Element:
    __slots__ = ("attrs", "children", "parent", "tag")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None, parent: Element | None = None) -> None:
        self.tag, self.attrs, self.parent = tag, attrs or {}, parent
        self.children: list[Element | str] = []

    @property
    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()

    def walk(self) -> Iterator[Element]:
        """Every element below, in document order."""
        todo = [c for c in reversed(self.children) if isinstance(c, Element)]
        while todo:
            e = todo.pop()
            yield e
            todo += [c for c in reversed(e.children) if isinstance(c, Element)]

    def all(self, *tags: str) -> list[Element]:
        return [e for e in self.walk() if e.tag in tags]

    def own(self, *tags: str) -> list[Element]:
        """Elements of the tags below, but not those inside another table."""
        out, todo = [], [c for c in reversed(self.children) if isinstance(c, Element)]
        while todo:
            e = todo.pop()
            if e.tag in tags:
                out.append(e)
            if e.tag != "table":
                todo += [c for c in reversed(e.children) if isinstance(c, Element)]
        return out

    def first(self, *tags: str) -> Element | None:
        return next((e for e in self.walk() if e.tag in tags), None)

    def where(self, test: Callable[[Element], bool]) -> list[Element]:
        return [e for e in self.walk() if test(e)]

    def strings(self) -> Iterator[str]:
        todo: list[Element | str] = list(reversed(self.children))
        while todo:
            c = todo.pop()
            if isinstance(c, str):
                yield c
            else:
                todo += reversed(c.children)

    def text(self, joint: str = "") -> str:
        """Stripped strings, joined."""
        return joint.join(s for s in (x.strip() for x in self.strings()) if s)

    def brief(self, nodes: int = 1000) -> str:
        """text() of an element of at most so many nodes, else nothing."""
        todo, out = list(reversed(self.children)), []
        while todo:
            nodes -= 1
            if nodes < 0:
                return ""
            c = todo.pop()
            if isinstance(c, str):
                out.append(c.strip())
            else:
                todo += reversed(c.children[: nodes + 1])
        return "".join(out)

    def remove(self) -> None:
        if self.parent:
            self.parent.children = [c for c in self.parent.children if c is not self]

    @staticmethod
    def remove_all(gone: Iterable[Element]) -> None:
        """Remove many elements; each parent's children are listed anew once."""
        gone = {id(e): e for e in gone}
        for parent in {id(e.parent): e.parent for e in gone.values() if e.parent}.values():
            parent.children = [c for c in parent.children if id(c) not in gone]

    def replace(self, text: str) -> None:
        """Put text in this element's place."""
        if self.parent:
            self.parent.children = [text if c is self else c for c in self.parent.children]

    def closest_where(self, test: Callable[[Element], bool]) -> Element | None:
        e = self.parent
        while e is not None and not test(e):
            e = e.parent
        return e

    def closest(self, *tags: str) -> Element | None:
        return self.closest_where(lambda e: e.tag in tags)


class _Builder:
    """Builds the tree.  What is nested deeper than DEPTH stands beside its parent instead, as in
    browsers, so that no later pass recurses or walks far; an end tag of such an element closes
    nothing.  Open elements are counted by tag, so a stray tag costs no walk."""

    def __init__(self) -> None:
        self.root = Element("[document]")
        self.at = self.root
        self.depth = 0
        self.open: Counter[str] = Counter()
        self.owed: Counter[str] = Counter()

    def _leave(self, e: Element) -> None:
        """Close e and all that is open inside it."""
        while True:
            at = self.at
            self.open[at.tag] -= 1
            self.depth -= 1
            self.at = at.parent
            if at is e:
                return

    def _close(self, tags: set[str], scope: set[str]) -> None:
        if not any(self.open[t] for t in tags):
            return
        e = self.at
        while e.parent and e.tag not in scope:
            if e.tag in tags:
                self._leave(e)
                return
            e = e.parent

    def start(self, tag: str, attrs: dict[str, str], empty: bool) -> None:
        if tag in _BLOCKS:
            self._close({"p"}, {"table", "td", "th", "button"})
        if tag in _SIBLINGS:
            names, scope = _SIBLINGS[tag]
            self._close(set(names.split()), scope)
        if tag in _HEADINGS and self.at.tag in _HEADINGS:
            self._leave(self.at)
        if not empty and self.depth >= DEPTH:
            self.owed[self.at.tag] += 1
            self._leave(self.at)
        e = Element(tag, attrs, self.at)
        self.at.children.append(e)
        if not empty:
            self.at = e
            self.depth += 1
            self.open[tag] += 1

    def end(self, tag: str) -> None:
        if self.owed[tag]:
            self.owed[tag] -= 1
            return
        if not self.open[tag]:
            return
        e = self.at
        while e.tag != tag:
            e = e.parent
        self._leave(e)


def parse(page: str | None) -> Element:
    builder = _Builder()
    for kind, what, rest in tokens(page or ""):
        if kind == "text":
            builder.at.children.append(what)
        elif kind == "end":
            builder.end(what)
        else:
            builder.start(what, dict(attributes(rest)), what in VOID or rest.endswith("/"))
    return builder.root


def has_class(e: Element, pattern: str) -> bool:
    return any(re.search(pattern, c) for c in e.classes)
