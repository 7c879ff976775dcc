"""Documents to retrieval chunks: header split, size rule, recursive split with overlap."""

from __future__ import annotations

import re
import zlib
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources import dom

SEPARATORS = ("\n\n\n", "\n\n", "\n", ". ", "? ", "! ", "; ", " ", "")
SENTENCES = 128  # a call of an embedding provider


@dataclass(frozen=True)
class Config:
    size: int = 512
    overlap: int = 64
    threshold: int = 1500
    least: int = 100
    separators: tuple[str, ...] = SEPARATORS
    prefix: bool = False
    semantic: bool = False
    similarity: float = 0.5
    window: int = 1  # sentences on each side of a place that are compared
    embed: Callable[[list[str]], np.ndarray] | None = None  # vectors of sentences; hashed words if none

    def __post_init__(self) -> None:
        if self.size <= 0 or not 0 <= self.overlap < self.size:
            raise ValueError("overlap must be below size")
        if self.window < 1:
            raise ValueError("a window has a sentence at least")
        if self.threshold < self.size or self.least < 0:
            raise ValueError("threshold must reach size")


RETRIEVAL = Config(400, 80, 1200, 30)
EXTRACTION = Config(1024, 128, 2500, 100)


def recursive_split(text: str, config: Config, separators: tuple[str, ...] | None = None) -> list[str]:
    """Pieces of at most `size` characters: split at the first separator that occurs, which
    starts the piece after it; merge neighbours up to size, the last `overlap` characters'
    worth of pieces beginning the next; split what is too long further."""
    separators = config.separators if separators is None else separators
    at = next((i for i, s in enumerate(separators) if s == "" or s in text), len(separators) - 1)
    mark, finer = separators[at], separators[at + 1 :]
    parts = list(text) if mark == "" else [p if i == 0 else mark + p for i, p in enumerate(text.split(mark))]
    out: list[str] = []
    held: deque[str] = deque()
    length = 0  # of what is held

    def flush() -> None:
        if piece := "".join(held).strip():
            out.append(piece)

    for part in filter(None, parts):
        if len(part) > config.size and finer:
            flush()
            held.clear()
            length = 0
            out += recursive_split(part, config, finer)
            continue
        if held and length + len(part) > config.size:
            flush()
            while held and (length > config.overlap or length + len(part) > config.size):
                length -= len(held.popleft())
        held.append(part)
        length += len(part)
    flush()
    return out


def header_split(lines: DataFrame) -> DataFrame:
    """id, section, h1, h2, h3, text from id, pos, line: a section per heading, fences kept.

    Windows run within a document, whose lines are bounded by its length."""
    order = Window.partitionBy("id").orderBy("pos")
    fence = F.sum(F.col("line").rlike(r"^\s*```").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    level = F.when(F.coalesce(fence, F.lit(0)) % 2 == 0, F.length(F.regexp_extract("line", r"^(#{1,3}) \S", 1))).otherwise(0)
    marked = lines.withColumn("level", level).withColumn("section", F.sum((F.col("level") > 0).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))

    def current(n: int) -> F.Column:
        """The latest heading of level n that no higher one has closed."""
        name = F.trim(F.regexp_replace("line", r"^#+ ", ""))
        latest = F.last(F.when((F.col("level") > 0) & (F.col("level") <= n), F.struct("level", name.alias("name"))), ignorenulls=True).over(order)
        return F.when(latest["level"] == n, latest["name"]).alias(f"h{n}")

    rows = marked.select("id", "section", "pos", "line", "level", *[current(n) for n in (1, 2, 3)])
    body = rows.groupBy("id", "section").agg(F.max("h1").alias("h1"), F.max("h2").alias("h2"), F.max("h3").alias("h3"), F.array_sort(F.collect_list(F.when(F.col("level") == 0, F.struct("pos", "line")))).alias("rows"))
    text = F.trim(F.array_join(F.transform("rows", lambda r: r["line"]), "\n"))
    return body.select("id", "section", "h1", "h2", "h3", text.alias("text")).where("text <> ''")


Section = tuple[str | None, str | None, str | None, str]  # h1, h2, h3, text


def _sectioned(lines: Iterable[tuple[int, str]], joint: str) -> list[Section]:
    """Sections of (heading level or 0, text) pairs; a heading closes those of its level and below."""
    heads: list[str | None] = [None, None, None]
    out: list[Section] = []
    body: list[str] = []

    def flush() -> None:
        if text := joint.join(body).strip(" "):
            out.append((*heads, text))
        body.clear()

    for level, words in lines:
        if level:
            flush()
            heads[level - 1 :] = [words, *[None] * (3 - level)]
        else:
            body.append(words)
    flush()
    return out


def markdown_sections(text: str) -> list[Section]:
    """A section per heading of a Markdown text; lines in code fences are no headings."""
    if "#" not in text:
        return _sectioned([(0, text)], "\n")

    def lines() -> Iterator[tuple[int, str]]:
        fenced = False
        for line in text.split("\n"):
            mark = None if fenced else re.match(r"(#{1,3}) (?=\S)", line)
            yield (len(mark[1]), re.sub(r"^#+ ", "", line).strip(" ")) if mark else (0, line)
            fenced ^= bool(re.match(r"\s*```", line))

    return _sectioned(lines(), "\n")


def html_sections(page: str) -> list[Section]:
    """A section per h1, h2 and h3 of a page, with the text of what follows up to the next."""
    def lines() -> Iterator[tuple[int, str]]:
        todo: list = list(reversed(dom.parse(page).children))
        while todo:
            e = todo.pop()
            if isinstance(e, str):
                if words := " ".join(e.split()):
                    yield 0, words
            elif e.tag in ("h1", "h2", "h3"):
                yield int(e.tag[1]), e.text(" ")
            elif e.tag not in ("head", "script", "style", "noscript"):
                todo += reversed(e.children)

    return _sectioned(lines(), "\n")


def hashed_words(sentences: list[str], places: int = 1024) -> np.ndarray:
    """A row of word counts for each sentence, words hashed to places: the offline provider."""
    out = np.zeros((len(sentences), places))
    for row, sentence in zip(out, sentences, strict=True):
        for word in re.findall(r"\w+", sentence.lower()):
            row[zlib.crc32(word.encode("utf-8", "surrogatepass")) % places] += 1
    return out


def _likeness(sentences: list[str], config: Config) -> np.ndarray:
    """At i, the cosine of the summed vectors of `window` sentences before i and from i on; 0 for
    zero or infinite vectors.  Vectors are asked for and kept in blocks, so memory does not grow
    with the text."""
    embed, w, n = config.embed or hashed_words, config.window, len(sentences)
    out = np.zeros(n)
    for start in range(1, n, SENTENCES):
        first, stop = max(0, start - w), min(n, start + SENTENCES)
        vectors = np.asarray(embed(sentences[first : min(n, stop + w - 1)]), dtype=float)
        if vectors.ndim != 2 or len(vectors) != min(n, stop + w - 1) - first:
            raise ValueError("a provider gives one vector a sentence")
        sums = np.vstack([np.zeros(vectors.shape[1]), np.cumsum(vectors, axis=0)])
        at = np.arange(start, stop) - first
        a, b = sums[at] - sums[np.maximum(at - w, 0)], sums[np.minimum(at + w, len(vectors))] - sums[at]
        with np.errstate(all="ignore"):
            likeness = (a * b).sum(axis=1) / np.sqrt((a * a).sum(axis=1) * (b * b).sum(axis=1))
        out[start:stop] = np.where(np.isfinite(likeness), likeness, 0.0)
    return out


def _boundaries(likeness: np.ndarray, config: Config) -> np.ndarray:
    """Places below `similarity` that are least among those one window around shares; of equal
    neighbours the first."""
    w = config.window
    padded = np.concatenate([np.full(w - 1, np.inf), likeness, np.full(w - 1, np.inf)])
    padded[w - 1] = np.inf  # before the first sentence is no place
    around = np.lib.stride_tricks.sliding_window_view(padded, 2 * w - 1)
    least = (around[:, : w - 1] > likeness[:, None]).all(axis=1) & (around[:, w:] >= likeness[:, None]).all(axis=1)
    return (likeness < config.similarity) & least


def semantic_split(text: str, config: Config) -> list[str] | None:
    """Groups of neighbouring sentences, cut where the sentence vectors of the provider, smoothed
    over a window, are least alike.  A group that outgrows `size` is cut at the least similar
    place of its later half, the last of equal ones.  None, for the caller to fall back on the
    recursive split: no groups, one of over twice the threshold, all below `least`, or a provider
    that fails."""
    if not text.strip():
        return None
    sentences = re.split(r"(?<=[.!?])\s+", text.strip())
    try:
        likeness = _likeness(sentences, config)
    except Exception:  # noqa: BLE001  whatever a provider raises, the text is still split
        return None
    cut = _boundaries(likeness, config)
    ends = np.cumsum([len(s) + 1 for s in sentences])
    begin = lambda i: int(ends[i - 1]) if i else 0
    groups: list[str] = []
    start = 0

    def close(stop: int) -> None:
        nonlocal start
        groups.append(" ".join(sentences[start:stop]))
        start = stop

    for i in range(1, len(sentences)):
        if cut[i]:
            close(i)
        while i > start and int(ends[i]) - 1 - begin(start) > config.size:
            later = [j for j in range(start + 1, i + 1) if 2 * (begin(j) - begin(start)) >= config.size] or [i]
            close(min(later, key=lambda j: (likeness[j], -j)))
    close(len(sentences))
    if any(len(g) > 2 * config.threshold for g in groups):
        return None
    return [g for g in groups if len(g) >= config.least] or None


def sized(sections: list[Section], config: Config, title: str | None = None) -> Iterator[Section]:
    """The size rule: sections over the threshold are split, those under `least` dropped, pieces of
    the recursive split all kept.  With a prefix, the title and headings come first."""
    for h1, h2, h3, text in sections:
        if config.prefix:
            head = " > ".join([*([f"Article: {title}"] if title else []), *filter(None, (h1, h2, h3))])
            text = f"{head}\n\n{text}" if head else text
        if len(text) > config.threshold:
            pieces = (semantic_split(text, config) if config.semantic else None) or recursive_split(text, config)
            yield from ((h1, h2, h3, p) for p in pieces)
        elif len(text) >= config.least:
            yield h1, h2, h3, text


def chunk(documents: DataFrame, config: Config | None = None, html: bool = False) -> DataFrame:
    """id, index, h1, h2, h3, text of Markdown texts or pages, with their `title` where documents
    have one: a function of each row, so nothing is shuffled."""
    config = config or Config()
    split = html_sections if html else markdown_sections

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = [(i, n, *x) for i, text, title in zip(rows["id"], rows["text"], rows["title"], strict=True) for n, x in enumerate(sized(split(text), config, title))]
            yield pd.DataFrame(out, columns=["id", "index", "h1", "h2", "h3", "text"])

    title = F.col("title").cast("string") if "title" in documents.columns else F.lit(None).cast("string")
    rows = documents.select(F.col("id").cast("string").alias("id"), F.coalesce("text", F.lit("")).alias("text"), title.alias("title"))
    return rows.mapInPandas(run, "id string, index int, h1 string, h2 string, h3 string, text string")


def splitter(config: Config | None = None, markdown: bool = True) -> Callable[[DataFrame], DataFrame]:
    """chunk() of one kind of text and one configuration, to hand to a pipeline."""
    return lambda documents: chunk(documents, config, html=not markdown)
