"""Personal data by rules and a skip-chain conditional random field.

Rules give the base spans.  Tokens with digits or an @ are the nodes of a field over the
labels none, email, ip, card and phone.  A node's potential comes from the token's pattern,
neighbouring nodes share a chain potential, and nodes whose tokens repeat (the same digits
or the same address, however written) each share a skip potential with the one hub of their
token.  Nodes whose tokens are only similar (the same last NEAR_DIGITS digits, as a number
with and without its country code, or the same domain) share a weaker potential with a hub of
what they have in common.  Nodes inside base spans are
observed, and so is the hub of a token that the rules found anywhere in the document, so a
repeat is labelled alike however far it is and however many there are.  Loopy belief propagation, run for each
document until its messages stop changing, labels the rest; runs of nodes with one label become
added spans if they hold an address or at least MIN_DIGITS digits.  Base spans always stay.

Potentials are fitted piecewise, as log ratios of counts over at most SAMPLE_ROWS rows
labelled by the rules.  All documents of a batch form one graph without edges between
documents, so a pass costs a few array operations per batch; a token that repeats m times
gets m skip edges, not all pairs, and its mentions are two hops apart.

Offsets are code points, ends exclusive.  Null text counts as empty.  Rows are independent:
repeated rows and ids are each scanned.
"""

from __future__ import annotations

import dataclasses
import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

KINDS = ("email", "ip", "card", "phone")
NONE = len(KINDS)
LABELS = NONE + 1
SAMPLE_ROWS = 4000
CHANGE = 1e-4  # messages (logs) that change by less have converged
DAMPING = 0.3
PATIENCE = 200  # after so many rounds more, messages that swing are damped twice as much
MIN_DIGITS = 7
NEAR_DIGITS = 7
MIN_BELIEF = 0.6

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A start inside a run of digits fails as the run's own start does, so only that is tried.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_MARK = re.compile(r"[0-9@]")
_BLANK = re.compile(r"[\x20\x09-\x0D]")
_DIGITS = re.compile(r"[^0-9]")
_TRIM = ".,;:!?\"'<>[]{}|*#$&"

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            done = match.end()
            yield start, 0, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """The rules' spans by start, then kind."""
    if not _MARK.search(text):
        return []
    out = list(_emails(text)) if "@" in text else []
    out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        if 14 <= m.end() - m.start() and 14 <= len(d := _DIGITS.sub("", m[0])) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(_DIGITS.sub("", m[0])) <= 15]
    return sorted(out)


def tokens(text: str) -> list[tuple[int, int]]:
    """Runs without white space that hold a digit or @, less outer punctuation."""
    out, at, size = [], 0, len(text)
    while m := _MARK.search(text, at):
        start = m.start()
        while start > at and not _BLANK.match(text, start - 1):
            start -= 1
        stop = _BLANK.search(text, m.end())
        at = stop.start() if stop else size
        end = at
        while start < end and text[start] in _TRIM:
            start += 1
        while end > start and text[end - 1] in _TRIM:
            end -= 1
        if start < end:
            out.append((start, end))
    return out


def pattern(token: str) -> str:
    """What a node's own potential depends on."""
    digits = _DIGITS.sub("", token)
    n = len(digits)
    size = next(k for k, top in enumerate((0, 3, 6, 7, 9, 13, 19, 10**9)) if n <= top)
    marks = "".join(c for c in "@+().-_%/" if c in token)
    letters = any(c.isalpha() for c in token)
    check = luhn(digits) if 14 <= n <= 19 and not letters else ""
    return f"{size}{'a' if letters else ''}{marks}{int(check) if check != '' else ''}"


def likeness(token: str) -> str:
    """Tokens with the same key are joined by a skip edge; empty for none."""
    if "@" in token:
        return token.lower()
    digits = _DIGITS.sub("", token)
    return digits if len(digits) >= 4 else ""


def resemblance(token: str) -> str:
    """Tokens with the same key are similar; empty for none."""
    if "@" in token:
        return "@" + token.lower().rpartition("@")[2]
    digits = _DIGITS.sub("", token)
    return "~" + digits[-NEAR_DIGITS:] if len(digits) >= NEAR_DIGITS else ""


@dataclass
class Field:
    """Log potentials: of patterns, of neighbours, of repeated and of similar tokens, of hubs."""

    own: dict[str, np.ndarray]
    chain: np.ndarray
    skip: np.ndarray
    near: np.ndarray = dataclasses.field(default_factory=lambda: np.zeros((LABELS, LABELS)))
    hub: np.ndarray = dataclasses.field(default_factory=lambda: np.zeros(LABELS))

    def unary(self, key: str) -> np.ndarray:
        return self.own.get(key, _RARE)


_RARE = np.log(np.array([0.01] * NONE + [1 - 0.01 * NONE]))


class _Graph:
    """Nodes and edges of any number of documents."""

    def __init__(self) -> None:
        self.where: list[tuple[int, int, int]] = []
        self.text: list[str] = []
        self.seen: list[int] = []
        self.edges: tuple[list, list, list] = ([], [], [])  # between nodes; from nodes to hubs of repeated and of similar tokens
        self.hubs: list[tuple[int, Counter | None]] = []  # row, labels that the rules gave the mentions of a repeated token
        self.repeats: tuple[list, list] = ([], [])

    def add(self, row: int, text: str, spans: list[Span]) -> None:
        first, last, hub, at = len(self.where), {}, {}, 0
        for start, end in tokens(text):
            node = len(self.where)
            while at < len(spans) and spans[at][2] <= start:
                at += 1
            label, k = NONE, at
            while k < len(spans) and spans[k][0] < end:
                if 2 * (min(end, spans[k][2]) - max(start, spans[k][0])) >= end - start:
                    label = spans[k][1]
                    break
                k += 1
            token = text[start:end]
            if node > first and not text[self.where[-1][2] : start].strip(" .,;:()-"):
                self.edges[0].append((node - 1, node))
            for near, key in enumerate((likeness(token), resemblance(token))):
                if not key:
                    continue
                if key in last:
                    if key not in hub:
                        hub[key] = len(self.hubs)
                        self.hubs.append((row, None if near else Counter([self.seen[last[key]]])))
                        self.edges[1 + near].append((last[key], hub[key]))
                    self.edges[1 + near].append((node, hub[key]))
                    if not near:
                        self.hubs[hub[key]][1][label] += 1
                    self.repeats[near].append((last[key], node))
                last[key] = node
            self.where.append((row, start, end))
            self.text.append(token)
            self.seen.append(label)


def beliefs(unary: np.ndarray, edges: np.ndarray, pair: np.ndarray, row: np.ndarray | None = None) -> np.ndarray:
    """Marginals by loopy sum-product: unary (n, L), edges (m, 2), pair (m, L, L), all in logs.

    Each row (n,) of nodes, by default all, is a graph of its own, which runs until its
    messages stop changing; so its marginals do not depend on the others."""
    n, labels = unary.shape
    _, row = np.unique(np.zeros(n, int) if row is None else row, return_inverse=True)
    tail = np.concatenate([edges[:, 0], edges[:, 1]])
    head = np.concatenate([edges[:, 1], edges[:, 0]])
    both = np.concatenate([pair, pair.transpose(0, 2, 1)])
    back = np.concatenate([np.arange(len(edges), 2 * len(edges)), np.arange(len(edges))])
    of = row[tail]
    sent = np.zeros((len(tail), labels))
    total, rounds = unary.copy(), 0
    while len(tail):
        out = (total[tail] - sent[back])[:, :, None] + both
        top = out.max(axis=1, keepdims=True)
        new = top[:, 0] + np.log(np.exp(out - top).sum(axis=1))
        new -= new.max(axis=1, keepdims=True)
        change = np.zeros(of.max() + 1)
        np.maximum.at(change, of, np.abs(new - sent).max(axis=1))
        step = (1 - DAMPING) * 0.5 ** (rounds // PATIENCE)
        sent += step * (new - sent)
        moving = np.zeros(n, bool)
        moving[head] = True
        total[moving] = unary[moving]
        np.add.at(total, head, sent)
        rounds += 1
        live = change[of] > CHANGE
        if not live.all():
            place = np.cumsum(live) - 1
            tail, head, both, back, of, sent = tail[live], head[live], both[live], place[back[live]], of[live], sent[live]
    total -= total.max(axis=1, keepdims=True)
    p = np.exp(total)
    return p / p.sum(axis=1, keepdims=True)


def infer(graph: _Graph, field: Field) -> tuple[np.ndarray, np.ndarray]:
    """Label and its belief for each node; observed nodes are held to their label."""
    seen, n = np.array(graph.seen), len(graph.seen)
    unary = np.array([field.unary(pattern(t)) for t in graph.text])
    fixed = seen < NONE
    unary[fixed] = -30.0
    unary[fixed, seen[fixed]] = 0.0
    hubs = np.repeat(field.hub[None], len(graph.hubs), axis=0)
    for hub, (_, labels) in enumerate(graph.hubs):
        # What the rules found in one mention holds for the token, however many they missed.
        if found := {k: c for k, c in (labels or {}).items() if k < NONE}:
            hubs[hub] = -np.inf  # no number of repeats outvotes it
            hubs[hub, list(found)] = np.log(np.array(list(found.values())) / sum(found.values()))
    unary = np.concatenate([unary, hubs])
    chain, skip, near = (np.array(e, int).reshape(-1, 2) for e in graph.edges)
    pair = np.concatenate([np.repeat(p[None], len(e), axis=0) for p, e in zip((field.chain, field.skip, field.near), (chain, skip, near), strict=True)])
    row = np.array([*[r for r, _, _ in graph.where], *[r for r, _ in graph.hubs]])
    p = beliefs(unary, np.concatenate([chain, skip + [0, n], near + [0, n]]), pair, row)[:n]
    return p.argmax(axis=1), p.max(axis=1)


def _added(graph: _Graph, field: Field, texts: list[str], base: list[list[Span]]) -> dict[int, list[Span]]:
    out: dict[int, list[Span]] = {}
    if not graph.where or all(s < NONE for s in graph.seen):
        return out
    label, belief = infer(graph, field)
    runs: list[list] = []
    for node, (row, start, end) in enumerate(graph.where):
        if graph.seen[node] < NONE or label[node] == NONE or belief[node] < MIN_BELIEF:
            continue
        kind = int(label[node])
        # Cards and addresses stand alone; parts of a phone number join.
        if runs and runs[-1][0] == row and runs[-1][2] == kind == 3 and runs[-1][4] == node - 1 and start - runs[-1][3] <= 2:
            runs[-1][3:] = [end, node]
        else:
            runs.append([row, start, kind, end, node])
    for row, start, kind, end, _ in runs:
        token = texts[row][start:end]
        if len(_DIGITS.sub("", token)) < MIN_DIGITS and "@" not in token:
            continue
        if all(end <= s or e <= start for s, _, e in base[row]):
            out.setdefault(row, []).append((start, kind, end))
    return out


def all_spans(texts: list[str], field: Field) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, all spans) of each text."""
    base = [base_spans(t) for t in texts]
    graph = _Graph()
    for row, text in enumerate(texts):
        graph.add(row, text, base[row])
    more = _added(graph, field, texts, base)
    return [(b, sorted([*b, *more[i]]) if i in more else b) for i, b in enumerate(base)]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        graph, count = _Graph(), Counter()
        for row, text in enumerate(batch.column(0).to_pylist()):
            graph.add(row, text or "", base_spans(text or ""))
        for text, label in zip(graph.text, graph.seen, strict=True):
            count["own", pattern(text), label, 0] += 1
        for name, edges in zip(("chain", "skip", "near"), (graph.edges[0], *graph.repeats), strict=True):
            for i, j in edges:
                count[name, "", graph.seen[i], graph.seen[j]] += 1
        part, key, a, b = zip(*count, strict=True) if count else ((), (), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array(key, pa.string()), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(list(count.values()), pa.int64())], names=["part", "key", "a", "b", "n"])


def fit(docs: DataFrame, rows: int = SAMPLE_ROWS) -> Field:
    """Potentials from at most about `rows` rows, those least by a hash of doc_id."""
    ids = docs.select(F.col("doc_id").alias("id")).where("doc_id is not null").distinct().orderBy(F.xxhash64("id"), "id").limit(rows)
    sample = docs.join(F.broadcast(ids), docs["doc_id"] == ids["id"], "left_semi").select(F.col("text").cast("string"))
    counts = sample.mapInArrow(_counted, "part string, key string, a int, b int, n long").groupBy("part", "key", "a", "b").agg(F.sum("n").alias("n")).collect()
    own: dict[str, np.ndarray] = {}
    pairs = {name: np.full((LABELS, LABELS), 0.5) for name in ("chain", "skip", "near")}
    for r in counts:
        if r["part"] == "own":
            own.setdefault(r["key"], np.exp(_RARE) * 4)[r["a"]] += r["n"]
        else:
            pairs[r["part"]][r["a"], r["b"]] += r["n"]
    pairs["skip"] += np.diag(np.full(LABELS, 5.0))  # labels of one thing agree

    def ratio(c: np.ndarray) -> np.ndarray:
        p = c / c.sum()
        return np.log(p / (p.sum(axis=1, keepdims=True) * p.sum(axis=0, keepdims=True)))

    pairs["near"] += np.eye(LABELS)
    skip, near = ((pairs[k] + pairs[k].T) / 2 for k in ("skip", "near"))
    return Field({k: np.log(v / v.sum()) for k, v in own.items()}, ratio(pairs["chain"]), ratio(skip), ratio(near), np.log(skip.sum(axis=0) / skip.sum()))


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _scan(field: Field):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = all_spans([t or "" for t in batch.column(1).to_pylist()], field)
            numbers = [pa.array([sum(k == kind for _, k, _ in b) for b, _ in found], pa.int64()) for kind in range(NONE)]
            base = pa.array([hashlib.sha256(written(b).encode()).hexdigest() for b, _ in found], pa.string())
            spans = pa.array([written(a) for _, a in found], pa.string())
            counts = [pa.array([f(b, a) for b, a in found], pa.int64()) for f in (lambda b, a: len(a) - len(b), lambda b, a: len(a))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *numbers, base, spans, *counts], names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added", "n_spans"])

    return run


def scan(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added, n_spans."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_scan(field), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long, n_spans long")


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; of overlapping spans, one mark."""
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _redact(field: Field):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            found = all_spans([t or "" for t in texts], field)
            clean = [t if t is None or not a else redacted(t, a) for t, (_, a) in zip(texts, found, strict=True)]
            columns = {n: batch.column(n) for n in batch.schema.names}
            columns["text"] = pa.array(clean, pa.string())
            if "n_chars" in columns:
                columns["n_chars"] = pa.array([None if t is None else len(t) for t in clean], pa.int64())
            yield pa.RecordBatch.from_pydict(columns)

    return run


def redact(docs: DataFrame, field: Field) -> DataFrame:
    """docs with personal data replaced in text; n_chars, if there, follows."""
    rows = docs.withColumn("text", F.col("text").cast("string"))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.col("n_chars").cast("long"))
    return rows.mapInArrow(_redact(field), rows.schema)
