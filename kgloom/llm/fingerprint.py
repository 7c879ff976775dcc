"""Document fingerprints from prefix polynomial hashes.

Prefix sums of byte * base**i modulo 2**31 - 1, under two bases, give the hash of any span in
constant time, and with it equality of spans and longest common extensions by binary search.
A fingerprint is the text's length, its whole hash, the hashes of its beginnings and ends of
the lengths in GRID, and a sketch: the least of its window hashes, the j-th occurrence of a
window counting as a window of its own.

Two fingerprints alone give a likeness.  The beginnings that agree are found by binary search
over the grid, likewise the ends; what they cover is shared for certain, down to the grid's
step of 2**(1/8).  The sketch estimates the share of common windows wherever they stand.  The
likeness is the greater of the two as a Dice coefficient, so texts with one half in common
have about 0.5 however long they are, and never 0.

Scale.  The neighbour of a document in descending doc_id order comes from one range
partitioning of the texts: a range holds its rows and a copy of the first row of the next,
so neither a global window nor a second shuffle of texts is needed.  Ranges are streamed, and
fingerprints are made after the shuffle.

Defined cases: null counts as empty; an empty text is like only another empty one.  Rows
with one doc_id are ordered by text; null ids come last.  A single row is its own neighbour.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_column, mix64, slices, spans_of

PRIME = (1 << 31) - 1
BASES = (1_048_573_183, 772_209_841)
WINDOW = 12
SKETCH = 48
RANGE_ROWS = 4000
GRID = np.unique(np.concatenate([np.arange(1, 9), np.floor(8 * 2.0 ** (np.arange(1, 8 * 28) / 8))]).astype(np.int64))
MAX_RANGES = 20_000
CHUNK = 1 << 19

_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _fold(x: np.ndarray) -> np.ndarray:
    """x modulo PRIME for x below 2**62 (a Mersenne prime: add the high bits to the low)."""
    x = (x & np.uint64(PRIME)) + (x >> np.uint64(31))
    x = (x & np.uint64(PRIME)) + (x >> np.uint64(31))
    return np.where(x >= PRIME, x - np.uint64(PRIME), x)


def _tables(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo PRIME, built by doubling."""
    if base not in _TABLES or len(_TABLES[base][0]) < n:
        made = []
        for b in (base, pow(base, -1, PRIME)):
            powers = np.ones(1, np.uint64)
            while len(powers) < max(n, 1 << 16):
                powers = np.concatenate([powers, _fold(powers * np.uint64(pow(b, len(powers), PRIME)))])
            made.append(powers)
        _TABLES[base] = tuple(made)
    return _TABLES[base]


class PrefixHashes:
    """Span hashes of one byte array."""

    def __init__(self, data: np.ndarray) -> None:
        self.size = len(data)
        self.sums = []
        symbols = data.astype(np.uint64) + np.uint64(1)
        for base in BASES:
            up, _ = _tables(base, self.size + 1)
            sums = np.zeros(self.size + 1, np.uint64)
            # Terms stay below 2**40, so 2**23 of them fit before they must be folded.
            for i in range(0, self.size, 1 << 22):
                part = symbols[i : i + (1 << 22)] * up[i : min(self.size, i + (1 << 22))]
                sums[i + 1 : i + 1 + len(part)] = _fold(np.cumsum(part) + sums[i])
            self.sums.append(sums)

    def spans(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """62-bit hashes of data[start:stop], whatever the position."""
        out = np.zeros(len(start), np.uint64)
        for base, sums in zip(BASES, self.sums, strict=True):
            _, down = _tables(base, self.size + 1)
            part = _fold((sums[stop] + np.uint64(PRIME) - sums[start]) * down[start])
            out = (out << np.uint64(31)) | part
        return out

    def span(self, start: int, stop: int) -> int:
        return int(self.spans(np.array([start]), np.array([stop]))[0])

    def equal(self, i: int, other: PrefixHashes, j: int, length: int) -> bool:
        return self.span(i, i + length) == other.span(j, j + length)

    def extension(self, i: int, other: PrefixHashes, j: int) -> int:
        """Longest length at which self[i:] and other[j:] agree."""
        low, high = 0, min(self.size - i, other.size - j)
        while low < high:
            middle = (low + high + 1) // 2
            if self.equal(i, other, j, middle):
                low = middle
            else:
                high = middle - 1
        return low


def _sketch(hashes: np.ndarray) -> np.ndarray:
    """The SKETCH least hashes of (window, number of its earlier occurrences)."""
    if not len(hashes):
        return hashes
    found = np.sort(hashes)
    new = np.append(True, found[1:] != found[:-1])
    if not new.all():
        slot = np.arange(len(found))
        before = slot - np.maximum.accumulate(np.where(new, slot, 0))
        found = np.where(before > 0, mix64(found + before.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), found)
    return np.sort(np.partition(found, SKETCH)[:SKETCH]) if len(found) > SKETCH else np.sort(found)


def _hex(hashes: np.ndarray) -> str:
    return (hashes >> np.uint64(32)).astype(">u4").tobytes().hex()


def fingerprints(data: np.ndarray, off: np.ndarray) -> Iterator[str]:
    """length:hash:beginnings:ends:sketch of each row, in hexadecimal."""
    for lo, hi in spans_of(off, CHUNK):
        raw = data[off[lo] : off[hi]]
        edge = off[lo : hi + 1] - off[lo]
        table = PrefixHashes(raw)
        whole = table.spans(edge[:-1], edge[1:])
        at = np.arange(max(0, len(raw) - WINDOW + 1))
        windows = mix64(table.spans(at, at + WINDOW))
        size = np.diff(edge)
        points = np.searchsorted(GRID, size, side="right")
        first = np.concatenate([[0], np.cumsum(points)])
        length = GRID[np.arange(first[-1]) - np.repeat(first[:-1], points)]
        start, stop = np.repeat(edge[:-1], points), np.repeat(edge[1:], points)
        heads, tails = mix64(table.spans(start, start + length)), mix64(table.spans(stop - length, stop))
        for r in range(hi - lo):
            a, b, g = edge[r], edge[r + 1], slice(first[r], first[r + 1])
            yield f"{b - a:x}:{int(whole[r]):016x}:{_hex(heads[g])}:{_hex(tails[g])}:{_hex(_sketch(windows[a : max(a, b - WINDOW + 1)]))}"


def _common(one: str, two: str) -> int:
    """The greatest length of the grid at which two lists of hashes agree, by binary search: if
    the beginnings of one length agree, those of all lesser lengths do."""
    low, high = 0, min(len(one), len(two)) // 8
    while low < high:
        middle = (low + high + 1) // 2
        if one[8 * middle - 8 : 8 * middle] == two[8 * middle - 8 : 8 * middle]:
            low = middle
        else:
            high = middle - 1
    return int(GRID[low - 1]) if low else 0


def likeness(one: str, two: str) -> float:
    """0 to 1; 1 for equal texts, 0 if one of two unequal texts is empty."""
    if one == two:
        return 1.0
    (n, _, *ends, sketch), (m, _, *ends2, sketch2) = one.split(":"), two.split(":")
    n, m = int(n, 16), int(m, 16)
    if not n or not m:
        return 0.0
    kept = 2 * min(sum(map(_common, ends, ends2)), n, m) / (n + m)
    a, b = (set(s[i : i + 8] for i in range(0, len(s), 8)) for s in (sketch, sketch2))
    union = sorted(a | b)[:SKETCH]
    share = sum(x in a and x in b for x in union) / len(union) if union else 0.0
    return max(kept, 2 * share / (1 + share))


def _keyed(cuts: np.ndarray, halo: dict[int | None, int]):
    """The range of each row; the first row of a range goes to the one above too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids = batch.column(0)
            numbers = ids.fill_null(np.iinfo(np.int64).min).to_numpy()
            part = np.searchsorted(cuts, numbers)
            copies = [(i, halo[v]) for i, v in enumerate(ids.to_pylist()) if v in halo]
            take = pa.array([*range(len(ids)), *[i for i, _ in copies]], pa.int64())
            to = pa.array([*part.tolist(), *[p for _, p in copies]], pa.int32())
            extra = pa.array([0] * len(ids) + [1] * len(copies), pa.int32())
            yield pa.RecordBatch.from_arrays([to, extra, ids.take(take), batch.column(1).take(take)], names=["part", "halo", "doc_id", "text"])

    return run


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    waiting = None  # the last row, until the next of its range arrives
    for batch in slices(batches):
        done = []
        prints = fingerprints(*byte_column(batch.column(3)))
        for row in zip(*[batch.column(i).to_pylist() for i in range(4)], prints, strict=True):
            if waiting and waiting[0] == row[0]:
                done.append((waiting, row))
            waiting = None if row[1] else row
        chars, texts = [], []
        for (_, _, _, text, _), (_, _, _, other, _) in done:
            text, other = text or "", other or ""
            half = len(text) // 2
            chars.append(len(text))
            texts.append(text[: len(text) - half] + other[:half])
        edited = list(fingerprints(*byte_column(pa.array(texts, pa.string()))))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([x[2] for x, _ in done], pa.int64()), pa.array(chars, pa.int64()), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string()),
                pa.array([x[4] for x, _ in done], pa.string()), pa.array(edited, pa.string()),
                pa.array([likeness(x[4], e) for (x, _), e in zip(done, edited, strict=True)], pa.float64()), pa.array([likeness(x[4], y[4]) for x, y in done], pa.float64()),
            ],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )


def neighbours(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    n = rows.count()
    parts = min(MAX_RANGES, -(-n // range_rows) or 1)
    share = [i / parts for i in range(1, parts)]
    cuts = rows.agg(F.percentile_approx("doc_id", share, 20 * parts).alias("c")).first()["c"] if share else None
    cuts = np.unique(np.array(cuts or [], np.int64))
    # A bound on ids is all that is gathered: one row per range.
    part = _part_of(cuts)
    tops = rows.select("doc_id").mapInArrow(part, "part int, doc_id long").groupBy("part").agg(F.max("doc_id").alias("top")).orderBy("part").collect()
    halo = {r["top"]: up["part"] for r, up in zip(tops, [*tops[1:], *tops[:1]], strict=True)}
    dealt = rows.mapInArrow(_keyed(cuts, halo), "part int, halo int, doc_id long, text string")
    dealt = dealt.repartition("part").sortWithinPartitions("part", "halo", F.col("doc_id").desc_nulls_last(), "text")
    return dealt.mapInArrow(_compared, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def _part_of(cuts: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids = batch.column(0)
            part = np.searchsorted(cuts, ids.fill_null(np.iinfo(np.int64).min).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), ids], names=["part", "doc_id"])

    return run
