"""Long repeated passages by run-length compressed Burrows-Wheeler indexes.

Every byte covered by a LENGTH-byte string that starts anywhere else too is removed.  Bytes
covered by repeated strings of PASSAGE bytes are reported as passages where a run of them has
over PASSAGE_WORDS words; they are not removed for that.

1. Routing.  The windows of a document (all its PASSAGE-byte strings) are split by their
   minimiser, the ANCHOR-byte gram with the least hash: equal windows have equal minimisers,
   so windows that share none need not meet.  A run of windows with one minimiser is a
   context, about 90 windows; no window is in two contexts.  Its body is its windows and what
   follows up to LENGTH bytes from the last one's start, so that one index answers both lengths.
2. Anchors that occur once are dropped; equal contexts become one with a weight.  An anchor
   with one distinct context left needs no index: all its windows occur elsewhere.  Only the
   bodies of the others are shuffled, into as many buckets as their volume asks for.
3. Per bucket: suffix order by prefix doubling, then its run-length compressed transform.
   Only the ends of runs are kept, each with its text position and the length of its match
   with its neighbour; matching statistics of all other positions are streamed from these
   (inside a run, a match is one shorter than that of the position before).  Windows whose
   statistic reaches their length are marked.

Scale.  The plan has one shape at every size.  Rows that cannot matter are sifted out before a
shuffle by a bitmap of at most SIEVE_WORDS rows, the only broadcast there is; once the bitmap
is full (some 10**7 repeated anchors, or documents with repeats) it sifts less and the joins,
which are exact, shuffle up to 32 bytes per 90 bytes of text and the texts once each.  Counts
and places combine before they are shuffled, and the join of contexts with their marks has a
plain exchange on either side, so adaptive execution splits a context with a third of all
rows.  An anchor with more than HOT distinct contexts does not go into one index: its windows
are hashed and counted with map-side combining, which is exact too and bounded.

Defined cases: null text is empty; texts under LENGTH bytes lose nothing; removal may split a
UTF-8 character, so kept text is bytes.  Rows that repeat doc_id and text are separate
occurrences with one and the same result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_long, byte_column, mix64, powers, prefix_sums, sieve, sifted, slices, spans_of, stored

LENGTH = 400
PASSAGE = 256
PASSAGE_WORDS = 50
ANCHOR = 64
HOT = 1 << 12
BUCKET_BYTES = 1 << 18
CHUNK = 1 << 20
PIECE = 1 << 22
_FIELD = 10  # bits of each of the two window counts packed behind a start


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """min(x[i:i + width]) for each i, from prefix and suffix minima of blocks."""
    n = len(x)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(x.dtype).max, x.dtype)
    padded[:n] = x
    grid = padded.reshape(blocks, width)
    left = np.minimum.accumulate(grid, axis=1).ravel()
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - width + 1], left[width - 1 : n])


def _pieces(off: np.ndarray, window: int, length: int) -> Iterator[tuple[int, np.ndarray, int, int, int]]:
    """(first row, edges, from byte, to byte, window starts below): chunks of rows, and long
    rows in pieces that overlap so that each window starts in exactly one."""
    for lo, hi in spans_of(off, CHUNK):
        start, stop = int(off[lo]), int(off[hi])
        if stop - start <= PIECE:
            yield lo, off[lo : hi + 1], start, stop, stop
            continue
        for at in range(start, max(start + 1, stop - window + 1), PIECE):
            end = min(stop, at + PIECE + length - 1)
            yield lo, np.array([at, end]), at, end, min(stop, at + PIECE)


def contexts(data: np.ndarray, off: np.ndarray, length: int = LENGTH, passage: int = PASSAGE, anchor: int = ANCHOR) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, start, windows, long windows, anchor hash, context hash) arrays; start counts bytes
    in the row, and so many of the windows' starts have `length` bytes of the row after them."""
    span = passage - anchor + 1
    for first, edges, start, stop, below in _pieces(off, passage, length):
        if stop - start < passage:
            continue
        raw = data[start:stop]
        sums = prefix_sums(raw)
        _, down = powers(len(raw))
        grams = mix64((sums[anchor:] - sums[: len(raw) - anchor + 1]) * down[: len(raw) - anchor + 1])
        place = np.uint64((1 << 24) - 1)
        least = _sliding_least((grams & ~place) | np.arange(len(grams), dtype=np.uint64), span) & place
        edge = edges - start
        slot = np.arange(len(least))
        row = np.searchsorted(edge, slot, side="right") - 1
        fits = (slot + passage <= edge[row + 1]) & (slot < below - start)
        new = fits.copy()
        new[1:] &= ~fits[:-1] | (least[1:] != least[:-1]) | (row[1:] != row[:-1])
        head = np.flatnonzero(new)
        if not len(head):
            continue
        last = fits.copy()
        last[:-1] &= new[1:] | ~fits[1:]
        tail = np.flatnonzero(last)
        end = np.minimum(tail + length, edge[row[head] + 1])
        windows, longs = tail - head + 1, np.maximum(end - head - length + 1, 0)
        whole = mix64((sums[end] - sums[head]) * down[head] + (windows * 8191 + end - head).astype(np.uint64))
        yield row[head] + first, edges[row[head]] - off[row[head] + first] + head - edge[row[head]], windows, longs, grams[least[head].astype(np.int64)], whole


_CONTEXT = pa.schema([("doc", pa.int64()), ("at", pa.int64()), ("anchor", pa.int64()), ("context", pa.int64())])


def _contexts_of(length: int, passage: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            doc = batch.column(0).to_numpy()
            for row, start, windows, longs, key, whole in contexts(*byte_column(batch.column(1)), length, passage, anchor):
                at = ((start << _FIELD) | windows) << _FIELD | longs
                yield pa.RecordBatch.from_arrays([pa.array(doc[row]), pa.array(at, pa.int64()), pa.array(as_long(key)), pa.array(as_long(whole))], schema=_CONTEXT)

    return run


def _unpacked(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """start, windows, long windows."""
    low = (1 << _FIELD) - 1
    return at >> 2 * _FIELD, at >> _FIELD & low, at & low


class RunLengthIndex:
    """The run-length compressed transform of texts that are never matched across.

    Of each text, only the suffixes at its first `starts` bytes, by default all, take part: the
    bodies of neighbouring contexts overlap after those."""

    def __init__(self, data: np.ndarray, off: np.ndarray, starts: np.ndarray | None = None) -> None:
        n, m = int(off[-1] - off[0]), len(off) - 1
        size = np.diff(off).astype(np.int32)
        self.start = (off[:-1] - off[0] + np.arange(m)).astype(np.int32)  # a separator follows each text
        self.stop = self.start + size
        text = np.zeros(n + m + 7, np.int64)
        inside = np.ones(n + m, bool)
        inside[self.stop] = False
        text[: n + m][inside] = data[off[0] : off[-1]].astype(np.int64) + 1
        self.left = np.repeat(self.stop, size + 1) - np.arange(n + m, dtype=np.int32)  # bytes up to the separator
        two = text[:-1] << 9 | text[1:]
        four = two[:-2] << 18 | two[2:]
        key = four[: n + m] << 27 | four[4:] >> 9  # seven symbols from each position
        order = self._order(key)
        if starts is not None:
            order = order[self.left[order] > np.repeat(size - starts.astype(np.int32), size + 1)[order]]
        before = np.where(order > 0, text[order - 1], 0)
        # Separators differ from one another, so each makes a run of its own.
        cut = np.ones(len(order) + 1, bool)
        cut[1:-1] = (before[1:] != before[:-1]) | (before[1:] == 0)
        heads, tails = np.flatnonzero(cut[:-1]), np.flatnonzero(cut[1:])
        self.symbols = before[heads]
        self.lengths = tails - heads + 1
        up, down = np.maximum(heads - 1, 0), np.minimum(tails + 1, len(order) - 1)
        words = np.append(key >> 18, 0)  # five symbols from each position
        self.head_at, self.head_match = order[heads], np.where(heads > 0, self._match(words, order[heads], order[up]), 0)
        self.tail_at, self.tail_match = order[tails], np.where(tails < len(order) - 1, self._match(words, order[tails], order[down]), 0)

    def _order(self, key: np.ndarray) -> np.ndarray:
        """Suffixes in order, by prefix doubling from ranks of the first seven symbols."""
        total = len(key)
        # What follows a separator does not count.
        short = np.flatnonzero(self.left < 7)
        key = key.copy()
        key[short] &= np.int64(-1) << (9 * (7 - self.left[short].astype(np.int64)))
        order = np.argsort(key).astype(np.int32)
        # Equal keys with a separator inside are told apart by which separator it is.
        ended = np.flatnonzero(self.left[order] < 7)
        at = order[ended]
        order[ended] = at[np.lexsort((at, key[at]))]
        apart = np.ones(total, bool)
        key = key[order]
        apart[1:] = key[1:] != key[:-1]
        apart[ended] = True
        # The rank of a suffix is the first slot of its group; only groups of two and more are
        # sorted again, by the rank of what follows.
        rank = np.empty(total + 1, np.int32)
        rank[total] = -1
        rank[order] = np.maximum.accumulate(np.where(apart, np.arange(total, dtype=np.int32), np.int32(0)))
        live = np.flatnonzero(~(apart & np.append(apart[1:], True))).astype(np.int32)
        width = 7
        while len(live):
            at = order[live]
            key = rank[at].astype(np.int64) << 32
            key |= rank[np.minimum(at + width, total)] + 1
            turn = np.argsort(key)
            key, at = key[turn], at[turn]
            order[live] = at
            new = np.append(True, key[1:] != key[:-1])
            rank[at] = live[np.maximum.accumulate(np.where(new, np.arange(len(live), dtype=np.int32), np.int32(0)))]
            live = live[~(new & np.append(new[1:], True))]
            width *= 2
        return order

    def _match(self, words: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common prefix lengths, up to either's separator."""
        bound = np.minimum(self.left[a], self.left[b])
        out = np.zeros(len(a), np.int32)
        live = np.flatnonzero(bound > 0)
        at = 0
        while len(live):
            x = words[a[live] + at] ^ words[b[live] + at]
            same = x == 0
            odd = live[~same]
            # The highest differing bit tells how many of the five symbols agree.
            out[odd] = at + (45 - np.frexp(x[~same].astype(np.float64))[1]) // 9
            live = live[same]
            at += 5
            ended = bound[live] <= at
            out[live[ended]] = bound[live[ended]]
            live = live[~ended]
        return np.minimum(out, bound)

    def statistics(self) -> np.ndarray:
        """For each byte of the texts in turn, the longest match that starts anywhere else."""
        total = int(self.stop[-1]) + 1
        place = np.arange(total, dtype=np.int32)
        longest = np.zeros(total, np.int32)
        for at, match in ((self.head_at, self.head_match), (self.tail_at, self.tail_match)):
            known, last = np.zeros(total, np.int32), np.zeros(total, np.int32)
            known[at] = match
            last[at] = at
            np.maximum.accumulate(last, out=last)
            np.maximum(longest, known[last] - (place - last), out=longest)
        keep = np.ones(total, bool)
        keep[self.stop] = False
        return longest[keep]


def _runs(mask: np.ndarray) -> list[int]:
    """start, stop, start, stop, ... of the true runs."""
    return np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))).tolist()


_RUNS = "anchor long, context long, passages array<int>, runs array<int>"
_SIDES = ("passages", "runs")


def _run_table(anchor: pa.Array, context: pa.Array, passages: list[list[int]], runs: list[list[int]]) -> pa.Table:
    return pa.table({"anchor": anchor, "context": context, "passages": pa.array(passages, pa.list_(pa.int32())), "runs": pa.array(runs, pa.list_(pa.int32()))})


def _whole(n: int) -> list[int]:
    return [0, n] if n else []


def _indexed(length: int, passage: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        col = table.column("body").combine_chunks().cast(pa.large_binary())
        off = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
        data = np.frombuffer(col.buffers()[2], np.uint8)
        _, windows, longs = _unpacked(table.column("at").to_numpy())
        weight = table.column("weight").to_numpy()
        longest = RunLengthIndex(data, off, windows).statistics()
        base, sides = off - off[0], ([], [])
        for found, least, count in ((sides[0], passage, windows.tolist()), (sides[1], length, longs.tolist())):
            mark = longest >= least
            for i, n in enumerate(count):
                found.append(_whole(n) if weight[i] > 1 else _runs(mark[base[i] : base[i] + n]))
        return _run_table(table.column("anchor"), table.column("context"), *sides)

    return run


def _bodies(length: int):
    """Cut the wanted contexts out of the texts: text, wants -> contexts with their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for text, wants in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for w in wants:
                    start, windows, _ = _unpacked(w["at"])
                    out.append((w["anchor"], w["context"], w["at"], w["weight"], w["hot"], text[start : start + windows + length - 1]))
                    if len(out) == 4096:
                        yield _cut(out)
                        out = []
            if out:
                yield _cut(out)

    return run


_BODY = pa.schema([("anchor", pa.int64()), ("context", pa.int64()), ("at", pa.int64()), ("weight", pa.int64()), ("hot", pa.bool_()), ("body", pa.binary())])


def _cut(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _BODY, strict=True)], schema=_BODY)


def _window_hashes(length: int, passage: int):
    """The exact way for hot anchors: every window of every context, hashed, for both lengths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for anchor, context, at, weight, body in zip(*[batch.column(i).to_pylist() for i in range(5)], strict=True):
                raw = np.frombuffer(body, np.uint8)
                sums, down = prefix_sums(raw), powers(len(raw))[1]
                _, windows, longs = _unpacked(at)
                for side, size, n in ((0, passage, windows), (1, length, longs)):
                    place = np.arange(n)
                    value = mix64((sums[place + size] - sums[place]) * down[place])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, anchor)), pa.array(np.full(n, context)), pa.array(np.full(n, side, np.int32)), pa.array(place.astype(np.int32)), pa.array(as_long(value)), pa.array(np.full(n, weight))], names=["anchor", "context", "side", "place", "value", "weight"])

    return run


def _crowded(bodies: DataFrame, length: int, passage: int) -> DataFrame:
    """anchor, context, passages, runs of contexts whose anchor has too many for one index."""
    singles = stored(bodies.select("anchor", "context", "at", "weight", "body").mapInArrow(_window_hashes(length, passage), "anchor long, context long, side int, place int, value long, weight long"), "singles")
    twice = stored(singles.groupBy("anchor", "side", "value").agg(F.sum("weight").alias("n")).where("n > 1").select("anchor", "side", "value"), "twice")
    hits = singles.join(twice, ["anchor", "side", "value"], "left_semi").groupBy("anchor", "context")
    ends = lambda side: F.flatten(F.transform(F.array_sort(F.collect_set(F.when(F.col("side") == side, F.col("place")))), lambda a: F.array(a, a + 1)))
    return hits.agg(*[ends(side).alias(name) for side, name in enumerate(_SIDES)])


def repeated(docs: DataFrame, length: int = LENGTH, passage: int = PASSAGE, anchor: int = ANCHOR, hot: int = HOT, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc, runs, passages: byte spans (arrays of start, stop structs) of each row so keyed that
    repeated strings of `length` and of `passage` bytes cover."""
    if not anchor < passage <= length or passage - anchor >= 1 << _FIELD:
        raise ValueError("anchor < passage <= length, and passage - anchor below 1024")
    rows = docs.select(_doc().alias("doc"), _text().alias("text"))
    found = stored(rows.mapInArrow(_contexts_of(length, passage, anchor), "doc long, at long, anchor long, context long"), "contexts")
    again = stored(found.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "anchors")
    live = stored(sifted(found, "anchor", sieve(again, "anchor")).join(again, "anchor", "left_semi"), "live")
    # A place of each distinct context, its least document and start.
    places = live.groupBy("anchor", "context").agg(F.count("*").alias("weight"), F.min(F.struct("doc", "at")).alias("first"))
    places = stored(places.select("anchor", "context", "weight", "first.doc", "first.at"), "places")
    groups = stored(places.groupBy("anchor").agg(F.count("*").alias("k")), "groups")
    places = stored(places.join(groups, "anchor"), "distinct")
    windows, longs = (F.shiftright("at", b).bitwiseAND((1 << _FIELD) - 1).cast("int") for b in (_FIELD, 0))
    whole = lambda n: F.when(n > 0, F.array(F.lit(0), n)).otherwise(F.array().cast("array<int>"))
    plain = places.where("k = 1").select("anchor", "context", whole(windows).alias("passages"), whole(longs).alias("runs"))
    mixed = places.where("k > 1")
    counts = mixed.agg(F.sum(F.when(F.col("k") <= hot, windows + (length - 1))).alias("bytes"), F.max("k").alias("k")).first()
    buckets = max(1, -(-(counts["bytes"] or 0) // bucket_bytes))
    wants = stored(mixed.groupBy("doc").agg(F.collect_list(F.struct("anchor", "context", "at", "weight", (F.col("k") > hot).alias("hot"))).alias("wants")), "wants")
    bodies = sifted(rows, "doc", sieve(wants, "doc")).join(wants, "doc").select("text", "wants").mapInArrow(_bodies(length), "anchor long, context long, at long, weight long, hot boolean, body binary")
    crowd = (counts["k"] or 0) > hot
    bodies = stored(bodies, "bodies") if crowd else bodies
    index = bodies.where("not hot").withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets)))
    runs = index.groupBy("bucket").applyInArrow(_indexed(length, passage), _RUNS).unionByName(plain)
    if crowd:
        runs = runs.unionByName(_crowded(bodies.where("hot"), length, passage))
    # Rows that repeat doc_id and text give their contexts more than once.
    runs = stored(runs.where(F.size("passages") > 0).dropDuplicates(["anchor", "context"]), "runs")
    marks = live.join(runs, ["anchor", "context"])
    start = F.shiftright("at", 2 * _FIELD)

    def spans(name: str, size: int) -> F.Column:
        pairs = F.when(F.size(name) > 0, F.sequence(F.lit(0), F.size(name) - 2, F.lit(2))).otherwise(F.array().cast("array<int>"))
        return F.transform(pairs, lambda i: F.struct((start + F.get(name, i)).alias("start"), (start + F.get(name, i + 1) + (size - 1)).alias("stop"))).alias(name)

    marks = marks.select("doc", spans("passages", passage), spans("runs", length))
    return marks.groupBy("doc").agg(*[F.flatten(F.collect_list(n)).alias(n) for n in _SIDES])


def _text() -> F.Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def _doc() -> F.Column:
    return F.xxhash64("doc_id", _text())


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, stop in sorted((s["start"], s["stop"]) for s in spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [(a, b) for a, b in out]


def cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for start, stop in spans:
        out.append(text[at:start])
        at = stop
    return b"".join([*out, text[at:]])


def passages_of(text: bytes, spans: list[tuple[int, int]], words: int = PASSAGE_WORDS) -> list[tuple[int, int]]:
    """The spans with over `words` words, runs of bytes other than [\x20\x09-\x0D]."""
    return [(a, b) for a, b in spans if len(text[a:b].split()) > words]


_CHANGED = "doc long, n_removed long, n_spans long, kept_sha256 string, n_passages long, n_passage_bytes long"


def _changed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        out = []
        for text, runs, passages in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            gone, long = merged(runs), passages_of(text, merged(passages))
            out.append((sum(b - a for a, b in gone), len(gone), hashlib.sha256(cut(text, gone)).hexdigest(), len(long), sum(b - a for a, b in long)))
        columns = list(zip(*out, strict=True)) if out else [()] * 5
        types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]], names=["doc", "n_removed", "n_spans", "kept_sha256", "n_passages", "n_passage_bytes"])


def remove_repeats(docs: DataFrame, **options: int) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_passages, n_passage_bytes: one row per
    row of docs."""
    spans = stored(repeated(docs, **options), "spans")
    texts = docs.select(_doc().alias("doc"), _text().alias("text"))
    hit = sifted(texts, "doc", sieve(spans, "doc")).join(spans, "doc").select("doc", "text", "runs", "passages")
    changed = stored(hit.mapInArrow(_changed, _CHANGED).dropDuplicates(["doc"]), "changed")
    # Texts without a repeat are done here; they are neither shuffled nor handed to Python.
    rows = docs.select(_doc().alias("doc"), F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(_text()).cast("long").alias("n_bytes"), F.sha2(_text(), 256).alias("same"))
    zero = lambda n: F.coalesce(n, F.lit(0).cast("long")).alias(n)
    out = rows.join(changed, "doc", "left")
    return out.select("doc_id", "n_bytes", zero("n_removed"), zero("n_spans"), F.coalesce("kept_sha256", "same").alias("kept_sha256"), zero("n_passages"), zero("n_passage_bytes"))
