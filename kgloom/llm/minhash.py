"""Near-duplicate documents by circulant MinHash.

Signature: one permutation of the shingle space (sigma), then a second one (pi) shifted by
1..K positions around the circle gives all K coordinates; rows of coordinates form bands.
Banding proposes pairs, and the exact Jaccard similarity of the full shingle sets decides.

Scale.  Documents with equal shingle sets collapse into a class first.  A band bucket of m
classes proposes m-1 pairs with its smallest member, never all pairs.  Members of one bucket
that are still in different components afterwards meet in blocks of bounded size: pairs whose
signatures agree in at least AGREE of the 128 coordinates (a pair at the threshold agrees in
96 on average; the chance to miss it is 4e-6) have their sets compared there, until one link
joins the components; no pair is emitted but a confirmed link.
Texts travel once per head pair, grouped by the bucket's head with a salt per 512 pairs, and
once per block, so no task holds an unbounded group.

Defined cases: null, empty or blank text has no shingles and is linked with nothing; under
five words, the whole sequence is the one shingle.  Rows that repeat doc_id and text count as
one document; texts that share a doc_id are told apart.  A null doc_id
cannot name a component: the row takes that of equal texts, or null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_long, byte_column, checked_broadcast, mix64, powers, prefix_sums, slices, spans_of, stored

WIDTH = 5
BANDS, ROWS = 32, 4
PERCENT = 75
CHUNK = 1 << 20
PAIRS_PER_SALT = 512
BLOCK = 1024
BLOCK_SHINGLES = 1 << 22
OPEN_BROADCAST = 250_000
AGREE = 74

_LANES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def shingle_sets(data: np.ndarray, off: np.ndarray) -> Iterator[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each row."""
    for lo, hi in spans_of(off, CHUNK):
        first, last = off[lo], off[hi]
        raw = data[first:last]
        edge = off[lo : hi + 1] - first
        if not len(raw):
            yield from (np.zeros(0, np.uint64) for _ in range(lo, hi))
            continue
        low = np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)
        ink = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
        full = np.flatnonzero(edge[1:] > edge[:-1])
        before = np.zeros(len(raw), bool)
        before[1:] = ink[:-1]
        before[edge[full]] = False
        after = np.zeros(len(raw), bool)
        after[:-1] = ink[1:]
        after[edge[full + 1] - 1] = False
        start, stop = np.flatnonzero(ink & ~before), np.flatnonzero(ink & ~after) + 1
        sums = prefix_sums(low)
        _, down = powers(len(low))
        word = mix64((sums[stop] - sums[start]) * down[start])
        bound = np.searchsorted(start, edge)
        padded = np.concatenate([word, np.zeros(WIDTH, np.uint64)])
        run = np.zeros(len(word), np.uint64)
        for lane in range(WIDTH):
            run += padded[lane : lane + len(word)] * _LANES[lane]
        run = mix64(run)
        for r in range(hi - lo):
            a, b = bound[r], bound[r + 1]
            if b - a >= WIDTH:
                yield np.unique(run[a : b - WIDTH + 1])
            elif b > a:
                yield mix64(np.array([(word[a:b] * _LANES[: b - a]).sum() + np.uint64(b - a)], np.uint64))
            else:
                yield np.zeros(0, np.uint64)


def _scatter(x: np.ndarray) -> np.ndarray:
    """A bijection of 32-bit words, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def circulant_signature(shingles: np.ndarray, size: int = BANDS * ROWS) -> np.ndarray:
    """min over the set of pi(sigma(x) - k) for k = 1..size, on the circle of 2**32 points."""
    shift = np.arange(1, size + 1, dtype=np.uint32)[:, None]
    out = np.full(size, 0xFFFFFFFF, np.uint32)
    placed = _scatter((shingles >> np.uint64(32)).astype(np.uint32) ^ np.uint32(0x5BD1E995))
    for i in range(0, len(placed), 512):
        np.minimum(out, _scatter(placed[None, i : i + 512] - shift).min(axis=1), out=out)
    return out


def band_keys(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    parts = signature.reshape(-1, rows).astype(np.uint64)
    key = np.arange(1, len(parts) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for c in range(rows):
        key = mix64(key ^ parts[:, c])
    return key


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        data, off = byte_column(batch.column(2))
        n, one, two, bands, sketch = [], [], [], [], []
        for s in shingle_sets(data, off):
            n.append(len(s))
            one.append(int(as_long(s.sum(dtype=np.uint64, keepdims=True))[0]) if len(s) else 0)
            two.append(int(as_long(mix64(s ^ np.uint64(0xA5A5A5A5)).sum(dtype=np.uint64, keepdims=True))[0]) if len(s) else 0)
            coordinates = circulant_signature(s)
            bands.append(as_long(band_keys(coordinates)) if len(s) else np.zeros(0, np.int64))
            sketch.append(coordinates.astype(np.uint8).tobytes())
        cut = np.concatenate([[0], np.cumsum([len(b) for b in bands])]).astype(np.int32)
        keys = pa.ListArray.from_arrays(pa.array(cut), pa.array(np.concatenate([*bands, np.zeros(0, np.int64)])))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), keys, pa.array(sketch, pa.binary())], names=["doc_id", "row_key", "n_shingles", "set_a", "set_b", "bands", "sketch"])


def row_key(docs: DataFrame) -> F.Column:
    """Names a row by its doc_id and text."""
    return F.xxhash64(docs["doc_id"].cast("long"), docs["text"].cast("string"))


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, row_key, n_shingles, set_a, set_b (fingerprint of the set), bands, sketch (a byte of each
    coordinate)."""
    return docs.select(F.col("doc_id").cast("long"), row_key(docs).alias("row_key"), F.col("text").cast("string")).mapInArrow(_signatures, "doc_id long, row_key long, n_shingles long, set_a long, set_b long, bands array<long>, sketch binary")


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, held = None, None  # the head's row comes first in its group, which may span batches
        for batch in slices(batches):
            group, salt = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
            doc = batch.column(2).to_numpy(zero_copy_only=False)
            data, off = byte_column(batch.column(3))
            a, b = [], []
            for i, s in enumerate(shingle_sets(data, off)):
                if doc[i] == group[i]:
                    head, held = (group[i], salt[i]), s
                    continue
                if head != (group[i], salt[i]):
                    raise ValueError(f"no head for {group[i]}")
                if min(len(s), len(held)) * 100 >= percent * max(len(s), len(held)) and _jaccard(s, held, percent):
                    a.append(int(doc[i]))
                    b.append(int(group[i]))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def confirmed(docs: DataFrame, pairs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach `percent` Jaccard; a and b are row keys."""
    salts = pairs.groupBy("b").agg(F.ceil(F.count("*") / PAIRS_PER_SALT).alias("salts"))
    members = pairs.join(salts, "b").select(F.col("b").alias("head"), F.pmod(F.xxhash64("a"), F.col("salts")).cast("int").alias("salt"), F.col("a").alias("node"))
    used = members.select("head", "salt").distinct()
    wanted = stored(members.unionByName(used.withColumn("node", F.col("head"))), "wanted")
    texts = docs.select(row_key(docs).alias("node"), F.col("text").cast("string").alias("text")).join(checked_broadcast(wanted), "node")
    rows = texts.select("head", "salt", "node", "text").repartition("head", "salt").sortWithinPartitions("head", "salt", F.col("node") != F.col("head"), "node")
    return rows.mapInArrow(_confirm(percent), "a long, b long").distinct()


def _jaccard(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    small, large = (x, y) if len(x) <= len(y) else (y, x)
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    both = int((large[at] == small).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def _linked(rows: list[tuple], percent: int) -> list[tuple[int, int]]:
    """Confirmed links of one block pair (band, p, q, node, component, size, own, sketch, text)."""
    node, part, size, side = (np.array([r[i] for r in rows], np.int64) for i in (3, 4, 5, 6))
    seen = np.frombuffer(b"".join(r[7] for r in rows), np.uint8).reshape(len(rows), -1)
    p, q = rows[0][1], rows[0][2]
    sets: dict[int, np.ndarray] = {}

    def shingles(i: int) -> np.ndarray:
        if i not in sets:
            raw = rows[i][8].encode()
            sets[i] = next(shingle_sets(np.frombuffer(raw, np.uint8), np.array([0, len(raw)])))
        return sets[i]

    out = []
    right = np.flatnonzero(side == q)
    for i in np.flatnonzero(side == p):
        other = right[right > i] if p == q else right
        other = other[(part[other] != part[i]) & (np.minimum(size[other], size[i]) * 100 >= percent * np.maximum(size[other], size[i]))]
        for j in other[(seen[other] == seen[i]).sum(axis=1) >= AGREE]:
            if part[i] != part[j] and _jaccard(shingles(i), shingles(j), percent):
                out.append((int(max(node[i], node[j])), int(min(node[i], node[j]))))
                part[part == part[j]] = part[i]
    return out


def _blocks(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in slices(batches):
            links: list[tuple[int, int]] = []
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if rows and row[:3] != rows[0][:3]:
                    links += _linked(rows, percent)
                    rows = []
                rows.append(row)
            yield _pairs(links)
        yield _pairs(_linked(rows, percent) if rows else [])

    return run


def _pairs(links: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], names=["a", "b"])


def across(docs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Confirmed links (a, b) between components: members have band, node, component, size,
    sketch and, of the bucket, n and the sum of sizes."""
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    rows = members.select("band", "node", "component", "size", own.alias("own"), "sketch", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    rows = rows.select("band", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "node", "component", "size", "own", "sketch")
    rows = stored(rows, "open")
    texts = docs.select(row_key(docs).alias("node"), F.col("text").cast("string").alias("text"))
    rows = texts.join(checked_broadcast(rows, limit=OPEN_BROADCAST), "node").select("band", "p", "q", "node", "component", "size", "own", "sketch", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.repartition("band", "p", "q").sortWithinPartitions("band", "p", "q")
    return rows.mapInArrow(_blocks(percent), "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest reachable node) for every end of an edge.  Alternates
    large-star and small-star steps, which need logarithmically many rounds."""
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).distinct()
        now = stored(small, "stars")
        # Done when all are stars: a leaf has one centre and is nobody's centre.
        ends = now.select(F.col("u").alias("x"), F.lit(1).alias("leaf"), F.lit(0).alias("centre")).unionByName(now.select(F.col("v").alias("x"), F.lit(0).alias("leaf"), F.lit(1).alias("centre")))
        if not ends.groupBy("x").agg(F.sum("leaf").alias("leaf"), F.max("centre").alias("centre")).where("leaf > 1 or leaf + centre > 1").limit(1).count():
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, row_key: one row per row of docs."""
    marks = stored(signatures(docs), "marks")
    named = F.col("doc_id").isNotNull()
    classes = marks.where("n_shingles > 0").groupBy("set_a", "set_b", "n_shingles").agg(F.min(F.when(named, F.col("row_key"))).alias("node"), F.min("doc_id").alias("low"))
    # A class is known by one of its rows; only that one is banded.
    nodes = classes.where("node is not null").select(F.col("node").alias("row_key"), "set_a", "set_b")
    banded = marks.join(nodes, ["row_key", "set_a", "set_b"], "left_semi").select(F.col("row_key").alias("node"), "n_shingles", F.explode("bands").alias("band"))
    heads = banded.groupBy("band").agg(F.min("node").alias("head"), F.max("node").alias("tail")).where("head < tail").drop("tail")
    shared = stored(banded.join(heads, "band").select("band", "node", "n_shingles", "head"), "buckets")
    sizes = shared.groupBy("node").agg(F.max("n_shingles").alias("size"))
    fits = F.least("size", "head_size") * 100 >= F.greatest("size", "head_size") * percent
    # The size bound is needed only to spare texts; sizes of both ends come with the pair.
    pairs = shared.where("node <> head").select("node", "head", F.col("n_shingles").alias("size")).distinct()
    pairs = pairs.join(sizes.select(F.col("node").alias("head"), F.col("size").alias("head_size")), "head").where(fits)
    tested = stored(pairs.select(F.col("node").alias("a"), F.col("head").alias("b")), "tested")
    links = stored(confirmed(docs, tested, percent), "links")
    found = components(links)
    # Members of one bucket that are still apart: compare them across components, in blocks.
    placed = shared.join(found, "node", "left").select("band", "node", F.col("n_shingles").alias("size"), F.coalesce("component", "node").alias("component"))
    mixed = placed.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n"), F.sum("size").alias("shingles")).where("lo < hi").select("band", "n", "shingles")
    sketches = marks.join(nodes, ["row_key", "set_a", "set_b"], "left_semi").select(F.col("row_key").alias("node"), "sketch").dropDuplicates(["node"])
    open_ = placed.join(mixed, "band").join(sketches, "node")
    more = stored(across(docs, open_, percent), "links2")
    if more.limit(1).count():
        found = components(links.unionByName(more))
    # A component is named by its smallest doc_id.
    low = found.join(classes.select("node", "low"), "node").groupBy("component").agg(F.min("low").alias("component_id"))
    found = found.join(low, "component").select("node", "component_id")
    named = classes.join(found, "node", "left").select("set_a", "set_b", "n_shingles", F.coalesce("component_id", "low").alias("component_id"))
    out = marks.drop("bands", "sketch").join(named, ["set_a", "set_b", "n_shingles"], "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "row_key")
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
