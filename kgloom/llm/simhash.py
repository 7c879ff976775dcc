"""SimHash near-duplicates by the generalised pigeonhole principle.

A fingerprint has 64 bits, each the majority of that bit over the XXH64 values of the text's
3-word shingles.  To link fingerprints that differ in at most RADIUS bits, the bits are split
into parts, correlated ones into the same part, and part i gets a budget b_i of 0 or more with
sum RADIUS + 1: a linked pair differs in fewer than b_i bits on some part i with b_i > 0.  A
dynamic programme chooses the budgets, for two, three and four parts, that minimise the estimated
candidates and probes; a part that tells little apart gets no budget, a telling one more.

Estimates: the pairs equal on a part are counted over all fingerprints; those one or two bits
apart follow from them and from how often each bit is set.

Probe and verify: a fingerprint is found under its own bits of each part with a budget, and
probes those within b_i - 1 flips; the full distance is tested inside the join, so no candidate
leaves it.

Hot buckets.  Where more than HOT different fingerprints share the bits of a part, these and all
that probe the bucket exchange the 65 words within one flip of them instead.  Two at a distance
of two or less meet at a word, and those that meet at a word are within two of each other; at
most 65 meet, so this is exact, linear, and makes no pairs but links to one of them.

Scale: copies fall into one fingerprint before anything is joined, with partial aggregates; rows of
a fingerprint that many have get their component from a broadcast of at most COMMON rows.  The
driver gets 64 x 64 bit counts and one count a part.

Defined cases: null, empty or blank text has fingerprint zero and is linked like any other; under
three words, the whole sequence is the one shingle.  Rows may repeat, their doc_id too: a
component is named by its smallest doc_id, null where none has one.  Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checked_broadcast, slices, stored
from .minhash import components

WIDTH, SEED, BITS, RADIUS = 3, 42, 64, 2
PARTS = (2, 3, 4)
HOT = 256
# What a probe costs, in comparisons of two fingerprints.
PROBE = 8.0
CHUNK = 1 << 16
COMMON = 10_000

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingle_hashes(text: bytes) -> Iterator[np.ndarray]:
    """XXH64 of every shingle, repeats included, in parts of at most CHUNK."""
    words = text.translate(_LOWER).split()
    if not words:
        return
    joined = b" ".join(words)
    stop = np.cumsum([len(w) + 1 for w in words]) - 1
    start = np.concatenate([[0], stop[:-1] + 1])
    first, last = start[: 1 - WIDTH].tolist() or [0], stop[WIDTH - 1 :].tolist() or [len(joined)]
    one = xxhash.xxh64_intdigest
    for at in range(0, len(first), CHUNK):
        yield np.array([one(joined[i:j], SEED) for i, j in zip(first[at : at + CHUNK], last[at : at + CHUNK], strict=True)], np.uint64)


def fingerprint(text: bytes) -> int:
    ones, n = np.zeros(BITS, np.int64), 0
    for h in shingle_hashes(text):
        ones += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(h)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        prints = np.array([fingerprint((t or "").encode()) for t in batch.column(1).to_pylist()], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], names=["doc_id", "print"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, print: the 64 bits as a signed integer."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_fingerprints, "doc_id long, print long")


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    both = np.zeros((BITS, BITS), np.int64)
    for batch in batches:
        raw = batch.column(0).to_numpy(zero_copy_only=False)
        for at in range(0, len(raw), CHUNK):
            bits = np.unpackbits(raw[at : at + CHUNK].astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            both += (bits.T @ bits).astype(np.int64)
    at = np.flatnonzero(both)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(both.ravel()[at])], names=["pair", "n"])


def bits_together(prints: DataFrame) -> np.ndarray:
    """How many fingerprints have bits i and j set, for every i and j."""
    out = np.zeros(BITS * BITS, np.int64)
    for r in prints.select("print").mapInArrow(_together, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        out[r["pair"]] = r["n"]
    return out.reshape(BITS, BITS)


def grouped(together: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """The bits in `parts` groups of nearly equal size, correlated ones together."""
    p = together.diagonal() / n
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    like = np.abs((together / n - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(like, 0)
    left, out = list(range(BITS)), []
    for k in range(parts):
        size = len(left) // (parts - k)
        group = [max(left, key=lambda b: (like[b, left].sum(), -b))]
        left.remove(group[0])
        while len(group) < size:
            group.append(max(left, key=lambda b: (like[b, group].sum(), -b)))
            left.remove(group[-1])
        out.append(sorted(group))
    return out


def signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def mask(bits: list[int]) -> int:
    return signed(sum(1 << b for b in bits))


def flips(bits: list[int], most: int) -> list[int]:
    """The masks of at most `most` of the bits."""
    return [mask(list(c)) for k in range(most + 1) for c in combinations(bits, k)]


def expected(pairs: float, n: int, bits: list[int], p: np.ndarray, budget: int) -> float:
    """Estimated cost of a part: comparisons and probes.  pairs: the pairs equal on the part."""
    if not budget:
        return 0.0
    apart = 2 * p[bits] * (1 - p[bits]) / (p[bits] ** 2 + (1 - p[bits]) ** 2)
    ways = [1.0, apart.sum(), (apart.sum() ** 2 - (apart**2).sum()) / 2]
    return pairs * sum(ways[:budget]) + PROBE * n * len(flips(bits, budget - 1))


def budgets(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """The budgets of least cost with the sum `total`; costs[i][b] is that of part i at budget b."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        new: dict[int, tuple[float, list[int]]] = {}
        for spent, (cost, chosen) in best.items():
            for b in range(total - spent + 1):
                option = (cost + row[b], [*chosen, b])
                if spent + b not in new or option < new[spent + b]:
                    new[spent + b] = option
        best = new
    return best[total]


def buckets(prints: DataFrame, splits: list[list[list[int]]]) -> DataFrame:
    """split, part, key, n: how many fingerprints share their bits on each part of each split."""
    own = [F.struct(F.lit(s).alias("split"), F.lit(i).alias("part"), F.col("print").bitwiseAND(F.lit(mask(bits))).alias("key")) for s, parts in enumerate(splits) for i, bits in enumerate(parts)]
    return prints.select(F.inline(F.array(*own))).groupBy("split", "part", "key").agg(F.count("*").alias("n"))


def links(prints: DataFrame) -> DataFrame:
    """a, b: links between different fingerprints; each pair within RADIUS bits is connected by
    them, directly or over others that are linked."""
    together = bits_together(prints)
    n = prints.count()
    if n < 2:
        return prints.select(F.col("print").alias("a"), F.col("print").alias("b")).limit(0)
    splits = [grouped(together, n, m) for m in PARTS]
    held = stored(buckets(prints, splits), "buckets")
    p = together.diagonal() / n
    same = {(r["split"], r["part"]): r["pairs"] for r in held.groupBy("split", "part").agg(F.sum(F.col("n").cast("double") * (F.col("n") - 1) / 2).alias("pairs")).collect()}
    plans = [budgets([[expected(same[s, i], n, bits, p, b) for b in range(RADIUS + 2)] for i, bits in enumerate(parts)], RADIUS + 1) for s, parts in enumerate(splits)]
    split = min(range(len(plans)), key=lambda s: plans[s][0])
    used = [(i, splits[split][i], b) for i, b in enumerate(plans[split][1]) if b]
    hot = held.where((F.col("split") == split) & (F.col("n") > HOT)).select("part", "key", F.lit(True).alias("hot"))
    n_hot = hot.count()
    at_home = lambda bits: F.col("print").bitwiseAND(F.lit(mask(bits)))
    own = prints.select("print", F.inline(F.array(*[F.struct(F.lit(i).alias("part"), at_home(bits).alias("key")) for i, bits, _ in used])))
    sought = [F.struct(F.lit(i).alias("part"), at_home(bits).alias("home"), at_home(bits).bitwiseXOR(F.lit(f)).alias("key")) for i, bits, b in used for f in flips(bits, b - 1)]
    probes = prints.select("print", F.inline(F.array(*sought)))
    words = None
    if n_hot:
        hot = checked_broadcast(hot, n_hot)
        loud = own.join(hot, ["part", "key"]).select("print").unionByName(probes.join(hot, ["part", "key"]).select("print")).distinct()
        words = loud.select("print", F.explode(F.array(*[F.col("print").bitwiseXOR(F.lit(f)) for f in flips(list(range(BITS)), 1)])).alias("word"))
        # At most 65 fingerprints are within one flip of a word.
        words = words.withColumn("b", F.min("print").over(Window.partitionBy("word"))).where("print <> b").select(F.col("print").alias("a"), "b").distinct()
        own = own.join(hot, ["part", "key"], "left_anti")
        probes = probes.join(hot.withColumnRenamed("key", "home"), ["part", "home"], "left_anti")
    near = (F.col("q.print") < F.col("x.print")) & (F.bit_count(F.col("q.print").bitwiseXOR(F.col("x.print"))) <= RADIUS)
    same_key = (F.col("q.part") == F.col("x.part")) & (F.col("q.key") == F.col("x.key"))
    found = own.alias("x").join(probes.select("print", "part", "key").alias("q"), same_key & near).select(F.col("x.print").alias("a"), F.col("q.print").alias("b")).distinct()
    return found if words is None else found.unionByName(words)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint, component_id: one row per row of docs."""
    marks = stored(fingerprints(docs), "prints")
    classes = stored(marks.groupBy("print").agg(F.min("doc_id").alias("low"), F.count("*").alias("n")), "classes")
    total = classes.agg(F.sum("n")).first()[0] or 0
    found = components(stored(links(classes), "links"))
    low = found.join(classes.withColumnRenamed("print", "node"), "node").groupBy("component").agg(F.min("low").alias("component_id"))
    named = found.join(low, "component").select(F.col("node").alias("print"), "component_id")
    named = stored(classes.join(named, "print", "left").select("print", "n", F.coalesce("component_id", "low").alias("component_id")), "named")
    # At most COMMON fingerprints have over a COMMON-th of the rows each: their rows do not move.
    often = F.col("n") > total / COMMON
    common = F.broadcast(named.where(often).select("print", "component_id"))
    rows = marks.join(common, "print").select("doc_id", "print", "component_id")
    rest = marks.join(common, "print", "left_anti").join(named.where(~often), "print").select("doc_id", "print", "component_id")
    return rows.unionByName(rest).select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
