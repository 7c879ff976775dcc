"""Packing into length buckets that are optimal for the whole corpus.

A document is cut into pieces of at most MAX_LENGTH tokens.  The histogram of piece lengths
is counted in Spark; it has at most MAX_LENGTH + 1 rows however large the corpus, and dynamic
programming over it picks the bucket boundaries with the least padding in all.  Inside a
bucket, pieces fill batches of TOKEN_BUDGET padded tokens.

Scale.  A bucket is dealt into shards of about SHARD_ROWS pieces by a hash of doc_id, text and piece, so no sort
holds a bucket or the rows of one repeated or null doc_id; each shard leaves at most one batch short.

Tokens are the words between [\\x20\\x09-\\x0D].  Null, empty and blank texts are one piece of
length 0.  Rows with the same doc_id are packed as separate rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import byte_column, slices, spans_of, stored

MAX_LENGTH = 2048
BUCKETS = 8
TOKEN_BUDGET = 1 << 16
SHARD_ROWS = 1 << 15
CHUNK = 1 << 22


def word_counts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    out = []
    for lo, hi in spans_of(off, CHUNK):
        raw = data[off[lo] : off[hi]]
        edge = off[lo : hi + 1] - off[lo]
        ink = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
        start = ink.copy()
        start[1:] &= ~ink[:-1]
        full = edge[:-1][edge[1:] > edge[:-1]]
        start[full] = ink[full]
        total = np.concatenate([[0], np.cumsum(start)])
        out.append(np.diff(total[edge]))
    return np.concatenate([*out, np.zeros(0, np.int64)]).astype(np.int64)


def _cut(longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n = word_counts(*byte_column(batch.column(1)))
            pieces = np.maximum(1, -(-n // longest))
            row = np.repeat(np.arange(len(n)), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * longest
            size = np.minimum(longest, n[row] - start)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(piece, pa.int64()), pa.array(start, pa.int64()), pa.array(size, pa.int64()), batch.column(2).take(pa.array(row))], names=["doc_id", "piece", "start", "n_tokens", "row"])

    return run


def pieces(docs: DataFrame, longest: int = MAX_LENGTH) -> DataFrame:
    """doc_id, piece, start, n_tokens, row (a hash of doc_id and text)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("row", F.xxhash64("doc_id", "text"))
    return rows.mapInArrow(_cut(longest), "doc_id long, piece long, start long, n_tokens long, row long")


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int = BUCKETS) -> list[int]:
    """Upper bounds of at most `buckets` buckets over ascending lengths, with the least
    padding: best[j] after k rounds is the least padded size of the first j lengths in k
    buckets."""
    n = len(lengths)
    if not n:
        return []
    seen = np.concatenate([[0], np.cumsum(counts)]).astype(np.float64)
    best = np.full(n + 1, np.inf)
    best[0] = 0
    back = []
    for _ in range(min(buckets, n)):
        new, cut = best.copy(), np.arange(n + 1)
        for j in range(1, n + 1):
            cost = best[:j] + lengths[j - 1] * (seen[j] - seen[:j])
            i = int(cost.argmin())
            if cost[i] < new[j]:
                new[j], cut[j] = cost[i], i
        back.append(cut)
        best = new
    out, j = [], n
    for cut in reversed(back):
        if cut[j] < j:
            out.append(int(lengths[j - 1]))
            j = int(cut[j])
    return out[::-1]


def pack(docs: DataFrame, longest: int = MAX_LENGTH, buckets: int = BUCKETS, budget: int = TOKEN_BUDGET, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """doc_id, piece, start, n_tokens, bucket, padded, batch_id, slot: one row per piece."""
    cut = stored(pieces(docs, longest), "pieces")
    histogram = cut.groupBy("n_tokens").agg(F.count("*").alias("n")).orderBy("n_tokens").collect()
    lengths = np.array([r["n_tokens"] for r in histogram], np.int64)
    counts = np.array([r["n"] for r in histogram], np.int64)
    tops = boundaries(lengths, counts, buckets) or [0]
    held = [int(counts[(lengths <= top) & (lengths > low)].sum()) for low, top in zip([-1, *tops], tops, strict=False)]
    numbers = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])
    bucket = F.size(F.filter(numbers(tops), lambda t: t < F.col("n_tokens")))
    shards = numbers([-(-h // shard_rows) or 1 for h in held])
    rows = cut.withColumn("bucket", bucket).withColumn("padded", F.get(numbers(tops), F.col("bucket")))
    rows = rows.withColumn("mix", F.xxhash64("row", "piece")).withColumn("shard", F.pmod(F.col("mix"), F.get(shards, F.col("bucket"))))
    order = Window.partitionBy("bucket", "shard").orderBy("mix", "doc_id", "piece", "row")
    room = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(F.lit(1), "padded")))
    rows = rows.withColumn("rank", F.row_number().over(order) - 1)
    batch = F.concat_ws("-", F.col("bucket").cast("string"), F.col("shard").cast("string"), F.floor(F.col("rank") / room).cast("string"))
    return rows.select("doc_id", "piece", "start", "n_tokens", "bucket", "padded", batch.alias("batch_id"), (F.col("rank") % room).alias("slot"))
