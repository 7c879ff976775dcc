"""Shared helpers: durable intermediate tables, checked broadcasts, byte-level hashing."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only when its counted rows stay under this; beyond it the join shuffles.
BROADCAST_ROWS = 1_000_000
# Rows and bytes of what a Python worker takes at once.
BATCH_ROWS = 1000
BATCH_BYTES = 1 << 24


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir.  Where it is unset, one of our own if driver and
    executors are one process (tests), else an error: executors share no local folder."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="kgloom-")
        spark.sparkContext.setCheckpointDir(path)
    return path


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Hand Python at most BATCH_ROWS rows at once while a table is written; then the session's
    own setting holds again."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if not 0 < int(before) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: lineage is cut and a lost
    executor costs one task, not a recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with small_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checked_broadcast(df: DataFrame, rows: int | None = None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """df marked for broadcast if it has at most `limit` rows; else df as it is, to be shuffled."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= limit else df


BATCH_ROWS = 1000
def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most BATCH_ROWS rows and, where a row is not longer itself,
    about BATCH_BYTES bytes, so that what a worker makes of one part is bounded."""
    for batch in batches:
        n = batch.num_rows
        step = max(1, min(BATCH_ROWS, n * BATCH_BYTES // max(1, batch.nbytes)))
        for at in range(0, n, step):
            yield batch.slice(at, step)


# Words of 64 bits in the bitmap of a sieve: it is broadcast and takes about 50 bytes a word.
SIEVE_WORDS = 1 << 19


def _place(key: str) -> F.Column:
    return F.pmod(F.xxhash64(key), F.lit(SIEVE_WORDS * 64))


def sieve(keys: DataFrame, key: str) -> DataFrame:
    """word, bits: a bitmap of the hashes of `key`, of at most SIEVE_WORDS rows however many keys
    there are."""
    place = _place(key)
    return keys.select((place / 64).cast("long").alias("word"), F.expr("1L").alias("one"), place.bitwiseAND(63).cast("int").alias("bit")).groupBy("word").agg(F.bit_or(F.expr("shiftleft(one, bit)")).alias("bits"))


def sifted(rows: DataFrame, key: str, bits: DataFrame) -> DataFrame:
    """The rows whose key may be one of the sieve's: all that are, and few others while the
    bitmap is not full.  An exact join has to follow."""
    place = _place(key)
    marked = rows.withColumns({"word": (place / 64).cast("long"), "bit": place.bitwiseAND(63).cast("int")}).join(F.broadcast(bits), "word")
    return marked.where(F.expr("shiftright(bits, bit) & 1 = 1")).drop("word", "bit", "bits")


def byte_column(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and its n+1 offsets; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    arr = col.cast(pa.large_string()).cast(pa.large_binary())
    off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset : arr.offset + len(arr) + 1] if len(arr) else np.zeros(1, np.int64)
    buf = arr.buffers()[2]
    data = np.frombuffer(buf, np.uint8) if buf is not None else np.zeros(0, np.uint8)
    return data, off


def spans_of(off: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Row ranges whose bytes come to about `size`; every row belongs to one range."""
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + size, side="right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i <= n."""
    if len(_POWERS.get("up", ())) <= n:
        size = max(n + 1, 1 << 20)
        for key, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[key] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """S with S[j] - S[i] = sum of (data[k] + 1) * BASE**k over i <= k < j, modulo 2**64."""
    up, _ = powers(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=out[1:])
    return out


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
