"""Exact duplicates by an exchange of Golomb-coded fingerprints.

Each partition sorts the fingerprints of a block of rows, sends every owner (a range of the
fingerprint space) its share as a Golomb-Rice code and receives a bitmap of those that occur
elsewhere.  Only rows so marked (suspects) have their texts shuffled, to compare bytes.

Scale.  A fingerprint has 20 bits more than it takes to number the rows, so about one unique
row in a million becomes a suspect by chance.  A block sends each fingerprint once, so a
text that fills a third of the table costs an owner one entry per block.  The number of
owners grows with the rows; an owner holds about OWNER_ROWS fingerprints.

Texts are equal when they are after deleting [\\x20\\x09-\\x0D].  Of equal texts the row with
the most code points, then the smallest doc_id, stays.  Null counts as empty.  A null doc_id
stays only where no equal text has an id.  Rows that repeat both doc_id and text are one
document and share its verdict.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_column, checked_broadcast, slices, stored

OWNER_ROWS = 500_000
MIN_OWNERS = 12
BLOCK_ROWS = 1 << 18
SPARE_BITS = 20
GROUP_ROWS = 250_000  # of some 100 bytes each
BLANKS = b" \t\n\x0b\x0c\r"


def golomb_encode(values: np.ndarray, bits: int) -> bytes:
    """Ascending distinct integers below 2**bits: a header (count, rest bits), the quotients of
    the gaps in unary, the remainders in plain binary."""
    n = len(values)
    gaps = np.diff(values.astype(np.int64), prepend=0)
    low = max(0, bits - max(n, 1).bit_length())
    ends = np.cumsum((gaps >> low) + 1) - 1
    unary = np.ones(int(ends[-1]) + 1 if n else 0, np.uint8)
    unary[ends] = 0
    rest = (gaps[:, None] >> np.arange(low - 1, -1, -1)) & 1
    parts = np.packbits(unary).tobytes(), np.packbits(rest.astype(np.uint8).ravel()).tobytes()
    return n.to_bytes(4, "big") + low.to_bytes(1, "big") + len(parts[0]).to_bytes(4, "big") + parts[0] + parts[1]


def golomb_decode(code: bytes) -> np.ndarray:
    n, low, size = int.from_bytes(code[:4], "big"), code[4], int.from_bytes(code[5:9], "big")
    unary = np.unpackbits(np.frombuffer(code, np.uint8, size, 9))
    quotient = np.diff(np.flatnonzero(unary == 0)[:n], prepend=-1) - 1
    bits = np.unpackbits(np.frombuffer(code, np.uint8, offset=9 + size), count=n * low).reshape(n, low)
    rest = bits.astype(np.int64) @ (np.int64(1) << np.arange(low - 1, -1, -1, dtype=np.int64)) if low else 0
    return np.cumsum((quotient.astype(np.int64) << low) + rest)


_SENT = "block long, owner int, at int, twin boolean, doc_id long, n_chars long, sha binary, code binary"


def _send(bits: int, owners: int):
    span = -(-(1 << bits) // owners)

    def close(block: int, ids: list, chars: list, shas: list) -> Iterator[pa.RecordBatch]:
        key = np.array([int.from_bytes(s[:8], "big") for s in shas], np.uint64) >> np.uint64(64 - bits)
        found, where, count = np.unique(key.astype(np.int64), return_inverse=True, return_counts=True)
        owner = found // span
        first = np.searchsorted(owner, np.arange(owners))
        rows = len(shas)
        schema = pa.schema([("block", pa.int64()), ("owner", pa.int32()), ("at", pa.int32()), ("twin", pa.bool_()), ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("sha", pa.binary()), ("code", pa.binary())])
        yield pa.RecordBatch.from_arrays([pa.array(np.full(rows, block)), pa.array(owner[where].astype(np.int32)), pa.array((where - first[owner[where]]).astype(np.int32)), pa.array(count[where] > 1), pa.concat_arrays(ids), pa.array(np.concatenate(chars)), pa.array(shas, pa.binary()), pa.nulls(rows, pa.binary())], schema=schema)
        used = np.unique(owner)
        codes = [golomb_encode(found[owner == o] - o * span, span.bit_length()) for o in used]
        n = len(used)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(n, block)), pa.array(used.astype(np.int32)), pa.nulls(n, pa.int32()), pa.nulls(n, pa.bool_()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.array(codes, pa.binary())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 24
        ids, chars, shas = [], [], []
        for batch in slices(batches):
            data, off = byte_column(batch.column(1))
            heads = np.concatenate([[0], np.cumsum((data[off[0] : off[-1]] & 0xC0) != 0x80)])
            chars.append(np.diff(heads[off - off[0]]).astype(np.int64))
            ids.append(batch.column(0).cast(pa.int64()))
            raw = data.tobytes()
            shas += [hashlib.sha256(raw[a:b].translate(None, BLANKS)).digest() for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
            if len(shas) >= BLOCK_ROWS:
                yield from close(block, ids, chars, shas)
                block, ids, chars, shas = block + 1, [], [], []
        if shas:
            yield from close(block, ids, chars, shas)

    return run


def _answer(codes: pd.DataFrame) -> pd.DataFrame:
    """An owner's bitmaps, one for each block: which of its fingerprints came from two blocks."""
    sent = [golomb_decode(c) for c in codes["code"]]
    values = np.concatenate(sent)
    found, count = np.unique(values, return_counts=True)
    twice = found[count > 1]
    marks = [np.isin(v, twice, assume_unique=True) for v in sent]
    out = codes[["block", "owner"]].assign(bitmap=[np.packbits(m).tobytes() for m in marks])
    return out[[bool(m.any()) for m in marks]]


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per row of docs."""
    n = docs.count()
    bits = min(62, max(1, n).bit_length() + SPARE_BITS)
    owners = max(MIN_OWNERS, -(-n // OWNER_ROWS))
    sent = stored(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_send(bits, owners), _SENT), "sent")
    answers = sent.where("code is not null").select("block", "owner", "code").groupBy("owner").applyInPandas(_answer, "block long, owner int, bitmap binary")
    # Bitmaps take a bit per row: under 8 MB in all here, else the join shuffles.
    answers = stored(answers, "answers")
    answers = F.broadcast(answers) if n <= 1 << 26 else answers
    byte = F.conv(F.hex(F.expr("substring(bitmap, at div 8 + 1, 1)")), 16, 10).cast("int")
    mark = F.coalesce(F.col("twin") | (byte.bitwiseAND(F.expr("shiftleft(1, 7 - at % 8)")) != 0), F.lit(False))
    rows = sent.where("code is null").join(answers, ["block", "owner"], "left").select("doc_id", "n_chars", F.lower(F.hex("sha")).alias("text_sha256"), mark.alias("suspect"))
    rows = stored(rows, "rows")
    suspects = rows.where("suspect")
    groups = suspects.groupBy("text_sha256", "n_chars").agg(F.min("doc_id").alias("low"), F.count("*").alias("n"))
    groups = groups.groupBy("text_sha256").agg(F.max(F.struct("n_chars", (-F.col("low")).alias("low"))).alias("top"), F.sum("n").alias("group_size"))
    groups = groups.select("text_sha256", (-F.col("top.low")).alias("keep_id"), "group_size")
    if _collisions(docs, suspects):
        return _by_text(docs)
    alone = rows.where("not suspect").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "text_sha256")
    # Beyond the limit, a join of plain exchanges, whose large partitions Spark splits.
    groups = checked_broadcast(stored(groups, "groups"), limit=GROUP_ROWS)
    out = suspects.join(groups, "text_sha256").select("doc_id", "keep_id", "group_size", "text_sha256").unionByName(alone)
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def _normal(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.length(text).cast("long").alias("n_chars"), F.translate(text, BLANKS.decode(), "").alias("plain"))


def _collisions(docs: DataFrame, suspects: DataFrame) -> bool:
    """Compare the suspects' bytes: within a hash the least and the greatest text must be one."""
    ids = suspects.select(F.col("doc_id").alias("id")).distinct()
    few = ids.count()
    ids = F.broadcast(ids) if few <= 1_000_000 else ids
    texts = _normal(docs).join(ids, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
    odd = texts.groupBy(F.sha2("plain", 256).alias("h")).agg((F.min("plain") != F.max("plain")).alias("odd")).where("odd")
    return odd.limit(1).count() > 0


def _by_text(docs: DataFrame) -> DataFrame:
    """The exact way for the case of two texts under one hash: group by the texts themselves."""
    rows = _normal(docs)
    low = rows.groupBy("plain", "n_chars").agg(F.min("doc_id").alias("low"), F.count("*").alias("n"))
    top = low.groupBy("plain").agg(F.max(F.struct("n_chars", (-F.col("low")).alias("low"))).alias("top"), F.sum("n").alias("group_size"))
    out = rows.join(top, "plain").select("doc_id", (-F.col("top.low")).alias("keep_id"), "group_size", F.sha2("plain", 256).alias("text_sha256"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))
