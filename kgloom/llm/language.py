"""Language identification with error-correcting output codes.

Every language has a codeword; one binary classifier per bit, linear in hashed byte n-grams,
predicts that bit.  Decoding adds up, for each codeword, the loss of all margins against its
bits, and takes the nearest.  A text whose two nearest codewords are close is flagged.

Learning takes about SAMPLE_ROWS labelled rows, an equal share for every label and LEAST_ROWS
of it at least, picked by a hash of doc_id; their features (not texts) go to the driver, 8 kB a
row.  Prediction reads text only.

Defined cases: null text, or text without letters, is `und` with score 0; so is every text if
no row has a label, and the pipeline then keeps all text with letters.  Rows with a null doc_id count as held out.  One known language is
predicted for all text with letters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import byte_column, checked_broadcast, slices, spans_of, stored

SAMPLE_ROWS = 1200
LEAST_ROWS = 6
FEATURES = 1 << 12
RIDGE = 0.05
EXHAUSTIVE = 6  # up to so many languages, the code has every split of them
FLAG_GAP = 0.15
UNKNOWN = "und"
CHUNK = 1 << 20

_FOLD = np.full(256, 32, np.uint8)
_FOLD[128:] = np.arange(128, 256)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[97:123] = np.arange(97, 123)


def features(data: np.ndarray, off: np.ndarray) -> Iterator[np.ndarray | None]:
    """For each row the unit vector of its folded byte 2- and 3-grams; None without letters."""
    for lo, hi in spans_of(off, CHUNK):
        first = off[lo]
        raw = _FOLD[data[first : off[hi]]]
        plain = (raw >= 97) & (raw < 123)
        wide = np.concatenate([raw, np.full(2, 32, np.uint8)]).astype(np.uint32)
        two = wide[:-1] * np.uint32(256) + wide[1:]
        pair = (two[:-1] * np.uint32(0x9E3779B1)) >> np.uint32(20)
        triple = ((two[:-1] * np.uint32(256) + wide[2:]) * np.uint32(0x85EBCA77)) >> np.uint32(20)
        for a, b in zip(off[lo:hi] - first, off[lo + 1 : hi + 1] - first, strict=True):
            if not plain[a:b].any() and not any(c.isalpha() for c in data[first + a : first + b].tobytes().decode()):
                yield None
                continue
            counts = np.bincount(pair[a : max(a, b - 1)], minlength=FEATURES) + np.bincount(triple[a : max(a, b - 2)], minlength=FEATURES)
            x = np.sqrt(counts, dtype=np.float32)
            norm = float(np.sqrt(counts.sum()))
            yield x / np.float32(norm) if norm else x


def codewords(classes: int) -> np.ndarray:
    """A row of +1 and -1 for each class."""
    if classes <= 2:
        return np.array([[1.0], [-1.0]])[:classes]
    if classes <= EXHAUSTIVE:
        splits = [s for s in product((1, -1), repeat=classes) if s[0] == 1 and -1 in s]
        return np.array(splits, float).T
    rng = np.random.default_rng(0)
    bits = 12 * int(np.ceil(np.log2(classes)))
    apart = lambda m: ((bits - m @ m.T) / 2 + bits * np.eye(len(m))).min()
    return max((rng.choice([-1.0, 1.0], (classes, bits)) for _ in range(200)), key=apart)


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def decode(self, x: np.ndarray) -> tuple[str, float, bool]:
        """Nearest language, its share of the codewords' likelihood, whether it is ambiguous."""
        loss = np.maximum(0, 1 - self.code * (x @ self.weights + self.bias)) ** 2
        total = loss.sum(axis=1)
        share = np.exp(-4 * (total - total.min()) / len(self.bias))
        share /= share.sum()
        best = int(total.argmin())
        rest = np.sort(share)[::-1]
        return self.languages[best], float(share[best]), bool(len(rest) > 1 and rest[0] - rest[1] < FLAG_GAP)


def fit(x: np.ndarray, languages: list[str]) -> Model:
    names = sorted(set(languages))
    code = codewords(len(names))
    place = {v: i for i, v in enumerate(names)}
    target = code[[place[v] for v in languages]]
    bias = target.mean(axis=0)
    # Ridge regression through the Gram matrix of the sample, or that of the features if smaller.
    ridge = RIDGE * len(x) ** 0.5
    if len(x) <= x.shape[1]:
        weights = x.T @ np.linalg.solve(x @ x.T + ridge * np.eye(len(x)), target - bias)
    else:
        weights = np.linalg.solve(x.T @ x + ridge * np.eye(x.shape[1]), x.T @ (target - bias))
    return Model(names, code, weights.astype(np.float32), bias)


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rows = [(x.astype(np.float16).tobytes() if x is not None else None) for x in features(*byte_column(batch.column(0)))]
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), batch.column(1)], names=["x", "lang"])


def train(docs: DataFrame, rows: int = SAMPLE_ROWS) -> Model | None:
    known = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = stored(known.groupBy(F.col("lang").alias("of")).agg(F.count("*").alias("n")), "labels")
    labels = counts.count()
    if not labels:
        return None
    each = max(LEAST_ROWS, rows // labels)
    # Twice the share by hash first, so that the exact cut ranks few ids.
    part = F.least(F.lit(1.0), F.lit(2.0 * (each + 20)) / F.col("n"))
    joined = known.select("doc_id", F.col("lang").alias("of")).join(checked_broadcast(counts, labels), "of")
    near = joined.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < part * (1 << 30)).select("doc_id", "of")
    rank = F.row_number().over(Window.partitionBy("of").orderBy(F.xxhash64("doc_id"), "doc_id"))
    ids = near.distinct().withColumn("rank", rank).where(F.col("rank") <= each)
    texts = known.join(F.broadcast(ids), (known["doc_id"] == ids["doc_id"]) & (known["lang"] == ids["of"]), "left_semi").select(F.col("text").cast("string"), "lang")
    sample = texts.mapInArrow(_sampled, "x binary, lang string").where("x is not null").sort("lang", F.xxhash64("x")).collect()
    if not sample:
        return None
    x = np.array([np.frombuffer(r["x"], np.float16) for r in sample], np.float32)
    return fit(x, [r["lang"] for r in sample])


def _predict(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = [(UNKNOWN, 0.0, True) if x is None or model is None else model.decode(x) for x in features(*byte_column(batch.column(2)))]
            lang, score, flag = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(flag, pa.bool_())], names=["doc_id", "held_out", "lang_pred", "score", "ambiguous"])

    return run


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous: one row per row of docs."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_predict(model), "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean")


def _accept(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keep = [x is not None and (model is None or model.decode(x)[0] != UNKNOWN) for x in features(*byte_column(batch.column("text")))]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return run


def accepted(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of docs, unchanged, whose text is in some learned language; has letters, if none was learned."""
    rows = docs.withColumn("text", F.col("text").cast("string"))
    return rows.mapInArrow(_accept(model), rows.schema)
