"""Whitening of embeddings from upper-triangle column aggregates.

One pass sums every dimension; a second one sums, by generated SQL expressions, the centred
product of every pair of dimensions i <= j in one aggregation (map-side partial sums, one row
to the driver).  LAPACK decomposes the small covariance; Arrow batches project the rows, and
the same kind of aggregate over the projected columns measures how far their covariance is
from the identity.

Scale: no row is shuffled.  The driver holds d * d sums; above PAIRS_PER_PASS pairs of
dimensions (d > 127) the triangle is summed in several passes, so a plan stays bounded.

Defined cases.  A vector that is null or empty or holds a null, NaN or infinity is dropped, and
so are entries beyond 2**45 (their scaled value is no 64-bit integer with room for sums).  Of
vectors of several lengths those of the commonest (then the longest) stay.  A component whose
eigenvalue is at most 1e-9 of the largest is rounding noise and gives no rows; so one vector, or
equal ones, give none.  deviation is exact; null where it does not fit 64 bits.  Repeated rows
count as often as they occur; ids may be null or repeat; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stored

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
LARGEST = float(1 << 45)
NOISE = 1e-9
PAIRS_PER_PASS = 8192

RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def scaled(rows: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, x: the usable vectors as integers."""
    v = F.col(vector).cast("array<double>")
    usable = (F.size("v") > 0) & F.forall("v", lambda c: c.isNotNull() & (F.abs(c) <= LARGEST))
    found = rows.select(F.col(key).cast("long").alias("vec_id"), v.alias("v")).where("v is not null").where(usable)
    return found.select("vec_id", F.transform("v", lambda c: F.floor(c * SCALE) + SHIFT).alias("x"))


def products(columns: DataFrame, names: list[str]) -> np.ndarray:
    """Sums over all rows of the product of every pair of columns, as a symmetric matrix."""
    pairs = list(combinations_with_replacement(range(len(names)), 2))
    out = np.zeros((len(names), len(names)))
    for at in range(0, len(pairs), PAIRS_PER_PASS):
        part = pairs[at : at + PAIRS_PER_PASS]
        sums = columns.agg(*[F.expr(f"sum({names[i]} * {names[j]})") for i, j in part]).first()
        for (i, j), value in zip(part, sums, strict=True):
            out[i, j] = out[j, i] = value
    return out


def covariance(columns: DataFrame, names: list[str], n: int) -> np.ndarray:
    """Covariance of columns of doubles, divisor n, centred before multiplying."""
    means = columns.agg(*[F.expr(f"avg({c})") for c in names]).first()
    return products(columns.selectExpr(*[f"{c} - {m!r}D AS {c}" for c, m in zip(names, means, strict=True)]), names) / n


class Whitening:
    """What the fit list gives: n, the sums of each dimension, the components and what they explain."""

    def __init__(self, fits: DataFrame, d: int, components: int = COMPONENTS):
        stats = fits.agg(F.count("*"), *[F.expr(f"{f}(x[{i}])") for f in ("sum", "min", "max") for i in range(d)]).first()
        self.d, self.n, self.sums = d, stats[0], list(stats[1 : d + 1])
        low, high = stats[d + 1 : 2 * d + 1], stats[2 * d + 1 :]
        #: The largest |n * x - S| of each dimension, as exact integers.
        self.reach = [max(self.n * b - s, s - self.n * a) for a, b, s in zip(low, high, self.sums, strict=True)]
        names = [f"c{i}" for i in range(d)]
        v = products(fits.selectExpr(*[f"{self._centred(i)} AS {c}" for i, c in enumerate(names)]), names) / self.n
        values, vectors = np.linalg.eigh(v)
        order = np.argsort(-values, kind="stable")[:components]
        order = order[values[order] > NOISE * max(values.max(), 0.0)]
        chosen = vectors[:, order]
        # The largest entry of each component is positive.
        chosen *= np.sign(chosen[np.abs(chosen).argmax(axis=0), np.arange(len(order))])
        self.values, self.vectors = values[order], chosen
        self.explained = (values[order] / np.trace(v)).tolist()

    def _centred(self, i: int) -> str:
        if self.reach[i] < 1 << 62:
            return f"CAST({self.n}L * x[{i}] - ({self.sums[i]}L) AS DOUBLE) / {self.n}D"
        return f"CAST(x[{i}] AS DOUBLE) - ({self.sums[i] / self.n!r}D)"

    def project(self, fits: DataFrame) -> DataFrame:
        """vec_id, deviation, whitened (one entry a component)."""
        n, d = self.n, self.d
        exact = sum(r * r for r in self.reach) < 1 << 63
        sums, weights = np.array(self.sums, np.int64 if exact else object), self.vectors / np.sqrt(self.values)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
                off = n * (x if exact else x.astype(object)) - sums
                total = (off * off).sum(axis=1)
                deviation = pa.array(total) if exact else pa.array([t if t < 1 << 63 else None for t in total], pa.int64())
                white = (off.astype(np.float64) / n) @ weights
                cut = pa.array(np.arange(len(x) + 1, dtype=np.int32) * white.shape[1])
                yield pa.RecordBatch.from_arrays([batch.column(0), deviation, pa.ListArray.from_arrays(cut, pa.array(white.ravel()))], names=["vec_id", "deviation", "whitened"])

        return fits.select("vec_id", "x").mapInArrow(run, "vec_id long, deviation long, whitened array<double>")


def whiten(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error: a row for each
    usable vector and component."""
    usable = scaled(rows, key, vector)
    lengths = usable.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    empty = rows.sparkSession.createDataFrame([], RESULT)
    if not lengths:
        return empty
    fits = usable.where(F.size("x") == lengths["d"])
    fitted = Whitening(fits, lengths["d"], components)
    k = len(fitted.explained)
    if not k:
        return empty
    white = stored(fitted.project(fits), "whitened")
    names = [f"w{i}" for i in range(k)]
    found = covariance(white.selectExpr(*[f"whitened[{i}] AS {c}" for i, c in enumerate(names)]), names, fitted.n)
    error = float(np.abs(found - np.eye(k)).max())
    shares = F.array(*[F.lit(float(e)) for e in fitted.explained])
    out = white.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return out.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(fitted.n).cast("long").alias("n"), "deviation", "whitened", F.element_at(shares, F.col("at") + 1).alias("explained"), F.lit(error).alias("identity_error"))
