"""The nearest of many query vectors, block against block.

Rows and queries meet in groups of at most about BLOCK_ROWS rows and BLOCK_QUERIES queries, keyed by (block,
part): rows have a copy for each part of the queries, queries one for each block of rows that they
ask.  So no query table passes through the driver or a broadcast, and no task holds more than a
group.  All pairs are tried, which is quadratic by nature; what is shuffled is the rows once for
every BLOCK_QUERIES queries and the queries once for every BLOCK_ROWS rows.

In a group a product of matrices tells which pairs can be among the k best; only these get the score,
added up in the order of vector.score(), so equal vectors have equal scores and ties go by id.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import graphops as g

BLOCK_ROWS = 16_384
BLOCK_QUERIES = 2_048
TILE = 64
# The product of matrices is nearer to the score than this.
MARGIN = 1e-9


def blocks_for(n: int, size: int) -> int:
    return max(1, -(-n // size))


def matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _dots(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Products of rows i of a with rows j of b, added up from the first dimension on."""
    out = np.zeros(len(i))
    for d in range(a.shape[1]):
        out += a[i, d] * b[j, d]
    return out


def _group(k: int, cells: bool):
    names = ["query_id", "id", "score", *(["cell"] if cells else [])]

    def run(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(asked):
            return pd.DataFrame({n: [] for n in names})
        x, q = matrix(rows["embedding"]), matrix(asked["q"])
        xu, qu, every = unit(x), unit(q), np.arange(len(x))
        size_x = np.sqrt(_dots(x, x, every, every))
        size_q = np.sqrt(_dots(q, q, np.arange(len(q)), np.arange(len(q))))
        rank = np.unique(rows["id"].to_numpy(), return_inverse=True)[1]
        at = min(k, len(x))
        held = rows["cell"].to_numpy() if cells else None
        out = []
        for lo in range(0, len(q), TILE):
            near = qu[lo : lo + TILE] @ xu.T
            near[:, size_x == 0] = np.inf  # no cosine: NaN, which comes first as in Spark's order
            for i, mine in enumerate(asked["cells"].iloc[lo : lo + TILE]) if cells else ():
                if mine is not None:
                    near[i, ~np.isin(held, mine)] = -np.inf
            least = np.partition(near, len(x) - at, axis=1)[:, len(x) - at]
            i, j = np.nonzero((near >= least[:, None] - MARGIN) & (near > -np.inf))
            i += lo
            with np.errstate(invalid="ignore", divide="ignore"):
                score = (_dots(x, q, j, i) / (size_x[j] * size_q[i]) + 1) / 2
            order = np.lexsort((rank[j], np.where(np.isnan(score), -np.inf, -score), i))
            i, j, score = i[order], j[order], score[order]
            first = np.arange(len(i)) - np.searchsorted(i, i) < k
            out.append((i[first], j[first], score[first]))
        i, j, score = (np.concatenate(p) for p in zip(*out, strict=True))
        found = {"query_id": asked["query_id"].to_numpy()[i], "id": rows["id"].to_numpy()[j], "score": score}
        return pd.DataFrame(found | ({"cell": held[j]} if cells else {}))

    return run


def best(rows: DataFrame, asked: DataFrame, k: int, parts: int) -> DataFrame:
    """query_id, id, score (and cell) of the k best rows of each query.

    rows: id, embedding, block, and cell if only some are asked.  asked: query_id, q, block (one row
    for each block it asks) and, with cells, cells: those it asks there, all if null."""
    cells = "cell" in rows.columns
    kind, key = dict(rows.dtypes), dict(asked.dtypes)["query_id"]
    schema = f"query_id {key}, id {kind['id']}, score double{', cell int' if cells else ''}"
    rows = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    asked = asked.withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(parts)).cast("int"))
    met = rows.groupBy("block", "part").cogroup(asked.groupBy("block", "part")).applyInPandas(_group(k, cells), schema)
    return g.first_k(met, ["query_id"], k, F.desc("score"), "id")


def table(rows: DataFrame, queries: DataFrame | list[tuple[int, list[float]]]) -> DataFrame:
    """query_id, q of a table or a short list of queries."""
    if isinstance(queries, DataFrame):
        return queries.where("q is not null").select("query_id", F.col("q").cast("array<double>").alias("q"))
    listed = [(int(i), [float(x) for x in v]) for i, v in queries]
    return rows.sparkSession.createDataFrame(listed, "query_id long, q array<double>")


def all_pairs(rows: DataFrame, queries: DataFrame | list[tuple[int, list[float]]], k: int) -> DataFrame:
    """query_id, id, score of the k nearest of rows (id, embedding), by trying all pairs."""
    rows, asked = rows.where("embedding is not null").select("id", "embedding"), table(rows, queries)
    blocks, parts = blocks_for(rows.count(), BLOCK_ROWS), blocks_for(asked.count(), BLOCK_QUERIES)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    return best(rows, asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))), k, parts)
