"""Stored indexes for retrieval: postings for BM25 and cells for nearest vectors.

Both are folders of Parquet that grow by one ingest at a time; a search reads only the
partitions that its terms or its query vector lead to.  An id that an index holds already is
not added again.

Text index.  postings: ingest, bucket (of the term's hash), term, id, tf, size; bucket -1 holds a row
of no term for each text.  Within a file terms are sorted, so the term filter skips row groups; a
term that a third of the texts have is divided over files by adaptive rebalancing.  A text is
shuffled twice: whole, to be held against the ids there, and as GROUPS short lists of the terms that
go to the same files.  Terms become rows, and are counted, only behind that.

Vector index.  Centroids are fitted once, by k-means on at most SAMPLE vectors (the rows with the
least hashes); every vector goes to its nearest centroid's cell.  How many cells a search reads is
chosen when the index is built: the fewest that find RECALL of the true neighbours of at most
TRIED vectors.  Reading all cells is the exact search.  Queries come as a short list or as a table
of any size; they meet the cells in bounded groups (module nearest).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import graphops as g
from . import nearest, retrieval

BUCKETS = 64
GROUPS = 8  # of buckets that are written together; divides BUCKETS
TEXTS = -1  # the bucket of rows that stand for texts
SAMPLE = 20_000
TRIED = 200
RECALL = 0.97
STEPS = 15
SLICE = 1024


def _there(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def _bucket(term: F.Column, buckets: int = BUCKETS) -> F.Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def _dealt(rows: DataFrame) -> DataFrame:
    """id, size, part, terms from id, tokens: the terms of each group of buckets, with repeats, joined
    by spaces (no token has one), and part TEXTS for each text.

    Outer generators, else a filter on the size of their array computes it once more."""
    marked = rows.select("id", F.size("tokens").alias("size"), F.transform("tokens", lambda t: F.struct(_bucket(t, GROUPS).alias("part"), t.alias("term"))).alias("tokens"))
    terms = lambda i: F.array_join(F.transform(F.filter("tokens", lambda x: x["part"] == i), lambda x: x["term"]), " ")
    parts = F.transform(F.sequence(F.lit(TEXTS), F.lit(GROUPS - 1)), lambda i: F.struct(i.alias("part"), terms(i).alias("terms")))
    return marked.select("id", "size", F.inline_outer(parts)).where((F.col("terms") != "") | (F.col("part") == TEXTS))


def _counted(dealt: DataFrame) -> DataFrame:
    """id, size, term, tf, bucket of what _dealt gives: lengths of the runs of sorted terms."""
    rows = dealt.select("id", "size", "part", F.sort_array(F.split(F.coalesce("terms", F.lit("")), " ")).alias("terms"))
    begins = F.filter(F.sequence(F.lit(0), F.size("terms") - 1), lambda i: (i == 0) | (F.get("terms", i) != F.get("terms", i - 1)))
    rows = rows.select("id", "size", "part", "terms", begins.alias("begins"))
    run = lambda b, k: F.struct(F.get("terms", b).alias("term"), (F.coalesce(F.get("begins", k + 1), F.size("terms")) - b).cast("long").alias("tf"))
    rows = rows.select("id", "size", "part", F.inline_outer(F.transform("begins", run)))
    return rows.select("id", "size", "term", "tf", F.when(F.col("part") == TEXTS, TEXTS).otherwise(_bucket(F.col("term"))).alias("bucket"))


class TextIndex:
    """BM25 postings under a path."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def add(self, texts: DataFrame, ingest: str) -> None:
        """Index texts (id, text; a null text counts as a text, not in the mean size).  The same ingest replaces its own rows."""
        texts = texts.select("id", "text").repartition("id")
        if _there(self.spark, f"{self.path}/postings"):
            kind = dict(texts.dtypes)["id"]
            held = self.spark.read.schema(f"id {kind}, ingest string, bucket int").parquet(f"{self.path}/postings").where((F.col("bucket") == TEXTS) & (F.col("ingest") != ingest))
            texts = texts.join(held.select("id"), "id", "left_anti")
        rows = texts.dropDuplicates(["id"]).select("id", retrieval.tokens(F.col("text")).alias("tokens"))
        postings = _counted(_dealt(rows).hint("rebalance", "part")).sortWithinPartitions("bucket", "term")
        postings.write.mode("overwrite").option("compression", "zstd").partitionBy("bucket").parquet(f"{self.path}/postings/ingest={ingest}")

    def postings(self, terms: list[str]) -> DataFrame:
        """id, size, term, tf of the lower-cased terms."""
        wanted = sorted({t.lower() for t in terms})
        buckets = [r["b"] for r in self.spark.createDataFrame([(t,) for t in wanted], "term string").select(_bucket(F.col("term")).alias("b")).distinct().collect()]
        return self.spark.read.parquet(f"{self.path}/postings").where(F.col("bucket").isin(buckets) & F.col("term").isin(wanted)).select("id", "size", "term", "tf")

    def search(self, terms: list[str], k: int = 10) -> DataFrame:
        """id, score: the k best texts."""
        hits = self.postings(terms)
        sizes = self.spark.read.parquet(f"{self.path}/postings").where(F.col("bucket") == TEXTS).agg(F.count("*").alias("docs"), F.avg("size").alias("mean"))
        return retrieval.scored_terms(hits, sizes, k)


def _nearest(centroids: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            cell = _home(_unit(nearest.matrix(rows["embedding"])), centroids) if len(rows) else np.zeros(0)
            yield rows.assign(cell=cell.astype(np.int32))

    return run


_unit = nearest.unit


def _home(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The nearest centroid of each point, some points at a time."""
    return np.concatenate([(points[i : i + SLICE] @ centroids.T).argmax(axis=1) for i in range(0, len(points), SLICE)])


def _packed(sizes: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(cell, first block, blocks) from (cell, rows): small cells share a block, a large one has several."""
    out, block, filled = [], 0, 0
    for cell, n in sizes:
        if filled and filled + n > nearest.BLOCK_ROWS:
            block, filled = block + 1, 0
        parts = nearest.blocks_for(n, nearest.BLOCK_ROWS)
        out.append((cell, block, parts))
        block, filled = (block + parts, 0) if parts > 1 else (block, filled + n)
    return out


def _asking(centroids: np.ndarray, probes: int, places: dict[int, tuple[int, int]]):
    """Queries with the blocks of the `probes` cells nearest to them and the cells asked there."""
    every = {b for first, parts in places.values() for b in range(first, first + parts)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for lo in range(0, len(rows), SLICE):
                some = rows.iloc[lo : lo + SLICE]
                out = []
                if probes >= len(centroids):
                    out = [(i, q, b, None) for i, q in zip(some["query_id"], some["q"], strict=True) for b in sorted(every)]
                else:
                    order = np.argsort(-(_unit(nearest.matrix(some["q"])) @ centroids.T), axis=1, kind="stable")[:, :probes]
                    for i, q, cells in zip(some["query_id"], some["q"], order.tolist(), strict=True):
                        asked: dict[int, list[int]] = {}
                        for c in cells:
                            first, parts = places.get(c, (0, 0))  # a cell without rows is in no block
                            for b in range(first, first + parts):
                                asked.setdefault(b, []).append(c)
                        out += [(i, q, b, cs) for b, cs in asked.items()]
                yield pd.DataFrame(out, columns=["query_id", "q", "block", "cells"])

    return run


def _kmeans(points: np.ndarray, cells: int) -> np.ndarray:
    """Spherical k-means; the first centroids are spread over the points in their given order."""
    centroids = points[np.linspace(0, len(points) - 1, cells).astype(int)].copy()
    for _ in range(STEPS):
        home = _home(points, centroids)
        for c in range(cells):
            mine = points[home == c]
            if len(mine):
                centroids[c] = mine.sum(axis=0)
        centroids = _unit(centroids)
    return centroids


class VectorIndex:
    """Cells of vectors (id, embedding) under a path; cosine, moved to 0..1 as in the exact search."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self.centroids, self.probes = np.zeros((0, 0)), 0
        if _there(spark, f"{path}/centroids"):
            rows = spark.read.parquet(f"{path}/centroids").orderBy("cell").collect()
            self.centroids = np.array([r["centroid"] for r in rows])
            self.probes = rows[0]["probes"]

    def build(self, vectors: DataFrame, ingest: str, cells: int | None = None, k: int = 5, recall: float = RECALL) -> None:
        """Fit the cells, add the vectors, choose the number of cells to read."""
        vectors = vectors.where("embedding is not null")
        sample = vectors.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("embedding").collect()
        points = _unit(np.array([r["embedding"] for r in sample], np.float64))
        cells = cells or max(1, min(4096, math.isqrt(vectors.count())))
        self.centroids = _kmeans(points, min(cells, len(points)))
        self._write(len(self.centroids))
        self.add(vectors, ingest)
        self.probes = self._chosen(k, recall)
        self._write(self.probes)

    def _write(self, probes: int) -> None:
        rows = [(i, c.tolist(), probes) for i, c in enumerate(self.centroids)]
        self.spark.createDataFrame(rows, "cell int, centroid array<double>, probes int").write.mode("overwrite").parquet(f"{self.path}/centroids")

    def add(self, vectors: DataFrame, ingest: str) -> None:
        """Put vectors in their cells.  The same ingest replaces its own rows."""
        if _there(self.spark, f"{self.path}/cells"):
            held = self.spark.read.parquet(f"{self.path}/cells").where(F.col("ingest") != ingest)
            vectors = vectors.join(held.select("id"), "id", "left_anti")
        kind = dict(vectors.dtypes)
        rows = vectors.where("embedding is not null").dropDuplicates(["id"]).select("id", "embedding")
        rows = rows.mapInPandas(_nearest(self.centroids), f"id {kind['id']}, embedding {kind['embedding']}, cell int")
        rows.hint("rebalance", "cell").write.mode("overwrite").partitionBy("cell").parquet(f"{self.path}/cells/ingest={ingest}")

    def _order(self, queries: list[list[float]]) -> np.ndarray:
        """The cells of each query, nearest first."""
        return np.argsort(-(_unit(np.array(queries, np.float64)) @ self.centroids.T), axis=1, kind="stable")

    def _chosen(self, k: int, recall: float) -> int:
        """The fewest cells that find `recall` of the neighbours of the tried vectors."""
        tried = self.spark.read.parquet(f"{self.path}/cells").orderBy(F.xxhash64("id", F.lit(1)), "id").limit(TRIED).select("embedding").collect()
        queries = [(i, list(r["embedding"])) for i, r in enumerate(tried)]
        if not queries:
            return len(self.centroids)
        found = self.search(queries, k, len(self.centroids), cell=True).collect()
        rank = {q: {int(c): i for i, c in enumerate(order)} for (q, _), order in zip(queries, self._order([v for _, v in queries]), strict=True)}
        needed = sorted(rank[r["query_id"]][r["cell"]] + 1 for r in found)
        return needed[min(len(needed) - 1, math.ceil(recall * len(needed)) - 1)]

    def search(self, queries: DataFrame | list[tuple[int, list[float]]], k: int = 5, probes: int | None = None, cell: bool = False) -> DataFrame:
        """query_id, id, score of each query, from the nearest `probes` cells.  queries: a table
        (query_id, q) of any size, or a short list."""
        probes = min(probes or self.probes, len(self.centroids))
        rows = self.spark.read.parquet(f"{self.path}/cells")
        if not isinstance(queries, DataFrame) and queries:
            rows = rows.where(F.col("cell").isin(sorted({int(c) for c in self._order([v for _, v in queries])[:, :probes].ravel()})))
        sizes = [tuple(r) for r in rows.groupBy("cell").agg(F.count("*").alias("n")).orderBy("cell").collect()]  # at most 4096
        packed = _packed(sizes)
        places = self.spark.createDataFrame(packed, "cell int, first int, parts int")
        asked = nearest.table(rows, queries)
        parts = nearest.blocks_for(asked.count(), nearest.BLOCK_QUERIES)
        kind = dict(asked.dtypes)["query_id"]
        asked = asked.mapInPandas(_asking(self.centroids, probes, {c: (b, n) for c, b, n in packed}), f"query_id {kind}, q array<double>, block int, cells array<int>")
        block = F.col("first") + F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
        rows = rows.join(F.broadcast(places), "cell").select("id", "embedding", "cell", block.alias("block"))
        best = nearest.best(rows, asked, k, parts)
        return best if cell else best.drop("cell")
