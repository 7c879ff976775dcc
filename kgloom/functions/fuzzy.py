"""Fuzzy ratio and best matches.

ratio(a, b) = 100 * 2 * LCS / (len a + len b), LCS the longest common subsequence.  It is found
by bit-parallel dynamic programming over Arrow batches: a row of the programme is one integer,
so a pair costs len b steps on integers of len a bits.  As a fold over arrays in the JVM each
cell would copy its row.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf


def common_length(a: str, b: str) -> int:
    """LCS of two strings; the zeros of `row` are the steps of the programme's row."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = row = (1 << len(a)) - 1
    for c in b:
        hit = row & places.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def lcs(a: Column, b: Column) -> Column:
    """Null where a or b is null."""
    return _common_lengths()(a, b)


def _common_lengths():
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else common_length(x, y) for x, y in zip(a, b, strict=True)], dtype="object")

    # Not deterministic for the planner only: a filter on the score would else call it twice.
    return pandas_udf(run, "int").asNondeterministic()


def ratio(a: Column, b: Column) -> Column:
    total = F.length(a) + F.length(b)
    return F.when(total == 0, F.lit(100.0)).otherwise(F.lit(200.0) * lcs(a, b) / total)


def can_reach(a: Column, b: Column, threshold: float) -> Column:
    """An upper bound on the ratio from the lengths alone."""
    return F.lit(200.0) * F.least(F.length(a), F.length(b)) >= threshold * (F.length(a) + F.length(b))


def scored(terms: DataFrame, keys: DataFrame, threshold: float) -> DataFrame:
    """term, key, ord, score of all pairs that reach `threshold`.

    `keys` is a dictionary of bounded size (a rule table), so it is broadcast; terms are
    distinct first.  The length bound cuts pairs before the costly score."""
    pairs = terms.distinct().join(F.broadcast(keys), can_reach(F.col("term"), F.col("key"), threshold))
    return pairs.withColumn("score", ratio(F.col("term"), F.col("key"))).where(F.col("score") >= threshold)


def best(pairs: DataFrame) -> DataFrame:
    """The best key of each term; the first in order on ties."""
    top = F.max_by(F.struct("key", "score"), F.struct(F.col("score"), -F.col("ord")))
    return pairs.groupBy("term").agg(top.alias("top")).select("term", F.col("top.key").alias("key"), F.col("top.score").alias("score"))
