"""Leiden over Spark: communities of graphs whose connected parts fit no single task.

The graph is (node, other, w) in both directions, without loops; `home` has node, degree, loop
(weight of a node's loops, both ends), community.  Every step is joins and partial aggregates:

* Moves are synchronous.  In each round one half of the nodes, by a hash of name and round, may
  go to the neighbouring community with the greatest gain; a node alone goes to another one that
  is alone only if that has the lesser name.  The objective before every round falls out of the
  same aggregate, and the best state that was seen is kept.
* Refinement builds parts inside communities from single nodes.  In each round one half may join,
  and only parts whose founder is of the other half, so a part never loses its founder and
  stays connected.
* Contraction joins the parts in and adds up the weights; once the graph is small, the local code
  goes on with it in one task.

A community that is not connected falls apart at the end.  No step collects a node's or a
community's edges: a hub's rows meet in joins that adaptive execution splits and in sums that
combine before they are shuffled.  States are written to the shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import graphops as g

# Two rounds of moves must raise the objective by so much to be followed by another; what is left
# to gain is gained on the levels above.
LEAST_GAIN = 5e-3
# Rounds of moves on one level, at most; they end by LEAST_GAIN long before.
ROUNDS = 30
EPSILON = 1e-12


def weighted(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(graph, home) of edges (source, target, w); every node is its own community."""
    ends = edges.select(F.col("source").alias("node"), F.col("target").alias("other"), "w").unionByName(edges.select(F.col("target").alias("node"), F.col("source").alias("other"), "w"))
    both = g.checkpointed(ends.groupBy("node", "other").agg(F.sum("w").alias("w")))
    loop = F.coalesce(F.sum(F.when(F.col("node") == F.col("other"), F.col("w"))), F.lit(0.0))
    home = both.groupBy("node").agg(F.sum("w").alias("degree"), loop.alias("loop"))
    return both.where("node <> other"), g.checkpointed(home.withColumn("community", F.col("node")))


def active(name: str, salt: int) -> Column:
    return F.pmod(F.xxhash64(F.col(name), F.lit(salt)), F.lit(2)) == 0


def _round(graph: DataFrame, home: DataFrame, gamma: float, total: float, salt: int) -> DataFrame:
    """home after one round, with moved and, of the state before it, `inside` (a node's
    weight to its community) and own_volume."""
    volumes = home.groupBy("community").agg(F.sum("degree").alias("volume"), F.count("*").alias("size"))
    mine = home.join(volumes, "community").select("node", "degree", "loop", F.col("community").alias("own"), F.col("volume").alias("own_volume"), F.col("size").alias("own_size"))
    near = graph.join(home.select(F.col("node").alias("other"), "community"), "other").groupBy("node", "community").agg(F.sum("w").alias("w"))
    here = F.col("community") == F.col("own")
    options = near.join(volumes, "community").join(mine, "node")
    gain = F.col("w") - gamma * F.col("volume") * F.col("degree") / total
    allowed = ~here & ((F.col("own_size") > 1) | (F.col("size") > 1) | (F.col("community") < F.col("own")))
    best = options.groupBy("node").agg(
        F.coalesce(F.max(F.when(here, F.col("w"))), F.lit(0.0)).alias("inside"),
        F.min(F.when(allowed, F.struct((-gain).alias("loss"), F.col("community").alias("to")))).alias("best"),
    )
    stay = F.col("inside") - gamma * (F.col("own_volume") - F.col("degree")) * F.col("degree") / total
    goes = F.coalesce(active("node", salt) & (-F.col("best.loss") > stay + EPSILON), F.lit(False))
    rows = mine.join(best, "node", "left").withColumn("inside", F.coalesce("inside", F.lit(0.0)))
    return rows.select("node", "degree", "loop", F.when(goes, F.col("best.to")).otherwise(F.col("own")).alias("community"), "inside", "own_volume", goes.alias("moved"))


def local_moves(graph: DataFrame, home: DataFrame, gamma: float, total: float) -> DataFrame:
    """home after rounds of moves: the best of the states that were met."""
    best, best_value, values, quiet = home, float("-inf"), [], 0
    for salt in range(ROUNDS):
        after = g.checkpointed(_round(graph, home, gamma, total, salt))
        # The squares of the communities' volumes add up to this sum over nodes.
        squares = F.sum(F.col("degree") * F.col("own_volume"))
        seen = after.agg(F.sum(F.col("inside") + F.col("loop")), squares, F.count_if("moved")).first()
        value = seen[0] / total - gamma * seen[1] / total**2
        if value > best_value:
            best, best_value = home, value
        values.append(value)
        quiet = 0 if seen[2] else quiet + 1
        if quiet == 2 or len(values) > 3 and value < values[-3] + LEAST_GAIN and values[-2] < values[-4] + LEAST_GAIN:
            break
        home = after.drop("inside", "own_volume", "moved")
    return best


def refined(graph: DataFrame, home: DataFrame, gamma: float, total: float) -> DataFrame:
    """node, part: connected parts of the communities, named after their founders."""
    there = home.select(F.col("node").alias("other"), F.col("community").alias("c"))
    inner = g.checkpointed(graph.join(home.select("node", "community"), "node").join(there, "other").where("community = c").select("node", "other", "w"))
    volumes = home.groupBy("community").agg(F.sum("degree").alias("whole"))
    ties = inner.groupBy("node").agg(F.sum("w").alias("ties"))
    state = home.join(volumes, "community").join(ties, "node").select("node", "degree", "whole", "ties", F.col("node").alias("part"))
    state, quiet = g.checkpointed(state), 0
    for salt in range(ROUNDS):
        near = inner.join(state.select(F.col("node").alias("other"), "part"), "other").groupBy("node", "part").agg(F.sum("w").alias("w"))
        own = near.join(state.select("node", "part"), ["node", "part"]).select("node", F.col("w").alias("own"))
        parts = state.join(own, "node", "left").groupBy("part").agg(F.sum("degree").alias("size"), F.count("*").alias("n"), F.sum(F.col("ties") - F.coalesce("own", F.lit(0.0))).alias("cut"), F.max("whole").alias("of"))
        tied = F.col("cut") >= gamma * F.col("size") * (F.col("of") - F.col("size")) / total - EPSILON
        parts = parts.where(tied).drop("cut", "of")
        single = parts.where("n = 1").select(F.col("part").alias("node"), F.col("size").alias("degree")).where(active("node", salt))
        targets = parts.where(~active("part", salt)).select("part", "size")
        options = near.join(single, "node").join(targets, "part").withColumn("gain", F.col("w") - gamma * F.col("degree") * F.col("size") / total)
        chosen = options.where(F.col("gain") > EPSILON).groupBy("node").agg(F.min(F.struct((-F.col("gain")).alias("loss"), F.col("part").alias("to"))).alias("best")).select("node", F.col("best.to").alias("to"))
        state = g.checkpointed(state.join(chosen, "node", "left").select("node", "degree", "whole", "ties", F.coalesce("to", "part").alias("part"), F.col("to").isNotNull().alias("moved")))
        quiet = 0 if state.where("moved").limit(1).count() else quiet + 1
        if quiet == 2:
            break
    return home.join(state.select("node", "part"), "node", "left").select("node", F.coalesce("part", "node").alias("part"))


def contracted(graph: DataFrame, home: DataFrame, parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(graph, home) with parts as nodes, in the communities that were found."""
    other = parts.select(F.col("node").alias("other"), F.col("part").alias("to"))
    rows = graph.join(parts, "node").join(other, "other").groupBy(F.col("part").alias("node"), F.col("to").alias("other")).agg(F.sum("w").alias("w"))
    rows = g.checkpointed(rows)
    loops = rows.where("node = other").select("node", F.col("w").alias("more"))
    merged = home.join(parts, "node").groupBy(F.col("part").alias("node")).agg(F.sum("degree").alias("degree"), F.sum("loop").alias("loop"), F.min("community").alias("community"))
    merged = merged.join(loops, "node", "left").select("node", "degree", (F.col("loop") + F.coalesce("more", F.lit(0.0))).alias("loop"), "community")
    return rows.where("node <> other"), g.checkpointed(merged)


def communities(edges: DataFrame, gamma: float, total: float, few: int, finish: Callable[[pd.DataFrame], pd.DataFrame], components: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """node, community (its least node) of edges (source, target).

    finish: clusters a graph of at most `few` edges in one task, from rows (source, target, w, one
    community each); components: node, component of edges."""
    graph, home = weighted(edges.select("source", "target", F.lit(1.0).alias("w")))
    member = home.select("node", F.col("node").alias("now"))
    while graph.count() > 2 * few:
        home = local_moves(graph, home, gamma, total)
        parts = g.checkpointed(refined(graph, home, gamma, total))
        fewer = parts.select("part").distinct().count()
        if fewer == parts.count():
            break
        graph, home = contracted(graph, home, parts)
        member = g.checkpointed(member.join(parts.withColumnRenamed("node", "now"), "now").select("node", F.col("part").alias("now")))
    else:
        # Every edge once, loops with half of their weight, as both their ends are counted.
        once = graph.where("node < other").select(F.col("node").alias("source"), F.col("other").alias("target"), "w")
        loops = home.select(F.col("node").alias("source"), F.col("node").alias("target"), (F.col("loop") / 2).alias("w"))
        rows = once.unionByName(loops).join(home.select(F.col("node").alias("source"), "community"), "source")
        home = rows.withColumn("task", F.lit(0)).groupBy("task").applyInPandas(finish, "node string, community string")
    found = g.checkpointed(member.join(home.select(F.col("node").alias("now"), "community"), "now").select("node", "community"))
    # Communities that are not connected fall apart; a node without a partner is one of its own.
    a, b = found.select(F.col("node").alias("source"), "community"), found.select(F.col("node").alias("target"), F.col("community").alias("c"))
    held = components(edges.join(a, "source").join(b, "target").where("community = c and source <> target").select("source", "target"))
    return found.select("node").join(held, "node", "left").select("node", F.coalesce("component", "node").alias("community"))
