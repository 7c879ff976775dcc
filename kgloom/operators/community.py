"""Communities: export of semantic edges, modularity, label propagation, Leiden."""

from __future__ import annotations

from collections import defaultdict

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..model import Graph, is_entity
from . import graphops as g
from . import leiden

# About so many edges of whole components go to one task; this does not change results.
TASK_EDGES = 20_000
# A component of more edges is clustered by joins, not in one task; about 300 bytes an edge there.
ONE_TASK = 200_000


def semantic_edges(graph: Graph) -> DataFrame:
    """Distinct (source, target) names over the semantic types; both directions stay."""
    names = graph.nodes.where(is_entity() & F.col("name").isNotNull())
    a, b = names.select(F.col("id").alias("src"), F.col("name").alias("source")), names.select(F.col("id").alias("dst"), F.col("name").alias("target"))
    return graph.edges.where(F.col("type").isin(rules.RELATIONSHIPS)).join(a, "src").join(b, "dst").select("source", "target").distinct()


def modularity(edges: DataFrame, partition: DataFrame, gamma: float = 1.0) -> DataFrame:
    """modularity of (node, community) over undirected edges (source, target)."""
    a, b = partition.select(F.col("node").alias("source"), F.col("community").alias("cs")), partition.select(F.col("node").alias("target"), F.col("community").alias("ct"))
    # Both sums come from the stored numbers of edges between communities, so edges are made once.
    rows = g.checkpointed(edges.join(a, "source").join(b, "target").groupBy("cs", "ct").agg(F.count("*").alias("n")))
    total = rows.agg(F.sum("n").alias("m"), F.coalesce(F.sum(F.when(F.col("cs") == F.col("ct"), F.col("n"))), F.lit(0)).alias("inside"))
    degrees = rows.select(F.explode(F.array("cs", "ct")).alias("c"), "n").groupBy("c").agg(F.sum("n").alias("d")).agg(F.sum(F.col("d").cast("double") * F.col("d")).alias("dd"))
    m = F.col("m").cast("double")
    return total.crossJoin(degrees).select(F.coalesce(F.col("inside") / m - gamma * F.col("dd") / (4 * m * m), F.lit(0.0)).alias("modularity"))


def label_propagation(edges: DataFrame, rounds: int = 3) -> DataFrame:
    """node, community after `rounds` synchronous rounds: the commonest label among the
    neighbours and oneself, the least on ties.  Each round is one join and two aggregations.

    A hub's label meets all its edges in the join; as an exchange follows on either side, adaptive
    execution splits such a key, and its votes combine before they are shuffled."""
    edges = g.checkpointed(edges.select("source", "target"))
    sym = edges.select(F.col("source").alias("node"), F.col("target").alias("other")).unionByName(edges.select(F.col("target").alias("node"), F.col("source").alias("other")))
    nodes = sym.select("node").distinct()
    sym = g.checkpointed(sym.unionByName(nodes.select("node", F.col("node").alias("other"))))
    labels = nodes.select("node", F.col("node").alias("community"))
    for done in range(rounds):
        labels = g.checkpointed(labels) if done % 4 == 3 else labels
        votes = sym.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node", "community").agg(F.count("*").alias("n"))
        labels = votes.groupBy("node").agg(F.min(F.struct((-F.col("n")).alias("n"), F.col("community"))).alias("best")).select("node", F.col("best.community").alias("community"))
    return labels


def _move(weight: dict, degree: dict, home: dict, gamma: float, total: float) -> None:
    """Nodes move to the neighbouring community with the greatest gain until none gains."""
    volume: dict = defaultdict(float)
    for n, c in home.items():
        volume[c] += degree[n]
    again = True
    while again:
        again = False
        for n in sorted(weight):
            near: dict = defaultdict(float)
            for other, w in weight[n].items():
                if other != n:
                    near[home[other]] += w
            volume[home[n]] -= degree[n]
            gain = {c: w - gamma * volume[c] * degree[n] / total for c, w in near.items()}
            stay = gain.get(home[n], -gamma * volume[home[n]] * degree[n] / total)
            best = min((c for c in gain if gain[c] > stay + 1e-12), key=lambda c: (-gain[c], c), default=home[n])
            if best != home[n]:
                home[n], again = best, True
            volume[home[n]] += degree[n]


def _refine(weight: dict, degree: dict, home: dict, gamma: float, total: float) -> dict:
    """The part of each node: communities are built anew from single nodes, which join the part
    of their community with the greatest gain, if both are well tied to the rest of it."""
    volume: dict = defaultdict(float)
    for n, c in home.items():
        volume[c] += degree[n]
    part, size, alone = {n: n for n in weight}, dict(degree), set(weight)
    ties = {n: sum(w for other, w in near.items() if other != n and home[other] == home[n]) for n, near in weight.items()}
    for n in sorted(weight):
        rest = volume[home[n]]
        tied = lambda p, rest=rest: ties[p] >= gamma * size[p] * (rest - size[p]) / total - 1e-12
        if n not in alone or not tied(n):
            continue
        near: dict = defaultdict(float)
        for other, w in weight[n].items():
            if other != n and home[other] == home[n]:
                near[part[other]] += w
        gain = {p: w - gamma * size[n] * size[p] / total for p, w in near.items() if tied(p)}
        best = min((p for p in gain if gain[p] > 1e-12), key=lambda p: (-gain[p], p), default=n)
        if best != n:
            ties[best] += ties[n] - 2 * near[best]
            size[best] += size[n]
            part[n] = best
            alone -= {n, best}
    return part


def _cluster(weight: dict, home: dict, gamma: float, total: float) -> dict:
    """The community of every node: moves, refinement and aggregation until nothing changes."""
    member = {n: n for n in weight}
    while True:
        degree = {n: sum(w.values()) for n, w in weight.items()}
        before = dict(home)
        _move(weight, degree, home, gamma, total)
        part = _refine(weight, degree, home, gamma, total)
        if home == before and all(p == n for n, p in part.items()):
            return {n: home[m] for n, m in member.items()}
        # Parts become nodes; they start in the communities that were found.
        merged: dict = defaultdict(lambda: defaultdict(float))
        for n, w in weight.items():
            for other, x in w.items():
                merged[part[n]][part[other]] += x
        weight, home = merged, {p: home[n] for n, p in part.items()}
        member = {n: part[m] for n, m in member.items()}


def _leiden(gamma: float, total: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        weight: dict = defaultdict(lambda: defaultdict(float))
        for a, b in sorted(zip(rows["source"], rows["target"], strict=True)):
            weight[a][b] += 1.0
            weight[b][a] += 1.0
        found = _cluster(weight, {n: n for n in weight}, gamma, total)
        # A community is named after its least node; should one not be connected, it falls apart.
        near = defaultdict(set)
        for a, b in zip(rows["source"], rows["target"], strict=True):
            if found[a] == found[b]:
                near[a].add(b)
                near[b].add(a)
        root: dict = {}
        for n in sorted(found):
            todo = [] if n in root else [n]
            while todo:
                x = todo.pop()
                if x not in root:
                    root[x] = n
                    todo += near[x]
        return pd.DataFrame({"node": list(root), "community": list(root.values())})

    return run


def _finish(gamma: float, total: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        weight: dict = defaultdict(lambda: defaultdict(float))
        for a, b, w in sorted(zip(rows["source"], rows["target"], rows["w"], strict=True)):
            weight[a][b] += w
            weight[b][a] += w
        # Every node is the source of a row, that of its loops at least.
        found = _cluster(weight, dict(zip(rows["source"], rows["community"], strict=True)), gamma, total)
        return pd.DataFrame({"node": list(found), "community": list(found.values())})

    return run


def components(edges: DataFrame) -> DataFrame:
    """node, component: the least node that is connected; rounds as the logarithm of paths."""
    sym = g.checkpointed(edges.select(F.col("source").alias("node"), F.col("target").alias("other")).union(edges.select("target", "source")).distinct())
    labels, changed = sym.groupBy("node").agg(F.least("node", F.min("other")).alias("component")), 1
    while changed:
        near = sym.join(labels.select(F.col("node").alias("other"), F.col("component").alias("c")), "other").groupBy("node").agg(F.min("c").alias("c"))
        new = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "c").alias("via"))
        # The label's own label, so that chains of labels shorten by half.
        far = new.select(F.col("node").alias("via"), F.col("via").alias("component"))
        done = new.join(far, "via").select("node", "old", "component")
        done = g.checkpointed(done)
        changed = done.where("old <> component").count()
        labels = done.select("node", "component")
    return labels


def communities(edges: DataFrame, gamma: float = 1.0, task_edges: int = TASK_EDGES, one_task: int = ONE_TASK) -> DataFrame:
    """node, community: Leiden (local moves, refinement, aggregation) at every size.

    Given the number of all edges, components do not depend on each other.  Those of up to
    `one_task` edges are clustered whole, several in a task; larger ones by joins over all tasks
    (module leiden), with the same objective.  The edges are stored first, as every step reads them."""
    edges = g.checkpointed(edges.select("source", "target"))
    n = edges.count()
    if n <= min(task_edges, one_task):
        return edges.withColumn("task", F.lit(0)).groupBy("task").applyInPandas(_leiden(gamma, 2.0 * n), "node string, community string")
    placed = g.checkpointed(edges.join(components(edges).withColumnRenamed("node", "source"), "source"))
    large = g.checkpointed(placed.groupBy("component").agg(F.count("*").alias("n")).where(F.col("n") > one_task).select("component"))
    small = placed.join(large, "component", "left_anti").withColumn("task", F.pmod(F.xxhash64("component"), F.lit(-(-n // task_edges))))
    out = small.groupBy("task").applyInPandas(_leiden(gamma, 2.0 * n), "node string, community string")
    if not large.limit(1).count():
        return out
    rows = placed.join(large, "component", "left_semi").select("source", "target")
    return out.unionByName(leiden.communities(rows, gamma, 2.0 * n, one_task, _finish(gamma, 2.0 * n), components))


def numbered(partition: DataFrame) -> DataFrame:
    """community as the least node's hash, so that no global order is needed."""
    return partition.withColumn("community_id", F.abs(F.xxhash64("community")))


def member_rows(graph: Graph, partition: DataFrame) -> DataFrame:
    """community, id, name, label, description: the members as rows, so that no community has to
    fit one row."""
    rows = graph.nodes.where(is_entity() & F.col("name").isNotNull()).join(partition.select(F.col("node").alias("name"), "community"), "name")
    return rows.select("community", "id", "name", "label", "description")


def members(graph: Graph, partition: DataFrame, least: int = 1) -> DataFrame:
    """community, member_count, labels (how many) of communities with `least` members."""
    groups = member_rows(graph, partition).groupBy("community").agg(F.count("*").alias("member_count"), F.countDistinct("label").alias("labels"))
    return groups.where(F.col("member_count") >= least)


def summaries(graph: Graph, partition: DataFrame, least: int = 3, sample: int = 20) -> DataFrame:
    """community, member_count, summary from the first 20 members (offline: their names).

    Only 20 rows per community are ever put together."""
    rows = graph.nodes.where(is_entity() & F.col("name").isNotNull()).join(partition.select(F.col("node").alias("name"), "community"), "name").select("community", "name", "label", "id")
    counts = rows.groupBy("community").agg(F.count("*").alias("member_count")).where(F.col("member_count") >= least)
    first = g.first_k(rows.join(counts.select("community"), "community", "left_semi"), ["community"], sample, "name", "label", "id")
    text = first.groupBy("community").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("name", "label"))), lambda x: F.concat(x["name"], F.lit(" ("), x["label"], F.lit(")"))), "; ").alias("summary"))
    return counts.join(text, "community")


def assign(graph: Graph, partition: DataFrame) -> DataFrame:
    """Entity nodes with the community of their name, null where it has none."""
    found = partition.select(F.col("node").alias("name"), "community")
    return graph.nodes.where(is_entity()).join(found, "name", "left").select("id", "label", "name", "community")


def membership(graph: Graph, partition: DataFrame) -> DataFrame:
    """IN_COMMUNITY edges of the members."""
    rows = assign(graph, partition).where("community is not null")
    return rows.select(F.col("id").alias("src"), F.lit("IN_COMMUNITY").alias("type"), F.concat(F.lit("community-"), "community").alias("dst"))
