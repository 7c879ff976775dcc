"""Primitives shared by all graph rewrites: degree, merge, upsert, delete.

A merge takes a mapping (dup, keep) and rewrites both edge ends; it is one level deep, as the
mappings of one pass never chain.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import rules


def ends(edges: DataFrame) -> DataFrame:
    """id, other, type: every edge seen from both ends; a self-loop once."""
    out = edges.select(F.col("src").alias("id"), F.col("dst").alias("other"), "type", F.lit(True).alias("outgoing"))
    return out.unionByName(edges.where("src <> dst").select(F.col("dst").alias("id"), F.col("src").alias("other"), "type", F.lit(False).alias("outgoing")))


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors share.  Where it is unset, one of our
    own if driver and executors are one process (tests), else an error."""
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not path:
        if context.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="kgloom-")
        context.setCheckpointDir(path)
    return path


def checkpointed(rows: DataFrame) -> DataFrame:
    """rows, written as a table to the shared folder and read back.  A loop does not compute them
    again, a lost executor costs one task, and the plan keeps neither lineage nor the constraints
    of the plans before, which would double in every round."""
    path = f"{shared_dir(rows.sparkSession)}/table-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def degree(edges: DataFrame) -> DataFrame:
    return ends(edges).groupBy("id").agg(F.count("*").alias("degree"))


def with_degree(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    return nodes.join(degree(edges), "id", "left").withColumn("degree", F.coalesce("degree", F.lit(0).cast("long")))


def rewrite_edges(edges: DataFrame, mapping: DataFrame) -> DataFrame:
    """Edges with merged ends; an edge between merge partners becomes a self-loop."""
    a = mapping.select(F.col("dup").alias("src"), F.col("keep").alias("new_src"))
    b = mapping.select(F.col("dup").alias("dst"), F.col("keep").alias("new_dst"))
    out = edges.join(a, "src", "left").join(b, "dst", "left")
    return out.select(F.coalesce("new_src", "src").alias("src"), "type", F.coalesce("new_dst", "dst").alias("dst")).distinct()


def drop_nodes(nodes: DataFrame, gone: DataFrame) -> DataFrame:
    return nodes.join(gone.select("id"), "id", "left_anti")


def detach_edges(edges: DataFrame, gone: DataFrame) -> DataFrame:
    return edges.join(gone.select(F.col("id").alias("src")), "src", "left_anti").join(gone.select(F.col("id").alias("dst")), "dst", "left_anti")


def upsert_edges(edges: DataFrame, new: DataFrame) -> DataFrame:
    return edges.unionByName(new.select(edges.columns).join(edges, ["src", "type", "dst"], "left_anti").distinct())


def upsert_nodes(nodes: DataFrame, new: DataFrame) -> DataFrame:
    return nodes.unionByName(new.join(nodes, "id", "left_anti").dropDuplicates(["id"]), allowMissingColumns=True)


def priority(label: Column | str) -> Column:
    order = F.array(*[F.lit(x) for x in rules.LABEL_PRIORITY])
    place = F.array_position(order, F.col(label) if isinstance(label, str) else label)
    return F.when(F.coalesce(place, F.lit(0)) > 0, place).otherwise(F.lit(100))


def same_label_map(nodes: DataFrame) -> DataFrame:
    """dup, keep: nodes with the same label and name; the least id stays."""
    named = nodes.where("name is not null")
    keeps = named.groupBy("label", "name").agg(F.min("id").alias("keep"), F.count("*").alias("n")).where("n > 1")
    return named.join(keeps, ["label", "name"]).where("id <> keep").select(F.col("id").alias("dup"), "keep", "label", "name")


def cross_label_winners(nodes: DataFrame) -> DataFrame:
    """name, winner, n_labels, n_nodes of names under several labels."""
    groups = nodes.where("name is not null").groupBy("name").agg(F.min(F.struct(priority("label").alias("p"), F.col("label"))).alias("best"), F.countDistinct("label").alias("n_labels"), F.count("*").alias("n_nodes"))
    return groups.where("n_labels > 1").select("name", F.when(F.col("best.p") < 100, F.col("best.label")).otherwise("Concept").alias("winner"), "n_labels", "n_nodes")


def cross_label_map(nodes: DataFrame) -> DataFrame:
    """dup, keep: the least id with the winning label takes all nodes of the name."""
    winners = cross_label_winners(nodes)
    rows = nodes.join(winners, "name").select("id", "name", "label", "winner")
    keeps = rows.groupBy("name").agg(F.min(F.struct((F.col("label") != F.col("winner")).alias("other"), F.col("id"))).alias("k")).select("name", F.col("k.id").alias("keep"))
    return rows.join(keeps, "name").where("id <> keep").select(F.col("id").alias("dup"), "keep", "name")


def fold(nodes: DataFrame, mapping: DataFrame, policy: str) -> DataFrame:
    """Properties of each kept node after a merge.

    dup_wins: the last non-null in id order; union_longer: spans united, the longer
    definition (the kept one's on ties); fill_null: the kept node's, nulls from the others.
    Empty lists count as null; `aliases` are folded where nodes have them."""
    grouped = nodes.join(mapping.select(F.col("dup").alias("id"), "keep"), "id", "left").withColumn("keep", F.coalesce("keep", "id"))
    involved = grouped.join(mapping.select("keep").distinct(), "keep", "left_semi")
    order = F.struct((F.col("id") != F.col("keep")).alias("dup"), F.col("id"))
    text = lambda name, how: how(F.col(name), F.when(F.col(name).isNotNull(), order)).alias(name)
    listed = [n for n in ("source_spans", "aliases") if n in nodes.columns]
    filled = lambda name, how: how(F.col(name), F.when(F.size(name) > 0, order)).alias(name)
    if policy in ("dup_wins", "fill_null"):
        how = F.max_by if policy == "dup_wins" else F.min_by
        return involved.groupBy("keep").agg(*[text(n, how) for n in ("definition", "description", "display_name")], *[filled(n, how) for n in listed])
    if policy == "union_longer":
        # Longest first; on ties the kept node, then the least id.
        longest = F.min_by("definition", F.when(F.col("definition").isNotNull(), F.struct((-F.length("definition")).alias("l"), order.alias("o")))).alias("definition")
        return involved.groupBy("keep").agg(longest, *[F.array_sort(F.array_distinct(F.flatten(F.collect_list(n)))).alias(n) for n in listed])
    raise ValueError(policy)


def folded(nodes: DataFrame, mapping: DataFrame, policy: str) -> DataFrame:
    """nodes, the kept ones of a merge with the properties that `policy` gives them."""
    values = fold(nodes, mapping, policy)
    names = [n for n in values.columns if n != "keep"]
    new = values.select(F.col("keep").alias("id"), *[F.col(n).alias(f"folded_{n}") for n in names])
    return nodes.join(new, "id", "left").withColumns({n: F.coalesce(f"folded_{n}", n) for n in names}).drop(*[f"folded_{n}" for n in names])


def merge(nodes: DataFrame, edges: DataFrame, mapping: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes without the duplicates and edges that point to the kept ones."""
    return drop_nodes(nodes, mapping.select(F.col("dup").alias("id"))), rewrite_edges(edges, mapping)


def top(rows: DataFrame, n: int | None, *order: Column | str) -> DataFrame:
    """The first n rows; all, in no order, if n is null."""
    return rows if n is None else rows.orderBy(*order).limit(n)


def first_of(rows: DataFrame, keys: list[str], *order: Column | str) -> DataFrame:
    return rows.withColumn("rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("rn = 1").drop("rn")


def first_k(rows: DataFrame, keys: list[str], k: int, *order: Column | str) -> DataFrame:
    """The first k rows of each key; Spark cuts each partition to k per key before shuffling."""
    return rows.withColumn("rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rn") <= k).drop("rn")
