"""Entity resolution in one pass: candidates by blocking keys, then their transitive closure.

Entities of one plain name (any label, case or padding) are one class.  Classes are linked where
one name is the other's plural under a shared label, and where names of industries are variants
of one canonical term.  What is connected is one entity, however many kinds of links chain up,
so one mapping and one merge replace a sequence of one-level merges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions import text
from ..model import Graph, is_entity
from . import community
from . import graphops as g


def links(names: DataFrame) -> DataFrame:
    """source, target: linked plain names of (label, plain)."""
    distinct = names.select("label", "plain").distinct()
    singular = distinct.where(~F.col("plain").endswith("s")).select("label", F.col("plain").alias("source"), F.concat("plain", F.lit("s")).alias("plain"))
    plural = singular.join(distinct, ["label", "plain"]).select("source", F.col("plain").alias("target"))
    table = rules.industry_table(names.sparkSession).where("kind = 'taxonomy'").select(F.col("term").alias("plain"), F.col("canonical").alias("target")).distinct()
    variants = distinct.where("label = 'Industry'").join(F.broadcast(table), "plain").select(F.col("plain").alias("source"), "target")
    return plural.unionByName(variants).where("source <> target").distinct()


def resolution(nodes: DataFrame) -> DataFrame:
    """id, entity, keep, label, n: every named entity node with the least plain name it is
    connected to, the node that stays (best label, then least id), the entity's label and how many
    nodes it has."""
    plain = text.plain_name(F.col("name"))
    named = nodes.where(is_entity()).select("id", "label", plain.alias("plain")).where("plain <> ''")
    found = links(named)
    parts = community.components(found).select(F.col("node").alias("plain"), F.col("component").alias("entity"))
    rows = named.join(parts, "plain", "left").withColumn("entity", F.coalesce("entity", "plain"))
    best = rows.groupBy("entity").agg(F.min(F.struct(g.priority("label").alias("p"), F.col("id"), F.col("label"))).alias("b"), F.count("*").alias("n"))
    label = F.when(F.col("b.p") < 100, F.col("b.label")).otherwise("Concept")
    return rows.select("id", "entity").join(best.select("entity", F.col("b.id").alias("keep"), label.alias("label"), "n"), "entity").select("id", "entity", "keep", "label", "n")


def resolve(graph: Graph) -> Graph:
    """The graph with each entity's nodes merged: spans united, the longest definition, edges moved."""
    found = g.checkpointed(resolution(graph.nodes))
    mapping = found.where("id <> keep").select(F.col("id").alias("dup"), "keep")
    nodes, edges = g.merge(g.folded(graph.nodes, mapping, "union_longer"), graph.edges, mapping)
    new = found.where("id = keep").select("id", F.col("label").alias("new_label"))
    nodes = nodes.join(new, "id", "left").withColumn("label", F.coalesce("new_label", "label")).drop("new_label")
    return graph.with_(nodes=nodes, edges=edges)
