"""Clean-up of entity names and labels: normalise, classify, merge, delete."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions import text
from ..model import Graph, is_entity
from . import checks
from . import graphops as g


def normalize_names(nodes: DataFrame) -> DataFrame:
    """Entity names lower-cased and stripped; the first spelling stays as display_name."""
    plain = text.plain_name(F.col("name"))
    change = is_entity() & F.col("name").isNotNull() & (F.col("name") != plain)
    return nodes.withColumns({"display_name": F.when(change, F.coalesce("display_name", "name")).otherwise(F.col("display_name")), "name": F.when(change, plain).otherwise(F.col("name"))})


def dispositions(nodes: DataFrame) -> DataFrame:
    """id, label, name, action, value, renamed."""
    d = text.disposition(F.col("name"), F.col("label"))
    rows = nodes.select("id", "label", "name", d["action"].alias("action"), d["value"].alias("value"))
    return rows.withColumn("renamed", F.coalesce((F.col("action") == "keep") & (F.col("value") != text.plain_name(F.col("name"))), F.lit(False)))


def buckets(nodes: DataFrame) -> DataFrame:
    """Counts of the four buckets of a clean-up."""
    bucket = F.when(F.col("action") == "keep", F.when(F.col("renamed"), "to_normalize").otherwise("to_keep")).when(F.col("action") == "delete", "to_delete").otherwise("skipped")
    return dispositions(nodes).groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))


def candidates(graph: Graph) -> DataFrame:
    return g.with_degree(graph.nodes.where(is_entity()), graph.edges).select("id", "label", "name", "degree")


def preview(graph: Graph) -> DataFrame:
    """action, n, relationships: what a clean-up would touch."""
    rows = dispositions(graph.nodes).join(candidates(graph).select("id", "degree"), "id", "left")
    counts = rows.groupBy("action").agg(F.count("*").alias("n"), F.coalesce(F.sum("degree"), F.lit(0)).alias("relationships"))
    pairs = checks.plural_map(graph.nodes).agg(F.lit("plural_pair").alias("action"), F.count("*").alias("n"), F.lit(0).cast("long").alias("relationships"))
    return counts.unionByName(pairs)


def deduplicate_by_name(graph: Graph) -> Graph:
    """Nodes of one label and name become one; what a duplicate has overwrites the kept node's."""
    mapping = g.same_label_map(graph.nodes)
    nodes, edges = g.merge(g.folded(graph.nodes, mapping, "dup_wins"), graph.edges, mapping)
    return graph.with_(nodes=nodes, edges=edges)


def deduplicate_across_labels(graph: Graph) -> Graph:
    """All nodes of a name under several labels become one; spans unite, the longer
    definition stays."""
    mapping = g.cross_label_map(graph.nodes)
    nodes, edges = g.merge(g.folded(graph.nodes, mapping, "union_longer"), graph.edges, mapping)
    return graph.with_(nodes=nodes, edges=edges)


def delete_generic(graph: Graph, terms: list[str] | None = None) -> Graph:
    gone = graph.nodes.where(is_entity() & F.lower("name").isin(terms or rules.GENERIC_TERMS))
    return graph.with_(nodes=g.drop_nodes(graph.nodes, gone), edges=g.detach_edges(graph.edges, gone))


def plural_merge_map(nodes: DataFrame) -> DataFrame:
    return checks.plural_map(nodes).select(F.col("plural_id").alias("dup"), F.col("singular_id").alias("keep")).groupBy("dup").agg(F.min("keep").alias("keep"))


def merge_plurals(graph: Graph) -> Graph:
    """Plurals move their edges to the singular; their own properties go."""
    nodes, edges = g.merge(graph.nodes, graph.edges, plural_merge_map(graph.nodes))
    return graph.with_(nodes=nodes, edges=edges)


def run_cleanup(graph: Graph) -> Graph:
    return merge_plurals(delete_generic(graph))


def backfill_labels(nodes: DataFrame) -> DataFrame:
    """System labels on entity nodes that lack them."""
    system = F.array(F.lit("__Entity__"), F.lit("__KGBuilder__"))
    lacking = is_entity() & ~F.array_contains("labels", "__Entity__")
    return nodes.withColumn("labels", F.when(lacking, F.array_union("labels", system)).otherwise(F.col("labels")))


def fragmented(nodes: DataFrame, longer: int = 200, limit: int = 100) -> DataFrame:
    """Entities with long descriptions, the longest first, and their fragments."""
    rows = nodes.where(is_entity() & (F.length("description") > longer))
    return g.top(rows.select("id", "name", F.length("description").cast("long").alias("length"), text.fragments(F.col("description")).alias("fragments")), limit, F.desc("length"), "id")


def summarize(nodes: DataFrame) -> DataFrame:
    """id, n_fragments, summary of entities with two fragments or more (offline: the distinct
    fragments in order)."""
    parts = text.fragments(F.col("description"))
    rows = nodes.where(is_entity() & F.col("description").isNotNull()).select("id", parts.alias("parts")).where(F.size("parts") >= 2)
    return rows.select("id", F.size("parts").cast("long").alias("n_fragments"), F.array_join(F.array_distinct("parts"), "; ").alias("summary"))
