"""Industry terms: classification, normalisation and consolidation.

Dictionaries have under 200 terms and are broadcast; distinct names are classified once:
exact matches by an equi-join, only the rest by fuzzy ratio.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions import fuzzy, text
from ..model import Graph
from . import graphops as g

KEEP_AT, CONCEPT_AT, GENERIC_AT = 80.0, 75.0, 75.0


def classify(terms: DataFrame) -> DataFrame:
    """term, action (delete, reclassify_org, reclassify, keep, unknown), value."""
    words = rules.industry_table(terms.sparkSession)
    distinct = terms.select("term").distinct().withColumn("plain", F.coalesce(text.plain_name(F.col("term")), F.lit("")))
    exact = words.groupBy(F.col("term").alias("plain")).agg(
        F.bool_or(F.col("kind") == "organization").alias("org"), F.bool_or(F.col("kind") == "concept").alias("concept"), F.bool_or(F.col("kind") == "generic").alias("vague"), F.max(F.when(F.col("kind") == "taxonomy", F.col("canonical"))).alias("canonical")
    )
    known = distinct.join(F.broadcast(exact), "plain", "left")
    rest = known.where("plain <> '' and org is null").select(F.col("plain").alias("term"))
    keys = words.select("kind", F.col("term").alias("key"), "canonical", "ord")
    scores = fuzzy.scored(rest, keys.where("kind <> 'organization'"), GENERIC_AT)
    fuzz = scores.groupBy("term").agg(
        F.max_by(F.when((F.col("kind") == "taxonomy") & (F.col("score") >= KEEP_AT), F.col("canonical")), F.when((F.col("kind") == "taxonomy") & (F.col("score") >= KEEP_AT), F.struct("score", -F.col("ord")))).alias("near"),
        F.bool_or((F.col("kind") == "concept") & (F.col("score") >= CONCEPT_AT)).alias("near_concept"), F.bool_or((F.col("kind") == "generic") & (F.col("score") >= GENERIC_AT)).alias("near_vague"),
    ).withColumnRenamed("term", "plain")
    action = (
        F.when(F.col("plain") == "", "delete").when(F.col("org"), "reclassify_org").when(F.col("concept"), "reclassify").when(F.col("vague"), "delete").when(F.col("canonical").isNotNull(), "keep")
        .when(F.col("near").isNotNull(), "keep").when(F.col("near_concept"), "reclassify").when(F.col("near_vague"), "delete").otherwise("unknown")
    )
    value = F.when(F.col("action") == "keep", F.coalesce("canonical", "near")).when(F.col("action").isin("reclassify", "reclassify_org"), F.col("plain"))
    return known.join(fuzz, "plain", "left").withColumn("action", action).select("term", "action", value.alias("value"))


def normalize(terms: DataFrame, threshold: float = 80.0) -> DataFrame:
    """term, industry: canonical name, null for concepts, vague terms and strangers."""
    words = rules.industry_table(terms.sparkSession)
    distinct = terms.select("term").distinct().withColumn("plain", F.coalesce(text.plain_name(F.col("term")), F.lit("")))
    barred = words.where("kind in ('concept', 'generic')").select(F.col("term").alias("plain"))
    open_ = distinct.where("plain <> ''").join(F.broadcast(barred), "plain", "left_anti")
    taxonomy = words.where("kind = 'taxonomy'")
    exact = taxonomy.select(F.col("term").alias("plain"), F.col("canonical").alias("exact"))
    found = open_.join(F.broadcast(exact), "plain", "left")
    near = fuzzy.best(fuzzy.scored(found.where("exact is null").select(F.col("plain").alias("term")), taxonomy.select(F.col("term").alias("key"), "ord"), threshold))
    near = near.join(F.broadcast(taxonomy.select(F.col("term").alias("key"), F.col("canonical").alias("near"))), "key").select(F.col("term").alias("plain"), "near")
    industries = found.join(near, "plain", "left").select("plain", F.coalesce("exact", "near").alias("industry"))
    return distinct.join(industries.dropDuplicates(["plain"]), "plain", "left").select("term", "industry")


def bulk_rename(nodes: DataFrame) -> DataFrame:
    """Industry nodes renamed by exact variant."""
    table = F.broadcast(rules.industry_table(nodes.sparkSession).where("kind = 'taxonomy'").select(F.col("term").alias("plain"), "canonical"))
    rows = nodes.withColumn("plain", F.when(F.col("label") == "Industry", text.plain_name(F.col("name")))).join(table, "plain", "left")
    return rows.withColumn("name", F.coalesce("canonical", "name")).drop("plain", "canonical")


def consolidation(nodes: DataFrame) -> DataFrame:
    """Per Industry node: id, name, action, value, label after, the node it merges into (keep)."""
    found = nodes.where("label = 'Industry'")
    classes = classify(found.select(F.col("name").alias("term")))
    rows = found.select("id", "name").join(classes, F.col("name").eqNullSafe(F.col("term")), "left").drop("term")
    label = F.when(F.col("action") == "reclassify", "Concept").when(F.col("action") == "reclassify_org", "Organization").when(F.col("action") != "delete", "Industry")
    rows = rows.withColumns({"new_label": label, "new_name": F.coalesce("value", "name")})
    live = rows.where("action <> 'delete'")
    # Those relabelled join an existing node of that label and name, else each other.
    there = nodes.where(F.col("label").isin("Concept", "Organization")).groupBy(F.col("label").alias("new_label"), F.col("name").alias("new_name")).agg(F.min("id").alias("there"))
    first = live.groupBy("new_label", "new_name").agg(F.min("id").alias("first"))
    keeps = first.join(there, ["new_label", "new_name"], "left").select("new_label", "new_name", F.coalesce("there", "first").alias("keep"))
    return rows.join(keeps, ["new_label", "new_name"], "left").select("id", "name", "action", "value", "new_label", "new_name", "keep")


def consolidate(graph: Graph) -> Graph:
    """Industries that merge fill the nulls of the kept one; those that join a concept or an
    organization drop their properties."""
    plan = consolidation(graph.nodes)
    gone = plan.where("action = 'delete'").select("id")
    moved = plan.where("keep is not null and keep <> id").select(F.col("id").alias("dup"), "keep", "new_label")
    mapping = moved.select("dup", "keep")
    filled = g.folded(graph.nodes, moved.where("new_label = 'Industry'").select("dup", "keep"), "fill_null")
    nodes, edges = g.merge(g.drop_nodes(filled, gone), g.detach_edges(graph.edges, gone), mapping)
    new = plan.where("keep = id").select("id", "new_label", "new_name")
    nodes = nodes.join(new, "id", "left").withColumns({"label": F.coalesce("new_label", "label"), "name": F.coalesce("new_name", "name")}).drop("new_label", "new_name")
    return graph.with_(nodes=nodes, edges=edges)
