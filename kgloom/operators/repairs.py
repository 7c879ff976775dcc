"""Repairs of what the checks find.  Each takes a graph and returns one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import rules
from ..functions import text
from ..model import Graph
from . import checks, cleanup, linking
from . import graphops as g


def degenerate_chunks(graph: Graph, least: int = rules.MIN_CHUNK) -> Graph:
    gone = graph.chunks.where(F.length("text") < least).join(checks.mentioned(graph).select(F.col("chunk_id").alias("id")), "id", "left_anti")
    return graph.with_(chunks=g.drop_nodes(graph.chunks, gone), edges=g.detach_edges(graph.edges, gone))


def chunk_index(graph: Graph) -> Graph:
    """Null indexes of an article's chunks count from 0 in id order; existing ones stay as they
    are, so numbers can repeat.  Chunks without an article stay null."""
    order = Window.partitionBy("article_id").orderBy("id")
    lacking = graph.chunks.where("index is null and article_id is not null").withColumn("index", F.row_number().over(order) - 1)
    rest = graph.chunks.where("index is not null or article_id is null")
    return graph.with_(chunks=rest.unionByName(lacking))


def chunk_ids(graph: Graph) -> Graph:
    """article_chunk_NNNN; the last four digits of the index, so 10000 becomes 0000."""
    number = F.right(F.concat(F.lit("000"), F.coalesce("index", F.lit(0)).cast("string")), F.lit(4))
    made = F.concat(F.col("article_id"), F.lit("_chunk_"), number)
    return graph.with_(chunks=graph.chunks.withColumn("chunk_id", F.coalesce("chunk_id", made)))


def titles(graph: Graph) -> Graph:
    """The description's first sentence, else a title from the URL."""
    bad = F.col("title").isNull() | (F.length("title") < rules.MIN_TITLE) | (F.col("title") == "Webinar")
    d = F.col("description")
    sentence = F.when(d.contains("."), F.left(d, F.instr(d, ".").cast("int"))).otherwise(F.left(d, F.lit(100)))
    slug = F.concat(F.lit("Webinar: "), text.slug_title(F.coalesce("url", F.lit("unknown"))))
    return graph.with_(webinars=graph.webinars.withColumn("title", F.when(bad, F.when(F.length(d) > rules.MIN_TITLE, sentence).otherwise(slug)).otherwise(F.col("title"))))


def relabeled(nodes: DataFrame) -> DataFrame:
    """id of challenges that become concepts: one per name, if no concept has the name."""
    found = nodes.where((F.col("label") == "Challenge") & F.col("name").isNotNull() & text.positive_any_word(F.col("name")))
    concepts = nodes.where("label = 'Concept' and name is not null").select("name")
    return found.join(concepts, "name", "left_anti").groupBy("name").agg(F.min("id").alias("id"))


def mislabeled(graph: Graph) -> Graph:
    new = relabeled(graph.nodes).select("id", F.lit("Concept").alias("new_label"))
    return graph.with_(nodes=graph.nodes.join(new, "id", "left").withColumn("label", F.coalesce("new_label", "label")).drop("new_label"))


def mentions(graph: Graph) -> Graph:
    return graph.with_(edges=graph.edges.unionByName(linking.mention_backfill(graph)))


def glossary_definitions(graph: Graph) -> DataFrame:
    """id, definition for entities without one, from the glossary; of several the least id."""
    lacking = graph.nodes.where(checks.is_entity() & (F.coalesce("definition", F.lit("")) == "") & F.col("name").isNotNull()).select("id", F.lower("name").alias("key"))
    terms = graph.definitions.where("definition is not null and definition <> ''").groupBy(F.lower("term").alias("key")).agg(F.min_by("definition", F.struct("term_id", "ord")).alias("definition"))
    return lacking.join(terms, "key").select("id", "definition")


def definitions(graph: Graph) -> Graph:
    new = glossary_definitions(graph).withColumnRenamed("definition", "new")
    return graph.with_(nodes=graph.nodes.join(new, "id", "left").withColumn("definition", F.coalesce("new", "definition")).drop("new"))


def generics(graph: Graph) -> Graph:
    return cleanup.delete_generic(graph)


def plurals(graph: Graph) -> Graph:
    return cleanup.merge_plurals(graph)


# In this order: junk first, then numbers, ids, titles, labels, edges, texts, merges.
ALL = [degenerate_chunks, chunk_index, chunk_ids, titles, mislabeled, mentions, definitions, generics, plurals]
CHUNKS_ONLY = [chunk_ids]
ENTITIES_ONLY = [generics, plurals]


def apply(graph: Graph, repairs: list | None = None) -> Graph:
    return reduce(lambda done, repair: repair(done), repairs or ALL, graph)


def preview(graph: Graph) -> DataFrame:
    """repair, n: what each would change, and their total."""
    count = lambda name, rows: rows.agg(F.count("*").alias("n")).select(F.lit(name).alias("repair"), "n")
    rows = [
        count("degenerate_chunks", graph.chunks.where(F.length("text") < rules.MIN_CHUNK).join(checks.mentioned(graph).select(F.col("chunk_id").alias("id")), "id", "left_anti")),
        count("chunk_index", graph.chunks.where("index is null and article_id is not null")),
        count("chunk_ids", graph.chunks.where("chunk_id is null and article_id is not null")),
        count("titles", graph.webinars.where(F.col("title").isNull() | (F.length("title") < rules.MIN_TITLE) | (F.col("title") == "Webinar"))),
        count("mislabeled", relabeled(graph.nodes)),
        count("definitions", glossary_definitions(graph)),
        count("generics", graph.nodes.where(checks.is_entity() & F.lower("name").isin(rules.GENERIC_TERMS))),
        count("plurals", cleanup.plural_merge_map(graph.nodes)),
    ]
    united = reduce(DataFrame.unionByName, rows)
    return united.unionByName(united.agg(F.lit("total").alias("repair"), F.sum("n").alias("n")))


def preview_text(rows: DataFrame, cap: int = 10) -> str:
    """A preview as text: a line per repair that would change something (nine at most)."""
    found = [r for r in rows.collect() if r["n"] and r["repair"] != "total"]
    lines = [f"{r['repair'].replace('_', ' ')}: {r['n']}" for r in sorted(found, key=lambda r: (-r["n"], r["repair"]))[:cap]]
    return "\n".join(["Nothing to repair."] if not lines else ["Repairs:", *lines])
