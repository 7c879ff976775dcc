"""Queries over phrases, stored indexes, communities by joins and resolved entities, with twins."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import community, extraction, indexes, linking, resolution, retrieval
from ..operators import graphops as g
from . import project

Query = Callable[[SparkSession, str], DataFrame]


def _place(spark: SparkSession, name: str) -> str:
    return f"{g.shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _glossary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The terms of one and of several words that texts can hold."""
    terms = project.definitions(spark, sf_dir).where("ord < 100000").select(F.lower("term").alias("term"))
    both = terms.select(F.col("term").alias("name")).unionByName(terms.select(F.get(F.split("term", " "), 0).alias("name")))
    return both.where("name <> ''").distinct().withColumn("label", F.lit("Concept"))


def phrase_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extraction.occurrences(project.chunks(spark, sf_dir), _glossary(spark, sf_dir))
    return found.select("chunk_id", "name", "start", "stop")


def all_source_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    mentions = extraction.dictionary_mentions(project.chunks(spark, sf_dir), _glossary(spark, sf_dir), every=True)
    new, _ = extraction.augment(project.entities(spark, sf_dir), mentions)
    return new.select("label", "name", F.explode("source_spans").alias("span"))


def backfilled_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions of whole glossary terms as standards, row by row."""
    graph = project.graph(spark, sf_dir)
    names = _glossary(spark, sf_dir).select(F.concat(F.lit("term-"), "name").alias("id"), F.lit("Standard").alias("label"), "name")
    return linking.mention_backfill(graph.with_(nodes=names))


def text_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BM25 from postings that two ingests wrote."""
    chunks = project.texts(spark, sf_dir)
    index = indexes.TextIndex(spark, _place(spark, "text"))
    odd = F.pmod(F.xxhash64("id"), F.lit(2)) == 1
    index.add(chunks.where(odd), "first")
    index.add(chunks.where(~odd), "second")
    return index.search(["blue", "the", "on"]).withColumn("score", F.round("score", 6))


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")


def _searched(spark: SparkSession, sf_dir: str) -> tuple[indexes.VectorIndex, DataFrame]:
    rows = _vectors(spark, sf_dir)
    index = indexes.VectorIndex(spark, _place(spark, "vectors"))
    index.build(rows, "first")
    # The stated queries: every row whose id is divisible by 20.
    return index, rows.where("id % 20 = 0 and embedding is not null").select(F.col("id").alias("query_id"), F.col("embedding").alias("q"))


def vector_index_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of each stated query, from all cells of the index."""
    index, queries = _searched(spark, sf_dir)
    found = index.search(queries, probes=len(index.centroids))
    return found.withColumn("score", F.round("score", 6))


def vector_index_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """queries, neighbours (of the exact search), enough: whether the pruned search finds nine of ten."""
    index, queries = _searched(spark, sf_dir)
    true = retrieval.vector_topk_many(_vectors(spark, sf_dir), queries).select("query_id", "id")
    found = true.join(index.search(queries).select("query_id", "id", F.lit(1).alias("found")), ["query_id", "id"], "left")
    return found.agg(F.countDistinct("query_id").alias("queries"), F.count("*").alias("neighbours"), (F.count("found") >= 0.9 * F.count("*")).alias("enough"))


def leiden_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nodes, divided (communities that are not connected), better: whether modularity is that of
    labels at least; from Leiden over joins."""
    edges = g.checkpointed(community.semantic_edges(project.graph(spark, sf_dir)))
    found = g.checkpointed(community.communities(edges, one_task=20_000))
    a, b = found.select(F.col("node").alias("source"), "community"), found.select(F.col("node").alias("target"), F.col("community").alias("c"))
    inner = edges.join(a, "source").join(b, "target").where("community = c").select("source", "target")
    # A connected community is one component, named after its least node as the community is.
    divided = found.join(community.components(inner), "node", "left").where("coalesce(component, node) <> community").select("community").distinct()
    labels = community.modularity(edges, community.label_propagation(edges, 3)).select(F.col("modularity").alias("labels"))
    value = community.modularity(edges, found)
    counts = found.agg(F.count("*").alias("nodes")).crossJoin(divided.agg(F.count("*").alias("divided")))
    return counts.crossJoin(value).crossJoin(labels).select("nodes", "divided", (F.col("modularity") >= F.col("labels") - 1e-9).alias("better"))


def entity_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolution.resolution(project.entities(spark, sf_dir))


def resolved_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolution.resolve(project.graph(spark, sf_dir)).edges


QUERIES: dict[str, Query] = {
    "phrase_spans": phrase_spans,
    "all_source_spans": all_source_spans,
    "backfilled_phrases": backfilled_phrases,
    "text_index_topk": text_index,
    "vector_index_exact": vector_index_exact,
    "vector_index_recall": vector_index_recall,
    "leiden_checks": leiden_checks,
    "entity_resolution": entity_resolution,
    "resolved_edges": resolved_edges,
}

_NAMES = "glossary AS (SELECT DISTINCT unnest([lower(term), lower(string_split(term, ' ')[1])]) AS name FROM definitions WHERE ord < 100000)"
# Every place where a padded text holds a padded name.
_PLACES = f""", {_NAMES}, padded AS (SELECT id, ' ' || lower(text) || ' ' AS t FROM chunks WHERE length(text) > 50),
 held AS (SELECT id, name, t FROM padded JOIN glossary ON name <> '' AND contains(t, ' ' || name || ' ')),
 places AS (SELECT id AS chunk_id, name, (i - 1)::INT AS start FROM held, unnest(range(1, length(t) - length(name))) AS u(i) WHERE substring(t, i, length(name) + 2) = ' ' || name || ' ')"""


def oracles(plain: Callable[[str], str], priority: str, entity: str, bm25: str) -> dict[str, str]:
    """Twins on the shared projection."""
    resolved = f""", named AS (SELECT id, label, {plain("name")} AS p FROM entities WHERE {plain("name")} <> ''),
 pairs AS (SELECT a.p AS x, b.p AS y FROM (SELECT DISTINCT label, p FROM named WHERE p NOT LIKE '%s') a JOIN (SELECT DISTINCT label, p FROM named) b ON a.label = b.label AND b.p = a.p || 's'
   UNION SELECT p, canonical FROM named JOIN tax ON kind = 'taxonomy' AND term = p WHERE label = 'Industry' AND p <> canonical),
 both_ways AS (SELECT x, y FROM pairs UNION SELECT y, x FROM pairs),
 near_to AS (SELECT x AS a, x AS b FROM both_ways UNION SELECT near_to.a, both_ways.y FROM near_to JOIN both_ways ON both_ways.x = near_to.b),
 part AS (SELECT a, min(b) AS e FROM near_to GROUP BY 1),
 placed AS (SELECT id, label, coalesce(e, p) AS entity FROM named LEFT JOIN part ON a = p),
 best AS (SELECT entity, min(lpad({priority.format("label")}::VARCHAR, 3, '0') || id) AS k, count(*) AS n FROM placed GROUP BY 1),
 resolved AS (SELECT w.id, entity, k[4:] AS keep, CASE WHEN k[:3] < '100' THEN o.label ELSE 'Concept' END AS label, n FROM placed w JOIN best USING (entity) JOIN placed o ON o.id = k[4:])"""
    return {
        "phrase_spans": _PLACES + " SELECT chunk_id, name, start, (start + length(name))::INT AS stop FROM places",
        "all_source_spans": _PLACES + f" SELECT DISTINCT 'Concept' AS label, name, start || '-' || (start + length(name)) || '@' || chunk_id AS span FROM places WHERE length(name) >= 2 AND name NOT IN (SELECT name FROM nodes WHERE label IN {entity} AND name IS NOT NULL)",
        "backfilled_phrases": f""", {_NAMES} SELECT 'term-' || name AS src, 'MENTIONED_IN' AS type, id AS dst FROM glossary JOIN chunks ON contains(' ' || lower(text) || ' ', ' ' || name || ' ') WHERE length(name) >= 4""",
        "text_index_topk": bm25,
        "vector_index_exact": """, scored AS (SELECT a.vec_id AS query_id, b.vec_id AS id, (list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) + 1) / 2 AS s FROM embeddings a, embeddings b WHERE a.vec_id % 20 = 0)
 SELECT query_id, id, round(s, 6) AS score FROM scored QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) <= 5""",
        "vector_index_recall": " SELECT count(*) AS queries, 5 * count(*) AS neighbours, true AS enough FROM embeddings WHERE vec_id % 20 = 0",
        "leiden_checks": " SELECT count(*) AS nodes, 0::BIGINT AS divided, true AS better FROM (SELECT source FROM semantic UNION SELECT target FROM semantic)",
        "entity_resolution": resolved + " SELECT id, entity, keep, label, n FROM resolved",
        "resolved_edges": resolved + " SELECT DISTINCT coalesce(a.keep, e.src) AS src, e.type, coalesce(b.keep, e.dst) AS dst FROM edges e LEFT JOIN resolved a ON a.id = e.src LEFT JOIN resolved b ON b.id = e.dst",
    }
