"""From pages to a graph: parse, split, extract, add the structure of the guide.

Each stage leaves a table or a version; plans.pipeline goes on from the graph that comes out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..model import Graph
from ..operators import chunking, extraction, providers, supplementary
from ..operators import graphops as g
from ..sources import articles as source


@dataclass(frozen=True)
class Built:
    """The graph and what happened on the way: status of each document, passes, counts by kind."""

    graph: Graph
    records: DataFrame
    status: DataFrame
    passes: list[tuple[int, int, int, int]]
    counts: DataFrame


def numbers(name: str, at: int) -> F.Column:
    """The at-th number in an id, null if there is none."""
    return F.expr(f"try_cast(get(regexp_extract_all({name}, '[0-9]+', 0), {at}) AS bigint)")


def from_pages(pages: DataFrame, extract: extraction.Extractor, site: source.Site | None = None, glossary: DataFrame | None = None, config: chunking.Config | None = None, passes: int = 2) -> Built:
    """pages: page_id, url, html; null html (a failed fetch) gives an article without text.
    glossary: term, definition; its terms become definitions and a pseudo-article.

    The last two numbers of an article's id are those of its chapter and of itself, as far as it
    has them."""
    spark = pages.sparkSession
    records = g.checkpointed(source.articles(pages, site))
    terms = glossary if glossary is not None else spark.createDataFrame([], "term string, definition string")
    terms = terms.where("term <> ''").withColumn("term_id", F.regexp_replace(F.lower("term"), " ", "_")).withColumn("ord", F.xxhash64("term", "definition"))
    documents = extraction.with_glossary(records.select(F.col("article_id").alias("id"), F.col("markdown_content").alias("text")), terms)
    found = extraction.gleaned(documents, extract, config, passes)
    none = F.lit(None).cast("string")
    nodes = found.nodes.select("id", "labels", "label", "name", none.alias("display_name"), "definition", none.alias("description"), F.array().cast("array<string>").alias("source_spans"))
    chunks = found.chunks.select(F.col("chunk_id").alias("id"), "article_id", "index", "chunk_id", "text")
    chunks = chunks.withColumn("embedding", F.when(F.col("text") != "", providers.hashed_vector(F.col("text")))).withColumn("embedded", F.col("embedding").isNotNull())
    two = F.expr("size(regexp_extract_all(article_id, '[0-9]+', 0)) > 1")
    articles = records.select(
        "article_id", F.when(two, numbers("article_id", 0)).cast("int").alias("chapter_number"), F.when(two, numbers("article_id", 1)).otherwise(numbers("article_id", 0)).alias("article_number"),
        "title", "url", F.col("markdown_content").alias("text"),
    )
    webinars = records.select("article_id", F.posexplode("webinars").alias("pos", "w")).select(F.concat_ws("-", "article_id", F.concat(F.lit("web"), F.col("pos").cast("string"))).alias("id"), "w.url", "w.title", "w.description", "w.thumbnail")
    structure, counts = supplementary.build(articles, terms, records)
    # Chunks know their article by a column; the edges of the graph are those between its nodes.
    edges = found.edges.where(F.col("type") != "FROM_ARTICLE").unionByName(structure.where("dst is not null")).distinct()
    graph = Graph(nodes, edges, chunks, articles, supplementary.definitions(terms).withColumn("ord", F.xxhash64("term_id")), webinars)
    return Built(graph, records, found.status, found.passes, counts)


def dictionary(nodes_or_terms: DataFrame) -> extraction.DictionaryExtractor:
    """The offline extractor over terms (label, name)."""
    known = nodes_or_terms.where(F.col("label").isin(rules.ENTITY_LABELS)).select("label", F.lower("name").alias("name"))
    return extraction.DictionaryExtractor(known.where("name <> ''").distinct())
