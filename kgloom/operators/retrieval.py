"""Vector, name and neighbourhood search, and BM25."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions import vector
from ..model import Graph
from . import checks, nearest
from . import graphops as g

K1, B = 1.2, 0.75


def vector_topk(vectors: DataFrame, query: DataFrame, k: int = 5) -> DataFrame:
    """id, score: the k nearest by cosine moved to 0..1.  `query` is one row with column q."""
    rows = vectors.crossJoin(F.broadcast(query.limit(1)))  # one query vector, not a join of tables
    return g.top(rows.select("id", vector.score(F.col("embedding"), F.col("q")).alias("score")), k, F.desc("score"), "id")


def vector_topk_many(vectors: DataFrame, queries: DataFrame | list[tuple[int, list[float]]], k: int = 5) -> DataFrame:
    """query_id, id, score for a table (query_id, q) or a short list of queries, by trying all pairs."""
    return nearest.all_pairs(vectors, queries, k)


def chunk_entities(graph: Graph, chunk_ids: DataFrame, limit: int = 20) -> DataFrame:
    hits = checks.mentioned(graph).join(chunk_ids.select("chunk_id"), "chunk_id", "left_semi")
    rows = hits.groupBy("id").agg(F.count("*").alias("mentions")).join(graph.nodes.select("id", "label", "name"), "id")
    return g.top(rows.select("id", "label", "name", "mentions"), limit, F.desc("mentions"), "label", F.asc_nulls_first("name"), "id")


def name_search(graph: Graph, term: str, limit: int = 10) -> DataFrame:
    """Entities whose name or display name holds the lower-cased term, by number of neighbours."""
    term = term.lower()
    found = graph.nodes.where(F.col("label").isin(rules.SEARCH_LABELS) & (F.col("name").contains(term) | F.col("display_name").contains(term)))
    near = g.ends(graph.edges).join(found.select("id"), "id", "left_semi").groupBy("id").agg(F.countDistinct("other").alias("connections"))
    rows = found.join(near, "id", "left").select("id", "label", "name", "display_name", "definition", F.coalesce("connections", F.lit(0).cast("long")).alias("connections"))
    return g.top(rows, limit, F.desc("connections"), "id")


def neighbourhood(graph: Graph, name: str) -> DataFrame:
    """rel_type, direction, related label and name of every edge of the nodes so named."""
    found = graph.nodes.where(F.col("name") == name.lower()).select("id")
    near = graph.nodes.select(F.col("id").alias("other"), F.col("label").alias("related_label"), F.col("name").alias("related_name"))
    arrow = F.when(F.col("outgoing"), "->").otherwise("<-").alias("direction")
    return g.ends(graph.edges).join(found, "id").join(near, "other").select(F.col("type").alias("rel_type"), arrow, "related_label", "related_name", "id", "other")


def two_hop(graph: Graph, first: str, second: str, middle: str) -> DataFrame:
    """Distinct (start, via, end) names over start <-first- via -second-> end."""
    via = graph.nodes.where(F.col("label") == middle).select(F.col("id").alias("src"), F.col("name").alias("via"))
    name = lambda alias: graph.nodes.select(F.col("id").alias("dst"), F.col("name").alias(alias))
    one = graph.edges.where(F.col("type") == first).join(via, "src").join(name("start"), "dst").select("src", "via", "start")
    two = graph.edges.where(F.col("type") == second).join(via.select("src"), "src", "left_semi").join(name("end"), "dst").select("src", "end")
    return one.join(two, "src").select("start", "via", "end").distinct()


def article_entities(graph: Graph) -> DataFrame:
    """article_id, id, mentions."""
    chunks = graph.chunks.where("article_id is not null").select(F.col("id").alias("chunk_id"), "article_id")
    return checks.mentioned(graph).join(chunks, "chunk_id").groupBy("article_id", "id").agg(F.count("*").alias("mentions"))


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def bm25(texts: DataFrame, terms: list[str], k: int = 10) -> DataFrame:
    """id, score: the k best texts for the terms.  Only postings of the terms are exploded."""
    wanted = F.array(*[F.lit(t.lower()) for t in terms])
    rows = texts.select("id", tokens(F.col("text")).alias("tokens"))
    sizes = rows.agg(F.count("*").alias("docs"), F.avg(F.size("tokens")).alias("mean"))
    hits = rows.select("id", F.size("tokens").alias("size"), F.explode(F.filter("tokens", lambda t: F.array_contains(wanted, t))).alias("term")).groupBy("id", "size", "term").agg(F.count("*").alias("tf"))
    return scored_terms(hits, sizes, k)


def scored_terms(hits: DataFrame, sizes: DataFrame, k: int) -> DataFrame:
    """id, score from id, size, term, tf of the searched terms and one row of docs and mean."""
    df = hits.groupBy("term").agg(F.count("*").alias("df"))  # at most one row per term
    x = hits.join(F.broadcast(df), "term").crossJoin(F.broadcast(sizes))  # one row of totals
    idf = F.log(1 + (F.col("docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    part = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("size") / F.col("mean")))
    return g.top(x.groupBy("id").agg(F.sum(part).alias("score")), k, F.desc(F.round("score", 9)), "id")


def chain(graph: Graph, vectors: DataFrame, query: DataFrame, k: int = 50) -> DataFrame:
    """Nearest chunks, then the entities they mention: one plan.  vectors: id of the chunk, embedding."""
    return chunk_entities(graph, vector_topk(vectors, query, k).select(F.col("id").alias("chunk_id")))


def search_chain(graph: Graph, term: str) -> DataFrame:
    """The neighbourhood of the best hit of a name search: one plan."""
    hit = name_search(graph, term, 1).select("id")
    near = graph.nodes.select(F.col("id").alias("other"), F.col("label").alias("related_label"), F.col("name").alias("related_name"))
    arrow = F.when(F.col("outgoing"), "->").otherwise("<-").alias("direction")
    rows = g.ends(graph.edges).join(F.broadcast(hit), "id").join(near, "other")  # one row
    return rows.select(F.col("type").alias("rel_type"), arrow, "related_label", "related_name", "id", "other")


def article_topk(graph: Graph, vectors: DataFrame, query: DataFrame, k: int = 5) -> DataFrame:
    """chunk_id, article_id, title, score of the chunks nearest to the query; no article: null.
    vectors: id of the chunk, embedding."""
    near = vector_topk(vectors, query, k).select(F.col("id").alias("chunk_id"), "score")
    chunks = graph.chunks.select(F.col("id").alias("chunk_id"), "article_id")
    rows = chunks.join(F.broadcast(near), "chunk_id")  # k rows
    return rows.join(graph.articles.select("article_id", "title"), "article_id", "left").select("chunk_id", "article_id", "title", "score")


def health(graph: Graph, communities: DataFrame) -> DataFrame:
    """check, value: chunks without an article, industries, duplicates, chunks and communities
    without a vector.  communities has community and embedding."""
    rows = [
        checks.orphan_chunks(graph).select(F.lit("orphan_chunks").alias("check"), F.col("orphan_chunks").alias("value")),
        checks.industry_count(graph).select(F.lit("industries"), "industries"),
        checks.duplicate_entities(graph, limit=None).agg(F.lit("duplicates"), F.count("*")),
        checks.missing_embeddings(graph).select(F.lit("missing_embeddings"), "missing_embeddings"),
        communities.agg(F.lit("communities_without_vector"), F.count_if(F.col("embedding").isNull())),
    ]
    return reduce(DataFrame.union, rows)
