"""Structure from documents: chapters, resources, glossary, links between articles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions import text
from ..model import Graph
from . import graphops as g


def chapters(articles: DataFrame) -> DataFrame:
    """chapter_number, articles, total_words."""
    return articles.groupBy("chapter_number").agg(F.count("*").alias("articles"), F.sum(text.word_count(F.col("text"))).alias("total_words"))


def chapter_rollup(articles: DataFrame) -> DataFrame:
    """The same per chapter and, with a null chapter, over all."""
    return articles.rollup("chapter_number").agg(F.count("*").alias("articles"), F.sum(text.word_count(F.col("text"))).alias("total_words"), F.sum(F.length("text").cast("long")).alias("total_chars"))


def in_chapter(articles: DataFrame) -> DataFrame:
    return articles.select(F.col("article_id").alias("src"), F.lit("IN_CHAPTER").alias("type"), F.concat(F.lit("chapter-"), F.col("chapter_number")).alias("dst"))


def definitions(terms: DataFrame) -> DataFrame:
    """One row per term_id; of several the last."""
    return terms.groupBy("term_id").agg(F.max_by(F.struct("term", "definition"), "ord").alias("x")).select("term_id", "x.term", "x.definition")


def by_url(articles: DataFrame) -> DataFrame:
    """url, target: of articles that share a url the last."""
    return articles.groupBy("url").agg(F.max_by("article_id", "article_number").alias("target"))


def article_links(articles: DataFrame, references: DataFrame, kind: str = "REFERENCES") -> DataFrame:
    """src, type, dst, text: references whose URL is an article's, not to itself."""
    hits = references.join(by_url(articles), "url").where("article_id <> target")
    return hits.select(F.col("article_id").alias("src"), F.lit(kind).alias("type"), F.col("target").alias("dst"), "text").distinct()


def article_index(articles: DataFrame, chunks: DataFrame) -> DataFrame:
    """article_id, chapter_number, url, n_chunks, url_owner: lookup by id, chapter and URL."""
    counts = chunks.where("article_id is not null").groupBy("article_id").agg(F.count("*").alias("n_chunks"))
    rows = articles.join(counts, "article_id", "left").join(by_url(articles), "url")
    return rows.select("article_id", "chapter_number", "url", F.coalesce("n_chunks", F.lit(0).cast("long")).alias("n_chunks"), (F.col("target") == F.col("article_id")).alias("url_owner"))


RESOURCES = [("images", "img", "src", "HAS_IMAGE"), ("videos", "vid", "url", "HAS_VIDEO"), ("webinars", "web", "url", "HAS_WEBINAR")]


def resources(records: DataFrame) -> DataFrame:
    """id, kind, url, article_id of images, videos and webinars of parsed articles."""
    def one(column: str, tag: str, url: str) -> DataFrame:
        rows = records.select("article_id", F.posexplode(column).alias("pos", "x"))
        return rows.select(F.concat_ws("-", "article_id", F.concat(F.lit(tag), F.col("pos").cast("string"))).alias("id"), F.lit(column).alias("kind"), F.col(f"x.{url}").alias("url"), "article_id")

    return reduce(DataFrame.unionByName, [one(*r[:3]) for r in RESOURCES])


def resource_edges(found: DataFrame, articles: DataFrame | None = None) -> DataFrame:
    """src, type, dst from articles to their resources; if articles (article_id) are given, from
    those only.  The nodes of the others stay without an edge."""
    if articles is not None:
        found = found.join(articles.select("article_id"), "article_id", "left_semi")
    kind = reduce(lambda c, r: c.when(F.col("kind") == r[0], r[3]), RESOURCES[1:], F.when(F.col("kind") == RESOURCES[0][0], RESOURCES[0][3]))
    return found.select(F.col("article_id").alias("src"), kind.alias("type"), F.col("id").alias("dst"))


def last_of_url(records: DataFrame) -> DataFrame:
    """url, target: of parsed articles that share a url the one with the greatest last number in its
    id, then the last id."""
    number = F.expr("try_cast(regexp_extract(article_id, '([0-9]+)[^0-9]*$', 1) AS bigint)")
    return records.groupBy("url").agg(F.max_by("article_id", F.struct(F.coalesce(number, F.lit(-1)).alias("n"), F.col("article_id"))).alias("target"))


def related_links(records: DataFrame) -> DataFrame:
    """RELATED_TO edges from the callouts of parsed articles to articles of that URL."""
    rows = records.select("article_id", F.inline("related"))
    hits = rows.join(last_of_url(records), "url").where("article_id <> target")
    return hits.select(F.col("article_id").alias("src"), F.lit("RELATED_TO").alias("type"), F.col("target").alias("dst")).distinct()


def titled_links(records: DataFrame) -> DataFrame:
    """src, title, dst: the links of related_links() with the title of the callout.  Two callouts of
    one article with different titles are two links, with equal ones a single link."""
    rows = records.select("article_id", F.inline("related")).select("article_id", "url", F.coalesce("title", F.lit("")).alias("title"))
    hits = rows.join(last_of_url(records), "url").where("article_id <> target")
    return hits.select(F.col("article_id").alias("src"), "title", F.col("target").alias("dst")).distinct()


def record_index(records: DataFrame, content: bool = False) -> DataFrame:
    """article_id, title, url, url_owner (of equal URLs the last article), counts of children; the
    Markdown only if asked for."""
    counts = [F.size(c).cast("long").alias(f"n_{c}") for c in ("sections", "images", "videos", "webinars", "related", "cross_references", "key_concepts")]
    return records.join(last_of_url(records), "url").select("article_id", "title", "url", (F.col("target") == F.col("article_id")).alias("url_owner"), *counts, *(["markdown_content"] if content else []))


def build(articles: DataFrame, terms: DataFrame, records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edges, counts by kind): chapters, resources, glossary and links in one go."""
    found = resources(records)
    edges = reduce(DataFrame.unionByName, [in_chapter(articles), resource_edges(found, articles), related_links(records)]).distinct()
    rows = [chapters(articles).select(F.lit("chapters").alias("kind")), definitions(terms).select(F.lit("definitions").alias("kind")), found.select("kind"), edges.select("type")]
    return edges, reduce(DataFrame.union, rows).groupBy("kind").agg(F.count("*").alias("n"))


def thumbnails(webinars: DataFrame) -> DataFrame:
    """Null thumbnails filled from another webinar of the same URL path (the fetch by URL is
    done once per distinct URL)."""
    known = webinars.where("thumbnail is not null").groupBy("url").agg(F.min("thumbnail").alias("found"))
    return webinars.join(known, "url", "left").select("id", "url", F.coalesce("thumbnail", "found").alias("thumbnail"))


def resource_facts(webinars: DataFrame) -> DataFrame:
    """Computed columns of resources."""
    return webinars.select(
        "id", F.coalesce(F.length("description") > 50, F.lit(False)).alias("has_description"), F.coalesce(F.length("thumbnail") > 0, F.lit(False)).alias("has_caption"),
        text.word_count(F.col("description")).alias("description_words"), F.coalesce(F.lower("title").rlike("figure|diagram|chart|graph|flow"), F.lit(False)).alias("is_figure"), text.authority(F.col("url")).alias("domain"),
    )


def orphan_free(graph: Graph) -> Graph:
    """Edges whose ends exist."""
    ids = graph.nodes.select("id").unionByName(graph.chunks.select("id")).unionByName(graph.articles.select(F.col("article_id").alias("id")))
    edges = graph.edges.join(ids.withColumnRenamed("id", "src"), "src", "left_semi").join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi")
    return graph.with_(edges=edges)


def diagnose(graph: Graph) -> DataFrame:
    """label, has_entity, has_builder, n."""
    return graph.nodes.groupBy("label", F.array_contains("labels", "__Entity__").alias("has_entity"), F.array_contains("labels", "__KGBuilder__").alias("has_builder")).agg(F.count("*").alias("n"))


def label_sets(nodes: DataFrame, limit: int = 10) -> DataFrame:
    return g.top(nodes.groupBy(F.array_join("labels", "+").alias("label_set")).agg(F.count("*").alias("n")), limit, F.desc("n"), "label_set")


def related_labels(graph: Graph, label: str, limit: int = 10) -> DataFrame:
    """type, direction, other_label, n of the relations of a label."""
    ends = g.ends(graph.edges).join(graph.nodes.where(F.col("label") == label).select("id"), "id", "left_semi")
    others = graph.nodes.select(F.col("id").alias("other"), F.col("label").alias("other_label"))
    rows = ends.join(others, "other").groupBy("type", F.when(F.col("outgoing"), "out").otherwise("in").alias("direction"), "other_label").agg(F.count("*").alias("n"))
    return g.top(rows, limit, F.desc("n"), "type", "direction", "other_label")


def mention_overlap(graph: Graph) -> DataFrame:
    """label, mentioned, without_entity_label, with_relations: nodes that chunks mention."""
    mentioned = graph.edges.where(F.col("type") == rules.MENTION).select(F.col("src").alias("id")).distinct()
    linked = g.ends(graph.edges.where(F.col("type") != rules.MENTION)).select("id").distinct().withColumn("linked", F.lit(True))
    rows = graph.nodes.join(mentioned, "id", "left_semi").join(linked, "id", "left")
    return rows.groupBy("label").agg(F.count("*").alias("mentioned"), F.count_if(~F.array_contains("labels", "__Entity__")).alias("without_entity_label"), F.count_if("linked").alias("with_relations"))


def contents_coverage(contents: DataFrame, articles: DataFrame) -> DataFrame:
    """chapter_number, listed, found, missing: the table of contents against the articles."""
    there = articles.select(F.col("url"), F.lit(True).alias("there")).distinct()
    return contents.join(there, "url", "left").groupBy("chapter_number").agg(F.count("*").alias("listed"), F.count_if("there").alias("found"), F.count_if(F.col("there").isNull()).alias("missing"))


def foreign_urls(contents: DataFrame, slugs: DataFrame) -> DataFrame:
    """chapter_number, slug, title, url of listed articles whose URL has no `/slug/` of their own
    chapter, from slugs (chapter_number, slug).  Chapters without a slug and entries without a
    URL are not judged."""
    own = slugs.where("slug <> ''").select("chapter_number", "slug").distinct()
    inside = F.col("url").contains(F.concat(F.lit("/"), "slug", F.lit("/")))
    return contents.join(own, "chapter_number").where(~inside).select("chapter_number", "slug", "title", "url")


def relation_histogram(graph: Graph, label: str, limit: int = 10) -> DataFrame:
    rows = g.ends(graph.edges).join(graph.nodes.where(F.col("label") == label).select("id"), "id", "left_semi")
    return g.top(rows.groupBy("type").agg(F.count("*").alias("n")), limit, F.desc("n"), "type")
