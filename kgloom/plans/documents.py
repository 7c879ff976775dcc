"""Queries over made pages and over documents, with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import chunking, extraction, supplementary
from ..sources import articles as source
from ..sources import sinks
from . import made, project

Query = Callable[[SparkSession, str], DataFrame]


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source.articles(made.pages(spark, sf_dir))


def _of(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(_records(spark, sf_dir))


def _resource_edges(records: DataFrame) -> DataFrame:
    return supplementary.resource_edges(supplementary.resources(records))


def _kept_resource_edges(records: DataFrame) -> DataFrame:
    """Where an article in three is not in the graph."""
    return supplementary.resource_edges(supplementary.resources(records), records.where("cast(article_id as long) % 3 <> 0"))


def _coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contents against the nations whose key is no multiple of three."""
    pages = project.table(spark, sf_dir, "nation").where("n_nationkey % 3 <> 0").select(F.concat(F.lit("/g/"), "n_nationkey").alias("url"))
    return supplementary.contents_coverage(source.contents_table(made.contents(spark, sf_dir)), pages)


def _foreign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All made URLs begin with /g/, which is the slug of chapters of an even number only."""
    number = (F.col("r_regionkey") + 1).cast("int")
    slugs = project.table(spark, sf_dir, "region").select(number.alias("chapter_number"), F.when(number % 2 == 0, "g").otherwise(F.lower("r_name")).alias("slug"))
    return supplementary.foreign_urls(source.contents_table(made.contents(spark, sf_dir)), slugs).select("chapter_number", "slug", "url")


def _glossary_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = project.table(spark, sf_dir, "nation").select(F.col("n_name").alias("term"), F.lit("A nation.").alias("definition"), F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("N"), "n_nationkey")).alias("acronym"), F.col("n_nationkey").alias("ord"))
    return source.glossary_markdown(terms)


def _fetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles of the contents with their pages; some pages failed to load."""
    from ..sources import pages

    n = F.col("n_nationkey")
    loaded = project.table(spark, sf_dir, "nation").select(F.concat(F.lit("/g/"), n).alias("url"), F.when(n % 4 != 0, F.concat(F.lit("<p>"), "n_name", F.lit("</p>"))).alias("html"))
    return pages.fetched(source.contents_table(made.contents(spark, sf_dir)).drop("page_id", "ord"), loaded)


def _html_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = made.pages(spark, sf_dir).select(F.col("page_id").alias("id"), F.col("html").alias("text"))
    return chunking.splitter(chunking.Config(least=0), markdown=False)(rows)


def _prefixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    text = F.concat(F.lit("# Head "), k, F.lit("\nbody "), k, F.lit("\n## Sub\nmore "), k)
    rows = project.table(spark, sf_dir, "supplier").select(k.alias("id"), F.when(k % 2 == 0, F.col("s_name")).alias("title"), text.alias("text"))
    return chunking.chunk(rows, chunking.Config(least=0, prefix=True)).select("id", "index", "text")


def _semantic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve sentences on one thing, then twelve on another: two groups."""
    k = F.col("s_suppkey")
    one, two = (F.concat_ws(" ", *[F.concat(F.lit(f"{word} "), k, F.lit(f" {word}s {word}ly.")) for _ in range(12)]) for word in ("cat", "quark"))
    rows = project.table(spark, sf_dir, "supplier").select(k.alias("id"), F.concat_ws(" ", one, two).alias("text"))
    return chunking.chunk(rows, chunking.Config(size=400, overlap=10, threshold=401, least=20, semantic=True)).select("id", "index", F.length("text").cast("long").alias("length"))


def _semantic_smoothed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbours share few words, but every other sentence is on one of two things, then of two
    others: smoothed over two sentences, there is one place to cut."""
    k = F.col("s_suppkey")
    one, two = (F.concat_ws(" ", *[F.concat(F.lit(f"{pair[i % 2]} "), k, F.lit(f" {pair[i % 2]}s {pair[i % 2]}ly.")) for i in range(12)]) for pair in (("cat", "dog"), ("quark", "gluon")))
    rows = project.table(spark, sf_dir, "supplier").select(k.alias("id"), F.concat_ws(" ", one, two).alias("text"))
    config = chunking.Config(size=400, overlap=10, threshold=401, least=20, semantic=True, window=2)
    return chunking.chunk(rows, config).select("id", "index", F.length("text").cast("long").alias("length"), F.substring_index("text", " ", 1).alias("begins"))


def _terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project.definitions(spark, sf_dir).select(F.lit("Concept").alias("label"), F.lower(F.get(F.split("term", " "), 0)).alias("name")).where("name <> ''").distinct()


def _extractor_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = extraction.parse_results(extraction.DictionaryExtractor(_terms(spark, sf_dir))(project.chunks(spark, sf_dir)))
    return parsed.select("chunk_id", F.size("nodes").cast("long").alias("n_nodes"), F.size("relationships").cast("long").alias("n_relationships"), "failed")


def _occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.occurrences(project.chunks(spark, sf_dir), _terms(spark, sf_dir)).groupBy("name").agg(F.count("*").alias("n"), F.min("start").alias("first"), F.max("stop").alias("last"))


def _graph_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = project.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    nodes, edges, chunks, status = extraction.documents_to_graph(docs, extraction.DictionaryExtractor(_terms(spark, sf_dir)), passes=1)
    rows = nodes.select(F.concat(F.lit("node "), "label").alias("kind")).unionByName(edges.select(F.concat(F.lit("edge "), "type").alias("kind")))
    rows = rows.unionByName(chunks.select(F.lit("chunk").alias("kind"))).unionByName(status.select(F.concat(F.lit("document "), "status").alias("kind")))
    return rows.groupBy("kind").agg(F.count("*").alias("n"))


def _guide(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = project.table(spark, sf_dir, "nation").select(F.col("n_name").alias("term"), F.lit("A nation.").alias("definition"))
    return sinks.guide_lines(_records(spark, sf_dir), terms)


QUERIES: dict[str, Query] = {
    "made_index": _of(supplementary.record_index),
    "made_sections": _of(lambda r: r.select("article_id", F.inline("sections"))),
    "html_links": _of(lambda r: r.select("article_id", F.inline("cross_references"))),
    "made_images": _of(lambda r: r.select("article_id", F.inline("images"))),
    "made_videos": _of(lambda r: r.select("article_id", F.inline("videos"))),
    "made_webinars": _of(lambda r: r.select("article_id", F.inline("webinars"))),
    "made_related": _of(lambda r: r.select("article_id", F.inline("related"))),
    "made_markdown": _of(lambda r: r.select("article_id", "title", "markdown_content", F.array_join("key_concepts", "|").alias("key_concepts"), "og_image")),
    "resource_nodes": _of(supplementary.resources),
    "made_resource_edges": _of(_resource_edges),
    "made_resource_edges_kept": _of(_kept_resource_edges),
    "made_related_edges": _of(supplementary.related_links),
    "made_related_titles": _of(supplementary.titled_links),
    "made_guide": _guide,
    "toc_articles": lambda s, d: source.contents_table(made.contents(s, d)),
    "toc_coverage": _coverage,
    "toc_foreign_urls": _foreign,
    "toc_fetched": _fetched,
    "glossary_terms": lambda s, d: source.glossary_table(made.glossaries(s, d)),
    "glossary_markdown": _glossary_markdown,
    "chunk_header_split": _html_chunks,
    "chunk_context_prefix": _prefixed,
    "chunk_semantic": _semantic,
    "chunk_semantic_smoothed": _semantic_smoothed,
    "extractor_results": _extractor_results,
    "term_occurrences": _occurrences,
    "documents_to_graph": _graph_of_documents,
}

_K = "s_suppkey"
_URL = f"'https://guide.example.com/guide/ch' || {_K} % 5 || '/art' || {_K}"
_NEXT = f"'https://guide.example.com/guide/ch' || {_K} % 5 || '/art' || ({_K} + 1)"
_OTHER = f"CASE {_K} % 3 WHEN 0 THEN 'https://blog.example.com/blog/post-' || {_K} WHEN 1 THEN 'https://guide.example.com/guide/ch' || ({_K} + 1) % 5 || '/art' || ({_K} + 1) ELSE 'https://other.example.org/y' || {_K} END"
_OTHER_HREF = _OTHER.replace("'https://guide.example.com/guide/ch'", "'/guide/ch'")
_WEBINAR = f"'https://resources.example.com/webinar/topic-' || {_K} % 3"
_ID = f"{_K}::VARCHAR AS article_id"
_TERM_ROWS = "terms AS (SELECT DISTINCT lower(string_split(term, ' ')[1]) AS name FROM definitions WHERE term <> '')"
_NL = "chr(10)"
_BODY = (
    f"'# ' || s_name || {_NL} || {_NL} || 'Intro of ' || s_name || '.' || {_NL} || {_NL} || '## Part A' || {_NL} || {_NL} || 'First ' || {_K} || '.' || {_NL} || {_NL} || 'Second ' || {_K} || '.' || {_NL} || {_NL}"
    f" || '### Part B' || {_NL} || {_NL} || 'Third ' || {_K} || ' with **term ' || {_K} % 7 || '**.' || {_NL} || {_NL} || '![Flow ' || {_K} || '](/img/' || {_K} || '.png)' || {_NL} || {_NL} || 'Caption ' || {_K} || {_NL} || {_NL} || '![again](/img/' || {_K} || '.png)' || {_NL} || {_NL}"
    f" || '[Next ' || {_K} || '](/guide/ch' || {_K} % 5 || '/art' || ({_K} + 1) || ') and [Out ' || {_K} || '](https://other.example.org/x' || {_K} || ')' || {_NL} || {_NL} || '[Video](https://www.youtube.com/embed/vid' || {_K} || ')' || {_NL} || {_NL}"
    f" || '[Watch](https://www.youtube.com/watch?v=vid' || {_K} || ')' || {_NL} || {_NL} || '**' || chr(128249) || ' [Webinar: Topic ' || {_K} % 3 || '](' || {_WEBINAR} || ')**' || {_NL} || {_NL} || 'RELATED ARTICLE: [Post ' || {_K} || '](' || {_OTHER_HREF} || ')'"
)
_RELATED = f"SELECT a.{_K}::VARCHAR AS src, 'RELATED_TO' AS type, b.{_K}::VARCHAR AS dst FROM supplier a JOIN supplier b ON a.{_K} % 3 = 1 AND b.{_K} = a.{_K} + 1"

ORACLES: dict[str, str] = {
    "made_index": f"SELECT {_ID}, s_name AS title, {_URL} AS url, true AS url_owner, 2::BIGINT AS n_sections, 2::BIGINT AS n_images, 1::BIGINT AS n_videos, 1::BIGINT AS n_webinars, 1::BIGINT AS n_related, 5::BIGINT AS n_cross_references, 2::BIGINT AS n_key_concepts FROM supplier",
    "made_sections": f"""SELECT {_ID}, 'Part A' AS heading, 2 AS level, 'First ' || {_K} || '.' || {_NL} || {_NL} || 'Second ' || {_K} || '.' AS content FROM supplier UNION ALL
 SELECT {_ID}, 'Part B', 3, 'Third ' || {_K} || ' withterm ' || {_K} % 7 || '.' || {_NL} || {_NL} || 'Next ' || {_K} || 'andOut ' || {_K} || {_NL} || {_NL} || 'Watch' || {_NL} || {_NL} || 'RELATED ARTICLE:Post ' || {_K} || {_NL} || {_NL} || 'Book a demo with us today' FROM supplier""",
    "html_links": f"""SELECT {_ID}, 'Next ' || {_K} AS text, {_NEXT} AS url, true AS is_internal, 'ch' || {_K} % 5 || '/art' || ({_K} + 1) AS section_id FROM supplier
 UNION ALL SELECT {_ID}, 'Out ' || {_K}, 'https://other.example.org/x' || {_K}, false, NULL FROM supplier UNION ALL SELECT {_ID}, 'Watch', 'https://www.youtube.com/watch?v=vid' || {_K}, false, NULL FROM supplier
 UNION ALL SELECT {_ID}, 'pic', {_WEBINAR}, true, NULL FROM supplier
 UNION ALL SELECT {_ID}, 'Post ' || {_K}, {_OTHER}, {_K} % 3 < 2, CASE WHEN {_K} % 3 = 1 THEN 'ch' || ({_K} + 1) % 5 || '/art' || ({_K} + 1) END FROM supplier""",
    "made_images": f"""SELECT {_ID}, 'https://guide.example.com/img/' || {_K} || '.png' AS src, 'Flow ' || {_K} AS alt, NULL::VARCHAR AS title, 'Caption ' || {_K} AS caption, 'Part B' AS context FROM supplier
 UNION ALL SELECT {_ID}, 'https://guide.example.com/t' || {_K} || '.png', 'pic', NULL, NULL, 'Part B' FROM supplier""",
    "made_videos": f"SELECT {_ID}, 'vid' || {_K} AS video_id, 'https://www.youtube.com/watch?v=vid' || {_K} AS url FROM supplier",
    "made_webinars": f"SELECT {_ID}, {_WEBINAR} AS url, 'Webinar: Topic ' || {_K} % 3 AS title, NULL::VARCHAR AS description, 'https://guide.example.com/t' || {_K} || '.png' AS thumbnail, 'Part B' AS context FROM supplier",
    "made_related": f"SELECT {_ID}, {_OTHER} AS url, 'Post ' || {_K} AS title, CASE {_K} % 3 WHEN 0 THEN 'blog' WHEN 1 THEN 'internal' ELSE 'external' END AS source_type FROM supplier",
    "made_markdown": f"SELECT {_ID}, s_name AS title, {_BODY} AS markdown_content, 'Supplier|term ' || {_K} % 7 AS key_concepts, CASE WHEN {_K} % 2 = 0 THEN 'https://img.example.com/' || {_K} || '.png' END AS og_image FROM supplier",
    "resource_nodes": f"""SELECT {_K} || '-img0' AS id, 'images' AS kind, 'https://guide.example.com/img/' || {_K} || '.png' AS url, {_ID} FROM supplier UNION ALL SELECT {_K} || '-img1', 'images', 'https://guide.example.com/t' || {_K} || '.png', {_ID} FROM supplier
 UNION ALL SELECT {_K} || '-vid0', 'videos', 'https://www.youtube.com/watch?v=vid' || {_K}, {_ID} FROM supplier UNION ALL SELECT {_K} || '-web0', 'webinars', {_WEBINAR}, {_ID} FROM supplier""",
    "made_resource_edges": f"SELECT {_K}::VARCHAR AS src, t AS type, {_K} || '-' || i AS dst FROM supplier, (VALUES ('HAS_IMAGE', 'img0'), ('HAS_IMAGE', 'img1'), ('HAS_VIDEO', 'vid0'), ('HAS_WEBINAR', 'web0')) x(t, i)",
    "made_resource_edges_kept": f"SELECT {_K}::VARCHAR AS src, t AS type, {_K} || '-' || i AS dst FROM supplier, (VALUES ('HAS_IMAGE', 'img0'), ('HAS_IMAGE', 'img1'), ('HAS_VIDEO', 'vid0'), ('HAS_WEBINAR', 'web0')) x(t, i) WHERE {_K} % 3 <> 0",
    "made_related_edges": _RELATED,
    "made_related_titles": _RELATED.replace("'RELATED_TO' AS type", f"'Post ' || a.{_K} AS title"),
    "made_guide": f"""SELECT 0 AS part, s_name AS key, '- ' || s_name AS line FROM supplier UNION ALL SELECT 1, s_name, {_BODY} FROM supplier
 UNION ALL SELECT 2, s_name, '- [Webinar: Topic ' || {_K} % 3 || '](' || {_WEBINAR} || ')' FROM supplier UNION ALL SELECT 3, s_name, '- [Post ' || {_K} || '](' || {_OTHER} || ')' FROM supplier
 UNION ALL SELECT 4, s_name, '- https://www.youtube.com/watch?v=vid' || {_K} FROM supplier UNION ALL SELECT 5, n_name, '**' || n_name || '**: A nation.' FROM nation""",
    "toc_articles": "SELECT r_regionkey::BIGINT AS page_id, (row_number() OVER (PARTITION BY r_regionkey ORDER BY n_nationkey) - 1)::INT AS ord, (r_regionkey + 1)::INT AS chapter_number, r_name AS chapter_title, n_nationkey::INT AS article_number, n_name AS title, '/g/' || n_nationkey AS url FROM nation JOIN region ON n_regionkey = r_regionkey",
    "toc_foreign_urls": "SELECT (r_regionkey + 1)::INT AS chapter_number, lower(r_name) AS slug, '/g/' || n_nationkey AS url FROM nation JOIN region ON n_regionkey = r_regionkey WHERE (r_regionkey + 1) % 2 = 1",
    "toc_coverage": "SELECT (n_regionkey + 1)::INT AS chapter_number, count(*) AS listed, count(*) FILTER (n_nationkey % 3 <> 0) AS found, count(*) FILTER (n_nationkey % 3 = 0) AS missing FROM nation GROUP BY 1",
    "toc_fetched": "SELECT 'ch' || (n_regionkey + 1) || '-art' || n_nationkey AS article_id, (n_regionkey + 1)::INT AS chapter_number, n_nationkey::INT AS article_number, n_name AS title, '/g/' || n_nationkey AS url, CASE WHEN n_nationkey = 0 THEN 'overview' ELSE 'article' END AS content_type, '<p>' || n_name || '</p>' AS html FROM nation WHERE n_nationkey % 4 <> 0",
    "glossary_terms": "SELECT n_regionkey::BIGINT AS page_id, (row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1)::INT AS ord, n_name AS term, CASE WHEN n_regionkey % 4 = 0 THEN 'N' || n_nationkey END AS acronym, 'The nation ' || n_name AS definition FROM nation",
    "glossary_markdown": f"SELECT '# Glossary' || {_NL} || {_NL} || string_agg('## ' || n_name || CASE WHEN n_nationkey % 2 = 0 THEN {_NL} || {_NL} || '**Acronym**: N' || n_nationkey ELSE '' END || {_NL} || {_NL} || 'A nation.', {_NL} || {_NL} ORDER BY n_nationkey) AS markdown FROM nation",
    "chunk_header_split": f"""SELECT {_K}::VARCHAR AS id, 0 AS index, s_name AS h1, NULL::VARCHAR AS h2, NULL::VARCHAR AS h3, 'Intro of ' || s_name || '.' AS text FROM supplier
 UNION ALL SELECT {_K}::VARCHAR, 1, s_name, 'Part A', NULL, 'First ' || {_K} || '.' || {_NL} || 'Second ' || {_K} || '.' FROM supplier
 UNION ALL SELECT {_K}::VARCHAR, 2, s_name, 'Part A', 'Part B', array_to_string(['Third ' || {_K} || ' with', 'term ' || {_K} % 7, '.', 'Caption ' || {_K}, 'Next ' || {_K}, 'and', 'Out ' || {_K}, 'Watch', 'RELATED ARTICLE:', 'Post ' || {_K}, 'Book a demo with us today'], {_NL}) FROM supplier""",
    "chunk_context_prefix": f"""SELECT {_K}::VARCHAR AS id, 0 AS index, CASE WHEN {_K} % 2 = 0 THEN 'Article: ' || s_name || ' > ' ELSE '' END || 'Head ' || {_K} || {_NL} || {_NL} || 'body ' || {_K} AS text FROM supplier
 UNION ALL SELECT {_K}::VARCHAR, 1, CASE WHEN {_K} % 2 = 0 THEN 'Article: ' || s_name || ' > ' ELSE '' END || 'Head ' || {_K} || ' > Sub' || {_NL} || {_NL} || 'more ' || {_K} FROM supplier""",
    "chunk_semantic": f"SELECT {_K}::VARCHAR AS id, i AS index, (12 * (length(w) * 3 + length({_K}::VARCHAR) + 8) - 1)::BIGINT AS length FROM supplier, (VALUES (0, 'cat'), (1, 'quark')) x(i, w)",
    "chunk_semantic_smoothed": f"SELECT {_K}::VARCHAR AS id, i AS index, (12 * (length(w) * 3 + length({_K}::VARCHAR) + 8) - 1)::BIGINT AS length, w AS begins FROM supplier, (VALUES (0, 'cat'), (1, 'quark')) x(i, w)",
}

# On the shared projection of the graph.
GRAPH_ORACLES: dict[str, str] = {
    "extractor_results": f", {_TERM_ROWS} SELECT c.id AS chunk_id, count(*) AS n_nodes, count(*) - 1 AS n_relationships, false AS failed FROM chunks c JOIN terms t ON contains(' ' || lower(c.text) || ' ', ' ' || t.name || ' ') WHERE length(c.text) > 50 GROUP BY 1",
    "term_occurrences": f", {_TERM_ROWS}, words AS (SELECT unnest(string_split(lower(text), ' ')) AS w, generate_subscripts(string_split(lower(text), ' '), 1) AS i, id FROM chunks WHERE length(text) > 50), placed AS (SELECT w, (sum(length(w) + 1) OVER (PARTITION BY id ORDER BY i) - length(w) - 1)::BIGINT AS s FROM words) SELECT name, count(*) AS n, min(s)::INT AS first, max(s + length(name))::INT AS last FROM placed JOIN terms ON w = name GROUP BY 1",
}
