"""All registered queries of the graph engine and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import rules
from ..functions import fuzzy, text
from ..model import Graph
from ..operators import census, checks, chunking, cleanup, community, extraction, industry, linking, prompts, providers, repairs, retrieval, supplementary
from ..operators import graphops as g
from ..sources import articles as article_source
from ..sources import pages as page_source
from ..sources import preflight
from ..sources import sinks
from . import documents, indexed, project, twins

Query = Callable[[SparkSession, str], DataFrame]


def over(build: Callable[[Graph], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(project.graph(spark, sf_dir))


def counted(build: Callable[[Graph], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(project.counted(spark, sf_dir))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")


def chunk_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of the first chunk of each document."""
    return vectors(spark, sf_dir).select(F.concat_ws("-", F.lit("doc"), F.col("id").cast("string"), F.lit("0")).alias("id"), "embedding")


def extraction_prompts(graph: Graph) -> DataFrame:
    rows = prompts.prompts(graph.chunks)
    return rows.select("chunk_id", F.array_join(F.col("examples").cast("array<string>"), ",").alias("examples"), F.length("prompt").cast("long").alias("n_chars"), F.sha2("prompt", 256).alias("sha256"))


def first_vector(rows: DataFrame) -> DataFrame:
    return rows.orderBy("id").limit(1).select(F.col("embedding").alias("q"))


def rounded(rows: DataFrame, name: str, digits: int = 6) -> DataFrame:
    return rows.withColumn(name, F.round(name, digits))


def properties(nodes: DataFrame) -> DataFrame:
    return nodes.select("id", "label", "name", "display_name", "definition", "description", F.array_join("source_spans", ",").alias("source_spans"))


def partition(graph: Graph) -> DataFrame:
    return graph.nodes.where(checks.is_entity() & F.col("name").isNotNull()).groupBy(F.col("name").alias("node")).agg(F.min("label").alias("community"))


def references(graph: Graph) -> DataFrame:
    return graph.articles.select("article_id", F.concat(F.lit("https://guide.example/ch"), "chapter_number", F.lit("/"), (F.col("article_number") * 3) % 50).alias("url"), F.col("title").alias("text"))


def generic_deletion(graph: Graph) -> DataFrame:
    left = cleanup.delete_generic(graph)
    return left.nodes.agg(F.count("*").alias("nodes_left")).crossJoin(left.edges.agg(F.count("*").alias("edges_left")))


def name_equivalence(graph: Graph) -> DataFrame:
    return graph.nodes.groupBy(text.normalize_name(F.col("name")).alias("normal")).agg(F.count("*").alias("n")).where("n > 1")


def singularize(graph: Graph) -> DataFrame:
    table = graph.nodes.sparkSession.createDataFrame([(p,) for p in rules.SINGULARS], "term string")
    terms = table.unionByName(graph.nodes.where("name is not null").select(F.col("name").alias("term")).distinct())
    return terms.select("term", text.singular(F.col("term")).alias("singular"))


def fuzzy_ratio_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = project.table(spark, sf_dir, "part").select(F.col("p_name").alias("term"))
    keys = rules.industry_table(spark).select(F.col("term").alias("key")).distinct().withColumn("ord", F.lit(0))
    return rounded(fuzzy.scored(names, keys, 60.0).select(F.col("term").alias("a"), F.col("key").alias("b"), "score"), "score")


def industry_terms(graph: Graph) -> DataFrame:
    return graph.nodes.where("label in ('Industry', 'Organization')").select(F.col("name").alias("term"))


def industry_normalized(graph: Graph) -> DataFrame:
    found = industry.normalize(industry_terms(graph))
    return found.where(~F.col("term").isin(rules.INDUSTRY_ORGANIZATIONS))


def applies_to(graph: Graph) -> DataFrame:
    """With a table of standards that the data has names of."""
    return linking.applies_to_backfill(graph.nodes, standards(graph))


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extractor outputs made from events: two entities and a relation, some fenced, some broken."""
    k = F.col("event_id")
    json = F.format_string('{"nodes": [{"id": "a", "label": "Concept", "properties": {"name": "%s"}}, {"id": "b", "label": "%s", "properties": {"name": "Blue Bolt"}}], "relationships": [{"type": "%s", "source": "%s", "target": "blue bolt"}]}', "event_type", F.when(k % 2 == 0, "Standard").otherwise("Planet"), F.when(k % 3 == 0, "DEFINES").when(k % 3 == 1, "").otherwise("EATS"), "event_type")
    text_ = F.when(k % 5 == 0, F.concat(F.lit("```json\n"), json, F.lit("\n```"))).when(k % 7 == 0, "no json").otherwise(json)
    return project.table(spark, sf_dir, "events").select(F.concat(F.lit("doc-"), k, F.lit("-0")).alias("chunk_id"), text_.alias("json"))


def glean_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = extraction.parse_results(results(spark, sf_dir))
    return parsed.select("chunk_id", F.size("nodes").cast("long").alias("n_nodes"), F.size("relationships").cast("long").alias("n_relationships"), "failed")


def glean_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extraction.result_nodes(extraction.parse_results(results(spark, sf_dir)))
    return found.groupBy("label", "name").agg(F.count("*").alias("mentions"))


def glean_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = project.entities(spark, sf_dir)
    new, _ = extraction.merge_nodes(nodes, extraction.parse_results(results(spark, sf_dir)))
    both = nodes.select("id", "label", "name").unionByName(new.select("id", "label", "name"))
    edges = extraction.merge_relationships(both, extraction.parse_results(results(spark, sf_dir)))
    return edges.groupBy("type").agg(F.count("*").alias("n"))


def chunk_rows(graph: Graph) -> DataFrame:
    rows = extraction.chunks_with_entities(graph.chunks, graph.nodes, graph.edges)
    text_ = F.array_sort(F.transform("entities", lambda e: F.concat_ws("|", e["name"], e["label"], F.coalesce(e["definition"], F.lit("")))))
    return rows.select("chunk", "article_id", "index", F.size("entities").cast("long").alias("n_entities"), F.array_join(text_, ";").alias("entities"))


def sizes(graph: Graph) -> DataFrame:
    return graph.nodes.agg(F.lit("nodes").alias("table"), F.count("*").alias("n")).unionByName(graph.edges.agg(F.lit("edges").alias("table"), F.count("*").alias("n")))


def fuzzy_best_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = project.table(spark, sf_dir, "part").select(F.col("p_name").alias("term"))
    keys = rules.industry_table(spark).where("kind = 'taxonomy'").select(F.col("term").alias("key"), "ord")
    return rounded(fuzzy.best(fuzzy.scored(names, keys, 40.0)), "score")


def standards(graph: Graph) -> DataFrame:
    """A table of standards that the data has names of."""
    return graph.nodes.sparkSession.createDataFrame([("blue bolt", "automobile"), ("red plate", "rail")], "name string, industry string")


def first_words(graph: Graph) -> DataFrame:
    """Dictionary terms of the data: the first word of every glossary term."""
    return graph.definitions.select(F.lit("Concept").alias("label"), F.lower(F.get(F.split("term", " "), 0)).alias("name")).where("name <> ''").distinct()


def with_terms(graph: Graph) -> DataFrame:
    """The nodes and, as standards, the words and pairs of words that the glossary's terms begin
    with and texts hold."""
    terms = graph.definitions.where("ord < 100000").select(F.lower("term").alias("term"))
    names = terms.select(F.get(F.split("term", " "), 0).alias("name")).unionByName(terms.select(F.col("term").alias("name"))).where("name <> ''").distinct()
    new = names.select(F.concat(F.lit("term-"), "name").alias("id"), F.lit("Standard").alias("label"), "name")
    return graph.nodes.select("id", "label", "name").unionByName(new)


def dictionary_extract(graph: Graph) -> DataFrame:
    rows = extraction.dictionary_mentions(graph.chunks, first_words(graph))
    return rows.select("chunk_id", "name", "span")


def source_spans(graph: Graph) -> DataFrame:
    new, _ = extraction.augment(graph.nodes, extraction.dictionary_mentions(graph.chunks, first_words(graph)))
    return new.select("label", "name", "display_name", F.size("source_spans").cast("long").alias("n_spans"))


def sections_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a heading before every fifth line, split at headings."""
    lines = project.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    marked = lines.withColumn("line", F.when(F.col("pos") % 5 == 0, F.concat(F.when(F.col("pos") % 10 == 0, "# ").otherwise("## "), F.lit("H"), F.col("pos").cast("string"))).otherwise(F.col("line")))
    return chunking.header_split(marked)


def jsonl(graph: Graph) -> DataFrame:
    records = sinks.jsonl_records(graph.articles.select("article_id", "title"), graph.definitions.select("term", "definition"), "guide")
    return records.groupBy("type", "guide_title").agg(F.count("*").alias("n"), F.count("article_id").alias("with_article"), F.count("term").alias("with_term"))


def page_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return article_source.articles(project.table(spark, sf_dir, "pages"))


def constraints(graph: Graph) -> DataFrame:
    """constraint, broken: keys that are not unique, values that are missing."""
    unique = {"article_id": (graph.articles, "article_id"), "article_url": (graph.articles, "url"), "chunk_id": (graph.chunks.where("chunk_id is not null"), "chunk_id"), "term_id": (graph.definitions, "term_id")}
    rows = [preflight.unique(f, c).agg(F.lit(k).alias("constraint"), F.count("*").alias("broken")) for k, (f, c) in unique.items()]
    rows += [preflight.present(f, c).agg(F.lit(k).alias("constraint"), F.count("*").alias("broken")) for k, (f, c) in {"chunk_article": (graph.chunks, "article_id"), "node_name": (graph.nodes, "name")}.items()]
    return reduce(DataFrame.unionByName, rows)


def embedded(graph: Graph) -> DataFrame:
    """Length and sum of the offline vectors of articles."""
    rows = providers.embed(graph.articles.select("article_id", "text"), "text")
    return rows.select("article_id", F.size("embedding").cast("long").alias("dimensions"), F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x).alias("words"))


QUERIES: dict[str, Query] = {
    "xlabel_winner": over(lambda x: g.cross_label_winners(x.nodes)),
    "xlabel_merge_map": over(lambda x: g.cross_label_map(x.nodes)),
    "samelabel_merge_map": over(lambda x: g.same_label_map(x.nodes)),
    "merged_edges_after_dedup": over(lambda x: g.rewrite_edges(x.edges, g.cross_label_map(x.nodes))),
    "merged_edges_same_label": over(lambda x: g.rewrite_edges(x.edges, g.same_label_map(x.nodes))),
    "property_fold_dup_wins": over(lambda x: g.fold(x.nodes, g.cross_label_map(x.nodes), "dup_wins").drop("source_spans")),
    "property_fold_fill_null": over(lambda x: g.fold(x.nodes, g.cross_label_map(x.nodes), "fill_null").drop("source_spans")),
    "merged_nodes_same_label": over(lambda x: properties(cleanup.deduplicate_by_name(x).nodes)),
    "merged_nodes_across_labels": over(lambda x: properties(cleanup.deduplicate_across_labels(x).nodes)),
    "industry_nodes": over(lambda x: properties(industry.consolidate(x).nodes)),
    "industry_edges": over(lambda x: industry.consolidate(x).edges.groupBy("type").agg(F.count("*").alias("n"))),
    "property_fold_union_longer": over(lambda x: g.fold(x.nodes, g.cross_label_map(x.nodes), "union_longer").withColumn("source_spans", F.array_join("source_spans", ","))),
    "generic_deletion": over(generic_deletion),
    "plural_merge_edges": over(lambda x: cleanup.merge_plurals(x).edges),
    "label_backfill": over(lambda x: cleanup.backfill_labels(x.nodes).groupBy(F.array_join("labels", "+").alias("label_set")).agg(F.count("*").alias("n"))),
    "normalize_names": over(lambda x: x.nodes.select("id", text.normalize_name(F.col("name")).alias("normal"))),
    "name_equivalence": over(name_equivalence),
    "entity_name_pass": over(lambda x: cleanup.normalize_names(x.nodes).select("id", "name", "display_name")),
    "name_stats": over(checks.name_stats),
    "generic_flag": over(lambda x: x.nodes.select("id", text.is_generic(F.col("name")).alias("generic"))),
    "singularize": over(singularize),
    "cleanup_disposition": over(lambda x: cleanup.dispositions(x.nodes).select("id", "action", "value", "renamed")),
    "cleanup_buckets": over(lambda x: cleanup.buckets(x.nodes)),
    "cleanup_candidates": over(cleanup.candidates),
    "cleanup_preview": over(cleanup.preview),
    "mislabel_first_word": over(lambda x: x.nodes.select("id", text.positive_first_word(F.col("name")).alias("flagged"))),
    "mislabel_any_word": over(lambda x: x.nodes.where("name is not null").select("id", text.positive_any_word(F.col("name")).alias("flagged"))),
    "fragments": over(lambda x: x.nodes.select("id", F.array_join(text.fragments(F.col("description")), "#").alias("fragments"))),
    "fuzzy_ratio_pairs": fuzzy_ratio_pairs,
    "industry_disposition": over(lambda x: industry.classify(industry_terms(x))),
    "industry_consolidated": over(lambda x: industry.consolidation(x.nodes)),
    "industry_bulk_rename": over(lambda x: industry.bulk_rename(x.nodes).select("id", "name")),
    "industry_normalized": over(industry_normalized),
    "orphan_chunks": over(checks.orphan_chunks),
    "orphan_entities": over(checks.orphan_entities),
    "duplicate_entities": over(checks.duplicate_entities),
    "missing_embeddings": over(checks.missing_embeddings),
    "industry_count": over(checks.industry_count),
    "entity_stats": over(checks.entity_stats),
    "invalid_patterns": over(checks.invalid_patterns),
    "valid_pattern_edges": over(checks.valid_pattern_edges),
    "article_coverage": over(checks.article_coverage),
    "missing_chunk_ids": over(checks.missing_chunk_ids),
    "missing_chunk_index": over(checks.missing_chunk_index),
    "degenerate_chunks": over(checks.degenerate_chunks),
    "plural_pairs": over(checks.plural_pairs),
    "generic_entities": over(checks.generic_entities),
    "relationship_counts": over(lambda x: checks.relationship_counts(x, "Concept")),
    "unmentioned_entities": over(checks.unmentioned_entities),
    "ghost_entities": over(checks.ghost_entities),
    "ghost_entities_bare": over(lambda x: checks.ghost_entities(x.with_(edges=x.edges.where(F.col("type") == rules.MENTION)))),
    "near_duplicates": over(checks.near_duplicates),
    "missing_definitions": over(checks.missing_definitions),
    "truncated_titles": over(checks.truncated_titles),
    "mislabeled_challenges": over(checks.mislabeled_challenges),
    "chunk_article_mapping": over(checks.chunk_article_mapping),
    "validation_summary": counted(lambda x: census.summary(x, limited=True)),
    "validation_counts": counted(census.summary),
    "validation_passed": counted(lambda x: checks.passed(census.summary(x, limited=True))),
    "fix_chunk_index": over(lambda x: repairs.chunk_index(x).chunks.select("id", "article_id", "index")),
    "fix_chunk_ids": over(lambda x: repairs.chunk_ids(x).chunks.select("id", "chunk_id")),
    "fix_titles": over(lambda x: repairs.titles(x).webinars.select("id", "title")),
    "fix_mislabeled": over(lambda x: repairs.mislabeled(x).nodes.select("id", "label")),
    "fix_definitions": over(repairs.glossary_definitions),
    "fix_generic": over(lambda x: repairs.generics(x).nodes.select("id")),
    "fix_plural": over(lambda x: repairs.plurals(x).nodes.select("id")),
    "fix_degenerate": over(lambda x: repairs.degenerate_chunks(x).chunks.select("id")),
    "fix_preview": over(repairs.preview),
    "fix_all": over(lambda x: repairs.apply(x).nodes.select("id", "label", "name", "definition")),
    "mention_backfill": over(linking.mention_backfill),
    "mention_backfill_terms": over(lambda x: linking.mention_backfill(x.with_(nodes=with_terms(x)))),
    "applies_to_backfill": over(applies_to),
    "glossary_links": over(lambda x: rounded(linking.glossary_links(x), "score")),
    "glossary_exact": over(lambda x: linking.glossary_links(x).where("how = 'exact'").select("term_id", "term")),
    "glossary_top3": over(linking.glossary_top),
    "chapter_structure": over(lambda x: supplementary.chapters(x.articles)),
    "chapter_rollup": over(lambda x: supplementary.chapter_rollup(x.articles)),
    "in_chapter_edges": over(lambda x: supplementary.in_chapter(x.articles)),
    "definitions": over(lambda x: supplementary.definitions(x.definitions)),
    "article_relationships": over(lambda x: supplementary.article_links(x.articles, references(x))),
    "article_index": over(lambda x: supplementary.article_index(x.articles, x.chunks)),
    "webinar_thumbnails": over(lambda x: supplementary.thumbnails(x.webinars)),
    "resource_facts": over(lambda x: supplementary.resource_facts(x.webinars)),
    "word_counts": over(lambda x: x.articles.select("article_id", text.word_count(F.col("text")).alias("words"), F.length("text").cast("long").alias("chars"))),
    "diag_labels": over(supplementary.diagnose),
    "diag_label_sets": over(lambda x: supplementary.label_sets(x.nodes)),
    "diag_relations": over(lambda x: supplementary.relation_histogram(x, "Concept")),
    "vector_topk": lambda s, d: rounded(retrieval.vector_topk(vectors(s, d), first_vector(vectors(s, d))), "score"),
    "chunk_entities": over(lambda x: retrieval.chunk_entities(x, x.chunks.where("chunk_id is not null").select(F.col("id").alias("chunk_id")))),
    "name_search": over(lambda x: retrieval.name_search(x, "Gear")),
    "neighbourhood": over(lambda x: retrieval.neighbourhood(x, "Blue bolt")),
    "two_hop": over(lambda x: retrieval.two_hop(x, "APPLIES_TO", "DEFINES", "Standard")),
    "article_entities": over(retrieval.article_entities),
    "bm25_topk": over(lambda x: rounded(retrieval.bm25(x.chunks, ["blue", "the", "on"]), "score")),
    "retrieval_chain": lambda s, d: retrieval.chain(project.graph(s, d), chunk_vectors(s, d), first_vector(vectors(s, d))),
    "semantic_edges": over(community.semantic_edges),
    "modularity": over(lambda x: rounded(community.modularity(community.semantic_edges(x), partition(x)), "modularity", 9)),
    "label_propagation": over(lambda x: community.label_propagation(community.semantic_edges(x), 3)),
    "community_member_rows": over(lambda x: community.member_rows(x, partition(x))),
    "chunks_with_entities": over(chunk_rows),
    "backfill_counts": over(lambda x: linking.backfill(x, standards(x))[1]),
    "backfill_edges": over(lambda x: linking.backfill(x, standards(x))[0].edges.groupBy("type").agg(F.count("*").alias("n"))),
    "cleanup_run": over(lambda x: sizes(cleanup.run_cleanup(x))),
    "fuzzy_best_match": fuzzy_best_match,
    "schema_types": lambda s, d: rules.type_table(s),
    "schema_patterns": lambda s, d: rules.pattern_table(s),
    "search_chain": over(lambda x: retrieval.search_chain(x, "Gear")),
    "article_topk": lambda s, d: rounded(retrieval.article_topk(project.graph(s, d), chunk_vectors(s, d), first_vector(vectors(s, d))), "score"),
    "health_queries": over(lambda x: retrieval.health(x, partition(x).select("community", F.when(F.col("community") != "Concept", F.array(F.lit(1.0))).alias("embedding")).distinct())),
    "related_labels": over(lambda x: supplementary.related_labels(x, "Concept")),
    "mention_overlap": over(supplementary.mention_overlap),
    "mention_edges": over(lambda x: extraction.mention_edges(x.nodes, extraction.dictionary_mentions(x.chunks, first_words(x))).groupBy("type").agg(F.count("*").alias("n"), F.countDistinct("src").alias("entities"))),
    "community_members": over(lambda x: community.members(x, partition(x))),
    "community_assignment": over(lambda x: community.assign(x, partition(x)).select("id", "community")),
    "in_community_edges": over(lambda x: community.membership(x, partition(x))),
    "leiden": over(lambda x: community.communities(community.semantic_edges(x))),
    "glean_parse": glean_parse,
    "glean_merge_nodes": glean_nodes,
    "glean_merge_edges": glean_edges,
    "dictionary_extract": over(dictionary_extract),
    "source_spans": over(source_spans),
    "section_rows": sections_of,
    "chunk_size_rule": lambda s, d: sections_of(s, d).groupBy((F.length("text") > 1500).alias("split"), (F.length("text") >= 100).alias("kept")).agg(F.count("*").alias("n")),
    "chunk_recursive": lambda s, d: chunking.chunk(project.table(s, d, "documents").select(F.col("doc_id").alias("id"), "text")),
    "jsonl_records": over(jsonl),
    "html_facts": lambda s, d: page_source.text_facts(project.table(s, d, "pages")),
    "html_text": lambda s, d: page_source.visible_text(project.table(s, d, "pages")),
    "html_articles": lambda s, d: page_articles(s, d).select("article_id", "title", "markdown_content", F.size("sections").alias("n_sections"), F.array_join("key_concepts", "|").alias("key_concepts")),
    "entity_fragments": over(lambda x: cleanup.fragmented(x.nodes, 10).withColumn("fragments", F.array_join("fragments", "#"))),
    "entity_summaries": over(lambda x: cleanup.summarize(x.nodes)),
    "constraint_checks": over(constraints),
    "article_vectors": over(embedded),
    "extraction_prompts": over(extraction_prompts),
    "community_search": over(lambda x: providers.community_search(community.summaries(x, partition(x)), "blue bolt gear")),
    "community_summaries": over(lambda x: community.summaries(x, community.communities(community.semantic_edges(x)))),
}

QUERIES |= documents.QUERIES
QUERIES |= indexed.QUERIES
ORACLES: dict[str, str] = {name: sql for name, sql in (twins.ORACLES | documents.ORACLES).items() if name in QUERIES}
