"""Quality checks of a graph.  Where a report is a top-k, its order is made total by id."""

from __future__ import annotations

import inspect
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import rules
from ..functions import text
from ..model import Graph, is_entity
from . import graphops as g


def one(rows: DataFrame, name: str) -> DataFrame:
    return rows.agg(F.count("*").alias(name))


def orphan_chunks(graph: Graph) -> DataFrame:
    return one(graph.chunks.where("article_id is null"), "orphan_chunks")


def orphan_entities(graph: Graph, limit: int | None = 100) -> DataFrame:
    lonely = graph.nodes.where(is_entity()).join(g.ends(graph.edges).select("id"), "id", "left_anti")
    return g.top(lonely.select("id", "label", "name"), limit, "id")


def duplicate_entities(graph: Graph, limit: int | None = 50) -> DataFrame:
    groups = graph.nodes.where(is_entity()).groupBy("label", "name").agg(F.count("*").alias("n")).where("n > 1")
    return g.top(groups, limit, F.desc("n"), "label", F.asc_nulls_first("name"))


def missing_embeddings(graph: Graph) -> DataFrame:
    return one(graph.chunks.where("not embedded"), "missing_embeddings")


def industry_count(graph: Graph) -> DataFrame:
    return one(graph.nodes.where("label = 'Industry'"), "industries")


def entity_stats(graph: Graph, labels: list[str] | None = None) -> DataFrame:
    counted = graph.nodes.select("label").unionByName(graph.articles.select(F.lit("Article").alias("label"))).unionByName(graph.chunks.select(F.lit("Chunk").alias("label"))).unionByName(graph.definitions.select(F.lit("Definition").alias("label"))).unionByName(graph.webinars.select(F.lit("Webinar").alias("label")))
    return counted.where(F.col("label").isin(labels or rules.STATS_LABELS)).groupBy("label").agg(F.count("*").alias("n"))


def typed_edges(graph: Graph) -> DataFrame:
    """source_label, type, target_label of every edge between entities."""
    ends = graph.nodes.where(is_entity()).select("id", "label")
    a = ends.select(F.col("id").alias("src"), F.col("label").alias("source_label"))
    b = ends.select(F.col("id").alias("dst"), F.col("label").alias("target_label"))
    return graph.edges.join(a, "src").join(b, "dst").select("src", "dst", "source_label", "type", "target_label")


def invalid_patterns(graph: Graph, limit: int | None = 20) -> DataFrame:
    allowed = rules.pattern_table(graph.edges.sparkSession)  # 55 rows
    bad = typed_edges(graph).join(F.broadcast(allowed), ["source_label", "type", "target_label"], "left_anti")
    return g.top(bad.groupBy("source_label", "type", "target_label").agg(F.count("*").alias("n")), limit, F.desc("n"), "source_label", "type", "target_label")


def valid_pattern_edges(graph: Graph) -> DataFrame:
    allowed = rules.pattern_table(graph.edges.sparkSession)
    good = typed_edges(graph).join(F.broadcast(allowed), ["source_label", "type", "target_label"], "left_semi")
    return good.groupBy("source_label", "type", "target_label").agg(F.count("*").alias("n"))


def article_coverage(graph: Graph) -> DataFrame:
    return graph.articles.agg(F.count("*").alias("articles"), F.countDistinct("chapter_number").alias("chapters"))


def missing_chunk_ids(graph: Graph) -> DataFrame:
    return one(graph.chunks.where("chunk_id is null"), "missing_chunk_ids")


def missing_chunk_index(graph: Graph) -> DataFrame:
    return one(graph.chunks.where("index is null"), "missing_chunk_index")


def plural_map(nodes: DataFrame) -> DataFrame:
    """label, singular_name, plural_name, singular_id, plural_id: an equi-join on name plus s."""
    names = nodes.where(is_entity() & F.col("name").isNotNull())
    one_, two = names.where(~F.col("name").endswith("s")), names
    a = one_.groupBy("label", "name").agg(F.min("id").alias("singular_id")).select("label", F.col("name").alias("singular_name"), F.concat("name", F.lit("s")).alias("plural_name"), "singular_id")
    return a.join(two.select("label", F.col("name").alias("plural_name"), F.col("id").alias("plural_id")), ["label", "plural_name"])


def plural_pairs(graph: Graph, limit: int | None = 100) -> DataFrame:
    d = g.degree(graph.edges)
    pairs = plural_map(graph.nodes).join(d.select(F.col("id").alias("singular_id"), F.col("degree").alias("singular_rels")), "singular_id", "left").join(d.select(F.col("id").alias("plural_id"), F.col("degree").alias("plural_rels")), "plural_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return g.top(pairs.select("label", "singular_name", "plural_name", zero("singular_rels"), zero("plural_rels"), "singular_id", "plural_id"), limit, "label", "singular_name", "singular_id", "plural_id")


def generic_entities(graph: Graph, terms: list[str] | None = None) -> DataFrame:
    found = graph.nodes.where(is_entity() & F.lower("name").isin(terms or rules.GENERIC_CHECK_TERMS))
    return g.with_degree(found, graph.edges).select("id", "label", "name", "degree")


def relationship_counts(graph: Graph, label: str) -> DataFrame:
    found = graph.nodes.where((F.col("label") == label) & F.col("name").isNotNull())
    return g.with_degree(found, graph.edges).groupBy("name").agg(F.sum("degree").alias("relationships"))


def mentioned(graph: Graph) -> DataFrame:
    """id, chunk_id of mentions that reach a chunk."""
    chunks = graph.chunks.select(F.col("id").alias("dst"))
    return graph.edges.where(F.col("type") == rules.MENTION).join(chunks, "dst", "left_semi").select(F.col("src").alias("id"), F.col("dst").alias("chunk_id"))


def degenerate_chunks(graph: Graph, least: int = rules.MIN_CHUNK, limit: int | None = 50) -> DataFrame:
    idle = graph.chunks.where(F.length("text") < least).join(mentioned(graph).select(F.col("chunk_id").alias("id")), "id", "left_anti")
    return g.top(idle.select("id", F.length("text").cast("long").alias("length")), limit, "length", "id")


def truncated_titles(graph: Graph, limit: int | None = 50) -> DataFrame:
    short = graph.webinars.where(F.col("title").isNull() | (F.length("title") < rules.MIN_TITLE) | (F.col("title") == "Webinar"))
    return g.top(short.select("id", "title"), limit, "id")


def unmentioned_entities(graph: Graph, limit: int | None = 100) -> DataFrame:
    rest = graph.nodes.where(is_entity()).join(mentioned(graph), "id", "left_anti")
    return g.top(rest.select("id", "label", "name"), limit, "label", F.asc_nulls_first("name"), "id")


def ghost_entities(graph: Graph, limit: int | None = 100) -> DataFrame:
    """A row per mention of an entity that has no other edge in either direction."""
    other = g.ends(graph.edges.where(F.col("type") != rules.MENTION)).select("id")
    rows = graph.nodes.where(is_entity()).join(mentioned(graph), "id").join(other, "id", "left_anti")
    return g.top(rows.select("id", "label", "name", "chunk_id"), limit, "id", "chunk_id")


def mislabeled_challenges(graph: Graph, limit: int | None = 50) -> DataFrame:
    found = graph.nodes.where((F.col("label") == "Challenge") & F.col("name").isNotNull() & text.positive_any_word(F.col("name")))
    return g.top(found.select("id", "name"), limit, "name", "id")


def near_names(nodes: DataFrame, longest: int = 5) -> DataFrame:
    """label, shorter, longer: pairs of distinct names in a label where one contains the other and
    is little longer, of nodes (label, name).

    No cross join: the shorter name is a substring of the longer of a known length, so an
    equi-join on all such substrings (at most 6 lengths) finds it."""
    names = nodes.select("label", "name").distinct()
    cuts = names.withColumn("size", F.length("name"))
    cuts = cuts.select("label", "name", F.explode(F.sequence(F.greatest(F.col("size") - longest, F.lit(1)), F.greatest(F.col("size") - 1, F.lit(1)))).alias("n"), "size").where("n < size and n > 4")
    parts = cuts.select("label", F.col("name").alias("longer"), F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.col("size") - F.col("n") + 1), lambda i: F.substring(F.col("name"), i, F.col("n"))))).alias("name"))
    return names.join(parts, ["label", "name"]).select("label", F.col("name").alias("shorter"), "longer")


def _named(graph: Graph) -> DataFrame:
    return graph.nodes.where(is_entity() & F.col("name").isNotNull() & F.col("id").isNotNull()).select("id", "label", "name")


def near_duplicates(graph: Graph, limit: int | None = 50, longest: int = 5) -> DataFrame:
    """Pairs of nodes whose names near_names() pairs, the shorter one's id the lesser.

    Names are paired, not nodes.  Of a limited list only the first `limit` pairs of names that have
    a pair of ids matter, of each the `limit` least ids of the shorter name (if one has no greater
    partner, no later one has) and of each of these the first `limit` greater ones."""
    names = _named(graph)
    pairs = near_names(names, longest)
    shown = ["label", "shorter", "longer", "shorter_id", "longer_id"]
    a, b = names.select("label", F.col("name").alias("shorter"), F.col("id").alias("shorter_id")), names.select("label", F.col("name").alias("longer"), F.col("id").alias("longer_id"))
    if limit is None:
        return pairs.join(a, ["label", "shorter"]).join(b, ["label", "longer"]).where("shorter_id < longer_id").select(*shown)
    least = a.groupBy("label", "shorter").agg(F.min("shorter_id").alias("least"))
    most = b.groupBy("label", "longer").agg(F.max("longer_id").alias("most"))
    some = pairs.join(least, ["label", "shorter"]).join(most, ["label", "longer"]).where("least < most").select("label", "shorter", "longer")
    some = F.broadcast(some.orderBy("label", "shorter", "longer").limit(limit))
    left = g.first_k(a.join(some, ["label", "shorter"]), ["label", "shorter", "longer"], limit, "shorter_id")
    rows = b.join(F.broadcast(left), ["label", "longer"]).where("shorter_id < longer_id")  # limit * limit rows
    return g.top(g.first_k(rows, ["label", "shorter", "longer", "shorter_id"], limit, "longer_id").select(*shown), limit, *shown)


def near_duplicate_count(graph: Graph, longest: int = 5) -> DataFrame:
    """value: how many pairs near_duplicates() has without a limit, without making them.

    Ids are dealt into buckets by range.  A pair is two ids of one bucket, counted by a running sum
    there, or of two buckets, counted from the numbers of ids of each; so what meets in a group is
    one bucket's rows, or a row for each bucket.  The buckets are stored, as their bounds come from
    a sample: any bounds give the same count."""
    names = _named(graph)
    pairs = near_names(names, longest)
    placed = g.checkpointed(names.repartitionByRange("id").withColumn("bucket", F.spark_partition_id()))
    shorter = placed.join(pairs.withColumnRenamed("shorter", "name"), ["label", "name"]).select("label", F.col("name").alias("shorter"), "longer", "bucket", "id", F.lit(1).alias("short"))
    longer = placed.join(pairs.withColumnRenamed("longer", "name"), ["label", "name"]).select("label", "shorter", F.col("name").alias("longer"), "bucket", "id", F.lit(0).alias("short"))
    key = ["label", "shorter", "longer"]
    # Of equal ids the longer name's row comes first, so that it does not count the shorter's.
    before = Window.partitionBy(*key, "bucket").orderBy("id", "short").rowsBetween(Window.unboundedPreceding, 0)
    rows = shorter.unionByName(longer).withColumn("lesser", F.sum("short").over(before))
    counts = rows.groupBy(*key, "bucket").agg(F.sum("short").alias("a"), F.sum(1 - F.col("short")).alias("b"), F.sum(F.when(F.col("short") == 0, F.col("lesser")).otherwise(0)).alias("inside"))
    earlier = F.coalesce(F.sum("a").over(Window.partitionBy(*key).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return counts.select((F.col("inside") + earlier * F.col("b")).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("value"))


def missing_definitions(graph: Graph) -> DataFrame:
    return graph.nodes.where(is_entity() & (F.coalesce("definition", F.lit("")) == "")).groupBy("label").agg(F.count("*").alias("n"))


def chunk_article_mapping(graph: Graph, limit: int | None = 100) -> DataFrame:
    rows = graph.chunks.where("chunk_id is null").join(graph.articles.select("article_id"), "article_id")
    return g.top(rows.select("id", "article_id", "index"), limit, "article_id", F.asc_nulls_first("index"), "id")


def name_stats(graph: Graph) -> DataFrame:
    """Per label: entities, those whose name is normal, those that need it."""
    plain = F.col("name") == text.plain_name(F.col("name"))
    named = graph.nodes.where(is_entity() & F.col("name").isNotNull())
    return named.groupBy("label").agg(F.count("*").alias("total"), F.count_if(plain).alias("normalized"), F.count_if(~plain).alias("needs"))


COUNTED = {
    "orphan_entities": orphan_entities, "duplicate_entities": duplicate_entities, "invalid_patterns": invalid_patterns, "plural_pairs": plural_pairs, "degenerate_chunks": degenerate_chunks,
    "truncated_titles": truncated_titles, "unmentioned_entities": unmentioned_entities, "ghost_entities": ghost_entities, "mislabeled_challenges": mislabeled_challenges, "near_duplicates": near_duplicates,
    "generic_entities": generic_entities, "missing_definitions": missing_definitions,
}
REPORTED = frozenset(COUNTED) - {"generic_entities", "missing_definitions"}  # with a limit, none if null
MEASURED = {"orphan_chunks": orphan_chunks, "missing_embeddings": missing_embeddings, "industries": industry_count, "missing_chunk_ids": missing_chunk_ids, "missing_chunk_index": missing_chunk_index}


def summary(graph: Graph, limited: bool = False) -> DataFrame:
    """check, value, ok, required: all checks as one table; `ok` of required ones decides.

    All defects are counted; if `limited`, those of the reports, as the SQL twin does."""
    rows = [f(graph).select(F.lit(name).alias("check"), F.col(name).alias("value")) for name, f in MEASURED.items()]
    for name, f in COUNTED.items():
        if name == "near_duplicates" and not limited:
            value = near_duplicate_count(graph)
        else:
            value = f(graph, **({"limit": None} if name in REPORTED and not limited else {})).agg(F.count("*").alias("value"))
        rows.append(value.select(F.lit(name).alias("check"), "value"))
    return judged(reduce(DataFrame.unionByName, rows))


#: What the lists of the reports hold at most.
LIMITS = {name: inspect.signature(COUNTED[name]).parameters["limit"].default for name in sorted(REPORTED)}


def judged(counts: DataFrame) -> DataFrame:
    """check, value, ok, required from check, value."""
    limit = F.when(F.col("check") == "industries", rules.MAX_INDUSTRIES).otherwise(0)
    required = F.col("check").isin("orphan_chunks", "duplicate_entities", "industries", "missing_chunk_ids", "missing_chunk_index", "plural_pairs")
    return counts.select("check", "value", (F.col("value") <= limit).alias("ok"), required.alias("required"))


def passed(checks: DataFrame) -> DataFrame:
    return checks.agg(F.coalesce(F.bool_and(F.when(F.col("required"), F.col("ok"))), F.lit(True)).alias("passed"))
