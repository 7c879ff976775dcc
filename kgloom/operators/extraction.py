"""Extraction results to nodes and edges: parsing, gleaning, dictionary augmentation.

The extractor is a provider; the offline one finds dictionary terms.  What is built here is
the relational part around it.
"""

from __future__ import annotations

from typing import NamedTuple, Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions import text
from . import chunking, linking
from . import graphops as g

NODES = "array<struct<id:string,label:string,properties:map<string,string>>>"
RELATIONSHIPS = "array<struct<type:string,start_node_id:string,end_node_id:string,source:string,target:string,properties:map<string,string>>>"
RESULT = f"struct<nodes:{NODES},relationships:{RELATIONSHIPS}>"
LEAST_TEXT = 50


class Extractor(Protocol):
    def __call__(self, chunks: DataFrame) -> DataFrame:
        """chunk_id, json for chunks (id, text)."""


def parse_results(rows: DataFrame) -> DataFrame:
    """chunk_id, nodes, relationships, failed from chunk_id, json; code fences are dropped,
    missing lists are empty, what is no JSON object counts as failed.

    Each step is a selection of its own, so that a text is stripped and parsed once; a text that
    begins and ends with a brace has nothing to strip."""
    plain = F.col("json").startswith("{") & F.col("json").endswith("}") & ~F.col("json").contains("```")
    bare = F.when(plain, F.col("json")).otherwise(text.strip(F.regexp_replace("json", r"(?m)^\s*```[a-z]*\s*$", "")))
    failed = F.coalesce(~(F.col("bare").startswith("{") & F.get_json_object("bare", "$").isNotNull()), F.lit(True))
    read = rows.select("chunk_id", bare.alias("bare")).select("chunk_id", failed.alias("failed"), F.from_json("bare", RESULT).alias("x"))
    part = lambda name, kind: F.coalesce(F.when(~F.col("failed"), F.col("x")[name]), F.array().cast(kind)).alias(name)
    return read.select("chunk_id", part("nodes", NODES), part("relationships", RELATIONSHIPS), "failed")


def result_nodes(parsed: DataFrame) -> DataFrame:
    """chunk_id, label, name, definition: entities of known labels with a name."""
    rows = parsed.select("chunk_id", F.inline("nodes"))
    name = text.plain_name(F.coalesce(F.element_at("properties", "name"), F.col("id")))
    label = F.coalesce(F.when(F.col("label") != "", F.col("label")), F.lit("Concept"))
    return rows.select("chunk_id", label.alias("label"), name.alias("name"), F.element_at("properties", "definition").alias("definition")).where((F.col("name") != "") & F.col("label").isin(rules.ENTITY_LABELS))


def entity_id(label: F.Column, name: F.Column) -> F.Column:
    return F.sha2(F.concat_ws("|", label, name), 256)


def merge_nodes(nodes: DataFrame, parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new nodes, mention edges): an entity that exists keeps its properties."""
    found = g.checkpointed(result_nodes(parsed))  # read by both
    known = nodes.where("name is not null").groupBy("label", "name").agg(F.min("id").alias("known"))
    rows = found.join(known, ["label", "name"], "left").withColumn("id", F.coalesce("known", entity_id(F.col("label"), F.col("name"))))
    # Mentions of one entity combine before they meet what is known.
    named = found.groupBy("label", "name").agg(F.min("definition").alias("definition")).join(known, ["label", "name"], "left_anti")
    new = named.select(entity_id(F.col("label"), F.col("name")).alias("id"), "label", "name", "definition")
    edges = rows.select(F.col("id").alias("src"), F.lit(rules.MENTION).alias("type"), F.col("chunk_id").alias("dst")).distinct()
    return new, edges


def merge_relationships(nodes: DataFrame, parsed: DataFrame) -> DataFrame:
    """src, type, dst: ends are found by lower-case name under any label.

    A relation between two names is joined once, however many chunks state it; else each of its rows
    would meet every node of either name."""
    rows = parsed.select(F.inline("relationships"))
    end = lambda a, b: text.plain_name(F.coalesce(F.when(F.col(a) != "", F.col(a)), F.col(b)))
    kind = F.coalesce(F.when(F.col("type") != "", F.col("type")), F.lit("RELATED_TO"))
    named = rows.select(end("source", "start_node_id").alias("a"), end("target", "end_node_id").alias("b"), kind.alias("type")).where(F.col("type").isin([*rules.RELATIONSHIPS, rules.MENTION])).distinct()
    names = nodes.where("name is not null").select("id", F.lower("name").alias("name"))
    left, right = names.select(F.col("id").alias("src"), F.col("name").alias("a")), names.select(F.col("id").alias("dst"), F.col("name").alias("b"))
    return named.join(left, "a").join(right, "b").select("src", "type", "dst").distinct()


def merged(nodes: DataFrame, edges: DataFrame, parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges to add to `edges`) after one pass of parsed results.

    What several later steps read is written once.  Mentions are held against mentions only; of the
    edges, relations meet those that equal one of them."""
    keys = ["src", "type", "dst"]
    new, mentions = merge_nodes(nodes, parsed)
    nodes = g.checkpointed(g.upsert_nodes(nodes, new.withColumn("labels", F.array(F.lit("__Entity__"), F.lit("__KGBuilder__"), "label"))))
    mentions = g.checkpointed(mentions.join(edges.where(F.col("type") == rules.MENTION).select(keys), keys, "left_anti"))
    relations = g.checkpointed(merge_relationships(nodes, parsed))
    held = edges.select(keys).unionByName(mentions).join(relations, keys, "left_semi").distinct()
    return nodes, mentions.unionByName(relations.join(held, keys, "left_anti"))


def glean(nodes: DataFrame, edges: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nodes, edges, counts) after one pass of results; a second pass changes nothing."""
    parsed = g.checkpointed(parse_results(rows))
    nodes, more = merged(nodes, edges, parsed)
    return nodes, edges.unionByName(more), parsed.agg(F.count("*").alias("chunks"), F.count_if("failed").alias("failed"))


def candidate_chunks(chunks: DataFrame, limit: int | None = None) -> DataFrame:
    """Chunks with over LEAST_TEXT characters; the first by index if limited."""
    return g.top(chunks.where(F.length("text") > LEAST_TEXT), limit, "index", "id")


def occurrences(chunks: DataFrame, terms: DataFrame, limit: int | None = None) -> DataFrame:
    """chunk_id, label, name, start, stop: every place of a dictionary term (label, name) of any
    number of words in a text."""
    texts = candidate_chunks(chunks, limit).select("id", "text")
    spans = linking.phrase_spans(texts, terms.select("name").distinct())
    return spans.join(terms.select("label", "name").distinct(), "name").select(F.col("id").alias("chunk_id"), "label", "name", "start", "stop")


def dictionary_mentions(chunks: DataFrame, terms: DataFrame, limit: int | None = None, every: bool = False) -> DataFrame:
    """chunk_id, label, name, span: the first place of each dictionary term in a text, or every
    one."""
    rows = occurrences(chunks, terms, limit)
    if not every:
        rows = rows.groupBy("chunk_id", "label", "name").agg(F.min("start").alias("start"), F.min("stop").alias("stop"))
    return rows.select("chunk_id", "label", "name", F.concat_ws("-", F.col("start").cast("string"), F.col("stop").cast("string")).alias("span"))


class DictionaryExtractor:
    """The offline extractor: terms (label, name) found in a chunk, and RELATED_TO from each to the
    next in the order of names.  Where in the text they are is not asked, so texts are not joined
    to what was found in them."""

    def __init__(self, terms: DataFrame) -> None:
        self.terms = g.checkpointed(terms.select("label", "name").distinct())  # read several times a call

    def __call__(self, chunks: DataFrame) -> DataFrame:
        hits = linking.phrase_hits(candidate_chunks(chunks).select("id", "text"), self.terms.select("name"))
        found = hits.join(self.terms, "name").groupBy(F.col("id").alias("chunk_id")).agg(F.array_sort(F.collect_set(F.struct("name", "label"))).alias("found"))
        node = lambda x: F.struct(x["name"].alias("id"), x["label"].alias("label"), F.struct(x["name"].alias("name")).alias("properties"))
        pair = lambda i: F.struct(F.lit("RELATED_TO").alias("type"), F.get("found", i)["name"].alias("source"), F.get("found", i + 1)["name"].alias("target"))
        pairs = F.when(F.size("found") > 1, F.transform(F.sequence(F.lit(0), F.size("found") - 2), pair))
        return found.select("chunk_id", F.to_json(F.struct(F.transform("found", node).alias("nodes"), pairs.alias("relationships"))).alias("json"))


def chunks_with_entities(chunks: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """chunk, index, entities (name, label, definition; distinct, named) of each chunk; chunks
    without one have none.  What a chunk gathers is bounded by its own text."""
    linked = edges.where(F.col("type") == rules.MENTION).select(F.col("src").alias("id"), F.col("dst").alias("chunk"))
    named = linked.join(nodes.where("name is not null").select("id", "name", "label", "definition"), "id")
    found = named.groupBy("chunk").agg(F.array_sort(F.collect_set(F.struct("name", "label", "definition"))).alias("entities"))
    rows = chunks.select(F.col("id").alias("chunk"), "article_id", "index").join(found, "chunk", "left")
    return rows.withColumn("entities", F.coalesce("entities", F.array().cast("array<struct<name:string,label:string,definition:string>>")))


class Gleaned(NamedTuple):
    """What documents_to_graph gives, and a row for each pass: pass, asked, failed, changed."""

    nodes: DataFrame
    edges: DataFrame
    chunks: DataFrame
    status: DataFrame
    passes: list[tuple[int, int, int, int]]


def gleaned(documents: DataFrame, extract: Extractor, config: chunking.Config | None = None, passes: int = 2) -> Gleaned:
    """Split documents (id, text), extract, then glean `passes` times at most.

    A gleaning pass asks only chunks whose entities changed in the pass before, as the others
    would answer the same, and those that failed.  Without any it ends.  A document fails if no
    chunk of it was ever answered; the others go on.

    edges: MENTIONED_IN, FROM_ARTICLE and the extracted ones; status: id, n_chunks, n_failed
    (chunks never answered), status."""
    chunks = g.checkpointed(chunking.chunk(documents, config).select(F.concat_ws("-", "id", "index").alias("chunk_id"), F.col("id").alias("article_id"), "index", "text"))
    asked = chunks.select(F.col("chunk_id").alias("id"), "index", "text")
    nodes = documents.sparkSession.createDataFrame([], "id string, labels array<string>, label string, name string, definition string")
    edges = chunks.select(F.col("chunk_id").alias("src"), F.lit("FROM_ARTICLE").alias("type"), F.col("article_id").alias("dst"))
    unanswered, counts = None, []
    for n in range(1 + passes):
        parsed = g.checkpointed(parse_results(extract(asked)))
        bad = parsed.groupBy("chunk_id").agg(F.bool_and("failed").alias("bad")).where("bad")
        bad = g.checkpointed(bad.select("chunk_id"))
        nodes, more = merged(nodes, edges, parsed)
        more = g.checkpointed(more)
        changed = g.checkpointed(more.where(F.col("type") == rules.MENTION).select(F.col("dst").alias("chunk_id")).distinct())
        unanswered = bad if unanswered is None else g.checkpointed(unanswered.join(bad, "chunk_id", "left_semi"))
        counts.append((n, asked.count(), bad.count(), changed.count()))
        edges = edges.unionByName(more)
        again = changed.unionByName(bad)
        if n == passes or again.isEmpty():
            break
        asked = g.checkpointed(asked.join(again.distinct().withColumnRenamed("chunk_id", "id"), "id", "left_semi"))
        if asked.isEmpty():
            break
    held = chunks.join(unanswered.withColumn("bad", F.lit(True)), "chunk_id", "left").groupBy(F.col("article_id").alias("id")).agg(F.count("*").alias("n_chunks"), F.count_if("bad").alias("n_failed"))
    rows = documents.select(F.col("id").cast("string").alias("id")).join(held, "id", "left").fillna(0, ["n_chunks", "n_failed"])
    status = F.when((F.col("n_chunks") > 0) & (F.col("n_failed") == F.col("n_chunks")), "failed").otherwise("succeeded")
    return Gleaned(nodes, edges, chunks, rows.withColumn("status", status), counts)


def documents_to_graph(documents: DataFrame, extract: Extractor, config: chunking.Config | None = None, passes: int = 2) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(nodes, edges, chunks, status) of gleaned()."""
    return gleaned(documents, extract, config, passes)[:4]


def with_glossary(documents: DataFrame, terms: DataFrame) -> DataFrame:
    """documents (id, text) and the glossary as a pseudo-article `glossary`: a row for each term
    (term, definition), so that no row holds them all."""
    entry = F.concat(F.lit("## "), "term", F.lit("\n\n"), "definition")
    rows = terms.where("term <> ''").select(F.concat(F.lit("glossary/"), F.regexp_replace(F.lower("term"), " ", "_")).alias("id"), F.coalesce(entry, F.concat(F.lit("## "), "term")).alias("text"))
    return documents.select(F.col("id").cast("string").alias("id"), "text").unionByName(rows.dropDuplicates(["id"]))


def augment(nodes: DataFrame, mentions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new nodes, id and added spans of nodes there): names of two characters or more.

    mention_edges() gives the edges of both to their chunks."""
    rows = mentions.where(F.col("label").isin(rules.ENTITY_LABELS) & (F.length("name") >= 2))
    known = nodes.where(F.col("label").isin(rules.ENTITY_LABELS) & F.col("name").isNotNull()).groupBy("name").agg(F.min("id").alias("id"))
    spans = F.array_sort(F.collect_set(F.concat_ws("@", "span", "chunk_id"))).alias("spans")
    there = rows.join(known, "name").groupBy("id").agg(spans)
    new = rows.join(known, "name", "left_anti").groupBy("label", "name").agg(spans)
    return new.select(entity_id(F.col("label"), F.col("name")).alias("id"), "label", "name", text.title_case(F.col("name")).alias("display_name"), F.lit("dictionary").alias("source"), F.col("spans").alias("source_spans")), there


def mention_edges(nodes: DataFrame, mentions: DataFrame) -> DataFrame:
    """src, type, dst from the entities of dictionary mentions, those there or to be created, to
    the chunks."""
    rows = mentions.where(F.col("label").isin(rules.ENTITY_LABELS) & (F.length("name") >= 2))
    known = nodes.where(F.col("label").isin(rules.ENTITY_LABELS) & F.col("name").isNotNull()).groupBy("name").agg(F.min("id").alias("id"))
    src = F.coalesce("id", entity_id(F.col("label"), F.col("name")))
    return rows.join(known, "name", "left").select(src.alias("src"), F.lit(rules.MENTION).alias("type"), F.col("chunk_id").alias("dst")).distinct()
