"""All check counts from one reading of each table of a graph.

Two stored tables carry what the checks need: `points`, a row for each node and chunk, and
`incidence`, a row for each point that has edges, besides one for each mention and each type that
is not listed.  Which labels reach a point by which listed type is a set of bits, so an edge moves
twice only, to its source's label and, as bits that are united before the shuffle, to its target;
no group has more than a row for each task.  Edges that come more than once count once.  Nodes,
edges, chunks and webinars are read once each; the counts are aggregates over the stored tables.
Ids of nodes and chunks are taken as unique.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions import text
from ..model import Graph, is_entity
from . import checks
from . import graphops as g


#: Types that have a bit for each label of the source, in words of BITS bits.
LISTED = [*rules.RELATIONSHIPS, rules.MENTION]
BITS = 60
WORDS = [f"word_{i}" for i in range(-(-len(rules.ENTITY_LABELS) * len(LISTED) // BITS))]


@dataclass(frozen=True)
class Census:
    """points: id, label, name, undefined, is_chunk, size, no_article, not_embedded, no_chunk_id,
    no_index (null where a column is of the other kind).
    incidence: id, unlisted (null: all listed types; else = and the type, empty if that is null),
    source (of a mention that ends here), others (has an edge that is no mention), mentioned,
    word_0 and so on: bit label * types + type, or of an unlisted type bit label, is set if an
    entity with the label has such an edge to id."""

    points: DataFrame
    incidence: DataFrame


def points(graph: Graph) -> DataFrame:
    undefined = F.coalesce("definition", F.lit("")) == ""
    nodes = graph.nodes.select("id", "label", "name", undefined.alias("undefined"), F.lit(False).alias("is_chunk"))
    size = F.col("size") if "size" in graph.chunks.columns else F.length("text")
    chunks = graph.chunks.select(
        "id", F.lit(True).alias("is_chunk"), size.alias("size"), F.isnull("article_id").alias("no_article"), (~F.col("embedded")).alias("not_embedded"),
        F.isnull("chunk_id").alias("no_chunk_id"), F.isnull("index").alias("no_index"),
    )
    return nodes.unionByName(chunks, allowMissingColumns=True)


def _place(values: list[str], column: str) -> Column:
    """From 0; null if it is none of the values."""
    at = F.array_position(F.array(*[F.lit(v) for v in values]), F.col(column))
    return F.when(at > 0, at.cast("int") - 1)


def ends(edges: DataFrame) -> DataFrame:
    """id, unlisted, source, others, mentioned, slot: every edge seen from both ends out of one
    scan.  slot is the bit of an incoming edge whose src has the place `at` among the labels."""
    at = F.col("at") if "at" in edges.columns else F.lit(None).cast("int")
    kind, mention = _place(LISTED, "type"), F.coalesce(F.col("type") == rules.MENTION, F.lit(False))
    edges = edges.select("src", "dst", "type", kind.alias("kind"), mention.alias("mention"), F.coalesce(F.col("type") != rules.MENTION, F.lit(False)).alias("others"), at.alias("at"))
    unlisted = F.when(F.isnull("kind"), F.coalesce(F.concat(F.lit("="), "type"), F.lit("")))
    slot = F.when(F.isnull("kind"), F.col("at")).otherwise(F.col("at") * len(LISTED) + F.col("kind"))
    text_, number = F.lit(None).cast("string"), F.lit(None).cast("int")
    end = lambda point, unlisted, source, mentioned, slot: F.struct(F.col(point).alias("id"), unlisted.alias("unlisted"), source.alias("source"), "others", mentioned.alias("mentioned"), slot.alias("slot"))
    return edges.select(F.inline(F.array(end("src", text_, text_, F.lit(False), number), end("dst", unlisted, F.when(F.col("mention"), F.col("src")), F.col("mention"), slot))))


def census(graph: Graph) -> Census:
    """The stored tables of a graph (an action: it writes both to the shared folder)."""
    all_points = g.checkpointed(points(graph))
    labels = all_points.where(is_entity()).select(F.col("id").alias("src"), _place(rules.ENTITY_LABELS, "label").alias("at"))
    rows = ends(graph.edges.join(labels.hint("shuffle_hash"), "src", "left"))  # a task's labels are few, its edges need no sort
    words = [F.bit_or(F.when(F.floor(F.col("slot") / BITS) == i, F.expr(f"shiftleft(1L, slot % {BITS})"))).alias(w) for i, w in enumerate(WORDS)]
    found = rows.groupBy("id", "unlisted", "source").agg(F.max("others").alias("others"), F.max("mentioned").alias("mentioned"), *words)
    return Census(all_points, g.checkpointed(found))


def facts(c: Census) -> DataFrame:
    """points with linked (has edges), others (has one that is no mention), mentioned (is the end of
    a mention) and mentions (how many chunks it is mentioned in)."""
    chunks = c.points.where("is_chunk").select("id")
    into = c.incidence.where("source is not null").join(chunks, "id", "left_semi").select(F.col("source").alias("id"), F.lit(False).alias("others"), F.lit(False).alias("mentioned"), F.lit(1).alias("mentions"))
    rows = c.incidence.select("id", "others", "mentioned", F.lit(0).alias("mentions")).unionByName(into)
    per = rows.groupBy("id").agg(F.lit(True).alias("linked"), F.max("others").alias("others"), F.max("mentioned").alias("mentioned"), F.sum("mentions").alias("mentions"))
    return c.points.join(per, "id", "left").fillna(False, ["linked", "others", "mentioned"]).fillna(0, ["mentions"])


def _listed(row: DataFrame, names: list[str]) -> DataFrame:
    """check, value out of a row with a column for each check."""
    return row.select(F.inline(F.array(*[F.struct(F.lit(n).alias("check"), F.coalesce(F.col(n), F.lit(0)).cast("long").alias("value")) for n in names])))


def _of_points(c: Census) -> DataFrame:
    entity, chunk = is_entity(), F.col("is_chunk")
    counts: dict[str, Column] = {
        "orphan_chunks": F.count_if(chunk & F.col("no_article")),
        "missing_embeddings": F.count_if(chunk & F.col("not_embedded")),
        "missing_chunk_ids": F.count_if(chunk & F.col("no_chunk_id")),
        "missing_chunk_index": F.count_if(chunk & F.col("no_index")),
        "degenerate_chunks": F.count_if(chunk & (F.col("size") < rules.MIN_CHUNK) & ~F.col("mentioned")),
        "industries": F.count_if(F.col("label") == "Industry"),
        "orphan_entities": F.count_if(entity & ~F.col("linked")),
        "unmentioned_entities": F.count_if(entity & (F.col("mentions") == 0)),
        "ghost_entities": F.sum(F.when(entity & ~F.col("others"), F.col("mentions"))),
        "mislabeled_challenges": F.count_if((F.col("label") == "Challenge") & F.col("name").isNotNull() & text.positive_any_word(F.col("name"))),
        "generic_entities": F.count_if(entity & F.lower("name").isin(rules.GENERIC_CHECK_TERMS)),
        "missing_definitions": F.size(F.collect_set(F.when(entity & F.col("undefined"), F.col("label")))),  # of twelve labels
    }
    return _listed(facts(c).agg(*[v.alias(k) for k, v in counts.items()]), list(counts))


def _of_names(c: Census) -> DataFrame:
    """Duplicates and plural pairs by one grouping: each name stands under itself and, as a
    singular, under its plural."""
    names = c.points.where(is_entity()).groupBy("label", "name").agg(F.count("*").alias("n"))
    role = lambda key, n, singular: F.struct(key.alias("key"), n.alias("n"), F.lit(singular).alias("singular"))
    plural = F.when(~F.col("name").endswith("s"), role(F.concat("name", F.lit("s")), F.lit(0).cast("long"), 1))
    rows = names.select("label", F.inline(F.array_compact(F.array(role(F.col("name"), F.col("n"), 0), plural))))
    keys = rows.groupBy("label", "key").agg(F.sum("n").alias("n"), F.max("singular").alias("singular"))
    return _listed(keys.agg(F.count_if(F.col("n") > 1).alias("duplicate_entities"), F.sum(F.when(F.col("singular") == 1, F.col("n"))).alias("plural_pairs")), ["duplicate_entities", "plural_pairs"])


def _of_patterns(c: Census) -> DataFrame:
    allowed = rules.pattern_table(c.points.sparkSession)  # 55 rows
    targets = c.points.where(is_entity()).select("id", F.col("label").alias("target_label"))
    some = F.coalesce(*WORDS).isNotNull()
    sets = c.incidence.where(some).join(targets, "id").groupBy("target_label", "unlisted").agg(*[F.bit_or(w).alias(w) for w in WORDS])  # labels times unlisted types
    slots = sets.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(BITS * len(WORDS) - 1))))
    word = F.get(F.array(*WORDS), F.floor(F.col("slot") / BITS).cast("int"))
    rows = slots.withColumn("word", word).where(f"(shiftright(word, slot % {BITS}) & 1L) = 1")
    named = lambda values, at: F.get(F.array(*[F.lit(v) for v in values]), at.cast("int"))
    listed, slot = F.isnull("unlisted"), F.col("slot")
    source_label = named(rules.ENTITY_LABELS, F.when(listed, F.floor(slot / len(LISTED))).otherwise(slot))
    type_ = F.when(listed, named(LISTED, slot % len(LISTED))).when(F.col("unlisted") != "", F.expr("substring(unlisted, 2)"))
    rows = rows.select(source_label.alias("source_label"), type_.alias("type"), "target_label")
    return rows.join(F.broadcast(allowed), ["source_label", "type", "target_label"], "left_anti").agg(F.count("*").alias("value")).select(F.lit("invalid_patterns").alias("check"), "value")


def counts(graph: Graph, c: Census | None = None) -> DataFrame:
    """check, value of every check of checks.summary(), all defects counted."""
    c = c or census(graph)
    count = lambda name, rows: rows.agg(F.count("*").alias("value")).select(F.lit(name).alias("check"), "value")
    parts = [
        _of_points(c), _of_names(c), _of_patterns(c),
        checks.near_duplicate_count(graph.with_(nodes=c.points)).select(F.lit("near_duplicates").alias("check"), "value"),
        count("truncated_titles", checks.truncated_titles(graph, None)),
    ]
    return reduce(DataFrame.unionByName, parts)


def summary(graph: Graph, limited: bool = False) -> DataFrame:
    """check, value, ok, required, as checks.summary(); if `limited`, counts stop at what a report
    lists, though all rows are read."""
    found = counts(graph)
    if limited:
        most = F.create_map(*[F.lit(x) for pair in checks.LIMITS.items() for x in pair])
        found = found.withColumn("value", F.least("value", most[F.col("check")].cast("long")))  # null: no limit
    return checks.judged(found)


def samples(graph: Graph, cap: int = 11) -> DataFrame:
    """check, row (values as text): at most `cap` of what each check lists, in one plan."""
    def some(name: str, rows: DataFrame) -> DataFrame:
        return rows.limit(cap).select(F.lit(name).alias("check"), F.array(*[F.col(f"`{n}`").cast("string") for n in rows.columns]).alias("row"))

    return reduce(DataFrame.unionByName, [some(name, check(graph)) for name, check in checks.COUNTED.items()])
