"""Backfill of mentions and applications, and glossary links."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from .. import rules
from ..functions import fuzzy
from ..model import Graph
from . import graphops as g

LEAST_NAME = 4
GLOSSARY_AT = 85.0
NAME_BYTES = 1 << 24
SLOTS = 1 << 20


def _anchors(words: DataFrame, names: DataFrame, small: bool) -> DataFrame:
    """name, parts, j, word: each name with its rarest word in the texts and that word's place in
    it; a name with a word that no text has is left out."""
    parts = names.select("name", "parts", F.posexplode("parts").alias("j", "word"))
    distinct = parts.select("word").distinct()
    counts = words.join(F.broadcast(distinct) if small else distinct, "word", "left_semi").groupBy("word").agg(F.count("*").alias("n"))
    rarest = parts.join(counts, "word", "left").groupBy("name", "parts").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "j", "word")).alias("a"))
    return rarest.where("a.n > 0").select("name", "parts", "a.j", "a.word")


def phrase_hits(texts: DataFrame, names: DataFrame) -> DataFrame:
    """id, name, pos: every place of a name between spaces in a text, as the number of the word at
    which it begins.

    ' name ' occurs in ' text ' just when the name's words, split at single spaces, follow one
    another in the text's.  A name meets the texts only at its rarest word, found by a count over
    the texts if any name has several; the words around that one tell whether the phrase is there.
    So a common word costs nothing where a name has a rarer one.  Names under NAME_BYTES are
    broadcast and look into the text's words where they meet one; else a bitmap of the rarest words'
    hashes (SLOTS bits at most, whatever the number of names) goes to the scan, and only words that
    pass it are shuffled, with the words around them."""
    names = names.where("name is not null").select("name", F.split("name", " ").alias("parts")).distinct()
    known = names.agg(F.sum(2 * F.length("name") + 60), F.max(F.size("parts"))).first()
    small, reach = (known[0] or 0) <= NAME_BYTES, (known[1] or 1) - 1
    split = F.split(F.lower(F.col("text")), " ")
    if reach:
        anchors = _anchors(texts.select("id", F.explode(split).alias("word")), names, small)
    else:
        anchors = names.select("name", "parts", F.lit(0).alias("j"), F.get("parts", 0).alias("word"))
    # Outer, else a filter on the size of the array splits every text once more; a null meets no name.
    tokens = texts.select("id", split.alias("near")).select("id", "near", F.posexplode_outer("near").alias("at", "word"))
    begins, first = F.col("at") - F.col("j"), F.lit(0)
    if small:
        anchors = F.broadcast(anchors)
    else:
        slot = lambda c: F.pmod(F.xxhash64(c), F.lit(SLOTS))
        tokens = tokens.withColumn("slot", slot("word")).join(F.broadcast(anchors.select(slot("word").alias("slot")).distinct()), "slot", "left_semi").drop("slot")
        first = F.greatest(F.col("at") - reach, F.lit(0))
        tokens = tokens.withColumn("near", F.slice("near", first + 1, F.lit(2 * reach + 1)))
    there = (begins >= 0) & (F.slice("near", begins - first + 1, F.size("parts")) == F.col("parts"))
    return tokens.join(anchors, "word").where(there).select("id", "name", begins.alias("pos"))


@F.pandas_udf(ArrayType(IntegerType()))
def _starts(text: pd.Series, places: pd.Series) -> pd.Series:
    def one(t: str, at: np.ndarray) -> np.ndarray:
        sizes = np.array([len(w) + 1 for w in t.split(" ")], np.int32)
        return (np.cumsum(sizes) - sizes)[at]

    return pd.Series([one(t, p) for t, p in zip(text, places, strict=True)])


def phrase_spans(texts: DataFrame, names: DataFrame) -> DataFrame:
    """id, name, start, stop: every place of a name in a text, as characters of the lower-cased
    text; places may overlap.  What one text gathers is bounded by its own words."""
    hits = phrase_hits(texts, names)
    places = hits.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("pos", "name"))).alias("found"))
    rows = texts.select("id", "text").join(places, "id")
    rows = rows.withColumn("starts", _starts(F.lower("text"), F.col("found.pos")))
    rows = rows.select("id", F.inline(F.arrays_zip(F.col("found.name").alias("name"), F.col("starts").alias("start"))))
    return rows.select("id", "name", "start", (F.col("start") + F.length("name")).alias("stop"))


def word_grams(texts: DataFrame, names: DataFrame) -> DataFrame:
    """id, name: every text that holds a name between spaces."""
    return phrase_hits(texts, names).select("id", "name").distinct()


def mention_backfill(graph: Graph, labels: tuple[str, ...] = ("Standard", "Industry")) -> DataFrame:
    """New (src, type, dst) mentions of named entities in chunk texts."""
    found = graph.nodes.where(F.col("label").isin(*labels) & (F.length("name") >= LEAST_NAME)).select(F.col("id").alias("src"), F.lower("name").alias("name"))
    texts = graph.chunks.where("text is not null").select("id", "text")
    hits = word_grams(texts, found.select("name").distinct()).join(found, "name")
    new = hits.select("src", F.lit(rules.MENTION).alias("type"), F.col("id").alias("dst")).distinct()
    return new.join(graph.edges, ["src", "type", "dst"], "left_anti")


def applies_to_backfill(nodes: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """standard_id, industry, industry_id (null: to be created) from the standards table, or
    another small one of name and industry."""
    known = known if known is not None else nodes.sparkSession.createDataFrame(rules.STANDARD_INDUSTRIES, "name string, industry string")
    standards = nodes.where("label = 'Standard'").select(F.col("id").alias("standard_id"), "name").join(known, "name")
    there = nodes.where("label = 'Industry'").groupBy(F.col("name").alias("industry")).agg(F.min("id").alias("industry_id"))
    return standards.join(there, "industry", "left").select("standard_id", "industry", "industry_id")


def backfill(graph: Graph, known: DataFrame | None = None) -> tuple[Graph, DataFrame]:
    """(graph with both kinds of edges, kind and n of what was found).  Industries that a known
    standard needs and that are not there are created."""
    mentions = mention_backfill(graph)
    found = applies_to_backfill(graph.nodes, known)
    made = found.withColumn("dst", F.coalesce("industry_id", F.concat(F.lit("industry-"), "industry")))
    new = made.where("industry_id is null").select(F.col("dst").alias("id"), F.array(F.lit("__Entity__"), F.lit("__KGBuilder__"), F.lit("Industry")).alias("labels"), F.lit("Industry").alias("label"), F.col("industry").alias("name"))
    edges = g.upsert_edges(graph.edges, mentions.unionByName(made.select(F.col("standard_id").alias("src"), F.lit("APPLIES_TO").alias("type"), "dst")))
    counts = mentions.agg(F.lit("mentions").alias("kind"), F.count("*").alias("n")).unionByName(found.agg(F.lit("applies_to").alias("kind"), F.count("*").alias("n")))
    return graph.with_(nodes=g.upsert_nodes(graph.nodes, new), edges=edges), counts


def concepts(nodes: DataFrame, label: str = "Concept") -> DataFrame:
    """key, concept_id, ord: names of a label; of equal names the last id."""
    rows = nodes.where((F.col("label") == label) & F.col("name").isNotNull()).groupBy(F.lower("name").alias("key")).agg(F.max("id").alias("concept_id"))
    return rows


def glossary_links(graph: Graph, threshold: float = GLOSSARY_AT) -> DataFrame:
    """term_id, term, name, score, how: exact first, the rest by fuzzy ratio."""
    terms = graph.definitions.select("term_id", "term", F.lower("term").alias("key"))
    names = concepts(graph.nodes).select("key")
    exact = terms.join(names, "key").select("term_id", "term", F.col("key").alias("name"), F.lit(100.0).alias("score"), F.lit("exact").alias("how"))
    rest = terms.join(names, "key", "left_anti")
    pairs = near_names(rest.select(F.col("key").alias("term")).distinct(), names, threshold)
    best = g.first_of(pairs, ["term"], F.desc("score"), "name")
    near = rest.join(best.withColumnRenamed("term", "key"), "key").select("term_id", "term", "name", "score", F.lit("fuzzy").alias("how"))
    return exact.unionByName(near)


def grams(name: Column) -> Column:
    """The pairs of neighbouring characters, in order."""
    last = F.length(name) - 1
    return F.when(last > 0, F.transform(F.sequence(F.lit(1), last), lambda i: F.substr(name, i, F.lit(2)))).otherwise(F.array().cast("array<string>"))


def near_names(terms: DataFrame, names: DataFrame, threshold: float) -> DataFrame:
    """term, name, score of pairs that reach the threshold, without loss.

    For each length a partner can have, a common subsequence must have so many characters that at
    least `need` grams of the term are grams of the partner: a gram is lost only by a character
    left out of the term (two at most) or put between (one).  So of any all but need - 1 of its
    grams a partner holds one, and the rarest are taken: the join is on (gram, length).  Terms
    with no such gram (one character, or a low threshold) are joined on the length alone."""
    n, size = F.length("term"), F.col("size")
    low, high = (F.ceil(n * threshold / (200 - threshold) - 1e-9), F.floor(n * (200 - threshold) / threshold + 1e-9))
    left = terms.where(n > 0).select("term", F.explode(F.sequence(low.cast("int"), F.greatest(low, high).cast("int"))).alias("size"))
    common = F.ceil(threshold * (n + size) / 200 - 1e-9).cast("int")
    left = left.withColumn("need", n - 1 - 2 * (n - common) - (size - common))
    right = names.select(F.col("key").alias("name"), F.length("key").alias("size"))
    held = right.select("name", "size", F.explode(F.array_distinct(grams(F.col("name")))).alias("gram"))
    often = held.groupBy("gram").agg(F.count("*").alias("n"))
    mine = terms.select("term", F.explode(grams(F.col("term"))).alias("gram")).join(often, "gram", "left")
    rarest = mine.groupBy("term").agg(F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram"))).alias("grams"))
    tried = left.where("need > 0").join(rarest, "term").select("term", "size", F.explode(F.array_distinct(F.slice("grams", F.lit(1), n - F.col("need")))["gram"]).alias("gram"))
    pairs = tried.join(held, ["gram", "size"]).select("term", "name").distinct()
    pairs = pairs.unionByName(left.where("need <= 0").join(right, "size").select("term", "name"))
    return pairs.withColumn("score", fuzzy.ratio(F.col("term"), F.col("name"))).where(F.col("score") >= threshold)


def glossary_top(graph: Graph, threshold: float = GLOSSARY_AT, k: int = 3) -> DataFrame:
    """term, matches: the exact name alone, else the best k that reach the threshold."""
    terms = graph.definitions.select(F.lower("term").alias("term")).distinct()
    names = concepts(graph.nodes).select("key")
    exact = terms.join(names, F.col("term") == F.col("key")).select("term", F.array("key").alias("matches"))
    rest = terms.join(names, F.col("term") == F.col("key"), "left_anti")
    pairs = near_names(rest, names, threshold)
    first = g.first_k(pairs, ["term"], k, F.desc("score"), "name")
    ranked = first.groupBy("term").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("name")))).alias("m"))
    near = rest.join(ranked, "term", "left").select("term", F.coalesce(F.transform("m", lambda m: m["name"]), F.array().cast("array<string>")).alias("matches"))
    return exact.unionByName(near)
