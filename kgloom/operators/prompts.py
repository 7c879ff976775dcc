"""Prompts for an extracting model: instructions, the schema, examples fit for a text, the text.

The pool of examples is a table that is small by contract (POOL at most), so it stands in the
plan as literals; a prompt is then an expression over the row of its chunk and nothing is
shuffled.  Each example carries the answer that is expected for it, in the form extraction reads
(extraction.parse_results), so the pool tests an extractor as well.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules

POOL = 64  # examples at most
Triple = tuple[str, str, str]


class Example(NamedTuple):
    """A text, its entities as (label, name) and its relations as (name, type, name)."""

    text: str
    entities: list[tuple[str, str]]
    relations: list[Triple]

    @property
    def answer(self) -> str:
        nodes = [{"id": name, "label": label, "properties": {"name": name}} for label, name in self.entities]
        ends = [{"type": kind, "start_node_id": a, "end_node_id": b, "properties": {}} for a, kind, b in self.relations]
        return json.dumps({"nodes": nodes, "relationships": ends}, sort_keys=True)

    @property
    def block(self) -> str:
        return f"Text:\n{self.text}\nAnswer:\n{self.answer}\n\n"


EXAMPLES = [
    Example("With a trace matrix, teams no longer miss requirements when a supplier changes a part.", [("Artifact", "trace matrix"), ("Challenge", "missed requirements"), ("Concept", "change control")], [("change control", "REQUIRES", "trace matrix"), ("change control", "ADDRESSES", "missed requirements")]),
    Example("A systems engineer writes the interface specification before design starts.", [("Role", "systems engineer"), ("Artifact", "interface specification"), ("Processstage", "design")], [("systems engineer", "PRODUCES", "interface specification"), ("interface specification", "PREREQUISITE_FOR", "design")]),
    Example("ISO 26262 applies to the automotive industry and defines functional safety.", [("Standard", "iso 26262"), ("Industry", "automotive"), ("Concept", "functional safety")], [("iso 26262", "APPLIES_TO", "automotive"), ("iso 26262", "DEFINES", "functional safety")]),
    Example("The FDA regulates makers of medical devices.", [("Organization", "fda"), ("Industry", "medical devices")], [("fda", "REGULATES", "medical devices")]),
    Example("Some teams choose agile, others the V-model; verification is a stage of the latter.", [("Methodology", "agile"), ("Methodology", "v-model"), ("Processstage", "verification")], [("agile", "ALTERNATIVE_TO", "v-model"), ("verification", "COMPONENT_OF", "v-model")]),
    Example("Reviewing early with all stakeholders shortens the time to market.", [("Bestpractice", "early review"), ("Outcome", "shorter time to market")], [("early review", "ACHIEVES", "shorter time to market")]),
    Example("A test manager works in the tracking tool, which must support baselines.", [("Role", "test manager"), ("Tool", "tracking tool"), ("Concept", "baseline")], [("test manager", "USED_BY", "tracking tool"), ("tracking tool", "REQUIRES", "baseline")]),
    Example("Good morning, and welcome to the third part of our guide.", [], []),
]


def schema_lines() -> str:
    """The labels and the allowed patterns, a line each."""
    return "\n".join([f"Labels: {', '.join(rules.ENTITY_LABELS)}", *[f"{a} -{kind}-> {b}" for a, kind, b in rules.PATTERNS]])


def header(schema: str | None = None) -> str:
    return (
        "Find the entities and relations that the last text states, for a knowledge graph on requirements management.\n"
        "Give one JSON object with the lists nodes and relationships, as in the examples, and nothing else.\n"
        "Use singular lower-case names. Use only these labels and relations, in the direction shown:\n"
        f"{schema_lines() if schema is None else schema}\n\n"
    )


def words(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != ""))


def word_set(text: str) -> list[str]:
    return sorted({w for w in re.split("[^a-z0-9]+", text.lower()) if w})


def prompts(chunks: DataFrame, examples: list[Example] | None = None, k: int = 3, schema: str | None = None) -> DataFrame:
    """chunk_id, examples (their places in the pool, best first), prompt for chunks (id, text).

    The k examples that share most distinct words with the text, of equal ones the first; an
    empty pool or k of 0 gives prompts without any.  A null text counts as empty."""
    pool = EXAMPLES if examples is None else examples
    if len(pool) > POOL:
        raise ValueError(f"a pool has {POOL} examples at most")
    text = F.coalesce("text", F.lit(""))
    found = words(text)
    ranked = [F.struct((-F.size(F.array_intersect(found, F.array(*map(F.lit, word_set(e.text))).cast("array<string>")))).alias("shared"), F.lit(i).alias("place")) for i, e in enumerate(pool)]
    best = F.transform(F.slice(F.array_sort(F.array(*ranked)), 1, k), lambda x: x["place"]) if ranked and k else F.array().cast("array<int>")
    blocks = F.array(*[F.lit(e.block) for e in pool]).cast("array<string>")
    rows = chunks.select(F.col("id").alias("chunk_id"), best.alias("examples"), text.alias("text"))
    prompt = F.concat(F.lit(header(schema)), F.array_join(F.transform("examples", lambda i: F.get(blocks, i)), ""), F.lit("Text:\n"), "text", F.lit("\nAnswer:\n"))
    return rows.select("chunk_id", "examples", prompt.alias("prompt"))


class PromptedExtractor:
    """An extractor (extraction.Extractor) out of a completion: a function from chunk_id, prompt to
    chunk_id, json.  Retries belong inside it; what is no JSON object counts as failed later."""

    def __init__(self, complete: Callable[[DataFrame], DataFrame], examples: list[Example] | None = None, k: int = 3) -> None:
        self.complete, self.examples, self.k = complete, examples, k

    def __call__(self, chunks: DataFrame) -> DataFrame:
        return self.complete(prompts(chunks, self.examples, self.k).select("chunk_id", "prompt"))
