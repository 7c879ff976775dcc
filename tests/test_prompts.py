"""Prompts and the pool of examples."""

import pytest
from pyspark.sql import functions as F

from kgloom import rules
from kgloom.operators import chunking, extraction, prompts


def test_examples_obey_the_schema(spark):
    for e in prompts.EXAMPLES:
        label = {name: kind for kind, name in e.entities}
        assert set(label.values()) <= set(rules.ENTITY_LABELS)
        assert all((label[a], kind, label[b]) in rules.PATTERNS for a, kind, b in e.relations), e.text
    answers = spark.createDataFrame([(str(i), e.answer) for i, e in enumerate(prompts.EXAMPLES)], "chunk_id string, json string")
    parsed = extraction.parse_results(answers)
    assert not parsed.where("failed").count()
    nodes, edges, _ = extraction.glean(spark.createDataFrame([], "id string, labels array<string>, label string, name string, definition string"), spark.createDataFrame([], "src string, type string, dst string"), answers)
    assert {(r["label"], r["name"]) for r in nodes.collect()} == {x for e in prompts.EXAMPLES for x in e.entities}
    name = nodes.select("id", "name")
    triples = edges.where("type <> 'MENTIONED_IN'").join(name.toDF("src", "a"), "src").join(name.toDF("dst", "b"), "dst").select("a", "type", "b")
    assert {tuple(r) for r in triples.collect()} == {x for e in prompts.EXAMPLES for x in e.relations}


def test_prompts_choose_examples_by_shared_words(spark):
    chunks = spark.createDataFrame([("c1", "The FDA regulates medical devices; ISO 26262 does not."), ("c2", ""), ("c3", None), ("c4", "fda " * 50_000)], "id string, text string")
    rows = {r["chunk_id"]: r for r in prompts.prompts(chunks).collect()}
    assert rows["c1"]["examples"][:2] == [3, 2]
    assert rows["c2"]["examples"] == rows["c3"]["examples"] == [0, 1, 2]  # ties: the first
    assert rows["c4"]["examples"] == [3, 0, 1] and rows["c4"]["prompt"].endswith("fda \nAnswer:\n")
    first = rows["c1"]["prompt"]
    assert first.startswith(prompts.header()) and first.index(prompts.EXAMPLES[3].block) < first.index(prompts.EXAMPLES[2].block) < first.index("Text:\nThe FDA regulates medical devices; ISO")
    bare = prompts.prompts(chunks, [], schema="S").first()["prompt"]
    assert bare == prompts.header("S") + "Text:\nThe FDA regulates medical devices; ISO 26262 does not.\nAnswer:\n"
    with pytest.raises(ValueError):
        prompts.prompts(chunks, prompts.EXAMPLES * 9)


def test_a_prompted_extractor_builds_a_graph(spark):
    """A completion that answers the example its prompt ends with, and nonsense to other texts."""
    def complete(rows):
        known = F.array(*[F.struct(F.lit(f"{e.text}\nAnswer:\n").alias("end"), F.lit(e.answer).alias("json")) for e in prompts.EXAMPLES])
        hit = F.get(F.filter(known, lambda x: F.col("prompt").endswith(x["end"])), 0)["json"]
        return rows.select("chunk_id", F.coalesce(hit, F.lit("I cannot.")).alias("json"))

    documents = spark.createDataFrame([("d1", prompts.EXAMPLES[2].text), ("d2", "Nothing that anyone has seen before.")], "id string, text string")
    nodes, edges, _, status = extraction.documents_to_graph(documents, prompts.PromptedExtractor(complete), chunking.Config(least=10), passes=1)
    assert {r["name"] for r in nodes.collect()} == {"iso 26262", "automotive", "functional safety"}
    assert edges.where("type in ('APPLIES_TO', 'DEFINES')").count() == 2
    assert {r["id"]: r["status"] for r in status.collect()} == {"d1": "succeeded", "d2": "failed"}
