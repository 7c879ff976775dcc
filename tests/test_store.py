"""Versions, resumed runs, small batches, gleaning by changes and entity resolution."""

import os
import random

import pytest
from pyspark.sql import functions as F

from kgloom import cli
from kgloom.model import EDGE, NODE, Graph
from kgloom.operators import chunking, extraction, resolution
from kgloom.plans import pipeline, project, store


@pytest.fixture
def graph(spark):
    empty = lambda schema: spark.createDataFrame([], schema)
    node = lambda i, label, name, definition=None: (i, [label], label, name, None, definition, None, [f"s{i}"])
    nodes = [
        node("a", "Concept", "gear", "short"), node("b", "Tool", " Gear", "the longest text"), node("c", "Tool", "gears"), node("d", "Industry", "aviation"), node("e", "Industry", "aerospace industry"), node("f", "Concept", "Aerospace"),
        node("g", "Concept", None), node("h", "Concept", "alone"), node("i", "Unknown", "gear"), node("j", "Concept", "glass"),
    ]
    edges = [("a", "REQUIRES", "c"), ("b", "REQUIRES", "h"), ("d", "RELATED_TO", "e"), ("f", "RELATED_TO", "h"), ("e", "RELATED_TO", "h")]
    return Graph(spark.createDataFrame(nodes, NODE), spark.createDataFrame(edges, EDGE), empty("id string, article_id string, index int, chunk_id string, text string, embedded boolean"), empty("article_id string"), empty("term_id string"), empty("id string"))


def test_chains_of_links_are_one_entity(graph):
    """Case and padding, another label, a plural under that label; variants over their canonical name."""
    found = {r["id"]: (r["entity"], r["keep"], r["label"], r["n"]) for r in resolution.resolution(graph.nodes).collect()}
    assert found["a"] == found["b"] == found["c"] == ("gear", "b", "Tool", 3)
    assert found["d"] == found["e"] == found["f"] == ("aerospace", "d", "Industry", 3)
    assert found["h"] == ("alone", "h", "Concept", 1) and found["j"] == ("glass", "j", "Concept", 1) and set(found) == set("abcdefhj")
    merged = resolution.resolve(graph)
    rows = {r["id"]: r for r in merged.nodes.collect()}
    assert set(rows) == set("bdghij") and rows["b"]["definition"] == "the longest text" and rows["b"]["source_spans"] == ["sa", "sb", "sc"]
    assert sorted(map(tuple, merged.edges.collect())) == [("b", "REQUIRES", "b"), ("b", "REQUIRES", "h"), ("d", "RELATED_TO", "d"), ("d", "RELATED_TO", "h")]
    assert resolution.resolution(graph.nodes.limit(0)).collect() == []


def test_a_killed_run_goes_on(spark, graph, tmp_path):
    held, calls = store.Store(spark, str(tmp_path / "g")), []

    def stage(name, fails=False):
        def run(x):
            calls.append(name)
            if fails:
                raise RuntimeError("killed")
            return graph if x is None else x.with_(nodes=x.nodes.withColumn("definition", F.lit(name)))

        return name, run

    with pytest.raises(RuntimeError):
        held.run([stage("one"), stage("two"), stage("three", fails=True)])
    # The tables of a stage without its marker do not count.
    graph.nodes.write.parquet(str(tmp_path / "g" / "three" / "nodes"))
    assert held.versions() == ["one", "two"] and held.current() is None
    out = held.run([stage("one"), stage("two"), stage("three")], resume=True)
    assert calls == ["one", "two", "three", "three"] and {r["definition"] for r in out.nodes.collect()} == {"three"}
    with pytest.raises(ValueError):
        held.promote("four")
    with pytest.raises(FileExistsError):
        held.save("one", graph)
    assert not os.path.exists(tmp_path / "g" / "two" / "edges") and os.path.exists(tmp_path / "g" / "two" / "nodes")
    held.promote("two")
    held.promote("three")
    assert held.current() == "three" and held.status() == [("one", True, False), ("three", True, True), ("two", True, False)]
    held.forget(["one"])
    assert held.versions() == ["three", "two"]


def test_pipeline_and_commands(spark, small, tmp_path, capsys, monkeypatch):
    path = str(tmp_path / "built")
    monkeypatch.setattr(cli, "session", lambda: spark)
    graph = project.graph(spark, small)
    checks = pipeline.run(graph, path, full=True)
    assert len({r["check"] for r in checks.collect()}) == 17
    assert store.Store(spark, path).current() == "repaired"
    stamp = os.path.getmtime(os.path.join(path, "clean", "WHOLE.json"))
    assert cli.main(["build", small, "-o", path, "--full", "--resume"]) == 0
    assert os.path.getmtime(os.path.join(path, "clean", "WHOLE.json")) == stamp
    assert cli.main(["promote", path, "clean"]) == 0 and cli.main(["status", path]) == 0
    assert "clean  whole  current" in capsys.readouterr().out
    report = str(tmp_path / "report.md")
    assert cli.main(["validate", path, "-o", report, "--fix-chunk-ids"]) in (0, 2) and "Graph validation report" in open(report).read()


def files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_a_batch_touches_its_partitions_only(spark, tmp_path):
    schema = "id string, name string, definition string, source_spans array<string>"
    rng = random.Random(0)
    rows = [(f"n{i}", f"name {i}", None if i % 3 else f"d{i}", [f"s{i}"]) for i in range(400)]
    batch = [(f"n{i}", "other", f"new {i}", [f"t{i}", f"s{i}"]) for i in (3, 4)] + [("m1", "fresh", None, None)]
    path = str(tmp_path / "nodes")
    store.create(spark.createDataFrame(rng.sample(rows, 400), schema), path, ["id"])
    before = files(path)
    for _ in range(2):  # the same batch again changes nothing
        store.upsert(spark.createDataFrame(batch, schema), path, ["id"], lists=("source_spans",))
        after = files(path)
        gone = {os.path.dirname(f) for f in set(before) - set(after)}
        assert 0 < len(gone) <= 3 and {os.path.dirname(f) for f in set(after) - set(before)} >= gone
        assert len(set(before) & set(after)) >= len(before) - 6
        got = {r["id"]: (r["name"], r["definition"], r["source_spans"]) for r in spark.read.parquet(path).collect()}
        assert len(got) == 401 and got["n3"] == ("name 3", "d3", ["s3", "t3"]) and got["n4"] == ("name 4", "new 4", ["s4", "t4"]) and got["m1"] == ("fresh", None, [])
        assert all(got[i] == (n, d, s) for i, n, d, s in rows if i not in ("n3", "n4"))


def test_gleaning_asks_what_changed(spark):
    text = "alpha meets beta in a long sentence about many things. " * 2
    docs = spark.createDataFrame([("1", text), ("2", text.replace("beta", "gamma")), ("3", text.replace("alpha", "x").replace("beta", "y")), ("4", None)], "id string, text string")
    terms = spark.createDataFrame([("Concept", "alpha"), ("Tool", "beta"), ("Tool", "gamma")], "label string, name string")
    inner, asked = extraction.DictionaryExtractor(terms), []

    def extract(chunks):
        """The second document fails at first and is answered later."""
        asked.append({r["id"] for r in chunks.select("id").collect()})
        bad = F.col("chunk_id").startswith("2-") & F.lit(len(asked) == 1)
        return inner(chunks).withColumn("json", F.when(bad, "no json").otherwise(F.col("json")))

    got = extraction.gleaned(docs, extract, chunking.Config(least=0), passes=5)
    assert [len(a) for a in asked] == [3, 2, 1] and all(x.startswith("2-") for x in asked[2])
    assert got.passes == [(0, 3, 1, 1), (1, 2, 0, 1), (2, 1, 0, 0)]
    assert sorted(r["name"] for r in got.nodes.collect()) == ["alpha", "beta", "gamma"]
    assert {r["id"]: (r["n_chunks"], r["n_failed"], r["status"]) for r in got.status.collect()} == {"1": (1, 0, "succeeded"), "2": (1, 0, "succeeded"), "3": (1, 0, "succeeded"), "4": (0, 0, "succeeded")}


def test_the_glossary_is_a_pseudo_article(spark):
    docs = spark.createDataFrame([("1", "text")], "id string, text string")
    terms = spark.createDataFrame([("Gear Box", "Turns."), ("gear box", "Again."), ("", "x"), ("Bolt", None)], "term string, definition string")
    rows = {r["id"]: r["text"] for r in extraction.with_glossary(docs, terms).collect()}
    assert set(rows) == {"1", "glossary/gear_box", "glossary/bolt"} and rows["glossary/bolt"] == "## Bolt" and rows["glossary/gear_box"].startswith("## ")
