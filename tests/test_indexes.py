"""Phrases, stored indexes, and Leiden over joins."""

import random

import pytest
from pyspark.sql import functions as F

from kgloom.functions import vector
from kgloom.operators import community, extraction, indexes, leiden, linking, nearest, retrieval

WORDS = ["the", "a", "of", "gear", "box", "blue", "bolt", "x", "", "é"]


def brute_places(texts, names):
    out = set()
    for key, text in texts:
        padded = f" {(text or '').lower()} "
        for name in names if text is not None else ():
            at = padded.find(f" {name} ")
            while name is not None and at >= 0:
                out.add((key, name, at, at + len(name)))
                at = padded.find(f" {name} ", at + 1)
    return out


@pytest.mark.parametrize("few", [True, False])
def test_phrases_at_every_place(spark, monkeypatch, few):
    if not few:
        monkeypatch.setattr(linking, "NAME_BYTES", 0)
    rng = random.Random(few)
    texts = [(f"t{i}", " ".join(rng.choice(WORDS) for _ in range(rng.randrange(60))).title() if i % 7 else None) for i in range(90)]
    names = [*{" ".join(rng.choice(WORDS) for _ in range(rng.randrange(1, 6))) for _ in range(120)}, None, "not there", "blue"]
    rows, terms = spark.createDataFrame(texts, "id string, text string"), spark.createDataFrame([(n,) for n in names], "name string")
    got = linking.phrase_spans(rows, terms).collect()
    assert len(got) == len(set(got)) and set(map(tuple, got)) == brute_places(texts, names)
    assert linking.phrase_spans(rows.limit(0), terms).collect() == [] and linking.phrase_spans(rows, terms.limit(0)).collect() == []


def test_a_name_meets_texts_at_its_rarest_word(spark):
    """Names that share a common word cost what their rare words cost."""
    texts = spark.createDataFrame([(i, "the " * 50 + f"rare{i} the end") for i in range(20)], "id long, text string")
    names = spark.createDataFrame([(f"rare{i} the",) for i in range(0, 40, 2)], "name string").withColumn("parts", F.split("name", " "))
    anchors = linking._anchors(texts.select("id", F.explode(F.split("text", " ")).alias("word")), names, True).collect()
    assert {r["word"] for r in anchors} == {f"rare{i}" for i in range(0, 20, 2)}
    assert linking.phrase_hits(texts, names.select("name")).count() == 10


def test_every_mention_of_a_term_becomes_a_span(spark):
    chunks = spark.createDataFrame([("c1", 0, "a gear box and a gear box beside the old gear box of this house")], "id string, index int, text string")
    terms = spark.createDataFrame([("Concept", "gear box"), ("Concept", "absent")], "label string, name string")
    spans = {r["span"] for r in extraction.dictionary_mentions(chunks, terms, every=True).collect()}
    assert spans == {"2-10", "17-25", "41-49"}
    assert [r["span"] for r in extraction.dictionary_mentions(chunks, terms).collect()] == ["2-10"]


def ranked(rows):
    return [(r["id"], round(r["score"], 9)) for r in rows.collect()]


def test_text_index_grows_and_equals_the_scan(spark, medium, tmp_path):
    docs = spark.read.parquet(f"{medium}/documents.parquet").select(F.col("doc_id").alias("id"), "text")
    docs = docs.unionByName(spark.createDataFrame([(-1, None), (-2, "")], "id long, text string"))
    index = indexes.TextIndex(spark, str(tmp_path / "text"))
    index.add(docs.where("id % 3 = 0"), "one")
    index.add(docs, "two")
    for terms in (["blue", "The", "on"], ["xyzzy"]):
        assert ranked(index.search(terms)) == ranked(retrieval.bm25(docs, terms))
    index.add(docs.where("id % 3 <> 0 or id < 0"), "two")  # again: it replaces itself
    assert ranked(index.search(["the"], 20)) == ranked(retrieval.bm25(docs, ["the"], 20))
    plan = index.search(["blue"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan and "In(term" in plan or "EqualTo(term" in plan


def test_text_index_shuffles_no_postings(spark, tmp_path):
    """What an ingest shuffles are texts and a few lists of each, not a row for every term of a text."""
    store, none = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._jvm.java.util.ArrayList()
    quantiles = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0)

    def shuffled():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
        stages = store.stageList(none, False, False, quantiles, none)
        return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))

    texts = [(f"t{i}", " ".join(f"w{i * j % 97}x{j}" for j in range(200)) + " one One ONE") for i in range(60)] + [("none", None), ("empty", ""), ("marks", " .,- ")]
    rows = spark.createDataFrame(texts, "id string, text string")
    before = shuffled()
    index = indexes.TextIndex(spark, str(tmp_path / "few"))
    index.add(rows.unionByName(rows), "first")
    assert shuffled() - before < 60 * 60
    got = {(r["id"], r["term"], r["tf"], r["size"]) for r in index.postings(["one", "w0x0", "w5x5", ""]).collect()}
    assert {x for x in got if x[1] == "one"} == {(f"t{i}", "one", 3, 203) for i in range(60)}
    assert {x for x in got if x[1] == "w5x5"} == {("t1", "w5x5", 1, 203)} and len(got) == 121
    index.add(rows.limit(0), "none")
    index.add(spark.createDataFrame([("t1", "one"), ("new", "one")], "id string, text string"), "second")
    assert index.postings(["one"]).count() == 61
    assert ranked(index.search(["one"], 61)) == ranked(retrieval.bm25(rows.unionByName(spark.createDataFrame([("new", "one")], rows.schema)), ["one"], 61))


def test_vector_index_recall_and_exact_search(spark, medium, tmp_path):
    vectors = spark.read.parquet(f"{medium}/embeddings.parquet").select(F.col("vec_id").alias("id"), "embedding")
    index = indexes.VectorIndex(spark, str(tmp_path / "vectors"))
    index.build(vectors.where("id % 2 = 0").unionByName(spark.createDataFrame([(-1, None)], "id long, embedding array<float>")), "one")
    index.add(vectors, "two")
    index = indexes.VectorIndex(spark, str(tmp_path / "vectors"))
    queries = [(r["id"], r["embedding"]) for r in vectors.where("id % 20 = 0").collect()]
    true = {(r["query_id"], r["id"]) for r in retrieval.vector_topk_many(vectors, queries).collect()}
    whole = index.search(queries, probes=len(index.centroids)).collect()
    assert {(r["query_id"], r["id"]) for r in whole} == true and len(whole) == 5 * len(queries)
    found = {(r["query_id"], r["id"]) for r in index.search(queries).collect()}
    assert len(found & true) >= 0.9 * len(true) and index.probes < len(index.centroids)
    plan = index.search(queries[:1], probes=1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "cell" in plan.split("PartitionFilters")[1][:60]


def planted(n, groups, inside, across, seed):
    rng, out = random.Random(seed), set()
    for i in range(n):
        out |= {(f"n{i:04}", f"n{rng.randrange(n // groups) * groups + i % groups:04}") for _ in range(inside)}
        out |= {(f"n{i:04}", f"n{rng.randrange(n):04}") for _ in range(across)}
    return sorted(out)


def test_leiden_over_joins_is_as_good_as_in_one_task(spark):
    """A large component by joins, small ones in tasks; loops and parallel edges count."""
    large = planted(240, 6, 4, 1, 3)
    edges = [*large, *large[:40], *[(f"{p}{a}", f"{p}{b}") for p in "xyz" for a, b in ((0, 1), (1, 2), (2, 0))]]
    rows = spark.createDataFrame(edges, "source string, target string").repartition(3)
    here = community.communities(rows)
    apart = leiden.g.checkpointed(community.communities(rows, one_task=300))
    value = lambda p: community.modularity(rows, p).first()[0]
    assert value(apart) > value(here) - 0.01
    home = {r["node"]: r["community"] for r in apart.collect()}
    assert set(home) == {x for e in edges for x in e} and home["x2"] == home["x0"] == "x0" != home["y0"]
    groups, near = {}, {}
    for n, c in home.items():
        groups.setdefault(c, set()).add(n)
    for a, b in edges:
        if home[a] == home[b]:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    for name, group in groups.items():
        seen, todo = set(), [name]
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                todo += near.get(x, ())
        assert seen == group and name == min(group)


def test_a_table_of_queries_stays_off_the_driver(spark, medium, tmp_path, monkeypatch):
    """queries as a table, in many small groups, with ties and a cell larger than a block;
    the driver gets neither a query nor a row for a pair of query and cell."""
    monkeypatch.setattr(nearest, "BLOCK_ROWS", 100)
    monkeypatch.setattr(nearest, "BLOCK_QUERIES", 7)
    vectors = spark.read.parquet(f"{medium}/embeddings.parquet").select(F.col("vec_id").alias("id"), "embedding")
    one = vectors.where("id = 0").select("embedding").first()[0]
    copies = spark.createDataFrame([(10_000 + i, one) for i in range(250)], "id long, embedding array<float>")
    vectors = leiden.g.checkpointed(vectors.unionByName(copies))
    index = indexes.VectorIndex(spark, str(tmp_path / "vectors"))
    index.build(vectors, "one")
    queries = vectors.where("id % 20 = 0 and id < 10100").select(F.col("id").alias("query_id"), F.col("embedding").alias("q"))
    scored = vectors.crossJoin(queries).select("query_id", "id", vector.score(F.col("embedding"), F.col("q").cast("array<double>")).alias("score"))
    true = set(map(tuple, leiden.g.first_k(scored, ["query_id"], 5, F.desc("score"), "id").collect()))
    assert set(map(tuple, retrieval.vector_topk_many(vectors, queries).collect())) == true
    assert set(map(tuple, index.search(queries, probes=len(index.centroids)).collect())) == true
    found = {r[:2] for r in map(tuple, index.search(queries).collect())}
    assert len(found & {r[:2] for r in true}) >= 0.9 * len(true)
    assert [p[1:] for p in indexes._packed([(0, 60), (1, 60), (2, 250), (3, 30)])] == [(0, 1), (1, 1), (2, 3), (5, 1)]
