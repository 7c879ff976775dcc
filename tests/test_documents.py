"""Pages, Markdown and chunks."""

import re

import numpy as np
import pytest

from kgloom import cli
from kgloom.operators import chunking
from kgloom.sources import articles, markdown, pages, sinks
from kgloom.streaming import ingest

SITE = articles.Site("guide.example", (" | Brand",), "/guide/")
PAGE = """<html><head><title>Ignored | Brand</title><meta property="og:image" content="https://x/i.png"></head><body>
<div class="flex_cell_inner">menu</div>
<div class="flex_cell_inner"><h1>Requirements Basics</h1><script>x</script>
<h2>What <b>Traceability</b> is</h2><p>Traceability is a link. See <a href="/guide/ch1/art2">part two</a> and <a href="https://other.example/p">other</a>.</p>
<ul><li>one</li><li>two</li></ul><figure><img src="a.png" alt="A"><figcaption>Fig</figcaption></figure>
<table><tr><th>H</th></tr><tr><td>c</td></tr></table><iframe src="https://www.youtube.com/embed/abc123"></iframe>
<div style="display: none">hidden</div><p>Book a demo now</p>
<section><h3>Get started</h3><a href="/trial/">Go</a></section></div></body></html>"""
MENU = """<div id="chapter-menu"><ul><li class="expand"><strong>1.</strong>First&nbsp;chapter<ul><li><a href="/c1"><span class="border"></span>Overview</a></li><li><a href="/c1/a1"><span class="border">1.1</span>Start</a></li></ul></li>
<li class="expand"><strong>X</strong>Bad</li><li class="expand glossary"><strong>9.</strong>Terms</li></ul></div>"""


def test_article():
    out = articles.article(PAGE, "https://guide.example/guide/ch1/art1", SITE)
    assert out["title"] == "Requirements Basics"
    text = out["markdown_content"]
    assert "## What **Traceability** is" in text and "- one\n- two" in text and "| H |" in text
    assert "hidden" not in text and "demo" not in text.lower() and "Get started" not in text
    assert [(r["is_internal"], r["section_id"]) for r in out["cross_references"]] == [(True, "ch1/art2"), (False, None)]
    assert out["images"][0]["src"] == "https://guide.example/guide/ch1/a.png" and out["images"][0]["caption"] == "Fig"
    assert [v["video_id"] for v in out["videos"]] == ["abc123"]
    assert "Traceability" in out["key_concepts"] and out["key_concepts"] == sorted(out["key_concepts"])
    assert out["sections"][0]["heading"].startswith("What")


def test_article_without_content():
    assert articles.article(None, "", SITE)["title"] == "Untitled"
    assert articles.article("<title>T | Brand</title>", "", SITE)["title"] == "T"


def test_contents():
    got = articles.contents(MENU)
    assert [(r["chapter_number"], r["article_number"], r["title"], r["chapter_title"]) for r in got] == [(1, 0, "Overview", "First chapter"), (1, 1, "Start", "First chapter")]
    with pytest.raises(ValueError):
        articles.contents("<p>none</p>")


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<body><table><tr><th>Term</th><th>Acronym</th><th>Definition</th></tr><tr><td>A</td><td>B</td><td>C</td></tr></table></body>", [("A", "C", "B")]),
        ("<body><dl><dt>A</dt><dd>C</dd><dt>D</dt><dd>E</dd></dl></body>", [("A", "C", None), ("D", "E", None)]),
        ("<body><h3>A</h3><p>C</p></body>", [("A", "C", None)]),
        ("<body><p><strong>A:</strong> C</p></body>", [("A", "C", None)]),
        ("<body></body>", []),
    ],
)
def test_glossary(page, want):
    assert [(t["term"], t["definition"], t["acronym"]) for t in articles.glossary(page)] == want


def test_og_image():
    from kgloom.sources.dom import parse

    assert articles.og_image(parse(PAGE)) == "https://x/i.png"
    assert articles.og_image(parse('<meta property="og:image" content=" ">')) is None and articles.og_image(parse("")) is None


def test_promotional_lines():
    text = "# A\nkeep\n## Ready to Find Out More?\ngone\n## Demo\ngone\n## B\nkept\nSchedule a demo"
    assert markdown.without_promotion(text, articles.PROMO_TEXT) == "# A\nkeep\n## B\nkept"


def test_visible_text():
    assert pages.preprocess("<nav>x</nav><main><p>a\n b</p><script>s</script></main>") == "a b"


@pytest.mark.parametrize("config", [chunking.Config(), chunking.RETRIEVAL, chunking.EXTRACTION])
def test_recursive_split_invariants(config):
    text = "\n\n".join(" ".join(f"word{i}-{j}." for j in range(80)) for i in range(9))
    out = chunking.recursive_split(text, config)
    assert len(out) > 1 and max(map(len, out)) <= config.size
    assert set(re.findall(r"word\d+-\d+", " ".join(out))) == set(re.findall(r"word\d+-\d+", text))
    assert chunking.recursive_split("x" * 5000, config) and chunking.recursive_split("", config) == []


def test_chunks(spark):
    rows = [("d", "# A\n" + "a" * 120 + "\n## B\nshort\n```\n# not a head\n```\n# C\n" + "c d " * 600), ("e", ""), ("f", None)]
    out = chunking.chunk(spark.createDataFrame(rows, "id string, text string")).orderBy("id", "index").collect()
    assert [r["index"] for r in out] == list(range(len(out))) and {r["id"] for r in out} == {"d"}
    assert out[0]["h1"] == "A" and out[-1]["h1"] == "C" and out[-1]["h2"] is None
    assert all(len(r["text"]) <= 512 for r in out[1:])
    with pytest.raises(ValueError):
        chunking.Config(size=10, overlap=10)


def test_jsonl(spark, tmp_path):
    a, t = spark.createDataFrame([("a1", "T", "<p>")], "article_id string, title string, raw_html string"), spark.createDataFrame([("x", "y")], "term string, definition string")
    sinks.save_jsonl(sinks.jsonl_records(a, t, "guide"), str(tmp_path / "out"))
    back = spark.read.json(str(tmp_path / "out"))
    assert "raw_html" not in back.columns and sorted(r["type"] for r in back.collect()) == ["article", "glossary_term"]


def test_streaming_ingest(spark, tmp_path):
    rows = spark.createDataFrame([("c1", "a", "2024-01-01 00:00:00"), ("c1", "a", "2024-01-01 00:10:00"), ("c2", "b", "2024-01-01 00:20:00")], "id string, text string, ts string").selectExpr("id", "text", "timestamp(ts) AS ts")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    ingest.append(ingest.new_chunks(stream), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination(60)
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["c1", "c2"]


def test_cli():
    args = cli.parser().parse_args(["validate", "g", "--fix"])
    assert args.fix and cli.is_local("/data/graph") and not cli.is_local("s3://bucket/graph")
    with pytest.raises(SystemExit) as stop:
        cli.confirm("s3://bucket/graph", ask=lambda _: "n")
    assert stop.value.code == 0


WEBINAR_PAGE = """<article><h2>Talks</h2><div class="flex_column av_three_fifth"><div class="avia-image-container"><a href="https://resources.example.com/webinar/safe-design">
<img src="/t.png" title="Safe design in practice"></a></div></div><div class="flex_column av_two_fifth"><h3>In This Webinar, learn about design</h3></div>
<a href="https://example.com/webinar/?x"></a><p>A talk on tests. More of it.</p></article>"""


def test_webinars_and_their_links():
    from kgloom.sources import articles

    out = articles.article(WEBINAR_PAGE, "https://example.com/guide/a", articles.Site())
    first, second = out["webinars"]
    assert first == {"url": "https://resources.example.com/webinar/safe-design", "title": "Safe design in practice", "description": "In This Webinar, learn about design", "thumbnail": "https://example.com/t.png", "context": "Talks"}
    assert (second["title"], second["description"], second["context"]) == ("A talk on tests", None, None)
    assert "[Safe design in practice](https://resources.example.com/webinar/safe-design)" in out["markdown_content"]
    # The column's link went with its image; a plain link is still there for the announcement.
    assert "### In This Webinar, learn about design" in out["markdown_content"]
    plain = WEBINAR_PAGE.replace("avia-image-container", "box")
    out = articles.article(plain, "https://example.com/guide/a", articles.Site())
    assert "**[In This Webinar, learn about design](https://resources.example.com/webinar/safe-design)**" in out["markdown_content"]


def test_semantic_split_falls_back():
    from kgloom.operators import chunking

    config = chunking.Config(size=60, overlap=10, threshold=60, least=10, semantic=True)
    assert chunking.semantic_split("", config) is None
    assert chunking.semantic_split("x" * 200 + ".", config) is None
    assert chunking.semantic_split("Hi. Yo.", config) is None
    assert chunking.semantic_split("Cats purr at night. Cats purr at noon. Stars burn far away.", config) == ["Cats purr at night. Cats purr at noon.", "Stars burn far away."]
    long = "word " * 100
    assert [c[3] for c in chunking.sized([(None, None, None, long)], config)] == chunking.recursive_split(long, config)
    def broken(sentences):
        raise OSError("no provider")

    text = "Cats purr at night. Cats purr at noon. Stars burn far away."
    for embed in (broken, lambda sentences: np.zeros((1, 2))):
        failing = chunking.Config(size=60, overlap=10, threshold=60, least=10, semantic=True, embed=embed)
        assert chunking.semantic_split(text * 3, failing) is None
        assert [x[3] for x in chunking.sized([(None, None, None, text * 3)], failing)] == chunking.recursive_split(text * 3, failing)


def test_semantic_split_cuts_at_the_least_similar_places():
    axes = {"a": [1.0, 0.0, 0.0], "b": [0.8, 0.6, 0.0], "c": [0.0, 0.0, 1.0], "z": [0.0, 0.0, 0.0]}
    config = lambda **more: chunking.Config(**{"size": 1000, "overlap": 10, "threshold": 1000, "least": 1, "semantic": True, "embed": lambda x: np.array([axes[s[0]] for s in x]), **more})
    split = lambda marks, **more: [g.replace(".", "").replace(" ", "") for g in chunking.semantic_split(" ".join(f"{m}." for m in marks), config(**more))]
    assert split("aabbcca") == ["aabb", "cc", "a"]
    assert split("aazaa") == ["aa", "z", "aa"]  # nothing is like a zero vector
    assert split("acacbbbb", window=2) == ["acacbbbb"] and split("acacbbbb") == ["a", "c", "a", "c", "bbbb"]
    assert split("aaaabaaa", size=17, threshold=17) == ["aaaab", "aaa"]  # by size: the last place where a and b meet
    assert split("aaaaaaaa", size=11, threshold=11) == ["aaaa", "aaaa"]  # of equal places the last that fits
    # Blocks of a provider's calls change nothing.
    marks = "aabbcc" * 100
    assert split(marks) == split(marks, window=2) == ["aabb", *["cc", "aabb"] * 99, "cc"]


def test_semantic_split_is_linear():
    sentence = "the same words again and again. "
    groups = chunking.semantic_split(sentence * 20_000, chunking.RETRIEVAL)
    assert sum(g.count(".") for g in groups) == 20_000 and max(map(len, groups)) <= chunking.RETRIEVAL.size


def test_documents_to_graph_goes_on_after_failures(spark):
    from pyspark.sql import functions as F

    from kgloom.operators import chunking, extraction

    text = "# A\n" + "alpha meets beta in a long sentence about many things. " * 2
    docs = spark.createDataFrame([("1", text), ("2", text.replace("beta", "gamma")), ("3", "")], "id string, text string")
    terms = spark.createDataFrame([("Concept", "alpha"), ("Tool", "beta"), ("Tool", "gamma")], "label string, name string")
    inner = extraction.DictionaryExtractor(terms)

    def extract(chunks):
        return inner(chunks).withColumn("json", F.when(F.col("chunk_id").startswith("2-"), "no json").otherwise(F.col("json")))

    nodes, edges, chunks, status = extraction.documents_to_graph(docs, extract, chunking.Config(least=0))
    assert sorted((r["label"], r["name"]) for r in nodes.collect()) == [("Concept", "alpha"), ("Tool", "beta")]
    assert sorted(r["type"] for r in edges.collect()) == ["FROM_ARTICLE", "FROM_ARTICLE", "MENTIONED_IN", "MENTIONED_IN", "RELATED_TO"]
    assert sorted(map(tuple, status.collect())) == [("1", 1, 0, "succeeded"), ("2", 1, 1, "failed"), ("3", 0, 0, "succeeded")]
    assert chunks.count() == 2


def test_one_json_document(spark, tmp_path):
    import json

    from kgloom.sources import sinks

    articles = spark.createDataFrame([("a2", 1, 2, "Two"), ("a1", 1, 1, "One")], "article_id string, chapter_number int, article_number long, title string")
    terms = spark.createDataFrame([("t", "d")], "term string, definition string")
    sinks.save_document(articles, terms, "G", str(tmp_path / "doc"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "doc").glob("part-*")))
    found = json.loads(text)
    assert found["title"] == "G" and [a["article_id"] for a in found["articles"][1:]] == ["a1", "a2"] and found["terms"][1]["definition"] == "d"


def test_results_are_parsed_once_and_texts_not_joined_again(spark):
    """No later step holds the parsing of the results; a dictionary's answer needs no place in a text."""
    from kgloom.operators import extraction

    plan = lambda rows: rows._jdf.queryExecution().optimizedPlan().toString()
    nodes = spark.createDataFrame([("n1", ["Concept"], "Concept", "beta", None)], "id string, labels array<string>, label string, name string, definition string")
    edges = spark.createDataFrame([("n1", "MENTIONED_IN", "c1")], "src string, type string, dst string")
    answers = [
        ("c1", '{"nodes": [{"id": "Alpha", "label": "Concept"}, {"id": "beta", "label": "Concept"}], "relationships": [{"type": "USED_BY", "source": "alpha", "target": "Beta"}]}'),
        ("c2", ' ```json\n{"nodes": [{"id": "beta", "label": ""}]}\n```\n'),
        ("c3", ' {"nodes": [{"id": "beta", "label": "Concept"}]} '),
        ("c4", '{"nodes": [}'),
        ("c5", None),
    ]
    after, found, counts = extraction.glean(nodes, edges, spark.createDataFrame(answers, "chunk_id string, json string"))
    assert not any("from_json" in plan(rows).lower() or "jsontostructs" in plan(rows).lower() for rows in (after, found, counts))
    alpha = next(r["id"] for r in after.collect() if r["name"] == "alpha")
    assert sorted(map(tuple, found.collect())) == sorted([("n1", "MENTIONED_IN", c) for c in ("c1", "c2", "c3")] + [(alpha, "MENTIONED_IN", "c1"), (alpha, "USED_BY", "n1")])
    assert tuple(counts.first()) == (5, 2)
    chunks = spark.createDataFrame([("c1", 0, "Alpha meets alpha and beta in a sentence of over fifty characters."), ("c2", 1, "alpha, but short"), ("c3", 2, None)], "id string, index int, text string")
    answer = extraction.DictionaryExtractor(spark.createDataFrame([("Tool", "alpha"), ("Concept", "alpha"), ("Tool", "beta")], "label string, name string"))(chunks)
    assert "_starts" not in plan(answer)
    rows = extraction.parse_results(answer).collect()
    assert [(r["chunk_id"], [(n["label"], n["id"]) for n in r["nodes"]], len(r["relationships"])) for r in rows] == [("c1", [("Concept", "alpha"), ("Tool", "alpha"), ("Tool", "beta")], 2)]
