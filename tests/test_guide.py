"""Fetching, and from pages to a graph by one command."""

import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from kgloom import cli
from kgloom.operators import retrieval, supplementary
from kgloom.plans import guide, store
from kgloom.sources import fetch


@pytest.fixture
def server():
    seen = []

    class Stub(BaseHTTPRequestHandler):
        def do_GET(self):
            seen.append(self.path)
            flaky = self.path == "/flaky" and seen.count("/flaky") < 3
            code = 404 if self.path == "/gone" else 500 if flaky or self.path == "/broken" else 200
            self.send_response(code)
            self.end_headers()
            self.wfile.write(f"<p>page {self.path} é</p>".encode() if code == 200 else b"")

        def log_message(self, *_):
            pass

    stub = HTTPServer(("127.0.0.1", 0), Stub)
    threading.Thread(target=stub.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{stub.server_port}", seen
    stub.shutdown()


def test_pages_are_fetched(spark, server):
    base, _ = server
    fetch.register(spark)
    urls = [f"{base}{p}" for p in ("/a", "/gone", "/flaky", "/broken")] + ["nothing://x/y", "/no/host"]
    rows = spark.read.format("pages").options(urls="\n".join([*urls, urls[0]]), spacing="0", shortest="0.01", attempts="3", timeout="5").load()
    got = {r["url"]: r for r in rows.collect()}
    assert set(got) == set(urls) and got[urls[0]]["html"] == "<p>page /a é</p>" and got[urls[0]]["attempts"] == 1
    assert (got[urls[1]]["html"], got[urls[1]]["status"], got[urls[1]]["error"]) == (None, 404, None)
    assert got[urls[2]]["html"] and got[urls[2]]["attempts"] == 3 and got[urls[2]]["error"] is None
    assert got[urls[3]]["html"] is None and got[urls[3]]["status"] == 500 and got[urls[3]]["attempts"] == 3 and "HTTPError" in got[urls[3]]["error"]
    assert all(got[u]["error"] for u in urls[4:])
    table = spark.createDataFrame([(u,) for u in [*urls[:2], urls[0], None]], "url string")
    out = fetch.fetch(table, spacing="0", timeout="5")
    assert {r["url"]: r["status"] for r in out.collect()} == {urls[0]: 200, urls[1]: 404}
    counts = {r["host"]: (r["pages"], r["missing"], r["failed"]) for r in fetch.failures(out).collect()}
    assert counts == {base.removeprefix("http://"): (2, 1, 0)}


def test_requests_to_a_host_are_spaced(server):
    base, _ = server
    waits = []
    list(fetch.pages_of_host(iter([f"{base}/a", f"{base}/b"]), fetch.Settings(spacing=5.0), sleep=waits.append))
    assert len(waits) == 1 and 4 < waits[0] <= 5
    waits.clear()
    list(fetch.pages_of_host(iter([f"{base}/broken"]), fetch.Settings(spacing=0, attempts=4, shortest=2, longest=5), sleep=waits.append))
    assert [w for w in waits if w] == [2, 4, 5]


def test_pages_from_a_folder(spark, tmp_path):
    (tmp_path / "h.example" / "docs").mkdir(parents=True)
    (tmp_path / "h.example" / "docs" / "index.html").write_text("<p>index</p>")
    (tmp_path / "h.example" / "one.html").write_text("<p>one</p>")
    (tmp_path / "list").write_text("https://h.example/docs\nhttps://h.example/one\n\nhttps://h.example/../../etc/passwd\nhttps://other.example/\n")
    fetch.register(spark)
    rows = spark.read.format("pages").option("list", str(tmp_path / "list")).option("folder", str(tmp_path)).load()
    assert rows.rdd.getNumPartitions() == 2
    assert {r["url"].rsplit("/", 1)[1]: r["html"] for r in rows.collect()} == {"docs": "<p>index</p>", "one": "<p>one</p>", "passwd": None, "": None}


PAGE = '<body><h1>{0}</h1><article><p>The gear box of {0} drives a blue bolt and more of the same, as everybody knows by now, though few would say so when asked about it in the morning.</p>{1}</article></body>'


@pytest.fixture
def tables(spark, tmp_path):
    pages = [(f"ch{1 + i // 3}-art{i}", f"https://guide.example.com/g/{i}", PAGE.format(f"Part {i}", '<div class="av_promobox">RELATED ARTICLE <a href="/g/1">Part 1</a></div>' if i == 4 else "")) for i in range(6)]
    pages.append(("ch9-art9", "https://guide.example.com/g/9", None))
    spark.createDataFrame(pages, "page_id string, url string, html string").write.parquet(str(tmp_path / "pages"))
    terms = [("Concept", "Gear Box", "It turns."), ("Tool", "blue bolt", None), ("Planet", "the", None)]
    spark.createDataFrame(terms, "label string, name string, definition string").write.parquet(str(tmp_path / "terms"))
    return tmp_path


def test_pages_become_a_graph(spark, tables):
    pages, terms = spark.read.parquet(str(tables / "pages")), spark.read.parquet(str(tables / "terms"))
    glossary = terms.where("definition is not null").select(F.col("name").alias("term"), "definition")
    built = guide.from_pages(pages, guide.dictionary(terms), glossary=glossary)
    graph = built.graph
    assert sorted((r["label"], r["name"]) for r in graph.nodes.collect()) == [("Concept", "gear box"), ("Tool", "blue bolt")]
    kinds = {r["type"]: r["count"] for r in graph.edges.groupBy("type").count().collect()}
    assert kinds["MENTIONED_IN"] == 12 and kinds["IN_CHAPTER"] == 7 and ("ch2-art4", "RELATED_TO", "ch1-art1") in set(map(tuple, graph.edges.collect()))
    assert {r["id"]: r["status"] for r in built.status.collect()} == {f"ch{1 + i // 3}-art{i}": "succeeded" for i in range(6)} | {"ch9-art9": "succeeded", "glossary/gear_box": "succeeded"}
    assert built.passes[0][1] >= 6 and built.passes[-1][3] == 0
    # The search chain works on the ids that this graph has.
    vectors = graph.chunks.where("embedding is not null").select("id", "embedding")
    query = vectors.orderBy("id").limit(1).select(F.col("embedding").alias("q"))
    assert retrieval.chain(graph, vectors, query, 3).count() == 2
    assert retrieval.article_topk(graph, vectors, query, 3).where("title is not null").count() == 3


def test_pages_by_one_command(spark, tables, monkeypatch):
    monkeypatch.setattr(cli, "session", lambda: spark)
    out = str(tables / "out")
    command = ["pages", str(tables / "pages"), "--terms", str(tables / "terms"), "-o", out]
    assert cli.main(command) == 0 and store.Store(spark, out).current() == "clean"
    store.Store(spark, out).forget(["clean"])
    assert cli.main([*command, "--resume"]) == 0
    assert {r["name"] for r in store.Store(spark, out).load("clean").nodes.collect()} == {"gear box", "blue bolt"}


def test_the_last_article_owns_a_shared_url(spark):
    rows = [(f"ch1-art{n}", "T", "u" if n in (9, 10) else f"u{n}", [], [("u", "x")] if n == 1 else []) for n in (1, 9, 10)]
    empty = [F.array().cast("array<string>").alias(c) for c in ("images", "videos", "webinars", "cross_references", "key_concepts")]
    records = spark.createDataFrame(rows, "article_id string, title string, url string, sections array<string>, related array<struct<url:string,title:string>>").select("*", *empty)
    assert {r["article_id"]: r["url_owner"] for r in supplementary.record_index(records).collect()} == {"ch1-art1": True, "ch1-art9": False, "ch1-art10": True}
    assert [tuple(r) for r in supplementary.related_links(records).collect()] == [("ch1-art1", "RELATED_TO", "ch1-art10")]
