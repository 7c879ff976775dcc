"""Broken, deep and hostile pages; the tokenizer and the tree."""

import time

import pytest

from kgloom.sources import articles as source
from kgloom.sources import dom
from kgloom.sources.tokens import attributes, tokens

N = 100_000
HOSTILE = {
    "nested": "<div>" * N + "x" + "</div>" * N, "marks": "<b>" * N + "x" + "</b>" * N, "quotes": "<blockquote>" * N + "x", "no end": "<b " * N, "late end": "<b " * N + ">", "open quote": '<a "' * N,
    "odd quotes": '<a x="' * N + ">", "stray": "</div>" * N, "scripts": "<div>" + "<script>x</script>" * N, "headings": "<h2>" * N + "x", "tables": "<table><tr><td>" * (N // 4) + "x", "lists": "<ul><li>" * (N // 2) + "x",
    "images": "<div>" * 500 + "<img src=a.png>" * N, "links": "<a href=/x>y" * N, "comments": "<!--" * N, "scope": "<p><table><td>" + "<div>" * N, "references": "&amp" * N,
}


@pytest.mark.parametrize("name", HOSTILE)
def test_hostile_pages_take_seconds(name):
    began = time.process_time()
    out = source.tried("<body>" + HOSTILE[name], "https://h.example/a", source.Site())
    assert out["error"] is None and time.process_time() - began < 20


def test_deep_pages_keep_their_text():
    page = "<body>" + "".join(f"<div>t{i}" for i in range(500)) + "</div>" * 500 + "<p>after</p>"
    assert source.article(page, "", source.Site())["markdown_content"].split() == [f"t{i}" for i in range(500)] + ["after"]


def test_an_error_stays_with_its_page(spark, monkeypatch):
    rows = spark.createDataFrame([(1, "https://h.example/1", "<body><h1>One</h1><p>Text</p>"), (2, "http://[bad", '<body><a href="x">y</a>'), (3, None, None)], "page_id long, url string, html string")
    got = {r["article_id"]: r for r in source.articles(rows).collect()}
    assert got["1"]["error"] is None and got["1"]["markdown_content"].endswith("Text")
    assert got["2"]["error"].startswith("ValueError") and got["2"]["markdown_content"] == "" and got["2"]["images"] == []
    assert got["3"]["error"] is None and got["3"]["title"] == "Untitled"


def test_tokens():
    page = "a &lt; b<P class='x y' id=z>c<br/>d</p ><!-- <p> --><!doctype html><script>if (a<b) \"</p>\"</script><title>&amp; <b></title>e <f"
    assert list(tokens(page)) == [
        ("text", "a < b", ""), ("start", "p", " class='x y' id=z"), ("text", "c", ""), ("start", "br", "/"), ("text", "d", ""), ("end", "p", ""),
        ("start", "script", ""), ("text", 'if (a<b) "</p>"', ""), ("end", "script", ""), ("start", "title", ""), ("text", "& <b>", ""), ("end", "title", ""), ("text", "e <f", ""),
    ]
    assert dict(attributes(" A=1 b='2 &amp; 3' c=\"x>y\" d")) == {"a": "1", "b": "2 & 3", "c": "x>y", "d": ""}
    assert list(tokens("<script>x")) == [("start", "script", ""), ("text", "x", ""), ("end", "script", "")]
    assert list(tokens("1 < 2 > 0")) == [("text", "1 < 2 > 0", "")] and list(tokens("")) == []


def test_tree_closes_what_html_closes():
    texts = lambda page, tag: [e.text() for e in dom.parse(page).all(tag)]
    assert texts("<ul><li>a<ul><li>b<li>c</ul><li>d</ul>", "li") == ["abc", "b", "c", "d"]
    assert texts("<p>a<div>b</div>c", "p") == ["a"] and texts("<a href=1>x<a href=2>y", "a") == ["x", "y"]
    assert texts("<h2>a<h3>b</h3>", "h2") == ["a"] and texts("<table><tr><td>1<td>2<tr><td>3</table>", "tr") == ["12", "3"]
    outer = dom.parse("<table><tr><td>a<table><tr><td>b</table></table>").first("table")
    assert [e.text() for e in outer.own("td")] == ["ab"]
