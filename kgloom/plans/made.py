"""Pages made from the star tables, so that what is parsed out of them can be told by SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .project import table

SITE = "https://guide.example.com"


def _text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, html: an article of each supplier, with sections, images, a video, a webinar,
    links and a related article."""
    k, name = F.col("s_suppkey"), F.col("s_name")
    other = F.when(k % 3 == 0, _text("https://blog.example.com/blog/post-", k)).when(k % 3 == 1, _text("/guide/ch", (k + 1) % 5, "/art", k + 1)).otherwise(_text("https://other.example.org/y", k))
    image = F.when(k % 2 == 0, _text('<meta property="og:image" content="https://img.example.com/', k, '.png">')).otherwise("")
    html = _text(
        "<html><head><title>", name, "</title>", image, "</head><body><article><h1>", name, "</h1><p>Intro of ", name, ".</p>",
        "<h2>Part A</h2><p>First ", k, ".</p><p>Second ", k, ".</p><h3>Part B</h3><p>Third ", k, " with <strong>term ", k % 7, "</strong>.</p>",
        '<figure><img src="/img/', k, '.png" alt="Flow ', k, '"><figcaption>Caption ', k, '</figcaption></figure><img src="/img/', k, '.png" alt="again">',
        '<p><a href="/guide/ch', k % 5, "/art", k + 1, '">Next ', k, '</a> and <a href="https://other.example.org/x', k, '">Out ', k, "</a></p>",
        '<iframe src="https://www.youtube.com/embed/vid', k, '"></iframe><p><a href="https://www.youtube.com/watch?v=vid', k, '">Watch</a></p>',
        '<div class="avia-image-container"><a href="https://resources.example.com/webinar/topic-', k % 3, '"><img src="/t', k, '.png" alt="pic"></a></div>',
        '<div class="av_promobox"><p>RELATED ARTICLE: <a href="', other, '">Post ', k, "</a></p></div><p>Book a demo with us today</p></article></body></html>",
    )
    # Parsing is work for many tasks, however few bytes the keys take: they are dealt out before pages are made.
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    suppliers = suppliers.repartition(4 * spark.sparkContext.defaultParallelism, "s_suppkey")
    return suppliers.select(k.alias("page_id"), _text(SITE, "/guide/ch", k % 5, "/art", k).alias("url"), html.alias("html"))


def _per_region(spark: SparkSession, sf_dir: str, line: Column) -> DataFrame:
    """r_regionkey, r_name, lines: `line` of each nation, in order, joined."""
    rows = table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("r_regionkey"), "n_nationkey", line.alias("line"))
    joined = rows.groupBy("r_regionkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "line"))), lambda x: x["line"]), "").alias("lines"))
    return joined.join(table(spark, sf_dir, "region"), "r_regionkey")


def contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, html: a table of contents of each region, its nations as articles."""
    n = F.col("n_nationkey")
    line = _text('<li><a href="/g/', n, '"><span class="border">', F.col("n_regionkey") + 1, ".", n, "</span> ", F.col("n_name"), "</a></li>")
    rows = _per_region(spark, sf_dir, line)
    r = F.col("r_regionkey")
    html = _text('<div id="chapter-menu"><ul><li class="expand"><strong>', r + 1, ".</strong> ", F.col("r_name"), "<ul>", F.col("lines"), '</ul></li><li class="glossary">Glossary</li></ul></div>')
    return rows.select(r.alias("page_id"), html.alias("html"))


def glossaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, html: the nations of a region as a glossary, in one of four forms."""
    name, kind = F.col("n_name"), F.col("n_regionkey") % 4
    means = _text("The nation ", name)
    line = (
        F.when(kind == 0, _text("<tr><td>", name, "</td><td>N", F.col("n_nationkey"), "</td><td>", means, "</td></tr>"))
        .when(kind == 1, _text("<dt>", name, "</dt><dd>", means, "</dd>"))
        .when(kind == 2, _text("<h3>", name, "</h3><p>", means, "</p>"))
        .otherwise(_text("<p><strong>", name, "</strong>: ", means, "</p>"))
    )
    rows = _per_region(spark, sf_dir, line)
    k = F.col("r_regionkey") % 4
    html = F.when(k == 0, _text("<table><tr><th>Term</th><th>Acronym</th><th>Definition</th></tr>", F.col("lines"), "</table>")).when(k == 1, _text("<dl>", F.col("lines"), "</dl>")).otherwise(F.col("lines"))
    return rows.select(F.col("r_regionkey").alias("page_id"), _text("<html><body>", html, "</body></html>").alias("html"))
