"""Page sources.  Live HTTP is a provider's matter; offline, pages are a table."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from . import dom


class PageSource(Protocol):
    def pages(self, spark: SparkSession) -> DataFrame:
        """page_id, url, html; null html is a failed fetch."""


class TablePages:
    def __init__(self, path: str) -> None:
        self.path = path

    def pages(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path).select("page_id", "url", "html")


class FilePages:
    """HTML and Markdown files, one page per file."""

    def __init__(self, path: str) -> None:
        self.path = path

    def pages(self, spark: SparkSession) -> DataFrame:
        kind = F.lower(F.regexp_extract("path", r"\.([A-Za-z]+)$", 1))
        files = spark.read.text(self.path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("html")).withColumn("kind", kind)
        known = F.col("kind").isin("html", "htm", "md", "markdown")
        return files.select(F.xxhash64("path").alias("page_id"), F.col("path").alias("url"), F.when(known, F.col("html")).otherwise(F.raise_error(F.concat(F.lit("not a page: "), "path"))).alias("html"), "kind")


def create_source(kind: str, path: str) -> PageSource:
    return {"table": TablePages, "files": FilePages}[kind](path)


def fetched(contents: DataFrame, pages: DataFrame) -> DataFrame:
    """Articles of a table of contents with their pages; those that failed to load are left out."""
    kind = F.when(F.col("article_number") == 0, "overview").otherwise("article")
    article = F.concat(F.lit("ch"), F.col("chapter_number"), F.lit("-art"), F.col("article_number")).alias("article_id")
    return contents.join(pages.where("html is not null"), "url").select(article, "chapter_number", "article_number", "title", "url", kind.alias("content_type"), "html")


_DROPPED = ("nav", "header", "footer", "script", "style", "noscript", "aside")
_NAMES = ("navigation", "sidebar", "menu", "advertisement")


def preprocess(page: str | None) -> str:
    """Visible text of the main part, white space as single spaces."""
    root = dom.parse(page)
    for e in root.where(lambda e: e.tag in _DROPPED or any(n in e.classes for n in _NAMES) or e.attrs.get("id") == "cookie-banner"):
        e.remove()
    tests = [lambda e: "flex_cell_inner" in e.classes, lambda e: e.tag == "main", lambda e: e.tag == "article", lambda e: "content" in e.classes]
    main = next((found[0] for t in tests if (found := root.where(t))), root)
    return " ".join(" ".join(main.strings()).split())


def visible_text(pages: DataFrame) -> DataFrame:
    """page_id, text."""
    def run(batches):
        for rows in batches:
            yield rows.assign(text=[preprocess(h) for h in rows["html"]])[["page_id", "text"]]

    return pages.select("page_id", "html").mapInPandas(run, "page_id long, text string")


def text_facts(pages: DataFrame) -> DataFrame:
    """page_id, title, n_links, authority by regular expression, in the JVM."""
    title = F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1)
    return pages.select("page_id", text.strip(title).alias("title"), F.size(F.regexp_extract_all("html", F.lit(r'<a href="([^"]*)"'), F.lit(1))).cast("long").alias("n_links"), text.authority(F.col("url")).alias("authority"))
