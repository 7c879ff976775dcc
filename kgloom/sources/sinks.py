"""Outputs: JSON, JSON lines and Markdown, written by executors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def jsonl_records(articles: DataFrame, terms: DataFrame, guide: str) -> DataFrame:
    """Articles, then glossary terms, one record each, told apart by `type`."""
    a = articles.drop("raw_html").withColumns({"type": F.lit("article"), "guide_title": F.lit(guide)})
    t = terms.withColumns({"type": F.lit("glossary_term"), "guide_title": F.lit(guide)})
    return a.unionByName(t, allowMissingColumns=True)


def save_jsonl(records: DataFrame, path: str) -> None:
    records.write.mode("overwrite").json(path)


def save_document(articles: DataFrame, terms: DataFrame, guide: str, path: str) -> None:
    """One JSON document in ordered part files: chapters with their articles, then terms; every
    line ends where a value does, so no row holds more than one article."""
    a = articles.select(F.lit(1).alias("part"), "chapter_number", "article_number", F.to_json(F.struct("*")).alias("line"))
    t = terms.select(F.lit(3).alias("part"), F.lit(0).alias("chapter_number"), F.row_number().over(Window.partitionBy("term").orderBy("definition")).cast("long").alias("article_number"), F.to_json(F.struct("*")).alias("line"))
    title = F.to_json(F.struct(F.lit(guide).alias("title"))).substr(F.lit(1), F.length(F.to_json(F.struct(F.lit(guide).alias("title")))) - 1)
    spark = articles.sparkSession
    frame = spark.range(3).select(F.when(F.col("id") == 0, 0).when(F.col("id") == 1, 2).otherwise(4).alias("part"), F.lit(0).alias("chapter_number"), F.lit(0).cast("long").alias("article_number"), F.when(F.col("id") == 0, F.concat(title, F.lit(', "articles": [null'))).when(F.col("id") == 1, F.lit('], "terms": [null')).otherwise("]}").alias("line"))
    lines = a.unionByName(t).withColumn("line", F.concat(F.lit(","), "line")).unionByName(frame)
    lines.repartitionByRange("part", "chapter_number", "article_number").sortWithinPartitions("part", "chapter_number", "article_number").select("line").write.mode("overwrite").text(path)


def save_json(rows: DataFrame, path: str) -> None:
    """One JSON document per row."""
    rows.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)


def markdown_lines(articles: DataFrame) -> DataFrame:
    """chapter_number, article_number, line: a consolidated guide in order, overviews without
    an entry in the contents."""
    body = F.concat(F.lit("## "), "title", F.lit("\n\n"), F.coalesce("text", F.lit("")))
    entry = F.concat(F.lit("- "), "title")
    toc = articles.where("article_number > 0").select("chapter_number", "article_number", F.lit(0).alias("part"), entry.alias("line"))
    return toc.unionByName(articles.select("chapter_number", "article_number", F.lit(1).alias("part"), body.alias("line")))


def guide_lines(records: DataFrame, terms: DataFrame) -> DataFrame:
    """part, key, line of a consolidated guide from parsed articles: contents, bodies, webinars,
    related articles, videos, glossary."""
    listed = lambda part, column, line: records.select(F.lit(part).alias("part"), F.col("title").alias("key"), F.explode(F.transform(column, line)).alias("line"))
    link = lambda x: F.concat(F.lit("- ["), x["title"], F.lit("]("), x["url"], F.lit(")"))
    parts = [
        records.select(F.lit(0).alias("part"), F.col("title").alias("key"), F.concat(F.lit("- "), "title").alias("line")),
        records.select(F.lit(1).alias("part"), F.col("title").alias("key"), F.col("markdown_content").alias("line")),
        listed(2, "webinars", link), listed(3, "related", link), listed(4, "videos", lambda x: F.concat(F.lit("- "), x["url"])),
        terms.select(F.lit(5).alias("part"), F.col("term").alias("key"), F.concat(F.lit("**"), "term", F.lit("**: "), "definition").alias("line")),
    ]
    return reduce(DataFrame.unionByName, parts)


HEADINGS = {0: "Contents", 2: "Webinars", 3: "Related", 4: "Videos", 5: "Glossary"}


def save_guide(records: DataFrame, terms: DataFrame, path: str) -> None:
    """The guide as ordered part files: reading them in name order gives one document."""
    heads = records.sparkSession.createDataFrame([(k, "", f"\n## {v}\n") for k, v in HEADINGS.items()], "part int, key string, line string")
    lines = heads.unionByName(guide_lines(records, terms)).repartitionByRange("part", "key").sortWithinPartitions("part", "key")
    lines.select("line").write.mode("overwrite").text(path)


def save_markdown(articles: DataFrame, path: str) -> None:
    rows = markdown_lines(articles).repartitionByRange("part", "chapter_number", "article_number").sortWithinPartitions("part", "chapter_number", "article_number")
    rows.select("line").write.mode("overwrite").text(path)
