"""The property graph as DataFrames.

nodes: id, labels, label, name, display_name, definition, description, source_spans.
`label` is the first label that does not start with two underscores.
edges: src, type, dst, unique on all three.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import rules

NODE = "id string, labels array<string>, label string, name string, display_name string, definition string, description string, source_spans array<string>"
EDGE = "src string, type string, dst string"
CHUNK = "id string, article_id string, index int, chunk_id string, text string, embedded boolean"
ARTICLE = "article_id string, chapter_number int, article_number long, title string, url string"
ARTICLE_RECORD = (
    "article_id string, title string, url string, content_type string, markdown_content string, sections array<struct<heading:string,level:int,content:string>>, "
    "key_concepts array<string>, cross_references array<struct<text:string,url:string,is_internal:boolean,section_id:string>>, "
    "images array<struct<src:string,alt:string,title:string,caption:string,context:string>>, videos array<struct<video_id:string,url:string>>, "
    "webinars array<struct<url:string,title:string,description:string,thumbnail:string,context:string>>, related array<struct<url:string,title:string>>, og_image string, error string"
)


@dataclass(frozen=True)
class Graph:
    """All tables of one graph; operators take and return graphs or single tables."""

    nodes: DataFrame
    edges: DataFrame
    chunks: DataFrame
    articles: DataFrame
    definitions: DataFrame
    webinars: DataFrame

    def with_(self, **tables: DataFrame) -> Graph:
        return replace(self, **tables)


def type_label(labels: Column | str) -> Column:
    return F.get(F.filter(labels, lambda x: ~x.startswith("__")), 0)


def is_entity(column: Column | str = "label") -> Column:
    return (F.col(column) if isinstance(column, str) else column).isin(rules.ENTITY_LABELS)
