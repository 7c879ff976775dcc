"""The star-schema and text tables as a property graph, so that every operator has data.

Names get the noise that clean-up is for: plurals, capitals, padding, vague terms and nulls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import rules
from ..model import Graph, type_label

PART_LABELS = {"STANDARD": "Standard", "ECONOMY": "Concept", "MEDIUM": "Challenge", "PROMO": "Tool", "LARGE": "Artifact", "SMALL": "Methodology"}
VAGUE = ["tool", "system", "process", "data"]
CUSTOMER_NAMES = ["auto industry", "fda", "artificial intelligence", "industry", "med device", "unheard of"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: list[str], at: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), at.cast("int"))


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, p = F.col("p_partkey"), F.col("p_name")
    label = F.coalesce(*[F.when(F.col("p_type") == t, v) for t, v in PART_LABELS.items()])
    name = (
        F.when(k % 19 == 0, None)
        .when(k % 13 == 0, _pick(VAGUE, F.floor(k / 13) % 4))
        .when(k % 11 == 0, F.concat(F.lit("  "), p, F.lit("\t")))
        .when(k % 7 == 0, F.upper(p))
        .when(k % 5 == 0, F.concat(p, F.lit("s")))
        .when(k % 17 == 0, F.concat(F.lit("Improved "), p))
        .otherwise(p)
    )
    labels = F.when(k % 3 == 0, F.array(label)).when(k % 3 == 1, F.array(F.lit("__Entity__"), label)).otherwise(F.array(F.lit("__KGBuilder__"), F.lit("__Entity__"), label))
    description = (
        F.when(k % 3 == 0, F.concat_ws(" | ", "p_brand", "p_name", "p_brand"))
        .when(k % 3 == 1, F.concat(F.lit('["'), F.col("p_brand"), F.lit('", " ", "'), p, F.lit('"]')))
        .otherwise(p)
    )
    definition = F.when(k % 4 == 0, None).when(k % 4 == 1, "").otherwise(F.concat_ws(" ", "p_brand", F.lower("p_type")))
    spans = F.when(k % 2 == 0, F.array(F.concat_ws("-", k.cast("string"), (k + 5).cast("string")))).otherwise(F.array().cast("array<string>"))
    parts = table(spark, sf_dir, "part").select(
        F.concat(F.lit("part-"), k).alias("id"), labels.alias("labels"), name.alias("name"), F.when(k % 10 == 0, p).alias("display_name"), definition.alias("definition"), description.alias("description"), spans.alias("source_spans")
    )
    c = F.col("c_custkey")
    none, empty = F.lit(None).cast("string"), F.array().cast("array<string>")
    customers = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("cust-"), c).alias("id"), F.array(F.lit("__Entity__"), F.lit("Industry")).alias("labels"),
        F.when(c % 12 < 6, _pick(CUSTOMER_NAMES, c % 12)).when(c % 12 == 6, F.col("c_mktsegment")).otherwise(F.lower("c_mktsegment")).alias("name"),
        none.alias("display_name"), F.concat(F.lit("Buys "), F.lower("c_mktsegment")).alias("definition"), none.alias("description"), empty.alias("source_spans"),
    )
    nations = table(spark, sf_dir, "nation").select(
        F.concat(F.lit("nation-"), F.col("n_nationkey")).alias("id"), F.array(F.lit("Organization")).alias("labels"), F.lower("n_name").alias("name"), F.col("n_name").alias("display_name"),
        none.alias("definition"), none.alias("description"), empty.alias("source_spans"),
    )
    both = parts.unionByName(customers).unionByName(nations)
    return both.select("id", "labels", type_label("labels").alias("label"), "name", "display_name", "definition", "description", "source_spans")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, chapter = F.col("doc_id"), F.expr("int(substring(source, 4))")
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("ch"), chapter, F.lit("-art"), d).alias("article_id"), chapter.alias("chapter_number"), d.alias("article_number"),
        F.get(F.split("text", " "), 0).alias("title"), F.concat(F.lit("https://guide.example/ch"), chapter, F.lit("/"), d % 50).alias("url"), "text",
    )


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "source", F.posexplode(F.split("text", "\n")).alias("pos", "text"))


def _chunk_id() -> Column:
    return F.concat_ws("-", F.lit("doc"), F.col("doc_id").cast("string"), F.col("pos").cast("string"))


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, text of the chunks; which of them have a vector is not looked up, so nothing is shuffled."""
    return _lines(spark, sf_dir).select(_chunk_id().alias("id"), "text")


def _embedded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), F.lit(True).alias("embedded"))


def _as_chunks(lines: DataFrame, value: str) -> DataFrame:
    d, i = F.col("doc_id"), F.col("pos")
    article = F.when(d % 23 == 0, None).otherwise(F.concat(F.lit("ch"), F.expr("int(substring(source, 4))"), F.lit("-art"), d))
    return lines.select(
        _chunk_id().alias("id"), article.alias("article_id"), F.when(d % 17 != 0, i).alias("index"),
        F.when(d % 29 != 0, F.concat(F.lit("c"), d, F.lit("_"), i)).alias("chunk_id"), value, F.coalesce("embedded", F.lit(False)).alias("embedded"),
    )


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_chunks(_lines(spark, sf_dir).join(_embedded(spark, sf_dir), "doc_id", "left"), "text")


def chunk_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """chunks() with the size of each text in place of the text: only the sizes of a document meet
    its vector."""
    sizes = F.transform(F.split("text", "\n"), F.length)
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", sizes.alias("sizes"))
    return _as_chunks(documents.join(_embedded(spark, sf_dir), "doc_id", "left").select("doc_id", "source", "embedded", F.posexplode("sizes").alias("pos", "size")), "size")


def edge_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges as often as the tables have them, in partitions by src: what is dealt out is the keys as
    numbers, the strings are made afterwards, and a join on src finds its rows where they are."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    row = lambda kind, a, at, b: (F.lit(kind).alias("kind"), F.col(a).cast("long").alias("a"), at.cast("int").alias("at"), F.col(b).cast("long").alias("b"))
    at = lambda c: c % len(rules.RELATIONSHIPS)
    sold = lines.select("l_orderkey", "l_partkey", at(F.col("l_linenumber") * 2 + F.col("l_suppkey")).cast("int").alias("at"))
    bought = sold.join(orders, "l_orderkey").select(*row("cust", "l_partkey", F.col("at"), "o_custkey"))
    made = lines.select(*row("part", "l_partkey", at(F.col("l_linenumber")), "l_suppkey"))
    first = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("event_id"))
    seen = table(spark, sf_dir, "events").select("event_id", "user_id").join(first, "event_id", "left_semi")
    mentions = seen.select(*row("doc", "user_id", F.lit(0), "event_id"))
    src = F.concat(F.lit("part-"), "a")
    rows = bought.unionByName(made).unionByName(mentions).repartition(src)
    kind = F.col("kind")
    type_ = F.when(kind == "doc", rules.MENTION).otherwise(_pick(rules.RELATIONSHIPS, F.col("at")))
    dst = F.concat(kind, F.lit("-"), "b", F.when(kind == "doc", "-0").otherwise(""))
    return rows.select(src.alias("src"), type_.alias("type"), dst.alias("dst"))


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edge_rows(spark, sf_dir).distinct()


def definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.split("text", " ")
    bench = table(spark, sf_dir, "benchmark").select(F.concat_ws(" ", F.get(words, 0), F.get(words, 1)).alias("term"), F.col("text").alias("definition"), F.col("item_id").alias("ord"))
    nations = table(spark, sf_dir, "nation").select(F.col("n_name").alias("term"), F.concat(F.lit("The nation "), F.col("n_name")).alias("definition"), (F.col("n_nationkey") + 100_000).cast("long").alias("ord"))
    parts = table(spark, sf_dir, "part").groupBy("p_name").agg(F.min("p_partkey").alias("k")).select(F.concat(F.initcap("p_name"), F.when(F.col("k") % 2 == 0, "z").otherwise("")).alias("term"), F.concat(F.lit("About "), F.col("p_name")).alias("definition"), (F.col("k") + 200_000).alias("ord"))
    both = bench.unionByName(nations).unionByName(parts)
    return both.select(F.regexp_replace(F.lower("term"), " ", "_").alias("term_id"), "term", "definition", "ord")


def webinars(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id")
    title = F.regexp_extract("html", "<title>([^<]*)", 1)
    return table(spark, sf_dir, "pages").select(
        F.concat(F.lit("web-"), k).alias("id"), "url",
        F.when(k % 5 == 0, None).when(k % 5 == 1, "Webinar").when(k % 5 == 2, F.left(title, F.lit(10))).otherwise(title).alias("title"),
        F.when(k % 3 == 0, None).when(k % 3 == 1, "Short").otherwise(F.concat(F.lit("On "), title, F.lit(". And more."))).alias("description"),
        F.when(k % 2 == 0, F.concat(F.lit("https://img.example/"), k)).alias("thumbnail"),
    )


def graph(spark: SparkSession, sf_dir: str) -> Graph:
    return Graph(entities(spark, sf_dir), edges(spark, sf_dir), chunks(spark, sf_dir), articles(spark, sf_dir), definitions(spark, sf_dir), webinars(spark, sf_dir))


def counted(spark: SparkSession, sf_dir: str) -> Graph:
    """graph() for census.summary(), which takes an edge once and of texts their sizes."""
    return graph(spark, sf_dir).with_(edges=edge_rows(spark, sf_dir), chunks=chunk_sizes(spark, sf_dir))
