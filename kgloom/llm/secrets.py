"""Secret scans over an incremental blob ledger, in DataFrame functions only.

Every version of every path is named by the SHA-256 of its content.  The ledger holds one row
for each (blob, rule version) ever scanned; a run scans only pairs not in it, once per blob
however many paths or versions hold it, and joins the findings back to all paths.

Scale.  Blobs are found by hash alone; the one copy of each that is scanned is picked by its
row's id, so texts are shuffled at most once and never grouped.  The join of findings to
paths has a blob's findings on the small side, so a blob with a third of all paths is a
skewed join that adaptive execution splits.

Offsets are code points, ends exclusive.  Null text is an empty blob.  Rows that repeat a
doc_id are versions of one path; each row gets the findings of its own text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The rules of version 1, in their order.
RULE_VERSION = "1"
RULES = {
    "assign": r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""",
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
    "pem": r"-----BEGIN [A-Z ]*PRIVATE KEY-----",
}
BASE = ("assign", "access", "hex")
ASSIGN_LENGTH = 6

FINDING = "array<struct<start:long,kind:int,end:long>>"


def _spans(text: Column, kind: int, pattern: str) -> Column:
    """Matches of a pattern as (start, kind, end): the pieces between them give the offsets."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    sizes = F.transform(found, lambda m: F.length(m).cast("long"))
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g).cast("long"))
    empty = F.array().cast(FINDING)
    zero = F.struct(F.lit(0).cast("long").alias("at"), empty.alias("spans"))

    def step(acc: Column, pair: Column) -> Column:
        start = acc["at"] + pair["gap"]
        end = start + pair["size"]
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    pairs = F.zip_with(F.slice(gaps, F.lit(1), F.size(sizes)), sizes, lambda g, s: F.struct(g.alias("gap"), s.alias("size")))
    spans = F.aggregate(pairs, zero, step, lambda acc: acc["spans"])
    if kind == 0:
        values = F.regexp_extract_all(text, F.lit(pattern), F.lit(2))
        keep = F.transform(values, lambda v: F.length(v) >= ASSIGN_LENGTH)
        both = F.arrays_zip(spans.alias("span"), keep.alias("keep"))
        spans = F.transform(F.filter(both, lambda x: x["keep"]), lambda x: x["span"])
    return F.when(text.rlike(pattern), spans).otherwise(empty)


def findings(text: Column) -> Column:
    """All spans of a text by start, then kind as listed."""
    return F.array_sort(F.concat(*[_spans(text, k, p) for k, p in enumerate(RULES.values())]))


def versions(docs: DataFrame) -> DataFrame:
    """path, text, blob: one row per version of a path."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").alias("path"), text.alias("text"), F.sha2(text, 256).alias("blob"))


def unseen(docs: DataFrame, ledger: DataFrame | None, rule_version: str = RULE_VERSION) -> DataFrame:
    """blob, path: the pairs still to scan and for each blob the least path that holds it."""
    blobs = versions(docs).groupBy("blob").agg(F.min("path").alias("path"))
    if ledger is not None:
        blobs = blobs.join(ledger.where(F.col("rule_version") == rule_version), "blob", "left_anti")
    return blobs


def scan(docs: DataFrame, ledger: DataFrame | None = None, rule_version: str = RULE_VERSION) -> DataFrame:
    """New ledger rows: blob, rule_version, findings."""
    todo = unseen(docs, ledger, rule_version).select("blob", F.col("path").alias("pick"))
    rows = versions(docs)
    # A blob held only by rows without an id matches on nulls.
    texts = rows.join(todo.hint("shuffle_hash"), (rows["blob"] == todo["blob"]) & rows["path"].eqNullSafe(todo["pick"]), "left_semi")
    scanned = texts.select("blob", F.lit(rule_version).alias("rule_version"), findings(F.col("text")).alias("findings"))
    return scanned.dropDuplicates(["blob"])


def open_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except Exception as error:  # noqa: BLE001  only a missing path is an empty ledger
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return None


def scan_into(docs: DataFrame, path: str, rule_version: str = RULE_VERSION) -> DataFrame:
    """Scan what the ledger at `path` lacks, append it there, return findings of all rows."""
    spark = docs.sparkSession
    scan(docs, open_ledger(spark, path), rule_version).write.mode("append").parquet(path)
    return by_path(docs, spark.read.parquet(path), rule_version)


def by_path(docs: DataFrame, ledger: DataFrame, rule_version: str = RULE_VERSION) -> DataFrame:
    """path, blob, findings: the findings of every row's blob."""
    known = ledger.where(F.col("rule_version") == rule_version).select("blob", "findings")
    return versions(docs).select("path", "blob").join(known, "blob")


def written(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in RULES])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(found: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, blob."""
    number = lambda k: F.size(F.filter("findings", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("findings", lambda s: s["kind"] < len(BASE))
    return found.select(F.col("path").alias("doc_id"), *[number(k).alias(f"n_{name}") for k, name in enumerate(BASE)], F.sha2(written(base), 256).alias("base_sha256"), written(F.col("findings")).alias("spans"), "blob")
