"""Merkle manifest of a dataset: a radix-ranked trie per language.

Leaves are hashes of rows.  Their exact places within a language come from hierarchical
histograms of the digits of doc_id, not from a sort of the table: rows are counted per bucket of
2**BUCKET_BITS ids, the counts are added up digit by digit, and the offset of a bucket is the sum
of its smaller siblings on each level.  Inside a bucket few rows are ordered.  The base-8 digits
of a place are the leaf's key in the trie; dropping the last digit (the longest proper prefix) is
its parent.  Three digits at a time are reduced inside one partition, as nested groups of eight;
the digests of these blocks of 512 are the leaves of the next tier.  Paths (the siblings on every
level) come down the same way.

Scale: the text is read once and only digests move, twice; a block holds at most 512 leaves, a
window at most a bucket's rows or 512 digits.  A bucket with over HEAVY rows (a doc_id that a
third of the rows repeat, or null) is divided by id and by leading digits of the leaf, and
identical rows are counted before they move, so no task holds a hot id.  Languages are ordered
by a range partition, so that many of them need no single task.

Defined cases: null doc_ids come first in their language; rows of one doc_id are ordered by leaf;
identical rows take one place each.  A null field hashes as `-`, an empty one as `0:`.  An empty
table has no rows.  Where root has a single language it is that language's subroot.  Other
columns are left out.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checked_broadcast, stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# Base 8; three digits a tier.
DIGIT, TIER = 3, 9
WIDE = 1 << TIER
BUCKET_BITS = 8
HEAVY = 1 << 16
TAMPER = 3
PATHS_BROADCAST = 20_000

RESULT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """Byte count, colon, value; `-` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(docs: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """g (names the language; null sorts first), doc_id, leaf, altered (the leaf of the tampered
    row, null where nothing is tampered with)."""
    lower = F.translate(F.col("text").cast("string"), ascii_uppercase, ascii_lowercase)
    leaf = digest(*[field(F.col(f)) for f in fields])
    altered = digest(*[field(lower if f == "text" else F.col(f)) for f in fields])
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER == 0
    group = F.when(F.col("lang").isNull(), "").otherwise(F.concat(F.lit("="), F.col("lang").cast("string")))
    return docs.select(group.alias("g"), F.col("doc_id").cast("long").alias("doc_id"), leaf.alias("leaf"), F.when(chosen, altered).alias("altered"))


def _offsets(counts: DataFrame, bits: int) -> DataFrame:
    """g, bucket, sub, base (rows of the language in smaller buckets), n (rows of the language)."""
    # From the finest digit to the coarsest: what of (bucket, sub) is left on each level.
    levels = [("bucket", "sub"), ("bucket", "shiftright(sub, 10)"), ("bucket", "shiftright(sub, 20)"), ("bucket", "0L")]
    levels += [(f"shiftright(bucket, {at})", "0L") for at in range(TIER, bits + TIER, TIER)]
    grouped = [counts.groupBy("g", F.expr(b).alias("bucket"), F.expr(s).alias("sub")).agg(F.sum("n").alias("n")) for b, s in levels]
    up = {1: ("bucket", "shiftright(sub, 10)"), 2: ("bucket", "shiftright(sub, 10)"), 3: ("bucket", "0L")}
    out = grouped[-1].select("g", "bucket", "sub", F.lit(0).cast("long").alias("base"), "n")
    for k in range(len(levels) - 1, 0, -1):
        b, s = up.get(k, (f"shiftright(bucket, {TIER})", "0L"))
        inside = grouped[k - 1].select("g", "bucket", "sub", F.col("n").alias("own"), F.expr(b).alias("ub"), F.expr(s).alias("us"))
        before = F.sum("own").over(Window.partitionBy("g", "ub", "us").orderBy("bucket", "sub").rowsBetween(Window.unboundedPreceding, -1))
        inside = inside.withColumn("before", F.coalesce(before, F.lit(0).cast("long")))
        outer = out.select("g", F.col("bucket").alias("ub"), F.col("sub").alias("us"), "base", "n")
        out = inside.join(outer, ["g", "ub", "us"]).select("g", "bucket", "sub", (F.col("base") + F.col("before")).alias("base"), "n")
    return out


def ranked(rows: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """g, n, start, copies, doc_id, leaf, altered: the places start .. start + copies - 1 of identical
    rows among the n of their group, by doc_id."""
    span = rows.agg(F.min(F.shiftright("doc_id", BUCKET_BITS)).alias("low"), F.max(F.shiftright("doc_id", BUCKET_BITS)).alias("high")).first()
    low, high = (0, 0) if span["low"] is None else span
    bucket = F.coalesce(F.shiftright("doc_id", BUCKET_BITS) - F.lit(low - 1), F.lit(0)).cast("long")
    rows = rows.withColumn("bucket", bucket)
    big = stored(rows.groupBy("g", "bucket").agg(F.count("*").alias("n")).where(F.col("n") > heavy).select("g", "bucket", F.lit(True).alias("big")), "heavy")
    # The place inside a heavy bucket: the id's digit, then 20 bits of the leaf.
    inside = F.shiftleft(F.coalesce(F.col("doc_id").bitwiseAND(F.lit((1 << BUCKET_BITS) - 1)), F.lit(0)).cast("long"), 20) + F.conv(F.substring("leaf", 1, 5), 16, 10).cast("long")

    def placed(found: DataFrame) -> DataFrame:
        return found.join(checked_broadcast(big), ["g", "bucket"], "left").withColumn("sub", F.when(F.col("big"), inside + 1).otherwise(F.lit(0)).cast("long")).drop("big")

    counts = stored(placed(rows).groupBy("g", "bucket", "sub").agg(F.count("*").alias("n")), "digits")
    base = _offsets(counts, (high - low + 1).bit_length())
    same = placed(rows.groupBy("g", "bucket", "doc_id", "leaf", "altered").agg(F.count("*").alias("copies")))
    order = Window.partitionBy("g", "bucket", "sub").orderBy(F.col("doc_id").asc_nulls_first(), "leaf")
    before = F.coalesce(F.sum("copies").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    out = same.withColumn("before", before).join(base, ["g", "bucket", "sub"])
    return out.select("g", "n", (F.col("base") + F.col("before")).alias("start"), "copies", "doc_id", "leaf", "altered")


def _joined(kids: Column) -> Column:
    return F.array_join(F.transform(kids, lambda k: k["digest"]), "")


def blocks(nodes: DataFrame) -> DataFrame:
    """g, n, block, digest, kids: tries of three digits.  nodes: g, n, start, copies, digest, item;
    a group of one block stops where one node is left."""
    last = F.shiftright(F.col("start") + F.col("copies") - 1, TIER)
    rows = nodes.withColumn("block", F.explode(F.sequence(F.shiftright("start", TIER), last))).repartition("g", "block")
    edge = F.shiftleft("block", TIER)
    rows = rows.select("g", "n", "block", F.explode(F.sequence(F.greatest("start", edge), F.least(F.col("start") + F.col("copies"), edge + WIDE) - 1)).alias("i"), "digest", "item")
    level = rows.groupBy("g", "n", "block", F.shiftright("i", DIGIT).alias("up")).agg(F.array_sort(F.collect_list(F.struct("i", "digest", "item"))).alias("kids"))
    for _ in range(2):
        kid = F.struct(F.col("up").alias("i"), F.sha2(_joined(F.col("kids")), 256).alias("digest"), "kids")
        level = level.select("g", "n", "block", F.shiftright("up", DIGIT).alias("up"), kid.alias("kid")).groupBy("g", "n", "block", "up").agg(F.array_sort(F.collect_list("kid")).alias("kids"))
    two = F.col("kids")[0]
    one = two["kids"][0]
    top = F.when(F.col("n") == 1, one["kids"][0]["digest"]).when(F.col("n") <= 1 << DIGIT, one["digest"]).when(F.col("n") <= 1 << 2 * DIGIT, two["digest"]).otherwise(F.sha2(_joined(F.col("kids")), 256))
    return level.select("g", "n", "block", top.alias("digest"), "kids")


def trie(nodes: DataFrame) -> list[DataFrame]:
    """The tiers, lowest first; a group's last tier is the one where it is a single block."""
    tiers = []
    while True:
        tiers.append(stored(blocks(nodes), "trie"))
        wide = tiers[-1].where(F.col("n") > WIDE)
        if not wide.limit(1).count():
            return tiers
        nodes = wide.select("g", F.ceil(F.col("n") / WIDE).alias("n"), F.col("block").alias("start"), F.lit(1).cast("long").alias("copies"), "digest", F.lit(None).cast("string").alias("item"))


def roots(tiers: list[DataFrame]) -> DataFrame:
    """g, digest."""
    out = None
    for tier in tiers:
        found = tier.where(F.col("n") <= WIDE).select("g", "digest")
        out = found if out is None else out.unionByName(found)
    return out


def _step(kids: Column, path: Column, counts: Column) -> Column:
    """The nodes with their paths: what stands left and right of each one among its siblings,
    before the path of their parent."""

    def node(k: Column, at: Column) -> Column:
        left, right = F.slice(kids, F.lit(1), at), F.slice(kids, at + 2, F.lit(1 << DIGIT))
        sides = F.array(F.struct(_joined(left).alias("left"), _joined(right).alias("right")))
        return F.struct(k.alias("node"), F.when(counts, F.concat(sides, path)).otherwise(path).alias("path"))

    return F.transform(kids, node)


def descended(tier: DataFrame, paths: DataFrame) -> DataFrame:
    """g, i, digest, item, path, top of every leaf of a tier; paths: g, block, path, top."""
    rows = tier.join(checked_broadcast(paths, limit=PATHS_BROADCAST), ["g", "block"]).select("g", "n", "top", "path", "kids")
    for least in (1 << 2 * DIGIT, 1 << DIGIT):
        rows = rows.select("g", "n", "top", F.inline(_step(F.col("kids"), F.col("path"), F.col("n") > least))).select("g", "n", "top", "path", F.col("node.kids").alias("kids"))
    return rows.select("g", "top", F.inline(_step(F.col("kids"), F.col("path"), F.col("n") > 1))).select("g", F.col("node.i").alias("i"), F.col("node.digest").alias("digest"), F.col("node.item").alias("item"), "path", "top")


def proofs(tiers: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The leaves of the lowest tier with their whole paths; tops: g, path (above its root), top."""
    below = None
    for k in range(len(tiers) - 1, -1, -1):
        ends = tiers[k].where(F.col("n") <= WIDE).select("g", "block").join(checked_broadcast(tops), "g").select("g", "block", "path", "top")
        if below is not None:
            ends = ends.unionByName(below.select("g", F.col("i").alias("block"), "path", "top"))
        below = descended(tiers[k], stored(ends, "paths") if k < len(tiers) - 1 else ends)
    return below


def by_name(groups: DataFrame) -> DataFrame:
    """groups with start, the place of each g by UTF-8 bytes, and n."""
    dealt = stored(groups.repartitionByRange("g").withColumn("part", F.spark_partition_id()), "groups")
    sizes = dealt.groupBy("part").agg(F.count("*").alias("size"))
    # One row a partition.
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("part", F.coalesce(F.sum("size").over(order), F.lit(0).cast("long")).alias("base"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("g")) - 1
    return dealt.withColumn("place", place).join(F.broadcast(sizes), "part").withColumn("start", F.col("base") + F.col("place")).withColumn("n", F.lit(dealt.count()).cast("long")).drop("part", "base", "place")


def manifest(docs: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: one row per row of docs."""
    rows = stored(leaves(docs), "leaves")
    nodes = ranked(rows, heavy).withColumnRenamed("leaf", "digest").withColumn("item", F.struct("doc_id", "altered"))
    tiers = trie(nodes.select("g", "n", "start", "copies", "digest", "item"))
    subroots = by_name(roots(tiers)).select(F.lit("").alias("g"), "n", "start", F.lit(1).cast("long").alias("copies"), "digest", F.struct(F.col("g").alias("lang")).alias("item"))
    above = trie(subroots)
    nothing = F.array().cast("array<struct<left:string,right:string>>")
    start = roots(above).select("g", nothing.alias("path"), F.col("digest").alias("top"))
    tops = proofs(above, start).select(F.col("item.lang").alias("g"), "path", F.struct(F.col("digest").alias("subroot"), F.col("top").alias("root")).alias("top"))
    out = proofs(tiers, stored(tops, "tops"))
    proof = F.sha2(F.array_join(F.transform("path", lambda p: F.concat(p["left"], p["right"])), ""), 256)
    folded = F.aggregate("path", F.coalesce("item.altered", "digest"), lambda acc, p: digest(p["left"], acc, p["right"]))
    out = out.select(F.col("item.doc_id").alias("doc_id"), F.col("digest").alias("leaf"), "top.subroot", "top.root", proof.alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
