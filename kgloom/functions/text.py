"""Scalar text functions as Column expressions.

Java's \\w and \\s are ASCII; (?U) gives the Unicode classes that names need.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import rules


def strip(c: Column) -> Column:
    """White space of any kind off both ends; Spark's trim takes spaces only."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def normalize_name(c: Column) -> Column:
    """Lower case, single spaces, no outer punctuation; null and empty give ''."""
    flat = F.regexp_replace(strip(F.lower(c)), r"(?U)\s+", " ")
    return F.coalesce(F.regexp_replace(flat, r"(?U)^[^\w]+|[^\w]+$", ""), F.lit(""))


def plain_name(c: Column) -> Column:
    return strip(F.lower(c))


def word_count(c: Column) -> Column:
    return F.size(F.filter(F.split(F.coalesce(c, F.lit("")), r"(?U)\s+"), lambda x: x != "")).cast("long")


def is_generic(c: Column) -> Column:
    return F.when(F.coalesce(c, F.lit("")) == "", True).otherwise(plain_name(c).isin(rules.GENERIC_TERMS))


def singular(c: Column) -> Column:
    """Dictionary singular of a plural; anything else lower-cased and stripped."""
    table = F.create_map(*[F.lit(x) for pair in rules.SINGULARS.items() for x in pair])
    return F.when(c == "", c).otherwise(F.coalesce(F.element_at(table, plain_name(c)), plain_name(c)))


def disposition(name: Column, label: Column) -> Column:
    """struct(action, value): what clean-up does with an entity."""
    kind = (
        F.when(F.coalesce(name, F.lit("")) == "", "delete")
        .when(~F.coalesce(label.isin(rules.ENTITY_LABELS), F.lit(False)), "skip")
        .when(is_generic(name), "delete")
        .otherwise("keep")
    )
    return F.struct(kind.alias("action"), F.when(kind == "keep", singular(name)).alias("value"))


def positive_first_word(c: Column) -> Column:
    """A challenge whose first word speaks of success."""
    return F.coalesce(F.get(F.split(plain_name(c), r"(?U)\s+"), 0).isin(rules.POSITIVE_WORDS), F.lit(False))


def positive_any_word(c: Column) -> Column:
    return F.arrays_overlap(F.split(F.lower(c), " "), F.array(*[F.lit(w) for w in rules.POSITIVE_WORDS]))


def fragments(c: Column) -> Column:
    """A description's parts: a JSON list, else split at ' | '."""
    parsed = F.filter(F.transform(F.from_json(c, "array<string>"), strip), lambda x: x != "")
    return F.when(c.isNull(), F.array().cast("array<string>")).when(strip(c).startswith("[") & parsed.isNotNull(), parsed).when(c.contains(" | "), F.filter(F.transform(F.split(c, r" \| "), strip), lambda x: x != "")).otherwise(F.array(strip(c)))


def title_case(c: Column) -> Column:
    """Every run of letters starts with a capital, as in O'Neil or Do-178C."""
    pieces = F.regexp_extract_all(c, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.lower(F.substring(p, 2, 1 << 30)))), "")


def slug_title(url: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(url, "/"), -1), "-", " ")


def authority(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def source_type(url: Column, brand: str, guide: str) -> Column:
    """Where a related article lives, for the site `brand` with a guide under `guide`."""
    return (
        F.when(~url.contains(brand), "external").when(url.contains("/blog/"), "blog").when(url.contains(guide), "internal").when(url.contains(f"resources.{brand}"), "resource").otherwise("site")
    )


# Domains of standards bodies.
STANDARD_DOMAINS = [
    "iso.org", "ieee.org", "incose.org", "faa.gov", "fda.gov", "rtca.org",
]


def is_standard(domain: Column) -> Column:
    held = [F.lower(domain).contains(d) for d in STANDARD_DOMAINS]
    out = held[0]
    for h in held[1:]:
        out = out | h
    return F.coalesce(out, F.lit(False))


def watch_url(platform: Column, video_id: Column, url: Column) -> Column:
    return F.when(platform == "youtube", F.concat(F.lit("https://www.youtube.com/watch?v="), video_id)).when(platform == "vimeo", F.concat(F.lit("https://vimeo.com/"), video_id)).otherwise(url)


def article_url(explicit: Column, overview: Column) -> Column:
    return F.coalesce(explicit, overview)
