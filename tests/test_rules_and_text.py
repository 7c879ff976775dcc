"""Goldens of scalar functions and classifiers."""

import pytest
from pyspark.sql import functions as F

from kgloom import rules
from kgloom.functions import fuzzy, text, vector
from kgloom.operators import industry


def column(spark, values, build):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["x"] for r in rows.select("i", build(F.col("v")).alias("x")).orderBy("i").collect()]


def test_rule_sizes():
    assert len(rules.PATTERNS) == 55 and len(rules.GENERIC_TERMS) == 95 and len(rules.SINGULARS) == 72
    assert len(rules.INDUSTRIES) == 106 and len({c for _, c in rules.INDUSTRIES}) == 23
    assert len(rules.ENTITY_LABELS) == 12 and len(rules.RELATIONSHIPS) == 14 and len(rules.POSITIVE_WORDS) == 31


def test_normalize_name(spark):
    got = column(spark, ["  Requirements Traceability  ", "ISO-26262", None, "élan!", "tüv süd", "a\t b"], text.normalize_name)
    assert got == ["requirements traceability", "iso-26262", "", "élan", "tüv süd", "a b"]


def test_generic_terms(spark):
    assert column(spark, ["tool", "TOOL", "  tool  ", "", None], text.is_generic) == [True] * 5
    assert column(spark, ["requirements management tool", "traceability", "iso 26262"], text.is_generic) == [False] * 3


def test_singular(spark):
    assert column(spark, ["requirements", "REQUIREMENTS", "traceability", ""], text.singular) == ["requirement", "requirement", "traceability", ""]


def test_disposition(spark):
    rows = spark.createDataFrame([("tool", "Tool"), ("software", "Concept"), ("requirements", "Concept"), ("Requirements", "Definition"), ("test", "Article"), (None, "Concept")], "n string, l string")
    got = [tuple(r["d"]) for r in rows.select(text.disposition(F.col("n"), F.col("l")).alias("d")).collect()]
    assert got == [("delete", None), ("delete", None), ("keep", "requirement"), ("skip", None), ("skip", None), ("delete", None)]


def test_mislabeled_challenges(spark):
    assert column(spark, ["High-Quality Products", "Improved Delivery", "Reduced Time-to-Market", "scope creep", "late defect discovery", "", None], text.positive_first_word) == [True] * 3 + [False] * 4


def test_fragments(spark):
    assert column(spark, ['["a", " ", "b", "c"]', "a | b | c", "plain", None], text.fragments) == [["a", "b", "c"], ["a", "b", "c"], ["plain"], []]


def test_title_case(spark):
    assert column(spark, ["o'neil", "do-178c", "iso 26262"], text.title_case) == ["O'Neil", "Do-178C", "Iso 26262"]


def test_word_count(spark):
    assert column(spark, ["a  b\tc", "", None, "  "], text.word_count) == [3, 0, 0, 0]


def test_fuzzy_ratio(spark):
    rows = spark.createDataFrame([("med device", "medical devices"), ("requirement", "requirements"), ("abcd", "abxd"), ("kitten", "sitting"), ("", ""), ("a", ""), (None, "a")], "a string, b string")
    got = [r["x"] for r in rows.select(fuzzy.ratio(F.col("a"), F.col("b")).alias("x")).collect()]
    assert got[:-1] == pytest.approx([80.0, 95.652174, 75.0, 61.538462, 100.0, 0.0], abs=1e-5) and got[-1] is None


def test_industry_terms(spark):
    want = {
        "automotive": ("keep", "automotive"), "AUTOMOTIVE": ("keep", "automotive"), "auto industry": ("keep", "automotive"), "artificial intelligence": ("reclassify", "artificial intelligence"),
        "industry": ("delete", None), "xyzzy_not_a_real_industry_12345": ("unknown", None), "fda": ("reclassify_org", "fda"), "industrial automation": ("unknown", None),
        "software development": ("reclassify", "software development"), "": ("delete", None), "med device": ("keep", "medical devices"),
    }
    rows = spark.createDataFrame([(t,) for t in want], "term string")
    assert {r["term"]: (r["action"], r["value"]) for r in industry.classify(rows).collect()} == want
    found = {r["term"]: r["industry"] for r in industry.normalize(rows).collect()}
    assert found["auto industry"] == "automotive" and found["xyzzy_not_a_real_industry_12345"] is None and found["artificial intelligence"] is None


def test_cosine(spark):
    rows = spark.createDataFrame([([1.0, 0.0], [0.0, 2.0]), ([1.0, 1.0], [2.0, 2.0])], "a array<float>, b array<float>")
    assert [r["x"] for r in rows.select(vector.score(F.col("a"), F.col("b")).alias("x")).collect()] == pytest.approx([0.5, 1.0])


def test_urls(spark):
    assert column(spark, ["www.ISO.org", "example.com", None], text.is_standard) == [True, False, False]
    rows = spark.createDataFrame([("youtube", "a", "u"), ("vimeo", "b", "u"), (None, "c", "u")], "p string, v string, u string")
    assert [r["x"] for r in rows.select(text.watch_url(F.col("p"), F.col("v"), F.col("u")).alias("x")).collect()] == ["https://www.youtube.com/watch?v=a", "https://vimeo.com/b", "u"]


def test_retry_and_config(monkeypatch):
    from kgloom.operators import providers

    calls, waits = [], []

    @providers.retried(TimeoutError, sleep=waits.append)
    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise providers.ProviderError("slow", TimeoutError())
        return "done"

    assert flaky() == "done" and len(waits) == 2
    with pytest.raises(ValueError):
        providers.retried(TimeoutError, sleep=waits.append)(lambda: int("x"))()
    monkeypatch.setenv("KGLOOM_API_KEY", "secret")
    assert "api_key" not in providers.Config.from_env(live=True).public()
    monkeypatch.delenv("KGLOOM_API_KEY")
    with pytest.raises(providers.ConfigError):
        providers.Config.from_env(live=True)
