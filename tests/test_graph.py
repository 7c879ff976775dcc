"""Graph rewrites on a small graph: goldens, idempotence, invariance under row order."""

import random

import pytest

from kgloom import rules
from kgloom.model import CHUNK, EDGE, NODE, Graph
from kgloom.operators import census, checks, cleanup, community, extraction, linking, repairs, report, retrieval, supplementary
from kgloom.operators import graphops as g

NODES = [
    ("n1", ["__Entity__", "Concept"], "Concept", "traceability", None, "short", "a | b", ["1-2"]),
    ("n2", ["Concept"], "Concept", "traceability", "Traceability", "much longer text", None, ["3-4"]),
    ("n3", ["Standard"], "Standard", "traceability", None, None, None, []),
    ("n4", ["Concept"], "Concept", "requirement", None, "x", None, []),
    ("n5", ["Concept"], "Concept", "requirements", None, "", None, []),
    ("n6", ["Tool"], "Tool", "tool", None, None, None, []),
    ("n7", ["Challenge"], "Challenge", "improved delivery", None, None, None, []),
    ("n8", ["Concept"], "Concept", None, None, None, None, []),
    ("n9", ["Industry"], "Industry", "auto industry", None, None, None, []),
    ("m1", ["Industry"], "Industry", "automotive", None, None, None, []),
    ("m2", ["Organization"], "Organization", "blue car", None, None, None, []),
]
EDGES = [("n1", "RELATED_TO", "n2"), ("n1", "REQUIRES", "n4"), ("n2", "REQUIRES", "n4"), ("n5", "RELATED_TO", "n6"), ("n3", "DEFINES", "n4"), ("n1", "MENTIONED_IN", "c1"), ("n7", "MENTIONED_IN", "c2")]
CHUNKS = [("c1", "a1", 0, "k1", "The auto industry is here, and so is traceability", True), ("c2", "a1", None, None, "two", False), ("c3", None, None, None, "three", False), ("c4", "a1", 10000, None, "x" * 200, True)]
DEFINITIONS = [("requirements", "Requirements", "What must hold", 1), ("traceabilty", "Traceabilty", "A link", 2)]
WEBINARS = [("w1", "https://x/y/my-talk", "Webinar", None, None), ("w2", "https://x/z", None, "A long description. Then more.", None), ("w3", "https://x/z", "A title of good length", "d", "t")]


@pytest.fixture(scope="module")
def graph(spark):
    return Graph(
        spark.createDataFrame(NODES, NODE), spark.createDataFrame(EDGES, EDGE), spark.createDataFrame(CHUNKS, CHUNK), spark.createDataFrame([("a1", 1, 1, "t", "u")], "article_id string, chapter_number int, article_number long, title string, url string"),
        spark.createDataFrame(DEFINITIONS, "term_id string, term string, definition string, ord long"), spark.createDataFrame(WEBINARS, "id string, url string, title string, description string, thumbnail string"),
    )


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_cross_label_merge(graph):
    assert rows(g.cross_label_winners(graph.nodes)) == [("traceability", "Standard", 2, 3)]
    assert rows(g.cross_label_map(graph.nodes)) == [("n1", "n3", "traceability"), ("n2", "n3", "traceability")]
    done = cleanup.deduplicate_across_labels(graph)
    kept = {r["id"]: r for r in done.nodes.collect()}
    assert "n1" not in kept and kept["n3"]["definition"] == "much longer text" and kept["n3"]["source_spans"] == ["1-2", "3-4"]
    assert ("n3", "RELATED_TO", "n3") in rows(done.edges) and ("n3", "REQUIRES", "n4") in rows(done.edges)


def test_merges_are_idempotent(graph):
    for merge in (cleanup.deduplicate_by_name, cleanup.merge_plurals, cleanup.delete_generic):
        once = merge(graph)
        twice = merge(once)
        assert rows(once.nodes) == rows(twice.nodes) and rows(once.edges) == rows(twice.edges)


def test_merges_ignore_row_order(graph, spark):
    turned = graph.with_(nodes=spark.createDataFrame(NODES[::-1], NODE), edges=spark.createDataFrame(EDGES[::-1], EDGE))
    assert rows(cleanup.deduplicate_across_labels(graph).nodes) == rows(cleanup.deduplicate_across_labels(turned).nodes)


def test_plural_merge_moves_edges(graph):
    done = cleanup.merge_plurals(graph)
    assert ("n4", "RELATED_TO", "n6") in rows(done.edges)
    assert "n5" not in {r["id"] for r in done.nodes.collect()}


def test_generic_entities_go_with_their_edges(graph):
    done = cleanup.delete_generic(graph)
    assert not [e for e in done.edges.collect() if "n6" in (e["src"], e["dst"])]


def test_checks_and_summary(graph):
    values = {r["check"]: r["value"] for r in checks.summary(graph).collect()}
    assert values["orphan_chunks"] == 1 and values["plural_pairs"] == 1 and values["duplicate_entities"] == 1 and values["generic_entities"] == 1
    assert values["mislabeled_challenges"] == 1 and values["ghost_entities"] == 1 and values["missing_chunk_index"] == 2
    assert not checks.passed(checks.summary(graph)).first()["passed"]


def test_repairs(graph):
    assert {r["id"]: r["index"] for r in repairs.chunk_index(graph).chunks.collect()} == {"c1": 0, "c2": 0, "c3": None, "c4": 10000}
    ids = {r["id"]: r["chunk_id"] for r in repairs.chunk_ids(graph).chunks.collect()}
    assert ids == {"c1": "k1", "c2": "a1_chunk_0000", "c3": None, "c4": "a1_chunk_0000"}
    titles = {r["id"]: r["title"] for r in repairs.titles(graph).webinars.collect()}
    assert titles == {"w1": "Webinar: my talk", "w2": "A long description.", "w3": "A title of good length"}
    labels = {r["id"]: r["label"] for r in repairs.mislabeled(graph).nodes.collect()}
    assert labels["n7"] == "Concept"
    assert rows(repairs.glossary_definitions(graph)) == [("n5", "What must hold")]
    totals = {r["repair"]: r["n"] for r in repairs.preview(graph).collect()}
    assert totals["total"] == sum(v for k, v in totals.items() if k != "total")
    assert repairs.apply(graph).nodes.count() < len(NODES)


def test_mentions_need_spaces_around(graph, spark):
    assert rows(linking.mention_backfill(graph)) == [("n3", "MENTIONED_IN", "c1"), ("n9", "MENTIONED_IN", "c1")]
    names = spark.createDataFrame([("blue car",), ("car",)], "name string")
    texts = spark.createDataFrame([("t1", "a Blue car"), ("t2", "blue  car"), ("t3", "car, blue"), ("t4", "")], "id string, text string")
    assert rows(linking.word_grams(texts, names).select("id", "name")) == [("t1", "blue car"), ("t1", "car"), ("t2", "car")]


def test_glossary_links(graph):
    found = {r["term_id"]: (r["name"], r["how"]) for r in linking.glossary_links(graph).collect()}
    assert found == {"requirements": ("requirements", "exact"), "traceabilty": ("traceability", "fuzzy")}


@pytest.mark.parametrize("threshold", [30.0, 60.0, 85.0, 95.0])
def test_near_names_lose_no_pair(spark, threshold):
    dice = random.Random(int(threshold))
    word = lambda: "".join(dice.choice("abcé") for _ in range(dice.randint(0, 12)))
    terms = {word() for _ in range(60)}
    names = {word() for _ in range(60)} | {t[:4] + dice.choice("abé") + t[5:] for t in terms}
    want = {}
    for t in terms:
        for n in names:
            table = [[0] * (len(n) + 1) for _ in range(len(t) + 1)]
            for i, x in enumerate(t):
                for j, y in enumerate(n):
                    table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
            score = 200 * table[-1][-1] / (len(t) + len(n)) if t else 0
            if t and score >= threshold:
                want[t, n] = pytest.approx(score)
    out = linking.near_names(spark.createDataFrame([(t,) for t in terms], "term string"), spark.createDataFrame([(n,) for n in names], "key string"), threshold).collect()
    assert len(out) == len(want) and {(r["term"], r["name"]): r["score"] for r in out} == want


def test_leiden_keeps_communities_connected(spark):
    """A ring of cliques with random links: modularity at least that of the cliques, and every
    community connected."""
    dice = random.Random(7)
    clique = [(f"{k:02}-{i}", f"{k:02}-{j}") for k in range(12) for i in range(6) for j in range(i)]
    ring = [(f"{k:02}-0", f"{(k + 1) % 12:02}-1") for k in range(12)] + [(f"{dice.randrange(12):02}-2", f"{dice.randrange(12):02}-3") for _ in range(6)]
    edges = spark.createDataFrame(sorted({e for e in clique + ring if e[0] != e[1]}), "source string, target string")
    found = community.communities(edges)
    planted = spark.createDataFrame([(f"{k:02}-{i}", str(k)) for k in range(12) for i in range(6)], "node string, community string")
    assert community.modularity(edges, found).first()["modularity"] >= community.modularity(edges, planted).first()["modularity"] - 1e-9
    of = {r["node"]: r["community"] for r in found.collect()}
    near = {n: {n} for n in of}
    for a, b in edges.collect():
        if of[a] == of[b]:
            near[a].add(b)
            near[b].add(a)
    for n, c in of.items():
        reach, todo = set(), [c]
        while todo:
            x = todo.pop()
            if x not in reach:
                reach.add(x)
                todo += near[x]
        assert n in reach


def test_two_triangles_are_two_communities(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("x", "y"), ("y", "z"), ("z", "x")], "source string, target string")
    for found in (community.communities(edges), community.label_propagation(edges, 5)):
        assert found.select("community").distinct().count() == 2
        assert community.modularity(edges, found).first()["modularity"] == pytest.approx(0.5)


def test_gleaning(graph, spark):
    good = '```json\n{"nodes": [{"id": "1", "label": "Concept", "properties": {"name": " New Thing "}}, {"id": "2", "label": "Planet", "properties": {}}], "relationships": [{"type": "REQUIRES", "source": "new thing", "target": "requirement"}]}\n```'
    results = spark.createDataFrame([("c1", good), ("c2", "oops")], "chunk_id string, json string")
    nodes, edges, counts = extraction.glean(graph.nodes, graph.edges, results)
    assert tuple(counts.first()) == (2, 1)
    assert nodes.count() == len(NODES) + 1 and edges.count() == len(EDGES) + 2
    again, edges2, _ = extraction.glean(nodes, edges, results)
    assert again.count() == nodes.count() and edges2.count() == edges.count()


def test_retrieval(graph):
    assert [r["connections"] for r in retrieval.name_search(graph, "TRACE").collect()] == [3, 2, 1]
    near = rows(retrieval.neighbourhood(graph, "requirement").select("rel_type", "direction", "related_name"))
    assert near == [("DEFINES", "<-", "traceability"), ("REQUIRES", "<-", "traceability"), ("REQUIRES", "<-", "traceability")]
    assert retrieval.bm25(graph.chunks, ["traceability"]).first()["id"] == "c1"


def test_report(graph, tmp_path):
    _, text = report.generate(graph)
    assert "**Status**: FAILED" in text and "Merge plurals" in text
    target = tmp_path / "r.md"
    assert report.save(text, str(target)) is None
    assert report.save(text, str(target)) and len(list(tmp_path.iterdir())) == 2


def test_communities_are_the_same_at_every_size(spark):
    edges = spark.createDataFrame([(f"{k}-{i}", f"{k}-{j}") for k in range(9) for i in range(8) for j in range(i) if (i < 4) == (j < 4) or (i, j) == (4, 0)], "source string, target string")
    assert sorted(community.communities(edges, task_edges=5).collect()) == sorted(community.communities(edges).collect())
    # 210,000 edges in 7,000 paths: with so many edges a path is one community.
    paths = spark.range(210_000).selectExpr("concat(id div 30, '-', lpad(id % 30, 2, '0')) as source", "concat(id div 30, '-', lpad(id % 30 + 1, 2, '0')) as target")
    assert community.communities(paths).select("community").distinct().count() == 7000


def test_summary_counts_beyond_the_reports(graph, spark):
    more = spark.createDataFrame([(f"many-{i:03}", "Concept", f"lonely {i}") for i in range(150)], "id string, label string, name string")
    big = graph.with_(nodes=graph.nodes.unionByName(more, allowMissingColumns=True))
    value = lambda **how: {r["check"]: r["value"] for r in checks.summary(big, **how).where("check = 'orphan_entities'").collect()}["orphan_entities"]
    assert value() >= 150 and value(limited=True) == checks.orphan_entities(big).count() == 100


def test_census_counts_what_the_single_checks_count(graph, spark):
    more = spark.createDataFrame([(f"hub-{i:03}", "Tool", f"tool {i}") for i in range(300)], "id string, label string, name string")
    odd = [("n6", "USED_BY", f"hub-{i:03}") for i in range(200)] + [("n4", "REQUIRES", "n4"), ("n5", "MENTIONED_IN", "gone"), ("gone", "MENTIONED_IN", "c3"), ("n9", "MENTIONED_IN", "c1"), ("n9", "MENTIONED_IN", "c2"), ("m1", None, "m2")]
    big = graph.with_(nodes=graph.nodes.unionByName(more, allowMissingColumns=True), edges=graph.edges.unionByName(spark.createDataFrame(odd, EDGE)))
    empty = graph.with_(**{t: getattr(graph, t).limit(0) for t in ("nodes", "edges", "chunks", "webinars")})
    for each in (graph, big, empty):
        assert rows(census.summary(each)) == rows(checks.summary(each))
    assert {r["check"]: r["value"] for r in census.counts(big).collect()}["ghost_entities"] == 3


def test_census_reads_each_table_once(graph, tmp_path, spark):
    stored = graph.with_(**{t: spark.read.schema(getattr(graph, t).schema).parquet(_written(getattr(graph, t), tmp_path / t)) for t in ("nodes", "edges", "chunks", "webinars")})
    scans = lambda frame: frame._jdf.queryExecution().sparkPlan().toString().count("FileScan parquet")
    assert scans(census.points(stored)) == 2 and scans(census.ends(stored.edges)) == 1
    kept = census.census(stored)
    text = census.counts(stored, kept)._jdf.queryExecution().sparkPlan().toString()
    assert text.count(f"{tmp_path}") == text.count("ReadSchema: struct<title:string>") == 1  # the webinars


def _written(frame, path):
    frame.write.parquet(str(path))
    return str(path)


def test_samples_are_those_of_the_checks(graph):
    found = {}
    for r in census.samples(graph, 2).collect():
        found.setdefault(r["check"], []).append(tuple(r["row"]))
    for name, check in checks.COUNTED.items():
        alone = [tuple(None if v is None else str(v) for v in r) for r in check(graph).limit(2).collect()]
        assert sorted(found.get(name, []), key=repr) == sorted(alone, key=repr), name


def test_mention_repair_and_subsets(graph):
    fixed = repairs.mentions(graph)
    assert set(rows(graph.edges)) < set(rows(fixed.edges)) and ("n9", "MENTIONED_IN", "c1") in rows(fixed.edges)
    assert rows(repairs.mentions(fixed).edges) == rows(fixed.edges)
    ids = repairs.apply(graph, repairs.CHUNKS_ONLY)
    assert rows(ids.chunks.select("id", "chunk_id"))[:2] == [("c1", "k1"), ("c2", "a1_chunk_0000")] and ids.nodes is graph.nodes
    cleaned = repairs.apply(graph, repairs.ENTITIES_ONLY)
    assert cleaned.chunks is graph.chunks and "n5" not in {r["id"] for r in cleaned.nodes.collect()}


def test_preview_text(graph, spark):
    lines = repairs.preview_text(repairs.preview(graph)).split("\n")
    assert lines[0] == "Repairs:" and "titles: 2" in lines and "plurals: 1" in lines and not any(x.startswith("total") for x in lines)
    assert repairs.preview_text(spark.createDataFrame([("titles", 0), ("total", 0)], "repair string, n long")) == "Nothing to repair."
    many = spark.createDataFrame([(f"r_{i}", i) for i in range(1, 15)], "repair string, n long")
    assert len(repairs.preview_text(many).split("\n")) == 11


def test_urls_of_another_chapter(spark):
    listed = spark.createDataFrame([(1, "in", "/guide/one/a"), (1, "out", "/guide/two/b"), (1, "near", "/guide/one-more/c"), (2, "in", "/guide/two/b"), (2, "none", None), (3, "free", "/x")], "chapter_number int, title string, url string")
    slugs = spark.createDataFrame([(1, "one"), (1, "one"), (2, "two"), (3, None)], "chapter_number int, slug string")
    assert rows(supplementary.foreign_urls(listed, slugs).select("title")) == [("near",), ("out",)]
    assert not supplementary.foreign_urls(listed, slugs.limit(0)).count()


def test_links_carry_titles_and_resources_need_their_article(spark):
    kind = "article_id string, url string, related array<struct<url:string,title:string>>"
    records = spark.createDataFrame([("a9", "u9", [("u10", "Next"), ("u10", "Next"), ("u10", "More"), ("u9", "Self"), ("u0", "Lost"), (None, "x")]), ("a10", "u10", [("u9", None)]), ("a2", "u2", None)], kind)
    assert rows(supplementary.titled_links(records)) == [("a10", "", "a9"), ("a9", "More", "a10"), ("a9", "Next", "a10")]
    assert rows(supplementary.titled_links(records).select("src", "dst").distinct()) == rows(supplementary.related_links(records).select("src", "dst"))
    found = spark.createDataFrame([("a9-img0", "images", "i", "a9"), ("a1-vid0", "videos", "v", "a1")], "id string, kind string, url string, article_id string")
    assert rows(supplementary.resource_edges(found, records)) == [("a9", "HAS_IMAGE", "a9-img0")] and supplementary.resource_edges(found).count() == 2


def test_a_relation_meets_the_nodes_once(spark):
    """equal relations of many chunks are one row before they meet the nodes of their names."""
    nodes = spark.createDataFrame([(f"a{i}", "Concept", "Gear") for i in range(30)] + [(f"b{i}", "Tool", "bolt") for i in range(20)], "id string, label string, name string")
    json = '{"nodes": [{"id": "x", "label": "Concept", "properties": {"name": "New", "definition": "%s"}}], "relationships": [{"type": "DEFINES", "source": "gear", "target": "BOLT"}]}'
    parsed = extraction.parse_results(spark.createDataFrame([(f"c{i}", json % i) for i in range(40)], "chunk_id string, json string"))
    found = extraction.merge_relationships(nodes, parsed)
    assert sorted(map(tuple, found.collect())) == sorted((f"a{i}", "DEFINES", f"b{j}") for i in range(30) for j in range(20))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 2  # before the joins and after them
    new, mentions = extraction.merge_nodes(nodes, parsed)
    assert [tuple(r)[1:] for r in new.collect()] == [("Concept", "new", "0")] and mentions.count() == 40


def brute_near(nodes):
    """The pairs of nodes, tried one by one."""
    out = []
    for i, label, a in nodes:
        for j, other, b in nodes:
            if a and b and i and j and label == other and i < j and 4 < len(a) < len(b) <= len(a) + 5 and a in b:
                out.append((label, a, b, i, j))
    return sorted(out)


def many_copies():
    """Few names, many nodes of each; ids in both orders, equal ids, nulls."""
    rng = random.Random(5)
    names = ["gear box", "gear boxes", "the gear box", "bolts", "blue bolts", "bolts bolts", "bolt", None]
    nodes = [(f"n{rng.randrange(400):03}", rng.choice(["Concept", "Tool"]), rng.choice(names)) for _ in range(300)]
    return [*nodes, ("z1", "Tool", "last one"), ("a1", "Tool", "the last one"), (None, "Tool", "bolts")]


def test_near_duplicates_of_many_copies(graph, spark):
    """names are paired, not nodes; the first rows, all rows and the count equal brute force."""
    nodes = many_copies()
    frame = spark.createDataFrame(nodes, "id string, label string, name string").repartition(5)
    copied, true = graph.with_(nodes=frame), brute_near(nodes)
    assert len(true) > 1000
    for limit in (1, 50, 300):
        assert [tuple(r) for r in checks.near_duplicates(copied, limit).collect()] == true[:limit]
    assert rows(checks.near_duplicates(copied, None)) == true
    assert checks.near_duplicate_count(copied).first()["value"] == len(true)
    assert checks.near_duplicate_count(graph.with_(nodes=frame.limit(0))).first()["value"] == 0
    # The limited list joins at most limit * limit rows of its own making to the nodes.
    assert checks.near_names(frame).count() == len({x[:3] for x in brute_near([(f"{i}", x, n) for i, (x, n) in enumerate(sorted({(x, n) for _, x, n in nodes if n}))] + [(f"{99 - i}", x, n) for i, (x, n) in enumerate(sorted({(x, n) for _, x, n in nodes if n}))])})


def test_limited_summary_comes_from_the_census(graph):
    """the counts of the lists, without a plan for each list."""
    assert rows(census.summary(graph, limited=True)) == rows(checks.summary(graph, limited=True))
    assert checks.LIMITS["orphan_entities"] == 100 and checks.LIMITS["invalid_patterns"] == 20 and set(checks.LIMITS) == checks.REPORTED


def test_census_moves_an_edge_as_a_bit(graph, spark):
    """a stored row for each point that has edges, whatever their types, labels and number, besides mentions and unlisted types."""
    tools = spark.createDataFrame([(f"t{i}", label, f"tool {i}") for i, label in enumerate(rules.ENTITY_LABELS * 3)], "id string, label string, name string")
    many = [(f"t{i}", kind, f"t{j}") for i in range(36) for j in range(3) for kind in rules.RELATIONSHIPS]
    odd = [("t1", "ODD", "t2"), ("t2", "ODD", "t2"), ("t1", "", "t2"), ("t2", None, "t2"), ("t3", "=", "t0"), ("gone", "ODD", "t2"), ("t1", "ODD", "gone"), ("c1", "REQUIRES", "t2"), ("c3", "MENTIONED_IN", "c3"), (None, "MENTIONED_IN", "c4"), ("n3", None, None)]
    edges = graph.edges.unionByName(spark.createDataFrame(many + odd, EDGE))
    big = graph.with_(nodes=graph.nodes.unionByName(tools, allowMissingColumns=True), edges=edges)
    assert rows(census.summary(big)) == rows(checks.summary(big))
    again = big.with_(edges=edges.unionByName(edges))
    assert rows(census.summary(again)) == rows(census.summary(big))
    kept = census.census(again).incidence
    linked = {x for s, _, d in [*EDGES, *many, *odd] for x in (s, d)}
    mentions = {(s, d) for s, t, d in [*EDGES, *many, *odd] if t == "MENTIONED_IN" and s}
    unlisted = {(t, d) for _, t, d in odd if t not in rules.RELATIONSHIPS and t != "MENTIONED_IN"}
    assert kept.count() <= len(linked) + len(mentions) + len(unlisted) < len(many) / 10
