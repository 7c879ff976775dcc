"""Merkle manifest, SimHash near-duplicates and whitening against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash

from kgloom.llm import manifest, oracles, queries, simhash, whitening
from kgloom.llm.common import read_table

DOCS = "doc_id long, text string, lang string, source string, n_chars long, g string, leaf string, print long, component long, digest string"


def docs_of(spark, rows):
    return spark.createDataFrame([(d, t, lang, "s" if d and d % 2 else None, None if t is None else len(t), "x", "y", 1, 2, "z") for d, t, lang in rows], DOCS)


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def brute_manifest(rows):
    """The contract, row by row, as a multiset."""
    text = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, t: sha(text(r["doc_id"]), text(r["source"]), text(r["lang"]), text(r["n_chars"]), text(t))
    by_lang = defaultdict(list)
    for r in rows:
        by_lang[r["lang"]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), r))
    order = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {lang: levels([x[2] for x in sorted(by_lang[lang], key=lambda x: x[:3])]) for lang in order}
    top = levels([trees[lang][-1][0] for lang in order])

    def path(tree, i):
        out = []
        for nodes in tree[:-1]:
            first = i // 8 * 8
            out.append(("".join(nodes[first:i]), "".join(nodes[i + 1 : first + 8])))
            i //= 8
        return out

    out = Counter()
    for at, lang in enumerate(order):
        for i, (_, _, x, r) in enumerate(sorted(by_lang[lang], key=lambda x: x[:3])):
            steps = path(trees[lang], i) + path(top, at)
            tampered = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
            low = r["text"] and re.sub("[A-Z]", lambda m: m[0].lower(), r["text"])
            folded = leaf(r, low) if tampered else x
            for left, right in steps:
                folded = sha(left, folded, right)
            out[(r["doc_id"], x, trees[lang][-1][0], top[-1][0], sha(*[a + b for a, b in steps]), folded, folded == top[-1][0])] += 1
    return out


def as_counter(frame):
    return Counter(tuple(r) for r in frame.collect())


def test_manifest_of_the_small_table(spark, small):
    want = brute_manifest(read_table(spark, small, "documents").collect())
    got = as_counter(queries.op11_manifest(spark, small))
    assert got == want and {k[-1] for k in got} == {True, False}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    assert Counter(con.execute(oracles.ORACLES["op11_manifest"]).fetchall()) == want


def sparse_ids():
    """Negative, huge, null and repeated ids, identical rows, several tiers, ten languages."""
    rng = random.Random(5)
    rows = [(rng.choice([-(1 << 63), (1 << 63) - 1, -5, 0, 3]) if i % 50 == 0 else rng.randrange(-(1 << 40), 1 << 40), f"Text {i}", "en") for i in range(1300)]
    rows += [(None, f"N{i % 40}", "en") for i in range(300)] + [(77, f"r{i % 70}", "en") for i in range(400)] + [(78, "Same", "en")] * 600
    rows += [(i, None if i % 3 else "", None) for i in range(9)] + [(i, "A", "") for i in range(8)] + [(1, "one", "fr")]
    return rows + [(i, "Żółć é" * i, lang) for lang in ("de", "é", "z", "Z", "pl", "it") for i in range(3, 70, 5)]


@pytest.mark.parametrize("heavy", [manifest.HEAVY, 100])
def test_manifest_of_odd_rows(spark, heavy):
    docs = docs_of(spark, sparse_ids()).repartition(7)
    assert as_counter(manifest.manifest(docs, heavy)) == brute_manifest(docs.collect())


def test_manifest_of_few_rows(spark):
    assert manifest.manifest(docs_of(spark, [])).collect() == []
    for rows in ([(None, None, None)], [(3, "Only", "en")], [(3, "A", "en"), (3, "A", "en")], [(i, "x", "en") for i in range(513)]):
        docs = docs_of(spark, rows)
        assert as_counter(manifest.manifest(docs)) == brute_manifest(docs.collect())


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(prints):
    """The class of every fingerprint: all pairs within two bits, then what can be reached."""
    values = np.array(sorted(set(prints)), np.uint64)
    part = {int(v): int(v) for v in values}

    def find(x):
        while part[x] != x:
            part[x] = part[part[x]]
            x = part[x]
        return x

    for i, v in enumerate(values):
        apart = np.unpackbits((values[i + 1 :] ^ v).view(np.uint8).reshape(-1, 8), axis=1).sum(axis=1)
        for w in values[i + 1 :][apart <= 2]:
            part[find(int(v))] = find(int(w))
    return {v: find(v) for v in part}


def brute_simhash(rows):
    prints = [(d, brute_print(t)) for d, t in rows]
    part = groups(p for _, p in prints)
    low = {}
    for d, p in prints:
        if d is not None:
            low[part[p]] = min(d, low.get(part[p], d))
    return Counter((d, f"{p:016x}", low.get(part[p])) for d, p in prints)


@pytest.mark.parametrize("folder", ["small", "medium"])
def test_simhash_matches_all_pairs(spark, folder, request):
    folder = request.getfixturevalue(folder)
    rows = [(r["doc_id"], r["text"]) for r in read_table(spark, folder, "documents").collect()]
    got = as_counter(queries.op12_simhash(spark, folder))
    assert got == brute_simhash(rows)
    assert len({k[2] for k in got}) < len(got)


def test_simhash_of_odd_rows(spark):
    long = " ".join(f"w{i * 7919 % 9973}" for i in range(70_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "ONE"), (5, "one"), (None, "one"), (None, "alone with none"), (6, "one two"), (7, "one  two"), (8, "a b c"), (9, "É a b"), (10, long), (11, long + " x")]
    got = as_counter(simhash.near_duplicates(docs_of(spark, [(d, t, None) for d, t in rows])))
    assert got == brute_simhash(rows)
    assert got[(1, "0" * 16, 1)] == 1 and got[(3, "0" * 16, 1)] == 1
    assert simhash.near_duplicates(docs_of(spark, [])).collect() == []
    assert as_counter(simhash.near_duplicates(docs_of(spark, [(3, "x", None)] * 4)))[(3, f"{brute_print('x'):016x}", 3)] == 4


@pytest.mark.parametrize("hot", [simhash.HOT, 5, 1])
def test_links_of_crowded_buckets_are_whole(spark, monkeypatch, hot):
    """Fingerprints around a few centres: bits that never change, hot buckets, chains of links."""
    monkeypatch.setattr(simhash, "HOT", hot)
    rng = random.Random(hot)
    centres, made = [rng.getrandbits(64) & 0xFFFF0FFFFFF | 1 << 63 for _ in range(12)], set()
    for i in range(1500):
        x = centres[i % 12 if i % 3 else 0]
        for b in rng.sample(range(64), rng.randrange(9)):
            x ^= 1 << b
        made.add(x)
    prints = spark.createDataFrame([(simhash.signed(x), x % 1000) for x in made], "print long, low long")
    want = groups(made)
    part = {x: x for x in made}

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    for r in simhash.links(prints).collect():
        a, b = r["a"] % (1 << 64), r["b"] % (1 << 64)
        assert a != b and want[a] == want[b] and (a ^ b).bit_count() <= 2
        part[find(a)] = find(b)
    assert len({find(x) for x in made}) == len(set(want.values()))


def test_correlated_bits_share_a_part():
    rng = np.random.default_rng(0)
    base = rng.random((4000, 4)) < 0.5
    bits = np.stack([base[:, b % 4] ^ (rng.random(4000) < 0.1) for b in range(64)], axis=1).astype(float)
    assert sorted(simhash.grouped(bits.T @ bits, 4000, 4)) == [list(range(k, 64, 4)) for k in range(4)]


def test_budgets_are_optimal():
    from itertools import product

    rng = random.Random(0)
    for _ in range(50):
        costs = [[0.0, *sorted(rng.random() for _ in range(3))] for _ in range(rng.randint(1, 4))]
        cost, chosen = simhash.budgets(costs, 3)
        best = min(sum(row[b] for row, b in zip(costs, bs, strict=True)) for bs in product(range(4), repeat=len(costs)) if sum(bs) == 3)
        assert sum(chosen) == 3 and abs(cost - best) < 1e-12


def brute_whitening(vectors, components=32):
    x = np.floor(64.0 * np.array(vectors, np.float64)) + 1_000_000
    n = len(x)
    centred = x - x.mean(axis=0)
    v = centred.T @ centred / n
    values, axes = np.linalg.eigh(v)
    order = np.argsort(-values)[:components]
    exact = x.astype(np.int64).astype(object)
    deviation = ((n * exact - exact.sum(axis=0)) ** 2).sum(axis=1)
    return centred @ axes[:, order] / np.sqrt(values[order]), values[order] / np.trace(v), deviation, n


def same_whitening(rows, vectors, ids):
    white, explained, deviation, n = brute_whitening(vectors)
    got = defaultdict(dict)
    for r in rows:
        got[r["vec_id"]][r["component"]] = r
    assert len(rows) == len(ids) * white.shape[1] and set(got) == set(ids)
    signs = [np.sign(white[0, k] * got[ids[0]][k + 1]["whitened"]) for k in range(white.shape[1])]
    for i, key in enumerate(ids):
        for k in range(white.shape[1]):
            r = got[key][k + 1]
            assert r["n"] == n and r["deviation"] == deviation[i]
            assert abs(r["whitened"] - signs[k] * white[i, k]) < 1e-6 and abs(r["explained"] / explained[k] - 1) < 1e-8
    assert {r["identity_error"] for r in rows} == {rows[0]["identity_error"]} and rows[0]["identity_error"] < 1e-9


def test_whitening_of_the_small_table(spark, small):
    table = read_table(spark, small, "embeddings").collect()
    same_whitening(queries.op13_whitening(spark, small).collect(), [r["embedding"] for r in table], [r["vec_id"] for r in table])


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(1)
    good = (rng.normal(size=(60, 5)) * [1, 2, 30, 4, 5]).tolist()
    bad = [None, [], [1.0, None, 1.0, 1.0, 1.0], [1.0, float("nan"), 0.0, 0.0, 0.0], [float("inf"), 0.0, 0.0, 0.0, 0.0], [1.0, 2.0], [1e300, 0.0, 0.0, 0.0, 0.0]]
    schema = "vec_id long, embedding array<double>, n long, x string, whitened string"
    frame = lambda rows: spark.createDataFrame([(i, v, 1, "a", "b") for i, v in rows], schema)
    rows = whitening.whiten(frame([*enumerate(good), *((100 + i, b) for i, b in enumerate(bad))])).collect()
    same_whitening(rows, good, list(range(60)))
    assert whitening.whiten(frame([])).collect() == [] and whitening.whiten(frame([(1, [2.0, 3.0])] * 3)).collect() == []
    twice = whitening.whiten(frame([(None, v) for v in good] + [(None, good[0])])).collect()
    assert len(twice) == 61 * 5 and twice[0]["n"] == 61
    # A dimension that never changes and one that repeats another: three components are left.
    flat = [[a, b, c, 7.0, a] for a, b, c, _, _ in good]
    assert {r["component"] for r in whitening.whiten(frame(enumerate(flat))).collect()} == {1, 2, 3}


def test_whitening_is_exact_beyond_64_bits(spark):
    vectors = [[1e9, -1e9], [-1e9, 1e9], [0.0, 0.0], [1.0, 5.0]]
    got = {r["vec_id"]: r["deviation"] for r in whitening.whiten(spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")).collect()}
    want = brute_whitening(vectors)[2]
    assert got == {i: int(d) if d < 1 << 63 else None for i, d in enumerate(want)} and None in got.values()


def test_wide_triangles_are_summed_in_passes(spark, monkeypatch):
    monkeypatch.setattr(whitening, "PAIRS_PER_PASS", 4)
    vectors = np.random.default_rng(2).normal(size=(30, 4)).tolist()
    same_whitening(whitening.whiten(spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")).collect(), vectors, list(range(30)))


def test_hostile_pages_take_seconds():
    """Nested, stray and unfinished tags: the cost grows with the page."""
    import time

    from kgloom.llm import html

    n = 100_000
    for page in ("<div>" * n + "x", "<b " * n, '<a x="' * n + ">", "</div>" * n, "<div class=share>" * n + "x", "<p><table><td>" + "<div>" * n, "<a href=/x>y" * n, "<div>" * 300 + "<h1>a</h1>" * n):
        began = time.process_time()
        root = html.parse("<body>" + page)
        html.hashed(root)
        html.around(root)
        html.main_text(root)
        assert time.process_time() - began < 20
    deep = "<article>" + "".join(f"<div>t{i}" for i in range(600)) + "</div>" * 600 + "<p>after</p></article><p>outside</p>"
    assert html.main_text(html.parse(deep)).split() == [f"t{i}" for i in range(600)] + ["after"]


def test_extracted_pages_with_repeats_ties_and_long_ones(spark):
    from kgloom.llm import html

    long = "<article>" + "".join(f"<p>word {i} of a long page</p>" for i in range(20_000)) + "</article>"
    rows = [(1, "https://h/1", long), (1, "https://h/1", long), (2, "https://h/2", "<article><p>a</article>"), (2, "https://h/9", "<article><p>b</article>"), (None, None, "<article><p>a</article>")]
    got = Counter((r["page_id"], r["url"], r["n_chars"], r["text"][:20]) for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect())
    size = sum(len(f"word {i} of a long page") + 2 for i in range(20_000)) - 2
    assert got == {(1, "https://h/1", size, "word 0 of a long pag"): 2, (2, "https://h/2", 1, "a"): 1, (2, "https://h/9", 1, "b"): 1, (None, None, 1, "a"): 1}


def test_rows_of_one_id_are_packed_in_many_shards(spark):
    from kgloom.llm import packing

    rows = [(None if i % 2 else 7, f"text number {i}") for i in range(400)]
    out = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), shard_rows=20).collect()
    shards = Counter(tuple(r["batch_id"].split("-")[:2]) for r in out)
    assert len(out) == 400 and len(shards) == 20 and max(shards.values()) < 60
