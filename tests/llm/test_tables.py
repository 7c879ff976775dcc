"""Operators over the small tables against brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from itertools import accumulate

import numpy as np
import pytest

import corpus_pipeline
from kgloom.llm import html, language, packing, pieces, pii, queries, runlength
from kgloom.llm.common import read_table


@pytest.fixture(scope="module")
def documents(spark, small):
    return {r["doc_id"]: r for r in read_table(spark, small, "documents").collect()}


def all_pairs(texts: dict) -> tuple[dict, dict]:
    """The shingles of each text, and the least id of its near-duplicate group."""

    def shingles(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())

    sets = {d: shingles(t) for d, t in texts.items()}
    group = {d: d for d in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((group[a], group[b]))
                group = {d: low if g == high else g for d, g in group.items()}
    return sets, group


def test_near_duplicates_match_all_pairs(spark, small, documents):
    sets, group = all_pairs({d: r["text"] for d, r in documents.items()})
    out = queries.op1_minhash(spark, small).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in out} == {d: (len(s), group[d], group[d] == d) for d, s in sets.items()}


def test_packing_fills_batches(spark, small, documents):
    out = queries.op3_packing(spark, small).collect()
    words = {d: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for d, r in documents.items()}
    total, batches = Counter(), defaultdict(list)
    for r in out:
        total[r["doc_id"]] += r["n_tokens"]
        assert r["start"] == r["piece"] * packing.MAX_LENGTH and r["n_tokens"] <= r["padded"]
        batches[r["batch_id"]].append(r)
    assert total == Counter(words) or {d: total[d] for d in words} == words
    for rows in batches.values():
        assert len({r["bucket"] for r in rows}) == 1
        assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
        assert len(rows) == 1 or len(rows) * rows[0]["padded"] <= packing.TOKEN_BUDGET
    # The least padded size of all: best[j] over the first j lengths, one bucket more each round.
    held = sorted(Counter(r["n_tokens"] for r in out).items())
    before = list(accumulate((n for _, n in held), initial=0))
    best = [0] + [float("inf")] * len(held)
    for _ in range(packing.BUCKETS):
        best = [min([best[j], *[best[i] + held[j - 1][0] * (before[j] - before[i]) for i in range(j)]]) for j in range(len(held) + 1)]
    assert sum(r["padded"] for r in out) == best[-1] and len({r["bucket"] for r in out}) <= packing.BUCKETS
    again = queries.op3_packing(spark, small).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, out))


def test_fingerprints_follow_the_order(spark, small, documents):
    out = {r["doc_id"]: r for r in queries.op4_fingerprint(spark, small).collect()}
    order = sorted(documents, reverse=True)
    texts = [documents[d]["text"] or "" for d in order]
    windows = {d: Counter(t.encode()[i : i + 12] for i in range(len(t.encode()) - 11)) for d, t in zip(order, texts, strict=True)}

    def exact(one, two, a, b):
        """The Dice coefficient of windows, or that of the common beginning and end."""
        one, two = one.encode(), two.encode()
        if not one or not two:
            return float(one == two)
        head = next((i for i, (x, y) in enumerate(zip(one, two, strict=False)) if x != y), min(len(one), len(two)))
        tail = next((i for i, (x, y) in enumerate(zip(reversed(one), reversed(two), strict=False)) if x != y), min(len(one), len(two)))
        kept = 2 * min(head + tail, len(one), len(two)) / (len(one) + len(two))
        return max(kept, 2 * (a & b).total() / max(1, (a + b).total()))

    off = []
    for d, text, other in zip(order, texts, [*texts[1:], texts[0]], strict=True):
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        assert out[d]["n_chars"] == len(text)
        assert out[d]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert (out[d]["fingerprint"] == out[d]["edited_fingerprint"]) == (text == edited)
        assert 0 <= out[d]["near_edited"] <= 1 and 0 <= out[d]["near_next"] <= 1
        after = order[(order.index(d) + 1) % len(order)]
        changed = Counter(edited.encode()[i : i + 12] for i in range(len(edited.encode()) - 11))
        for got, want in ((out[d]["near_edited"], exact(text, edited, windows[d], changed)), (out[d]["near_next"], exact(text, other, windows[d], windows[after]))):
            assert abs(got - want) < 0.25
            off.append(abs(got - want))
        assert len(text) < 100 or out[d]["near_edited"] > 0.4
    assert np.mean(off) < 0.05
    prints = defaultdict(set)
    for d, text in zip(order, texts, strict=True):
        prints[text].add(out[d]["fingerprint"])
    assert all(len(p) == 1 for p in prints.values()) and len(set().union(*prints.values())) == len(prints)


def test_language_on_held_out_rows(spark, medium):
    truth = {r["doc_id"]: r["lang"] for r in read_table(spark, medium, "documents").collect()}
    out = [r for r in queries.op6_language(spark, medium).collect() if r["held_out"]]
    assert len(out) > 100 and all(0 <= r["score"] <= 1 for r in out)
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in out]) > 0.97


def test_language_matches_brute_force(spark, small, documents):
    """Features, margins and decoding of the query in plain Python; weights that solve the ridge
    equations."""
    model = language.train(read_table(spark, small, "documents"))
    code, weights = model.code.tolist(), model.weights.astype(float)
    for r in queries.op6_language(spark, small).collect():
        raw = [b if b >= 128 else b | 32 if chr(b).isalpha() else 32 for b in (documents[r["doc_id"]]["text"] or "").encode()]
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        if not any(c.isalpha() for c in documents[r["doc_id"]]["text"] or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0)
            continue
        grams = Counter((a << 8 | b) * 0x9E3779B1 % 2**32 >> 20 for a, b in zip(raw, raw[1:], strict=False))
        grams.update((a << 16 | b << 8 | c) * 0x85EBCA77 % 2**32 >> 20 for a, b, c in zip(raw, raw[1:], raw[2:], strict=False))
        margins = [bias + sum((n / grams.total()) ** 0.5 * weights[g, k] for g, n in grams.items()) for k, bias in enumerate(model.bias)]
        loss = {v: sum(max(0, 1 - bit * m) ** 2 for bit, m in zip(word, margins, strict=True)) for v, word in zip(model.languages, code, strict=True)}
        share = {v: np.exp(-4 * x / len(margins)) for v, x in loss.items()}
        assert r["score"] == pytest.approx(share[r["lang_pred"]] / sum(share.values()), abs=1e-3)
        assert loss[r["lang_pred"]] == pytest.approx(min(loss.values()), abs=1e-3)

    rng = np.random.default_rng(1)
    for rows, width in ((30, 50), (50, 30)):
        x, names = rng.normal(size=(rows, width)), [f"l{i % 3}" for i in range(rows)]
        made = language.fit(x, names)
        target = made.code[[int(v[1:]) for v in names]]
        assert np.allclose(x.T @ (x @ made.weights + made.bias - target), -language.RIDGE * rows**0.5 * made.weights, atol=1e-3)


def test_pages_keep_the_article_only(spark, small):
    pages = {r["page_id"]: r["html"] for r in read_table(spark, small, "pages").collect()}
    for r in queries.op7_html(spark, small).collect():
        body = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        parts = re.split(r"</?(?:p|h1)[^>]*>", body)
        plain = [" ".join(re.sub(r"<[^>]+>", " ", p).replace("&amp;", "&").split()) for p in parts]
        assert r["text"] == "\n\n".join(p for p in plain if p)
        assert r["n_chars"] == len(r["text"])


def best_score(use: pieces.Coder, text: str) -> float:
    """The best score of any segmentation of a text with marks, by trying all of them."""
    score = {p: s for p, _, s in use.vocabulary.pieces}
    longest = max(map(len, score))
    best = [0.0]
    for j in range(1, len(text) + 1):
        best.append(max([best[j - 1] + use.floor, *[best[i] + score[text[i:j]] for i in range(max(0, j - longest), j) if text[i:j] in score]]))
    return best[-1]


def score_of(use: pieces.Coder, ids: list[int]) -> float:
    score = {i: s for _, i, s in use.vocabulary.pieces}
    single = b"".join(use.bytes[i] for i in ids if i not in score)
    return sum(score[i] for i in ids if i in score) + use.floor * len(single.decode())


def test_pieces_of_the_table_are_the_best(spark, small, documents):
    use = pieces.Coder(pieces.Vocabulary.load(queries.TOKENIZER))
    for r in queries.op8_sentencepiece(spark, small).collect():
        text = documents[r["doc_id"]]["text"] or ""
        assert r["round_trip"] and r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        ids = use.encode(text)
        assert (r["n_pieces"], r["ids_sha256"]) == (len(ids) // 4, hashlib.sha256(ids).hexdigest())
        assert score_of(use, np.frombuffer(ids, "<u4").tolist()) == pytest.approx(best_score(use, text and "▁" + text.replace(" ", "▁")))


def covered(raw: dict, size: int) -> dict:
    """The maximal runs of each text that strings of `size` bytes, found twice in all, cover."""
    count, out = Counter(), {}
    for text in raw.values():
        count.update(text[i : i + size] for i in range(len(text) - size + 1))
    for d, text in raw.items():
        out[d] = []
        for i in range(len(text) - size + 1):
            if count[text[i : i + size]] > 1:
                if out[d] and i <= out[d][-1][1]:
                    out[d][-1] = (out[d][-1][0], i + size)
                else:
                    out[d].append((i, i + size))
    return out


@pytest.mark.parametrize("options", [{}, {"hot": 2, "bucket_bytes": 5000}])
def test_repeats_match_brute_force(spark, small, documents, options):
    raw = {d: (r["text"] or "").encode() for d, r in documents.items()}
    out = {r["doc_id"]: r for r in runlength.remove_repeats(read_table(spark, small, "documents"), **options).collect()}
    gone, passages = covered(raw, 400), covered(raw, 256)
    for d, text in raw.items():
        kept, at = [], 0
        for a, b in gone[d]:
            kept.append(text[at:a])
            at = b
        long = [b - a for a, b in passages[d] if len(text[a:b].split()) > 50]
        assert (out[d]["n_bytes"], out[d]["n_removed"], out[d]["n_spans"]) == (len(text), sum(b - a for a, b in gone[d]), len(gone[d]))
        assert out[d]["kept_sha256"] == hashlib.sha256(b"".join([*kept, text[at:]])).hexdigest()
        assert (out[d]["n_passages"], out[d]["n_passage_bytes"]) == (len(long), sum(long))


def test_passages_of_over_fifty_words(spark):
    """A passage of 55 short words is found though it has under 400 bytes; one of 30 is not."""
    words = [f"w{i:04d}" for i in range(4000)]
    passage, short = " ".join(words[:55]), " ".join(words[100:130])
    texts = [" ".join(words[1000 + 90 * i : 1090 + 90 * i]) for i in range(6)]
    rows = [(0, f"{texts[0]} {passage} {texts[1]}"), (1, f"{texts[2]} {passage}"), (2, f"{texts[3]} {short}"), (3, f"{short} {texts[4]}"), (4, texts[5]), (5, None)]
    out = {r["doc_id"]: r for r in runlength.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [out[i]["n_passages"] for i in range(6)] == [1, 1, 0, 0, 0, 0]
    assert all(out[i]["n_removed"] == 0 for i in range(6))
    assert len(passage) <= out[0]["n_passage_bytes"] <= len(passage) + 4


def test_base_spans_of_personal_data(spark, medium):
    out = {r["doc_id"]: r for r in queries.op10_pii(spark, medium).collect()}
    rules = [
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda d, t: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda d, t: all(int(p) <= 255 for p in t.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda d, t: 14 <= len(d) <= 19 and pii.luhn(d)),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda d, t: 10 <= len(d) <= 15),
    ]
    for r in read_table(spark, medium, "documents").collect():
        spans = []
        for kind, (pattern, good) in enumerate(rules):
            for m in re.finditer(pattern, r["text"] or ""):
                if good(re.sub(r"[^0-9]", "", m[0]), m[0]):
                    spans.append((m.start(), kind, m.end()))
        spans.sort()
        text = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in spans)
        assert out[r["doc_id"]]["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert set(text.split(",")) <= set(out[r["doc_id"]]["spans"].split(","))


def test_pipeline_stages_take_effect(spark, small, documents):
    docs = read_table(spark, small, "documents")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, small).collect(), docs.schema)
        assert docs.columns == corpus_pipeline.COLUMNS
        assert docs.count() <= before
        before = docs.count()
    texts = [r["text"] for r in docs.collect()]
    assert len(texts) == len(set(texts)) < len(documents)
    field = pii.fit(docs)
    assert not any(pii.base_spans(t) for t in texts), field
    ids = {r["doc_id"] for r in corpus_pipeline.run(spark, small).collect()}
    assert ids == {r["doc_id"] for r in docs.collect()}
    # By brute force: letters, then one of equal texts (the longest, least id), then one of each group.
    equal = defaultdict(list)
    for d, r in documents.items():
        if any(c.isalpha() for c in r["text"] or ""):
            equal[re.sub(r"[\x20\x09-\x0D]", "", r["text"])].append((-len(r["text"]), d))
    single = {min(same)[1] for same in equal.values()}
    _, group = all_pairs({d: documents[d]["text"] for d in single})
    assert ids == {d for d in single if group[d] == d}


def test_pieces_are_the_best_segmentation():
    use = pieces.Coder(pieces.Vocabulary.load(queries.TOKENIZER))
    for text in ("▁the▁onthe", "▁éèçon", "▁a\u0001b", "▁▁▁x", "日本語のto", "zzzz"):
        assert score_of(use, use.segment(text)) == pytest.approx(best_score(use, text))
    for text in ("", " ", "a", "  two  spaces ", "mark ▁ here▁", "▁▁ x", "tab\tand\nline\n", "\u0000nul", "🙂 end"):
        assert use.decode(use.encode(text)) == text


def test_long_units_take_little_memory():
    """A long text without spaces, there and back, in bounded memory."""
    import tracemalloc

    use = pieces.Coder(pieces.Vocabulary.load(queries.TOKENIZER))
    text = "abcdefgh\u00e9" * 60_000
    tracemalloc.start()
    ids = use.encode(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert use.decode(ids) == text and peak < 50 * len(text) and not use.known
    # The tables of units may be emptied at any time without a change.
    words = " ".join(f"w{i} x{i % 7}" for i in range(300))
    whole = use.encode(words)
    use.known.clear()
    use.older.clear()
    assert use.encode(words) == whole


def test_html_parser_cases():
    root = html.parse("<div class='sidebar'>no</div><main><p>One &amp; two<p>Three<br>four<ul><li>a<li>b</ul><form>x</form></main>")
    assert html.main_text(root) == "One & two\n\nThree four\n\na\n\nb"
    assert html.main_text(html.parse("")) == ""
    assert html.main_text(html.parse("<article><h1>T</h1><div class='comments'>c</div><!-- x --><p>a<b>b</b> c</p></article>")) == "T\n\nab c"


def test_html_drops_by_name():
    page = """<body class="has-sidebar"><header>Site</header><div class="layout with-sidebar"><main><article><div class="header"><h1>T</h1></div><p>One</p>
    <div id="cookie-notice">c</div><aside>a</aside><div role="search">s</div><p hidden>h</p></article></main><section class="comments"><article class="comment"><p>Nice</p></article></section></div><footer>f</footer></body>"""
    assert html.main_text(html.parse(page)) == "T\n\nOne"
    page = """<div class="menu">m</div><article><h1>T</h1><p>One</p></article><div class="comments"><article class="comment"><p>Nice</p></article></div>"""
    assert html.main_text(html.parse(page)) == "T\n\nOne"


def test_codewords_are_apart():
    for k in (2, 3, 4, 5, 9):
        code = language.codewords(k)
        assert len(code) == k and min((a != b).sum() for i, a in enumerate(code) for b in code[:i]) >= (1 if k < 3 else 2)


def test_templates_of_a_host_carry_the_result(spark):
    """Plain divs without telling names: what ten different pages of a host share goes, counted
    by brute force; without templates it would stay."""
    blocks = {"menu": "<div class='x1'><div>Start</div><div>Docs</div></div>", "notice": "<div class='x7'><p>We keep records of all visits to this place.</p></div>", "rare": "<div class='x3'><p>Seen on nine pages only, so it stays.</p></div>"}
    rows = []
    for host, pages in (("a.example", 14), ("b.example", 3)):
        for i in range(pages):
            rare = blocks["rare"] if i < 9 else ""
            rows.append((len(rows), f"https://{host}/{i}", f"<body>{blocks['menu']}<div class='x2'><h1>Title {host} {i}</h1><p>Body {i} of {host}.</p>{rare}</div>{blocks['notice']}</body>"))
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    seen = Counter((url.split("/")[2], name) for _, url, page in rows for name, block in blocks.items() if block in page)
    out = {r["page_id"]: r["text"] for r in html.extract(table).collect()}
    off = {r["page_id"]: r["text"] for r in html.extract(table, least=1000).collect()}
    plain = {"menu": "Start\n\nDocs", "notice": "We keep records of all visits to this place.", "rare": "Seen on nine pages only, so it stays."}
    for i, url, page in rows:
        host, n = url.split("/")[2:]
        whole = [("menu", plain["menu"]), ("", f"Title {host} {n}"), ("", f"Body {n} of {host}."), *[("rare", plain["rare"])] * (blocks["rare"] in page), ("notice", plain["notice"])]
        assert out[i] == "\n\n".join(t for name, t in whole if not name or seen[host, name] < html.TEMPLATE_PAGES)
        assert off[i] == "\n\n".join(t for _, t in whole)
    assert out == {r["page_id"]: r["text"] for r in html.extract(table, few=0).collect()}


def test_html_names_and_articles():
    page = "<article><h1>T</h1><p class='social-history'>one</p><section class='share-price'><p>two</p></section><div id='form-follows'><p>three</p></div><div class='post-share'><a>tweet</a></div></article>"
    assert html.main_text(html.parse(page + "<article class='card'><h2>Other</h2><p>story</p></article>")) == "T\n\none\n\ntwo\n\nthree"
    assert html.main_text(html.parse("<main><p>lead</p><article><h1>T</h1><p>a</p></article><p>rest</p></main>")) == "lead\n\nT\n\na\n\nrest"
    assert html.main_text(html.parse("<main><h1>T</h1><article class='card'><p>Other</p></article><article><p>part</p></article></main>")) == "T\n\npart"
