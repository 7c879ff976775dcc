"""Nulls, empty and very long texts, ties, repeated rows, empty tables, extra columns."""

import random

import pytest

import corpus_pipeline
from kgloom.llm import exact, fingerprint, html, language, minhash, packing, pieces, pii, queries, runlength, secrets

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, component long, band string, text_sha256 string, node long, spans string"


def words(n, seed=0):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))


LONG = words(60_000, 9)
TEXTS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (5, "one"), (6, "o ne"), (None, "one"), (None, None), (7, words(300, 1)), (8, words(300, 1)), (9, words(300, 1) + " x"),
    (10, LONG), (11, "12345 !!"), (12, "🙂é\u0000z"), (13, words(200, 2)), (13, words(200, 3)), (14, 'token = "abcdef123456" a@b.co +1 (743) 555-3824'),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(d, t, "en" if i % 3 else None, None, None, 1, "b", "h", 2, "s") for i, (d, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def found(frame, key="doc_id"):
    out = {}
    for r in frame.collect():
        out.setdefault(r[key], []).append(r)
    return out


OPERATORS = {
    "minhash": minhash.near_duplicates,
    "packing": packing.pack,
    "fingerprint": fingerprint.neighbours,
    "exact": exact.exact_duplicates,
    "language": lambda d: language.predict(d, language.train(d)),
    "pieces": lambda d: pieces.digest(d, queries.TOKENIZER),
    "runlength": runlength.remove_repeats,
    "pii": lambda d: pii.scan(d, pii.fit(d)),
    "secrets": lambda d: secrets.report(secrets.by_path(d, secrets.scan(d))),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_row(docs, empty, name):
    got = found(OPERATORS[name](docs))
    assert {k: len(v) for k, v in got.items() if k != 10} == {k: sum(d == k for d, _ in TEXTS) for k in {d for d, _ in TEXTS} - {10}}
    assert OPERATORS[name](empty).collect() == []


def test_near_duplicates(docs):
    got = {k: (v[0]["n_shingles"], v[0]["component_id"], v[0]["kept"]) for k, v in found(minhash.near_duplicates(docs)).items()}
    assert got[1] == (0, 1, True) and got[2] == (0, 2, True) and got[3] == (0, 3, True)
    assert got[4] == (1, 4, True) and got[5] == (1, 4, False) and got[6][1] == 6
    assert got[8] == (296, 7, False) and got[9] == (297, 7, False) and got[10][2]


def test_exact_duplicates(docs):
    got = found(exact.exact_duplicates(docs))
    assert {r["keep_id"] for k in (4, 5, 6) for r in got[k]} == {6} and got[6][0]["group_size"] == 5
    assert {r["keep_id"] for r in got[3]} == {3} and got[1][0]["group_size"] == 4
    assert sorted(map(tuple, exact._by_text(docs).collect()), key=repr) == sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"], r["kept"]) for v in got.values() for r in v), key=repr)


def test_golomb_codes():
    import numpy as np

    rng = np.random.default_rng(0)
    for n, bits in ((0, 20), (1, 40), (1000, 38), (5000, 62)):
        values = np.unique(rng.integers(0, 1 << bits, n))
        assert (exact.golomb_decode(exact.golomb_encode(values, bits)) == values).all()


def test_language_without_letters(docs):
    got = found(language.predict(docs, language.train(docs)))
    for k in (1, 2, 3, 11):
        assert got[k][0]["lang_pred"] == "und" and got[k][0]["score"] == 0
    assert got[7][0]["lang_pred"] == "en" and got[None][0]["held_out"]


def test_every_label_is_learned(spark, docs):
    rows = [(i, "".join(chr(0x4E00 + 60 * (i % 230) + j) for j in range(i % 7, 60)), f"l{i % 230:03}") for i in range(230 * 12)]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == [f"l{i:03}" for i in range(230)]


def test_documents_stay_where_no_language_is_known(docs):
    unknown = docs.drop("lang").selectExpr("*", "cast(null as string) as lang")
    assert language.train(unknown) is None
    assert set(found(language.accepted(unknown, None))) == {4, 5, 6, None, 7, 8, 9, 10, 12, 13, 14}


def test_prefix_hashes():
    import numpy as np

    text = b"abcabcabcabx" * 50
    one = fingerprint.PrefixHashes(np.frombuffer(text, np.uint8))
    for i, j in ((0, 3), (0, 12), (5, 29), (599, 0)):
        want = next((k for k in range(600 - max(i, j)) if text[i + k] != text[j + k]), 600 - max(i, j))
        assert one.extension(i, one, j) == want
    assert one.equal(0, one, 12, 100) and not one.equal(0, one, 1, 5)
    assert fingerprint.likeness("0:0:", "0:0:") == 1 and fingerprint.likeness("0:0:", "5:1:00000001") == 0


def test_ledger_scans_each_blob_once(docs, tmp_path):
    path = str(tmp_path / "ledger")
    first = secrets.report(secrets.scan_into(docs, path)).collect()
    ledger = docs.sparkSession.read.parquet(path)
    assert ledger.count() == len({t or "" for _, t in TEXTS})
    assert secrets.scan(docs, ledger).count() == 0
    assert secrets.scan(docs, ledger, "2").count() == ledger.count()
    assert {r["doc_id"]: r["spans"] for r in first}[14] == "assign:0:21"


def test_near_duplicates_tell_texts_of_one_id_apart(spark):
    """Of two texts with one id only the near copy joins the group of its original."""
    words = [f"w{i}" for i in range(300)]
    rows = [(1, " ".join(words[:100])), (2, " ".join([*words[:99], "end"])), (2, " ".join(words[150:250])), (3, " ".join(words[200:])), (2, " ".join(words[150:250]))]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    keys = {r["row_key"] for r in found}
    out = sorted((r["doc_id"], r["component_id"], r["kept"]) for r in found)
    assert out == [(1, 1, True), (2, 1, False), (2, 2, True), (2, 2, True), (3, 3, True)] and len(keys) == 4


def test_run_length_index():
    import numpy as np

    texts = [b"banana", b"ananas", b"xyz", b"banana"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    off = np.cumsum([0, *map(len, texts)])
    index = runlength.RunLengthIndex(data, off)
    suffixes = [t[i:] for t in texts for i in range(len(t))]
    common = lambda a, b: next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
    want = [max(common(s, o) for j, o in enumerate(suffixes) if j != i) for i, s in enumerate(suffixes)]
    assert index.statistics().tolist() == want
    assert index.lengths.sum() == len(data) + len(texts)


def test_packing_boundaries_are_optimal():
    from itertools import combinations

    import numpy as np

    rng = random.Random(1)
    for _ in range(20):
        lengths = np.array(sorted(rng.sample(range(1, 60), 7)))
        counts = np.array([rng.randint(1, 9) for _ in lengths])
        cost = lambda tops, a=lengths, c=counts: sum(int(n) * min(t for t in tops if t >= x) for x, n in zip(a, c, strict=True))
        best = min(cost([*c, lengths[-1]]) for k in range(3) for c in combinations(lengths[:-1].tolist(), k))
        assert cost(packing.boundaries(lengths, counts, 3)) == best


def test_field_labels_repeated_tokens():
    import numpy as np

    card = "4111111111111111"
    own = {pii.pattern(card): np.log([0.01, 0.01, 0.9, 0.01, 0.07])}
    flat = np.zeros((5, 5))
    field = pii.Field(own, flat, np.log(np.full((5, 5), 0.1) + np.eye(5)))
    text = f"{card} {card} and 123"
    (base, spans), (none, also) = pii.all_spans([text, "no digits"], field)
    assert base == [] and spans == [(0, 2, 16), (17, 2, 33)] and none == also == []
    assert pii.redacted(text, spans) == "[CARD] [CARD] and 123"


def test_every_repeat_of_a_found_token_is_labelled():
    import numpy as np

    flat = np.zeros((5, 5))
    own = {pii.pattern("15551234567"): np.log([0.01, 0.01, 0.01, 0.17, 0.8])}
    field = pii.Field(own, flat, np.log(np.full((5, 5), 0.02) + np.eye(5)))
    for repeats in (1, 9, 15, 400):
        text = "+15551234567 or " + " or ".join(["15551234567"] * repeats)
        (base, spans), _ = pii.all_spans([text, "15551234567 and 15551234567"], field)
        assert base == [(0, 3, 12)] and spans == base + [(16 + 15 * i, 3, 27 + 15 * i) for i in range(repeats)]
    assert pii.all_spans(["15551234567 and 15551234567"], field) == [([], [])]


def test_similar_tokens_share_a_label():
    """A number without its country code is labelled as the one with it; an unlike one is not."""
    import numpy as np

    own = {pii.pattern("555-123-4567"): np.log([0.01, 0.01, 0.01, 0.2, 0.77])}
    flat = np.zeros((5, 5))
    field = pii.Field(own, flat, flat, np.log(np.full((5, 5), 0.02) + np.eye(5)))
    text = "call +1 555-123-4567 now or else 555-123-4567 then 555-999-0000"
    (base, spans), _ = pii.all_spans([text, ""], field)
    assert len(base) == 1 and set(spans) - set(base) == {(33, 3, 45)}


def test_beliefs_run_until_they_stop_changing():
    import numpy as np

    n, pair = 60, np.log(np.array([[0.95, 0.05], [0.05, 0.95]]))
    unary = np.zeros((n, 2))
    unary[0] = 0, -30
    edges = np.array([[i, i + 1] for i in range(n - 1)])
    want = [0.5 + 0.5 * 0.9**i for i in range(n)]
    assert np.allclose(pii.beliefs(unary, edges, np.repeat(pair[None], n - 1, axis=0))[:, 0], want, atol=2e-3)


def test_beliefs_are_exact_on_a_chain():
    import numpy as np

    rng = np.random.default_rng(0)
    unary, pair = rng.normal(size=(3, 3)), rng.normal(size=(2, 3, 3))
    joint = np.exp(unary[0][:, None, None] + unary[1][None, :, None] + unary[2][None, None, :] + pair[0][:, :, None] + pair[1][None, :, :])
    want = np.array([joint.sum(axis=tuple(a for a in range(3) if a != i)) for i in range(3)]) / joint.sum()
    assert np.allclose(pii.beliefs(unary, np.array([[0, 1], [1, 2]]), pair), want, atol=0.02)


def test_template_subtrees_go(spark):
    page = "<body><div><span>Site of the year</span></div><article><p>Text {0}</p><div>Join us</div><p>Quoted</p></article></body>"
    rows = [(i, "https://h.example/" + str(i), page.format(i), "x") for i in range(20)] + [(99, None, None, None), (100, "bad", "", None), (101, "https://other.example/", page.format(101), None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = {r["page_id"]: r["text"] for r in html.extract(pages).collect()}
    assert got[3] == "Text 3\n\nQuoted" and got[99] == "" and got[100] == ""
    assert got[101] == "Text 101\n\nJoin us\n\nQuoted"
    assert html.extract(pages.limit(0)).collect() == []


def test_templates_of_a_section_go_and_copies_stay(spark):
    page = "<body><div><p>{0}</p></div><article><p>Text {1}</p><div>{2}</div><table><tr><td>Yes</td></tr><tr><td>No {1}</td></tr></table></article></body>"
    rows = [(i, f"https://h.example/{i}", page.format("Tips" if i < 12 else f"Tip {i}", i, "Read on" if i < 12 else f"Other {i}")) for i in range(30)]
    # One article under twelve addresses, of a host with many pages.
    rows += [(i, f"https://h.example/{i}", "<body><article><div>All of it</div><div>And more</div></article></body>") for i in range(30, 42)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for few in (html.TEMPLATE_ROWS, 0):
        got = {r["page_id"]: r["text"] for r in html.extract(pages, few=few).collect()}
        assert got[3] == "Text 3\n\nYes\n\nNo 3" and got[20] == "Text 20\n\nOther 20\n\nYes\n\nNo 20"
        assert got[35] == "All of it\n\nAnd more" and len(got) == 42


def test_items_go_with_their_list(spark):
    page = "<body><ul><li>Home<li>News<li>Page {0}</ul><h1>T {0}</h1><ul><li>Salt<li>Rice {0}<li>Oil {0}</ul></body>"
    rows = [(i, f"https://h.example/{i}", page.format(i)) for i in range(12)]
    got = {r["page_id"]: r["text"] for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[3] == "Page 3\n\nT 3\n\nSalt\n\nRice 3\n\nOil 3"


def test_pipeline_on_edges(spark, docs, empty):
    for table in (docs, empty):
        rows = table
        for _, stage in corpus_pipeline.STAGES[:-1]:
            rows = spark.createDataFrame(stage(spark, rows, "").collect(), rows.select(corpus_pipeline.COLUMNS).schema)
        ids = {r["doc_id"] for r in corpus_pipeline.pack(spark, rows, "").collect()}
        assert ids == ({6, 7, 10, 12, 13, 14} if table is docs else set())
