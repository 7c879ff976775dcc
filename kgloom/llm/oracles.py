"""DuckDB twins of the opN_ queries that SQL can express."""

_WORDS = r"""
words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]) END AS s
  FROM words
)"""

OP1 = f"""
WITH RECURSIVE {_WORDS},
sized AS (SELECT doc_id, len(s)::BIGINT AS n, list_sort(s) AS s FROM sets),
classes AS (SELECT min(doc_id) AS node, any_value(n) AS n, s FROM sized WHERE n > 0 GROUP BY s),
items AS (SELECT node, n, unnest(s) AS g FROM classes),
common AS (
  SELECT a.node AS a, b.node AS b, count(*) AS n_both, any_value(a.n) AS na, any_value(b.n) AS nb
  FROM items a JOIN items b ON a.g = b.g AND a.node < b.node GROUP BY 1, 2
),
links AS (SELECT a, b FROM common WHERE 100 * n_both >= 75 * (na + nb - n_both)),
sym AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT node AS a, node AS b FROM classes
  UNION
  SELECT reach.a, sym.b FROM reach JOIN sym ON reach.b = sym.a
),
comp AS (SELECT a AS node, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, d.n AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id,
       d.doc_id = coalesce(c.component_id, d.doc_id) AS kept
FROM sized d LEFT JOIN classes k ON d.n > 0 AND k.s = d.s LEFT JOIN comp c ON c.node = k.node
"""


OP5 = r"""
WITH rows AS (
  SELECT doc_id, length(coalesce(text, ''))::BIGINT AS n_chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
),
groups AS (
  SELECT text_sha256, count(*)::BIGINT AS group_size, max(n_chars) AS top FROM rows GROUP BY 1
),
keeps AS (
  SELECT r.text_sha256, min(r.doc_id) AS keep_id FROM rows r JOIN groups g
  ON r.text_sha256 = g.text_sha256 AND r.n_chars = g.top GROUP BY 1
)
SELECT r.doc_id, k.keep_id, g.group_size, r.doc_id = k.keep_id AS kept, r.text_sha256
FROM rows r JOIN groups g USING (text_sha256) JOIN keeps k USING (text_sha256)
"""


def _matches(name: str, kind: int, pattern: str, keep: str = "true") -> str:
    """Spans of one kind as a list of structs, from the pieces between the matches."""
    pattern = pattern.replace("'", "''")
    return f"""
{name}_parts AS (
  SELECT doc_id, regexp_extract_all(t, '{pattern}', 0) AS m, regexp_extract_all(t, '{pattern}', {2 if kind == 0 else 0}) AS v,
         string_split_regex(t, '{pattern}') AS g
  FROM texts
),
{name} AS (
  SELECT doc_id, list_filter([
    {{'start': list_sum(list_transform(g[1:i], lambda x: length(x)))::BIGINT + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0)::BIGINT,
      'kind': {kind}, 'stop': list_sum(list_transform(g[1:i], lambda x: length(x)))::BIGINT + list_sum(list_transform(m[1:i], lambda x: length(x)))::BIGINT,
      'v': v[i]}}
    for i in range(1, len(m) + 1)], lambda s: {keep}) AS s
  FROM {name}_parts
)"""


# The patterns, written out so that a wrong one in the operator shows.
_SECRETS = [
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", "length(s.v) >= 6"),
    ("access", r"AKIA[A-Z0-9]{16,}", "true"),
    ("hex", r"[0-9a-f]{24,}", "true"),
    ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", "true"),
]


def _secrets() -> str:
    rules = [(name, pattern) for name, pattern, _ in _SECRETS]
    parts = ",".join(_matches(name, k, pattern, keep) for k, (name, pattern, keep) in enumerate(_SECRETS))
    names = "[" + ", ".join(f"'{n}'" for n, _ in rules) + "]"
    lists = ", ".join(f"{n}.s" for n, _ in rules)
    joins = " ".join(f"JOIN {n} USING (doc_id)" for n, _ in rules)
    text = f"list_transform(list_sort(%s), lambda s: {names}[s.kind + 1] || ':' || s.start || ':' || s.stop)"
    base = text % "list_filter(spans, lambda s: s.kind < 3)"
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), {parts},
joined AS (SELECT texts.doc_id, t, flatten([{lists}]) AS spans FROM texts {joins})
SELECT doc_id, len(list_filter(spans, lambda s: s.kind = 0))::BIGINT AS n_assign,
       len(list_filter(spans, lambda s: s.kind = 1))::BIGINT AS n_access,
       len(list_filter(spans, lambda s: s.kind = 2))::BIGINT AS n_hex,
       sha256(array_to_string({base}, ',')) AS base_sha256,
       array_to_string({text % "spans"}, ',') AS spans, sha256(t) AS blob
FROM joined
"""


def _repeated(name: str, size: int) -> str:
    """Keys of all strings of `size` bytes, and the maximal runs that those found twice cover."""
    return f"""
{name}_keys AS MATERIALIZED (
  SELECT doc, k * 400 + o AS pos, hash(substring(piece, 2 * o + 1, {2 * size})) AS h
  FROM pieces, unnest(range(least(400, len(piece) // 2 - {size - 1}))) AS t(o)
),
{name}_hits AS (
  SELECT doc, pos FROM {name}_keys SEMI JOIN (SELECT h FROM {name}_keys GROUP BY h HAVING count(*) > 1) USING (h)
),
{name} AS (
  SELECT doc, min(pos) AS a, max(pos) + {size} AS b FROM (
    SELECT doc, pos, sum(new) OVER (PARTITION BY doc ORDER BY pos) AS run FROM (
      SELECT doc, pos, (pos > lag(pos, 1, -{size + 1}) OVER (PARTITION BY doc ORDER BY pos) + {size})::INT AS new FROM {name}_hits))
  GROUP BY doc, run
)"""


# Texts as hexadecimal bytes; pieces of 800 bytes start every 400, so each string is in one.
OP9 = f"""
WITH texts AS (SELECT row_number() OVER () AS doc, doc_id, hex(encode(coalesce(text, ''))) AS t FROM documents),
pieces AS MATERIALIZED (
  SELECT doc, k, substring(t, 800 * k + 1, 1600) AS piece FROM texts, unnest(range((len(t) // 2 + 399) // 400)) AS u(k)
),{_repeated("gone", 400)},{_repeated("seen", 256)},
removed AS (
  SELECT doc, sum(b - a)::BIGINT AS n_removed, count(*)::BIGINT AS n_spans, list(a ORDER BY a) AS a, list(b ORDER BY a) AS b FROM gone GROUP BY doc
),
passages AS (
  SELECT doc, count(*)::BIGINT AS n_passages, sum(b - a)::BIGINT AS n_passage_bytes FROM (
    SELECT doc, a, b, regexp_replace(substring(t, 2 * a + 1, 2 * (b - a)), '(..)', '\\1 ', 'g') AS run FROM seen JOIN texts USING (doc))
  WHERE len(list_filter(regexp_split_to_array(run, '(20|09|0A|0B|0C|0D) '), lambda w: w <> '')) > 50 GROUP BY doc
),
kept AS (
  SELECT doc, doc_id, len(t)::BIGINT // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
         CASE WHEN n_spans IS NULL THEN t ELSE array_to_string(
           [substring(t, 2 * x + 1, 2 * (a[i] - x)) for x, i in list_prepend(0, b[:-2])], '') || substring(t, 2 * b[-1] + 1) END AS t
  FROM texts LEFT JOIN removed USING (doc)
)
SELECT doc_id, n_bytes, n_removed, n_spans, sha256(unhex(t)) AS kept_sha256,
       coalesce(n_passages, 0) AS n_passages, coalesce(n_passage_bytes, 0) AS n_passage_bytes
FROM kept LEFT JOIN passages USING (doc)
"""


def _text(name: str) -> str:
    return f"coalesce(strlen({name}::VARCHAR) || ':' || {name}::VARCHAR, '-')"


# The nodes of each level as a list per language; the checksum by the reversed polynomial.
OP11 = f"""
WITH RECURSIVE leaves AS (
  SELECT row_number() OVER () AS k, doc_id, lang,
         sha256({" || ".join(_text(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))}) AS leaf,
         sha256({" || ".join(_text(c) for c in ("doc_id", "source", "lang", "n_chars"))} || {_text("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) AS altered,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substring(doc_id::VARCHAR, i, 1))::BIGINT)),
           lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda a, z: CASE WHEN (a & 1) = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END)), 4294967295::BIGINT) % 3 = 0 AS tampered
  FROM documents
),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
levels AS (
  SELECT lang, 0 AS level, list(leaf ORDER BY pos) AS nodes FROM placed GROUP BY lang
  UNION ALL
  SELECT lang, level + 1, [sha256(array_to_string(nodes[8 * i + 1:8 * i + 8], '')) for i in range((len(nodes) + 7) // 8)] FROM levels WHERE len(nodes) > 1
),
subroots AS (SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos FROM levels WHERE len(nodes) = 1),
tops AS (
  SELECT 0 AS level, list(subroot ORDER BY pos) AS nodes FROM subroots
  UNION ALL
  SELECT level + 1, [sha256(array_to_string(nodes[8 * i + 1:8 * i + 8], '')) for i in range((len(nodes) + 7) // 8)] FROM tops WHERE len(nodes) > 1
),
steps AS (
  SELECT k, level, placed.pos // (8 ** level)::BIGINT AS place, nodes FROM placed JOIN levels ON placed.lang IS NOT DISTINCT FROM levels.lang AND len(nodes) > 1
  UNION ALL
  SELECT k, 100 + level, subroots.pos // (8 ** level)::BIGINT, nodes FROM placed JOIN subroots ON placed.lang IS NOT DISTINCT FROM subroots.lang, tops WHERE len(nodes) > 1
),
paths AS (
  SELECT k, list({{'l': array_to_string(nodes[8 * (place // 8) + 1:place], ''), 'r': array_to_string(nodes[place + 2:8 * (place // 8) + 8], '')}} ORDER BY level) AS path FROM steps GROUP BY k
),
whole AS (
  SELECT placed.*, subroot, (SELECT nodes[1] FROM tops WHERE len(nodes) = 1) AS root, coalesce(path, []) AS path
  FROM placed LEFT JOIN paths USING (k) JOIN subroots ON placed.lang IS NOT DISTINCT FROM subroots.lang
),
folded AS (
  SELECT *, list_reduce(list_prepend({{'l': CASE WHEN tampered THEN altered ELSE leaf END, 'r': ''}}, path), lambda a, p: {{'l': sha256(p.l || a.l || p.r), 'r': ''}}).l AS folded_root FROM whole
)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string([p.l || p.r for p in path], '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM folded
"""


ORACLES = {
    "op1_minhash": OP1,
    "op2_secrets": _secrets(),
    "op5_exact": OP5,
    "op9_runlength": OP9,
    "op11_manifest": OP11,
}
