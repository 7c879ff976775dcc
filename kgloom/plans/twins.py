"""DuckDB SQL twins of the registered queries: a shared projection, then one SELECT each."""

from __future__ import annotations

from .. import rules
from ..operators import prompts
from . import documents, indexed


def _list(values) -> str:
    return "[" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in values) + "]"


def _set(values) -> str:
    return "(" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in values) + ")"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _rows(rows) -> str:
    return ", ".join("(" + ", ".join(str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'" for v in row) + ")" for row in rows)


ENTITY = _set(rules.ENTITY_LABELS)
SPACE = r"[\s\x0B]"
PLAIN = r"regexp_replace(lower({0}), '^[\s\x0B\x{{1C}}-\x{{1F}}\x{{85}}\p{{Z}}]+|[\s\x0B\x{{1C}}-\x{{1F}}\x{{85}}\p{{Z}}]+$', '', 'g')"
PRIORITY = f"coalesce(nullif(list_position({_list(rules.LABEL_PRIORITY)}, {{0}}), 0), 100)"
POSITIVE = _list(rules.POSITIVE_WORDS)
RELATION = f"{_list(rules.RELATIONSHIPS)}[({{0}}) % 14 + 1]"


def plain(c: str) -> str:
    return PLAIN.format(c)


BASE = f"""
WITH RECURSIVE nodes AS (
  SELECT *, list_filter(labels, lambda l: NOT starts_with(l, '__'))[1] AS label FROM (
    SELECT 'part-' || p_partkey AS id,
      CASE WHEN p_partkey % 3 = 0 THEN [lab] WHEN p_partkey % 3 = 1 THEN ['__Entity__', lab] ELSE ['__KGBuilder__', '__Entity__', lab] END AS labels,
      CASE WHEN p_partkey % 19 = 0 THEN NULL WHEN p_partkey % 13 = 0 THEN ['tool', 'system', 'process', 'data'][(p_partkey // 13) % 4 + 1]
        WHEN p_partkey % 11 = 0 THEN '  ' || p_name || chr(9) WHEN p_partkey % 7 = 0 THEN upper(p_name) WHEN p_partkey % 5 = 0 THEN p_name || 's'
        WHEN p_partkey % 17 = 0 THEN 'Improved ' || p_name ELSE p_name END AS name,
      CASE WHEN p_partkey % 10 = 0 THEN p_name END AS display_name,
      CASE p_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE p_brand || ' ' || lower(p_type) END AS definition,
      CASE p_partkey % 3 WHEN 0 THEN p_brand || ' | ' || p_name || ' | ' || p_brand WHEN 1 THEN '["' || p_brand || '", " ", "' || p_name || '"]' ELSE p_name END AS description,
      CASE WHEN p_partkey % 2 = 0 THEN [p_partkey || '-' || (p_partkey + 5)] ELSE []::VARCHAR[] END AS source_spans
    FROM (SELECT *, CASE p_type WHEN 'STANDARD' THEN 'Standard' WHEN 'ECONOMY' THEN 'Concept' WHEN 'MEDIUM' THEN 'Challenge' WHEN 'PROMO' THEN 'Tool' WHEN 'LARGE' THEN 'Artifact' ELSE 'Methodology' END AS lab FROM part)
    UNION ALL
    SELECT 'cust-' || c_custkey, ['__Entity__', 'Industry'],
      CASE WHEN c_custkey % 12 < 6 THEN ['auto industry', 'fda', 'artificial intelligence', 'industry', 'med device', 'unheard of'][c_custkey % 12 + 1] WHEN c_custkey % 12 = 6 THEN c_mktsegment ELSE lower(c_mktsegment) END,
      NULL, 'Buys ' || lower(c_mktsegment), NULL, []::VARCHAR[] FROM customer
    UNION ALL
    SELECT 'nation-' || n_nationkey, ['Organization'], lower(n_name), n_name, NULL, NULL, []::VARCHAR[] FROM nation
  )
),
entities AS (SELECT * FROM nodes WHERE label IN {ENTITY}),
articles AS (
  SELECT 'ch' || substring(source, 4)::INT || '-art' || doc_id AS article_id, substring(source, 4)::INT AS chapter_number, doc_id AS article_number,
    string_split(text, ' ')[1] AS title, 'https://guide.example/ch' || substring(source, 4)::INT || '/' || doc_id % 50 AS url, text FROM documents
),
lines AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1)::INT - 1 AS pos FROM documents),
chunks AS (
  SELECT 'doc-' || doc_id || '-' || pos AS id, CASE WHEN doc_id % 23 <> 0 THEN 'ch' || substring(source, 4)::INT || '-art' || doc_id END AS article_id,
    CASE WHEN doc_id % 17 <> 0 THEN pos END AS index, CASE WHEN doc_id % 29 <> 0 THEN 'c' || doc_id || '_' || pos END AS chunk_id, text,
    doc_id IN (SELECT vec_id FROM embeddings) AS embedded FROM lines
),
edges AS (
  SELECT 'part-' || l_partkey AS src, {RELATION.format("l_linenumber * 2 + l_suppkey")} AS type, 'cust-' || o_custkey AS dst FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  UNION SELECT 'part-' || l_partkey, {RELATION.format("l_linenumber")}, 'part-' || l_suppkey FROM lineitem
  UNION SELECT 'part-' || user_id, 'MENTIONED_IN', 'doc-' || event_id || '-0' FROM events WHERE event_id IN (SELECT doc_id FROM documents)
),
definitions AS (
  SELECT replace(lower(term), ' ', '_') AS term_id, * FROM (
    SELECT concat_ws(' ', string_split(text, ' ')[1], string_split(text, ' ')[2]) AS term, text AS definition, item_id AS ord FROM benchmark
    UNION ALL SELECT n_name, 'The nation ' || n_name, n_nationkey + 100000 FROM nation
    UNION ALL SELECT (SELECT string_agg(upper(w[1]) || w[2:], ' ' ORDER BY i) FROM (SELECT unnest(string_split(p_name, ' ')) AS w, generate_subscripts(string_split(p_name, ' '), 1) AS i)) || CASE WHEN k % 2 = 0 THEN 'z' ELSE '' END, 'About ' || p_name, k + 200000
      FROM (SELECT p_name, min(p_partkey) AS k FROM part GROUP BY 1)
  )
),
webinars AS (
  SELECT 'web-' || page_id AS id, url, CASE page_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'Webinar' WHEN 2 THEN left(t, 10) ELSE t END AS title,
    CASE page_id % 3 WHEN 0 THEN NULL WHEN 1 THEN 'Short' ELSE 'On ' || t || '. And more.' END AS description,
    CASE WHEN page_id % 2 = 0 THEN 'https://img.example/' || page_id END AS thumbnail
  FROM (SELECT *, regexp_extract(html, '<title>([^<]*)', 1) AS t FROM pages)
),
ends AS (SELECT src AS id, dst AS other, type, true AS outgoing FROM edges UNION ALL SELECT dst, src, type, false FROM edges WHERE src <> dst),
degrees AS (SELECT id, count(*) AS degree FROM ends GROUP BY 1),
mentioned AS (SELECT src AS id, dst AS chunk_id FROM edges WHERE type = 'MENTIONED_IN' AND dst IN (SELECT id FROM chunks)),
patterns(source_label, type, target_label) AS (VALUES {_rows(rules.PATTERNS)}),
typed AS (SELECT e.src, e.dst, a.label AS source_label, e.type, b.label AS target_label FROM edges e JOIN entities a ON a.id = e.src JOIN entities b ON b.id = e.dst),
plural_map AS (
  SELECT a.label, a.name AS singular_name, b.name AS plural_name, a.id AS singular_id, b.id AS plural_id
  FROM (SELECT label, name, min(id) AS id FROM entities WHERE name IS NOT NULL AND name NOT LIKE '%s' GROUP BY 1, 2) a JOIN entities b ON a.label = b.label AND b.name = a.name || 's'
),
plural_merge AS (SELECT plural_id AS dup, min(singular_id) AS keep FROM plural_map GROUP BY 1),
same_keep AS (SELECT label, name, min(id) AS keep FROM nodes WHERE name IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1),
same_map AS (SELECT id AS dup, keep, label, name FROM nodes JOIN same_keep USING (label, name) WHERE id <> keep),
winners AS (
  SELECT name, arg_min(label, {PRIORITY.format("label")}) AS winner, count(DISTINCT label) AS n_labels, count(*) AS n_nodes FROM nodes WHERE name IS NOT NULL GROUP BY 1 HAVING count(DISTINCT label) > 1
),
cross_keep AS (SELECT name, arg_min(id, (CASE WHEN label <> winner THEN '1' ELSE '0' END) || id) AS keep FROM nodes JOIN winners USING (name) GROUP BY 1),
cross_map AS (SELECT id AS dup, keep, name FROM nodes JOIN cross_keep USING (name) WHERE id <> keep),
groups AS (
  SELECT n.*, coalesce(m.keep, n.id) AS keep, (CASE WHEN coalesce(m.keep, n.id) <> n.id THEN '1' ELSE '0' END) || n.id AS ord FROM nodes n LEFT JOIN cross_map m ON m.dup = n.id
  WHERE coalesce(m.keep, n.id) IN (SELECT keep FROM cross_map)
),
dispositions AS (
  SELECT id, label, name, CASE WHEN coalesce(name, '') = '' THEN 'delete' WHEN label NOT IN {ENTITY} THEN 'skip' WHEN {plain("name")} IN {_set(rules.GENERIC_TERMS)} THEN 'delete' ELSE 'keep' END AS action FROM nodes
),
singulars(plural, one) AS (VALUES {_rows(rules.SINGULARS.items())}),
valued AS (SELECT d.*, CASE WHEN action = 'keep' THEN coalesce(s.one, {plain("name")}) END AS value FROM dispositions d LEFT JOIN singulars s ON s.plural = {plain("d.name")}),
positive_any AS (SELECT * FROM nodes WHERE label = 'Challenge' AND name IS NOT NULL AND list_has_any(string_split(lower(name), ' '), {POSITIVE})),
relabel AS (SELECT name, min(id) AS id FROM positive_any WHERE name NOT IN (SELECT name FROM nodes WHERE label = 'Concept' AND name IS NOT NULL) GROUP BY 1),
semantic AS (SELECT DISTINCT a.name AS source, b.name AS target FROM edges e JOIN entities a ON a.id = e.src JOIN entities b ON b.id = e.dst WHERE e.type <> 'MENTIONED_IN' AND a.name IS NOT NULL AND b.name IS NOT NULL),
tax(kind, term, canonical, ord) AS (VALUES {_rows([("taxonomy", v, c, i) for i, (v, c) in enumerate(rules.INDUSTRIES)] + [(k, t, t, i) for k, ts in (("concept", rules.INDUSTRY_CONCEPTS), ("organization", rules.INDUSTRY_ORGANIZATIONS), ("generic", rules.INDUSTRY_GENERICS)) for i, t in enumerate(ts)])})
"""


def _ratio(a: str, b: str) -> str:
    """The same measure by rows of the dynamic programme: each row is a fold over b."""
    left, right = f"string_split({a}, '')", f"string_split({b}, '')"
    row = f"list_reduce(list_prepend([0]::INT[], list_transform(range(1, len({right}) + 1), lambda j: [j::INT])), lambda acc, j: list_append(acc, CASE WHEN {right}[j[1]] = x[1] THEN p[j[1]::INT] + 1 ELSE greatest(p[j[1] + 1], acc[len(acc)]) END))"
    rows = f"list_reduce(list_prepend(list_transform(range(0, len({right}) + 1), lambda z: '0'), list_transform({left}, lambda c: [c])), lambda q, x: {row.replace('p[', 'list_transform(q, lambda v: v::INT)[')}::VARCHAR[])"
    return f"(200.0 * ({rows})[len({right}) + 1]::INT / (length({a}) + length({b})))"


def _rewrite(mapping: str) -> str:
    return f"SELECT DISTINCT coalesce(a.keep, e.src) AS src, e.type, coalesce(b.keep, e.dst) AS dst FROM edges e LEFT JOIN {mapping} a ON a.dup = e.src LEFT JOIN {mapping} b ON b.dup = e.dst"


_SUMMARY = {
    "orphan_chunks": "SELECT count(*) FROM chunks WHERE article_id IS NULL", "missing_embeddings": "SELECT count(*) FROM chunks WHERE NOT embedded", "industries": "SELECT count(*) FROM nodes WHERE label = 'Industry'",
    "missing_chunk_ids": "SELECT count(*) FROM chunks WHERE chunk_id IS NULL", "missing_chunk_index": "SELECT count(*) FROM chunks WHERE index IS NULL",
}

DUPLICATES = "SELECT label, name, count(*) AS n FROM entities GROUP BY 1, 2 HAVING count(*) > 1 ORDER BY n DESC, label, name NULLS FIRST LIMIT 50"
ORPHANS = "SELECT id, label, name FROM entities WHERE id NOT IN (SELECT id FROM ends) ORDER BY id LIMIT 100"
INVALID = "SELECT source_label, type, target_label, count(*) AS n FROM typed ANTI JOIN patterns USING (source_label, type, target_label) GROUP BY ALL ORDER BY n DESC, 1, 2, 3 LIMIT 20"
PLURALS = "SELECT label, singular_name, plural_name, coalesce(a.degree, 0) AS singular_rels, coalesce(b.degree, 0) AS plural_rels, singular_id, plural_id FROM plural_map LEFT JOIN degrees a ON a.id = singular_id LEFT JOIN degrees b ON b.id = plural_id ORDER BY label, singular_name, singular_id, plural_id LIMIT 100"
DEGENERATE = "SELECT id, length(text) AS length FROM chunks WHERE length(text) < 100 AND id NOT IN (SELECT chunk_id FROM mentioned) ORDER BY length, id LIMIT 50"
TITLES = "SELECT id, title FROM webinars WHERE title IS NULL OR length(title) < 15 OR title = 'Webinar' ORDER BY id LIMIT 50"
UNMENTIONED = "SELECT id, label, name FROM entities WHERE id NOT IN (SELECT id FROM mentioned) ORDER BY label, name NULLS FIRST, id LIMIT 100"
GHOSTS = "SELECT e.id, e.label, e.name, m.chunk_id FROM entities e JOIN mentioned m USING (id) WHERE e.id NOT IN (SELECT id FROM ends WHERE type <> 'MENTIONED_IN') ORDER BY 1, 4 LIMIT 100"
MISLABELED = "SELECT id, name FROM positive_any ORDER BY name, id LIMIT 50"
NEAR = "SELECT a.label, a.name AS shorter, b.name AS longer, a.id AS shorter_id, b.id AS longer_id FROM entities a JOIN entities b ON a.label = b.label AND a.name <> b.name AND length(a.name) > 4 AND contains(b.name, a.name) AND length(b.name) - length(a.name) <= 5 AND a.id < b.id ORDER BY 1, 2, 3, 4, 5 LIMIT 50"
GENERIC = f"SELECT n.id, label, name, coalesce(degree, 0) AS degree FROM entities n LEFT JOIN degrees d ON d.id = n.id WHERE lower(name) IN {_set(rules.GENERIC_CHECK_TERMS)}"
UNDEFINED = "SELECT label, count(*) AS n FROM entities WHERE coalesce(definition, '') = '' GROUP BY 1"
_LISTS = {
    "orphan_entities": ORPHANS, "duplicate_entities": DUPLICATES, "invalid_patterns": INVALID, "plural_pairs": PLURALS, "degenerate_chunks": DEGENERATE, "truncated_titles": TITLES, "unmentioned_entities": UNMENTIONED,
    "ghost_entities": GHOSTS, "mislabeled_challenges": MISLABELED, "near_duplicates": NEAR, "generic_entities": GENERIC, "missing_definitions": UNDEFINED,
}


def _summary(lists: dict[str, str]) -> str:
    """The verdict on every check, from what the lists count."""
    rows = " UNION ALL ".join([f"SELECT '{k}' AS \"check\", ({v}) AS value" for k, v in _SUMMARY.items()] + [f"SELECT '{k}', (SELECT count(*) FROM ({v}))" for k, v in lists.items()])
    return f"SELECT \"check\", value, value <= CASE WHEN \"check\" = 'industries' THEN 19 ELSE 0 END AS ok, \"check\" IN ('orphan_chunks', 'duplicate_entities', 'industries', 'missing_chunk_ids', 'missing_chunk_index', 'plural_pairs') AS required FROM ({rows})"


SUMMARY = _summary(_LISTS)
ALL_COUNTED = _summary({k: v.partition(" ORDER BY ")[0] for k, v in _LISTS.items()})

_POOL = ", ".join(f"({i}, {_text(e.block)}, [{', '.join(map(_text, prompts.word_set(e.text)))}])" for i, e in enumerate(prompts.EXAMPLES))
PROMPTS = f""", pool(place, block, words) AS (VALUES {_POOL}),
 scored AS (SELECT c.id, place, block, row_number() OVER (PARTITION BY c.id ORDER BY len(list_intersect(regexp_split_to_array(lower(coalesce(c.text, '')), '[^a-z0-9]+'), words)) DESC, place) AS r FROM chunks c, pool),
 shown AS (SELECT id, string_agg(place, ',' ORDER BY r) AS examples, string_agg(block, '' ORDER BY r) AS blocks FROM scored WHERE r <= 3 GROUP BY 1),
 asked AS (SELECT id, examples, {_text(prompts.header())} || blocks || {_text("Text:" + chr(10))} || coalesce(text, '') || {_text(chr(10) + "Answer:" + chr(10))} AS prompt FROM shown JOIN chunks USING (id))
 SELECT id AS chunk_id, examples, length(prompt) AS n_chars, sha256(prompt) AS sha256 FROM asked"""

NORMAL_FLAT = r"regexp_replace(" + PLAIN.format("name") + r", '[\s\x0B\x{1C}-\x{1F}\x{85}\p{Z}]+', ' ', 'g')"
NORMAL = r"coalesce(regexp_replace(" + NORMAL_FLAT + r", '^[^\p{L}\p{N}\p{M}\p{Pc}]+|[^\p{L}\p{N}\p{M}\p{Pc}]+$', '', 'g'), '')"

_VALUES = "list_filter(list_transform({0}, lambda x: trim(x)), lambda x: x <> '')"
FRAGMENTS = f"CASE WHEN description IS NULL THEN []::VARCHAR[] WHEN starts_with(description, '[') THEN {_VALUES.format('CASE WHEN starts_with(description, chr(91)) THEN from_json(description, chr(91) || chr(34) || $$VARCHAR$$ || chr(34) || chr(93)) END')} WHEN contains(description, ' | ') THEN {_VALUES.format(chr(115) + 'tring_split(description, $$ | $$)')} ELSE [trim(description)] END"


def _votes(previous: str) -> str:
    return f"(SELECT node, arg_min(community, lpad((100000000 - n)::VARCHAR, 9, '0') || community) AS community FROM (SELECT s.node, l.community, count(*) AS n FROM sym s JOIN {previous} l ON l.node = s.other GROUP BY 1, 2) GROUP BY 1)"


_SYM = "sym AS (SELECT source AS node, target AS other FROM semantic UNION ALL SELECT target, source FROM semantic UNION ALL SELECT DISTINCT n, n FROM (SELECT source AS n FROM semantic UNION SELECT target FROM semantic)), l0 AS (SELECT DISTINCT node, node AS community FROM sym)"
LABELS = f", {_SYM}, l1 AS {_votes('l0')}, l2 AS {_votes('l1')}, l3 AS {_votes('l2')} SELECT node, community FROM l3"
PARTITION = "SELECT name AS node, min(label) AS community FROM entities WHERE name IS NOT NULL GROUP BY 1"
MODULARITY = f""", part_of AS ({PARTITION}), x AS (SELECT a.community AS cs, b.community AS ct FROM semantic JOIN part_of a ON a.node = source JOIN part_of b ON b.node = target),
 d AS (SELECT c, count(*)::DOUBLE AS d FROM (SELECT cs AS c FROM x UNION ALL SELECT ct FROM x) GROUP BY 1)
 SELECT round((SELECT count(*) FROM x WHERE cs = ct) / (SELECT count(*)::DOUBLE FROM x) - (SELECT sum(d * d) FROM d) / (4 * pow((SELECT count(*)::DOUBLE FROM x), 2)), 9) AS modularity"""

CLASSIFY = f""", terms AS (SELECT DISTINCT name AS term, coalesce({plain("name")}, '') AS p FROM nodes WHERE label IN ('Industry', 'Organization')),
 scores AS (SELECT p, kind, canonical, ord, {_ratio("p", "tax.term")} AS score FROM (SELECT DISTINCT p FROM terms WHERE p <> '' AND p NOT IN (SELECT term FROM tax)) JOIN tax ON kind <> 'organization' AND 200.0 * least(length(p), length(tax.term)) >= 75 * (length(p) + length(tax.term))),
 marks AS (SELECT p, EXISTS (SELECT 1 FROM tax WHERE kind = 'organization' AND tax.term = p) AS org, EXISTS (SELECT 1 FROM tax WHERE kind = 'concept' AND tax.term = p) AS con, EXISTS (SELECT 1 FROM tax WHERE kind = 'generic' AND tax.term = p) AS gen,
   (SELECT max(canonical) FROM tax WHERE kind = 'taxonomy' AND tax.term = p) AS canonical,
   (SELECT canonical FROM scores s WHERE s.p = q.p AND kind = 'taxonomy' AND score >= 80 ORDER BY score DESC, ord LIMIT 1) AS near,
   EXISTS (SELECT 1 FROM scores s WHERE s.p = q.p AND kind = 'concept' AND score >= 75) AS ncon, EXISTS (SELECT 1 FROM scores s WHERE s.p = q.p AND kind = 'generic' AND score >= 75) AS ngen
   FROM (SELECT DISTINCT p FROM terms) q),
 acts AS (SELECT p, CASE WHEN p = '' THEN 'delete' WHEN org THEN 'reclassify_org' WHEN con THEN 'reclassify' WHEN gen THEN 'delete' WHEN canonical IS NOT NULL THEN 'keep' WHEN near IS NOT NULL THEN 'keep' WHEN ncon THEN 'reclassify' WHEN ngen THEN 'delete' ELSE 'unknown' END AS action, coalesce(canonical, near) AS kept FROM marks),
 classified AS (SELECT term, action, CASE WHEN action = 'keep' THEN kept WHEN action LIKE 'reclassify%' THEN p END AS value FROM terms JOIN acts USING (p))"""
_PLAN = CLASSIFY + """, plan AS (SELECT n.id, n.name, action, value, CASE WHEN action = 'reclassify' THEN 'Concept' WHEN action = 'reclassify_org' THEN 'Organization' WHEN action <> 'delete' THEN 'Industry' END AS new_label, coalesce(value, n.name) AS new_name FROM nodes n JOIN classified c ON n.name = c.term WHERE n.label = 'Industry')"""
_KEEPS = """SELECT id, name, action, value, new_label, new_name, CASE WHEN action <> 'delete' THEN coalesce((SELECT min(x.id) FROM nodes x WHERE x.label = new_label AND x.name = new_name AND x.label <> 'Industry'), (SELECT min(y.id) FROM plan y WHERE y.action <> 'delete' AND y.new_label = plan.new_label AND y.new_name = plan.new_name)) END AS keep FROM plan"""
CONSOLIDATION = _PLAN + " " + _KEEPS

def _merged(mapping: str, folds: str, policy: str, nodes: str = "nodes") -> str:
    """Nodes after a merge: `folds` gives the pairs whose properties are folded."""
    order = "(CASE WHEN f.keep IS NULL THEN '0' ELSE '1' END) || n.id"
    pick = "arg_max" if policy == "dup_wins" else "arg_min"
    one = lambda c: f"{pick}({c}, ord) FILTER ({c} IS NOT NULL) AS {c}"
    if policy == "union_longer":
        values = "arg_min(definition, lpad((100000 - length(definition))::VARCHAR, 6, '0') || ord) FILTER (definition IS NOT NULL) AS definition, list_sort(list_distinct(flatten(list(source_spans)))) AS source_spans, NULL AS display_name, NULL AS description"
    else:
        values = f"{one('definition')}, {one('description')}, {one('display_name')}, {pick}(source_spans, ord) FILTER (len(source_spans) > 0) AS source_spans"
    return f"""SELECT n.id, n.label, n.name, coalesce(v.display_name, n.display_name) AS display_name, coalesce(v.definition, n.definition) AS definition,
 coalesce(v.description, n.description) AS description, array_to_string(coalesce(v.source_spans, n.source_spans), ',') AS source_spans FROM {nodes} n
 LEFT JOIN (SELECT keep, {values} FROM (SELECT n.*, coalesce(f.keep, n.id) AS keep, {order} AS ord FROM nodes n LEFT JOIN {folds} f ON f.dup = n.id) WHERE keep IN (SELECT keep FROM {folds}) GROUP BY 1) v ON v.keep = n.id
 WHERE n.id NOT IN (SELECT dup FROM {mapping})"""


_CONSOLIDATED = _PLAN + f", kept AS ({_KEEPS}), moved AS (SELECT id AS dup, keep, new_label FROM kept WHERE keep <> id), folds AS (SELECT * FROM moved WHERE new_label = 'Industry'), gone AS (SELECT id FROM kept WHERE action = 'delete'), after AS (SELECT n.* REPLACE (coalesce(k.new_label, n.label) AS label, coalesce(k.new_name, n.name) AS name) FROM nodes n LEFT JOIN kept k ON k.id = n.id AND k.keep = k.id WHERE n.id NOT IN (SELECT id FROM gone))"
INDUSTRY_NODES = _CONSOLIDATED + " " + _merged("moved", "folds", "fill_null", "after")
INDUSTRY_EDGES = _CONSOLIDATED + " SELECT type, count(*) AS n FROM (SELECT DISTINCT coalesce(a.keep, e.src), e.type, coalesce(b.keep, e.dst) FROM edges e LEFT JOIN moved a ON a.dup = e.src LEFT JOIN moved b ON b.dup = e.dst WHERE e.src NOT IN (SELECT id FROM gone) AND e.dst NOT IN (SELECT id FROM gone)) GROUP BY 1"

_NAMES = "concept_names AS (SELECT DISTINCT lower(name) AS key FROM nodes WHERE label = 'Concept' AND name IS NOT NULL)"
GLOSSARY = f""", {_NAMES}, t AS (SELECT term_id, term, lower(term) AS k FROM definitions),
 pairs AS (SELECT q.k, c.key, {_ratio("q.k", "c.key")} AS score FROM (SELECT DISTINCT k FROM t WHERE k NOT IN (SELECT key FROM concept_names)) q JOIN concept_names c ON 200.0 * least(length(q.k), length(c.key)) >= 85 * (length(q.k) + length(c.key))),
 best AS (SELECT k, key, score FROM pairs WHERE score >= 85 QUALIFY row_number() OVER (PARTITION BY k ORDER BY score DESC, key) = 1)
 SELECT term_id, term, k AS name, 100.0::DOUBLE AS score, 'exact' AS how FROM t WHERE k IN (SELECT key FROM concept_names)
 UNION ALL SELECT t.term_id, t.term, best.key, round(best.score::DOUBLE, 6), 'fuzzy' FROM t JOIN best USING (k)"""

GLOSSARY_TOP = f""", {_NAMES}, t AS (SELECT DISTINCT lower(term) AS term FROM definitions),
 pairs AS (SELECT q.term, c.key, {_ratio("q.term", "c.key")} AS score FROM (SELECT term FROM t WHERE term NOT IN (SELECT key FROM concept_names)) q JOIN concept_names c ON 200.0 * least(length(q.term), length(c.key)) >= 85 * (length(q.term) + length(c.key))),
 best AS (SELECT term, list(key ORDER BY score DESC, key)[1:3] AS m FROM pairs WHERE score >= 85 GROUP BY 1)
 SELECT term, CASE WHEN term IN (SELECT key FROM concept_names) THEN [term] ELSE coalesce(m, []) END AS matches FROM t LEFT JOIN best USING (term)"""

MENTIONS = """, found AS (SELECT id AS src, lower(name) AS name FROM nodes WHERE label IN ('Standard', 'Industry') AND length(name) >= 4),
 texts AS (SELECT id, ' ' || lower(text) || ' ' AS t FROM chunks),
 hits AS (SELECT f.name, t.id FROM (SELECT DISTINCT name FROM found) f JOIN texts t ON contains(t.t, ' ' || f.name || ' '))
 SELECT DISTINCT f.src, 'MENTIONED_IN' AS type, h.id AS dst FROM found f JOIN hits h USING (name) ANTI JOIN edges e ON e.src = f.src AND e.dst = h.id AND e.type = 'MENTIONED_IN'"""

_BACKFILL = MENTIONS.replace("\n SELECT DISTINCT f.src", ",\n new_mentions AS (SELECT DISTINCT f.src") + """), applied AS (SELECT n.id AS standard_id, industry, (SELECT min(i.id) FROM nodes i WHERE i.label = 'Industry' AND i.name = industry) AS industry_id
 FROM nodes n JOIN (VALUES ('blue bolt', 'automobile'), ('red plate', 'rail')) k(name, industry) USING (name) WHERE n.label = 'Standard')"""

WORDS = r"len(list_filter(regexp_split_to_array(text, '[\s\x0B\x{1C}-\x{1F}\x{85}\p{Z}]+'), lambda w: w <> ''))"
WORDS_OF = WORDS.replace("(text,", "(coalesce({0}, ''),")
COSINE = "(list_cosine_similarity(embedding::DOUBLE[], (SELECT embedding::DOUBLE[] FROM embeddings WHERE vec_id = (SELECT min(vec_id) FROM embeddings))) + 1) / 2"
_TOKENS = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda t: t <> '')"
BM25 = f""", toks AS (SELECT id, {_TOKENS} AS t FROM chunks), sizes AS (SELECT count(*) AS docs, avg(len(t)) AS mean FROM toks),
 hits AS (SELECT id, size, term, count(*) AS tf FROM (SELECT id, len(t) AS size, unnest(t) AS term FROM toks) WHERE term IN ('blue', 'the', 'on') GROUP BY ALL),
 df AS (SELECT term, count(*) AS df FROM hits GROUP BY 1)
 SELECT id, round(sum(ln(1 + (docs - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * size / mean))), 6) AS score FROM hits JOIN df USING (term), sizes GROUP BY id ORDER BY round(sum(ln(1 + (docs - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * size / mean))), 9) DESC, id LIMIT 10"""
CHUNK_ENTITIES = "SELECT e.id, label, name, mentions FROM (SELECT id, count(*) AS mentions FROM mentioned WHERE chunk_id IN ({0}) GROUP BY 1) JOIN nodes e USING (id) ORDER BY mentions DESC, label, name NULLS FIRST, id LIMIT 20"

REPAIRED_INDEX = "CASE WHEN index IS NOT NULL OR article_id IS NULL THEN index ELSE row_number() OVER (PARTITION BY article_id, index IS NULL ORDER BY id) - 1 END"
NEW_TITLE = "CASE WHEN title IS NULL OR length(title) < 15 OR title = 'Webinar' THEN CASE WHEN length(description) > 15 THEN CASE WHEN contains(description, '.') THEN left(description, instr(description, '.')) ELSE left(description, 100) END ELSE 'Webinar: ' || replace(string_split(coalesce(url, 'unknown'), '/')[-1], '-', ' ') END ELSE title END"
GLOSSARY_DEFINITIONS = "SELECT e.id, d.definition FROM entities e JOIN (SELECT lower(term) AS k, arg_min(definition, term_id || lpad(ord::VARCHAR, 12, '0')) AS definition FROM definitions WHERE coalesce(definition, '') <> '' GROUP BY 1) d ON d.k = lower(e.name) WHERE coalesce(e.definition, '') = ''"
_GONE = f"SELECT id FROM entities WHERE lower(name) IN {_set(rules.GENERIC_TERMS)}"
_PREVIEW = {
    "degenerate_chunks": "SELECT count(*) FROM chunks WHERE length(text) < 100 AND id NOT IN (SELECT chunk_id FROM mentioned)", "chunk_index": "SELECT count(*) FROM chunks WHERE index IS NULL AND article_id IS NOT NULL",
    "chunk_ids": "SELECT count(*) FROM chunks WHERE chunk_id IS NULL AND article_id IS NOT NULL", "titles": "SELECT count(*) FROM webinars WHERE title IS NULL OR length(title) < 15 OR title = 'Webinar'",
    "mislabeled": "SELECT count(*) FROM relabel", "definitions": f"SELECT count(*) FROM ({GLOSSARY_DEFINITIONS})", "generics": f"SELECT count(*) FROM ({_GONE})", "plurals": "SELECT count(*) FROM plural_merge",
}
PREVIEW = ", p AS (" + " UNION ALL ".join(f"SELECT '{k}' AS repair, ({v})::BIGINT AS n" for k, v in _PREVIEW.items()) + ") SELECT * FROM p UNION ALL SELECT 'total', sum(n)::BIGINT FROM p"

LINKS = ", refs AS (SELECT article_id, 'https://guide.example/ch' || chapter_number || '/' || (article_number * 3) % 50 AS url, title AS text FROM articles), urls AS (SELECT url, arg_max(article_id, article_number) AS target FROM articles GROUP BY 1) SELECT DISTINCT article_id AS src, 'REFERENCES' AS type, target AS dst, text FROM refs JOIN urls USING (url) WHERE article_id <> target"

_TERMS = "terms AS (SELECT DISTINCT lower(string_split(term, ' ')[1]) AS name FROM definitions WHERE term <> '')"
_HITS = f"{_TERMS}, hits AS (SELECT c.id AS chunk_id, t.name, instr(' ' || lower(c.text) || ' ', ' ' || t.name || ' ') - 1 AS s FROM chunks c JOIN terms t ON contains(' ' || lower(c.text) || ' ', ' ' || t.name || ' ') WHERE length(c.text) > 50)"
_EVENTS = "ev AS (SELECT event_id AS k, 'doc-' || event_id || '-0' AS chunk_id, event_type, NOT (event_id % 5 = 0) AND event_id % 7 = 0 AS bad FROM events)"
_SECTIONS = """heads AS (SELECT doc_id AS id, pos, text AS line, pos // 5 AS section FROM lines),
 secs AS (SELECT id, (section + 1)::BIGINT AS section, trim(string_agg(line, chr(10) ORDER BY pos)) AS text, CASE WHEN (section * 5) % 10 = 0 THEN 'H' || (section * 5) ELSE 'H' || (section * 5 - 5) END AS h1, CASE WHEN (section * 5) % 10 = 5 THEN 'H' || (section * 5) END AS h2 FROM heads WHERE pos % 5 <> 0 GROUP BY id, section)"""

QUERIES = {
    # merges
    "xlabel_winner": "SELECT name, winner, n_labels, n_nodes FROM winners",
    "xlabel_merge_map": "SELECT dup, keep, name FROM cross_map",
    "samelabel_merge_map": "SELECT dup, keep, label, name FROM same_map",
    "merged_edges_after_dedup": _rewrite("cross_map"),
    "merged_edges_same_label": _rewrite("same_map"),
    "property_fold_dup_wins": "SELECT keep, arg_max(definition, ord) FILTER (definition IS NOT NULL) AS definition, arg_max(description, ord) FILTER (description IS NOT NULL) AS description, arg_max(display_name, ord) FILTER (display_name IS NOT NULL) AS display_name FROM groups GROUP BY 1",
    "property_fold_fill_null": "SELECT keep, arg_min(definition, ord) FILTER (definition IS NOT NULL) AS definition, arg_min(description, ord) FILTER (description IS NOT NULL) AS description, arg_min(display_name, ord) FILTER (display_name IS NOT NULL) AS display_name FROM groups GROUP BY 1",
    "property_fold_union_longer": "SELECT keep, arg_min(definition, lpad((100000 - length(definition))::VARCHAR, 6, '0') || ord) FILTER (definition IS NOT NULL) AS definition, array_to_string(list_sort(list_distinct(flatten(list(source_spans)))), ',') AS source_spans FROM groups GROUP BY 1",
    "merged_nodes_same_label": _merged("same_map", "same_map", "dup_wins"),
    "merged_nodes_across_labels": _merged("cross_map", "cross_map", "union_longer"),
    "industry_nodes": INDUSTRY_NODES,
    "industry_edges": INDUSTRY_EDGES,
    "generic_deletion": f"SELECT count(*) AS nodes_left, (SELECT count(*) FROM edges WHERE src NOT IN ({_GONE}) AND dst NOT IN ({_GONE})) AS edges_left FROM nodes WHERE id NOT IN ({_GONE})",
    "plural_merge_edges": _rewrite("plural_merge"),
    "label_backfill": f"SELECT array_to_string(CASE WHEN label IN {ENTITY} AND NOT list_contains(labels, '__Entity__') THEN list_concat(labels, list_filter(['__Entity__', '__KGBuilder__'], lambda x: NOT list_contains(labels, x))) ELSE labels END, '+') AS label_set, count(*) AS n FROM nodes GROUP BY 1",
    # names
    "normalize_names": f"SELECT id, {NORMAL} AS normal FROM nodes",
    "name_equivalence": f"SELECT normal, count(*) AS n FROM (SELECT {NORMAL} AS normal FROM nodes) GROUP BY 1 HAVING count(*) > 1",
    "entity_name_pass": f"SELECT id, CASE WHEN label IN {ENTITY} THEN {plain('name')} ELSE name END AS name, CASE WHEN label IN {ENTITY} AND name <> {plain('name')} THEN coalesce(display_name, name) ELSE display_name END AS display_name FROM nodes",
    "name_stats": f"SELECT label, count(*) AS total, count_if(name = {plain('name')})::BIGINT AS normalized, count_if(name <> {plain('name')})::BIGINT AS needs FROM entities WHERE name IS NOT NULL GROUP BY 1",
    "generic_flag": f"SELECT id, CASE WHEN coalesce(name, '') = '' THEN true ELSE {plain('name')} IN {_set(rules.GENERIC_TERMS)} END AS generic FROM nodes",
    "singularize": f"SELECT plural AS term, one AS singular FROM singulars UNION ALL SELECT DISTINCT name, CASE WHEN name = '' THEN name ELSE coalesce(one, {plain('name')}) END FROM nodes LEFT JOIN singulars ON plural = {plain('name')} WHERE name IS NOT NULL",
    "cleanup_disposition": f"SELECT id, action, value, coalesce(action = 'keep' AND value <> {plain('name')}, false) AS renamed FROM valued",
    "cleanup_buckets": f"SELECT CASE WHEN action = 'keep' THEN CASE WHEN value <> {plain('name')} THEN 'to_normalize' ELSE 'to_keep' END WHEN action = 'delete' THEN 'to_delete' ELSE 'skipped' END AS bucket, count(*) AS n FROM valued GROUP BY 1",
    "cleanup_candidates": "SELECT e.id, label, name, coalesce(degree, 0) AS degree FROM entities e LEFT JOIN degrees d ON d.id = e.id",
    "cleanup_preview": "SELECT action, count(*) AS n, coalesce(sum(CASE WHEN label IN " + ENTITY + " THEN coalesce(degree, 0) END), 0)::BIGINT AS relationships FROM dispositions d LEFT JOIN degrees g ON g.id = d.id GROUP BY 1 UNION ALL SELECT 'plural_pair', count(*), 0 FROM plural_map",
    "mislabel_first_word": f"SELECT id, coalesce(list_contains({POSITIVE}, regexp_split_to_array({plain('name')}, '\\s+')[1]), false) AS flagged FROM nodes",
    "mislabel_any_word": f"SELECT id, list_has_any(string_split(lower(name), ' '), {POSITIVE}) AS flagged FROM nodes WHERE name IS NOT NULL",
    "fragments": f"SELECT id, array_to_string({FRAGMENTS}, '#') AS fragments FROM nodes",
    # fuzzy
    "fuzzy_ratio_pairs": f", n1 AS (SELECT DISTINCT p_name AS a FROM part), n2 AS (SELECT DISTINCT term AS b FROM tax) SELECT a, b, round({_ratio('a', 'b')}::DOUBLE, 6) AS score FROM n1 JOIN n2 ON 200.0 * least(length(a), length(b)) >= 60 * (length(a) + length(b)) WHERE {_ratio('a', 'b')} >= 60",
    "industry_disposition": CLASSIFY + " SELECT term, action, value FROM classified",
    "industry_consolidated": CONSOLIDATION,
    "industry_bulk_rename": f"SELECT id, CASE WHEN label = 'Industry' THEN coalesce(t.canonical, n.name) ELSE n.name END AS name FROM nodes n LEFT JOIN tax t ON t.kind = 'taxonomy' AND t.term = {plain('n.name')}",
    "industry_normalized": CLASSIFY + " SELECT term, CASE WHEN p = '' OR con OR gen THEN NULL ELSE coalesce(canonical, near, CASE WHEN org THEN NULL END) END AS industry FROM terms JOIN marks USING (p) WHERE term NOT IN (SELECT term FROM tax WHERE kind = 'organization')",
    # checks
    "orphan_chunks": "SELECT count(*) AS orphan_chunks FROM chunks WHERE article_id IS NULL",
    "orphan_entities": ORPHANS, "duplicate_entities": DUPLICATES,
    "missing_embeddings": "SELECT count(*) AS missing_embeddings FROM chunks WHERE NOT embedded",
    "industry_count": "SELECT count(*) AS industries FROM nodes WHERE label = 'Industry'",
    "entity_stats": f"SELECT label, count(*) AS n FROM (SELECT label FROM nodes UNION ALL SELECT 'Article' FROM articles UNION ALL SELECT 'Chunk' FROM chunks UNION ALL SELECT 'Definition' FROM definitions UNION ALL SELECT 'Webinar' FROM webinars) WHERE label IN {_set(rules.STATS_LABELS)} GROUP BY 1",
    "invalid_patterns": INVALID,
    "valid_pattern_edges": "SELECT source_label, type, target_label, count(*) AS n FROM typed SEMI JOIN patterns USING (source_label, type, target_label) GROUP BY ALL",
    "article_coverage": "SELECT count(*) AS articles, count(DISTINCT chapter_number) AS chapters FROM articles",
    "missing_chunk_ids": "SELECT count(*) AS missing_chunk_ids FROM chunks WHERE chunk_id IS NULL",
    "missing_chunk_index": "SELECT count(*) AS missing_chunk_index FROM chunks WHERE index IS NULL",
    "degenerate_chunks": DEGENERATE, "plural_pairs": PLURALS, "generic_entities": GENERIC,
    "relationship_counts": "SELECT name, sum(coalesce(degree, 0))::BIGINT AS relationships FROM nodes n LEFT JOIN degrees d ON d.id = n.id WHERE label = 'Concept' AND name IS NOT NULL GROUP BY 1",
    "unmentioned_entities": UNMENTIONED, "ghost_entities": GHOSTS, "near_duplicates": NEAR, "missing_definitions": UNDEFINED, "truncated_titles": TITLES, "mislabeled_challenges": MISLABELED,
    "chunk_article_mapping": "SELECT id, article_id, index FROM chunks WHERE chunk_id IS NULL AND article_id IN (SELECT article_id FROM articles) ORDER BY article_id, index NULLS FIRST, id LIMIT 100",
    "validation_summary": SUMMARY,
    "validation_counts": ALL_COUNTED,
    "extraction_prompts": PROMPTS,
    "validation_passed": f"SELECT bool_and(ok) AS passed FROM ({SUMMARY}) WHERE required",
    # repairs
    "fix_chunk_index": f"SELECT id, article_id, ({REPAIRED_INDEX})::INT AS index FROM chunks",
    "fix_chunk_ids": "SELECT id, coalesce(chunk_id, article_id || '_chunk_' || right('000' || coalesce(index, 0)::VARCHAR, 4)) AS chunk_id FROM chunks",
    "fix_titles": f"SELECT id, {NEW_TITLE} AS title FROM webinars",
    "fix_mislabeled": "SELECT id, CASE WHEN id IN (SELECT id FROM relabel) THEN 'Concept' ELSE label END AS label FROM nodes",
    "fix_definitions": GLOSSARY_DEFINITIONS,
    "fix_generic": f"SELECT id FROM nodes WHERE id NOT IN ({_GONE})",
    "fix_plural": "SELECT id FROM nodes WHERE id NOT IN (SELECT dup FROM plural_merge)",
    "fix_degenerate": "SELECT id FROM chunks WHERE NOT (length(text) < 100 AND id NOT IN (SELECT chunk_id FROM mentioned))",
    "fix_preview": PREVIEW,
    # linking
    "mention_backfill": MENTIONS,
    "applies_to_backfill": ", known(name, industry) AS (VALUES " + _rows([("blue bolt", "automobile"), ("red plate", "rail")]) + ") SELECT s.id AS standard_id, k.industry, (SELECT min(id) FROM nodes i WHERE i.label = 'Industry' AND i.name = k.industry) AS industry_id FROM known k JOIN nodes s ON s.label = 'Standard' AND s.name = k.name",
    "glossary_links": GLOSSARY,
    "glossary_exact": f", {_NAMES} SELECT term_id, term FROM definitions WHERE lower(term) IN (SELECT key FROM concept_names)",
    # structure
    "chapter_structure": f"SELECT chapter_number, count(*) AS articles, sum({WORDS})::BIGINT AS total_words FROM articles GROUP BY 1",
    "chapter_rollup": f"SELECT chapter_number, count(*) AS articles, sum({WORDS})::BIGINT AS total_words, sum(length(text))::BIGINT AS total_chars FROM articles GROUP BY ROLLUP (chapter_number)",
    "in_chapter_edges": "SELECT article_id AS src, 'IN_CHAPTER' AS type, 'chapter-' || chapter_number AS dst FROM articles",
    "definitions": "SELECT term_id, arg_max(term, ord) AS term, arg_max(definition, ord) AS definition FROM definitions GROUP BY 1",
    "article_relationships": LINKS,
    "article_index": ", c AS (SELECT article_id, count(*) AS n FROM chunks WHERE article_id IS NOT NULL GROUP BY 1), u AS (SELECT url, arg_max(article_id, article_number) AS target FROM articles GROUP BY 1) SELECT a.article_id, chapter_number, a.url, coalesce(n, 0) AS n_chunks, u.target = a.article_id AS url_owner FROM articles a JOIN u USING (url) LEFT JOIN c USING (article_id)",
    "webinar_thumbnails": ", k AS (SELECT url, min(thumbnail) AS found FROM webinars WHERE thumbnail IS NOT NULL GROUP BY 1) SELECT id, w.url, coalesce(thumbnail, found) AS thumbnail FROM webinars w LEFT JOIN k USING (url)",
    "resource_facts": f"SELECT id, coalesce(length(description) > 50, false) AS has_description, coalesce(length(thumbnail) > 0, false) AS has_caption, {WORDS_OF.replace('{0}', 'description')} AS description_words, coalesce(regexp_matches(lower(title), 'figure|diagram|chart|graph|flow'), false) AS is_figure, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) AS domain FROM webinars",
    "word_counts": f"SELECT article_id, {WORDS}::BIGINT AS words, length(text) AS chars FROM articles",
    "diag_labels": "SELECT label, list_contains(labels, '__Entity__') AS has_entity, list_contains(labels, '__KGBuilder__') AS has_builder, count(*) AS n FROM nodes GROUP BY 1, 2, 3",
    "diag_label_sets": "SELECT array_to_string(labels, '+') AS label_set, count(*) AS n FROM nodes GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10",
    "diag_relations": "SELECT type, count(*) AS n FROM ends WHERE id IN (SELECT id FROM nodes WHERE label = 'Concept') GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10",
    # retrieval
    "vector_topk": f"SELECT vec_id AS id, round({COSINE}, 6) AS score FROM embeddings ORDER BY {COSINE} DESC, vec_id LIMIT 5",
    "chunk_entities": CHUNK_ENTITIES.format("SELECT id FROM chunks WHERE chunk_id IS NOT NULL"),
    "name_search": f"SELECT e.id, label, name, display_name, definition, coalesce(c, 0) AS connections FROM nodes e LEFT JOIN (SELECT id, count(DISTINCT other) AS c FROM ends GROUP BY 1) x ON x.id = e.id WHERE label IN {_set(rules.SEARCH_LABELS)} AND (contains(name, 'gear') OR contains(display_name, 'gear')) ORDER BY connections DESC, e.id LIMIT 10",
    "neighbourhood": "SELECT e.type AS rel_type, CASE WHEN outgoing THEN '->' ELSE '<-' END AS direction, r.label AS related_label, r.name AS related_name, e.id, e.other FROM ends e JOIN nodes r ON r.id = e.other WHERE e.id IN (SELECT id FROM nodes WHERE name = 'blue bolt')",
    "two_hop": "SELECT DISTINCT a.name AS start, v.name AS via, b.name AS \"end\" FROM nodes v JOIN edges x ON x.src = v.id AND x.type = 'APPLIES_TO' JOIN nodes a ON a.id = x.dst JOIN edges y ON y.src = v.id AND y.type = 'DEFINES' JOIN nodes b ON b.id = y.dst WHERE v.label = 'Standard'",
    "article_entities": "SELECT c.article_id, m.id, count(*) AS mentions FROM mentioned m JOIN chunks c ON c.id = m.chunk_id WHERE c.article_id IS NOT NULL GROUP BY 1, 2",
    "bm25_topk": BM25,
    "retrieval_chain": f", near AS (SELECT vec_id FROM embeddings ORDER BY {COSINE} DESC, vec_id LIMIT 50) " + CHUNK_ENTITIES.format("SELECT 'doc-' || vec_id || '-0' FROM near"),
    # communities
    "semantic_edges": "SELECT source, target FROM semantic",
    "modularity": MODULARITY,
    "label_propagation": LABELS,
    "glean_parse": f", {_EVENTS} SELECT chunk_id, CASE WHEN bad THEN 0 ELSE 2 END::BIGINT AS n_nodes, CASE WHEN bad THEN 0 ELSE 1 END::BIGINT AS n_relationships, bad AS failed FROM ev",
    "glean_merge_nodes": f", {_EVENTS} SELECT label, name, count(*) AS mentions FROM (SELECT 'Concept' AS label, event_type AS name FROM ev WHERE NOT bad UNION ALL SELECT 'Standard', 'blue bolt' FROM ev WHERE NOT bad AND k % 2 = 0) GROUP BY 1, 2",
    "glean_merge_edges": f", {_EVENTS}, all_names AS (SELECT id, lower(name) AS name FROM nodes WHERE name IS NOT NULL UNION SELECT 'new-' || event_type, event_type FROM ev WHERE NOT bad UNION SELECT 'new-bolt', 'blue bolt' WHERE NOT EXISTS (SELECT 1 FROM nodes WHERE label = 'Standard' AND name = 'blue bolt')), rel AS (SELECT DISTINCT event_type AS a, CASE k % 3 WHEN 0 THEN 'DEFINES' ELSE 'RELATED_TO' END AS type FROM ev WHERE NOT bad AND k % 3 <> 2) SELECT type, count(*) AS n FROM rel JOIN all_names x ON x.name = a JOIN all_names y ON y.name = 'blue bolt' GROUP BY 1",
    "dictionary_extract": f", {_HITS} SELECT chunk_id, name, s || '-' || (s + length(name)) AS span FROM hits",
    "source_spans": f", {_HITS} SELECT 'Concept' AS label, name, upper(name[1]) || lower(name[2:]) AS display_name, count(*) AS n_spans FROM hits WHERE length(name) >= 2 AND name NOT IN (SELECT name FROM entities WHERE name IS NOT NULL) GROUP BY 2",
    "section_rows": f", {_SECTIONS} SELECT id, section, h1, h2, NULL::VARCHAR AS h3, text FROM secs WHERE text <> ''",
    "chunk_size_rule": f", {_SECTIONS} SELECT length(text) > 1500 AS split, length(text) >= 100 AS kept, count(*) AS n FROM secs WHERE text <> '' GROUP BY 1, 2",
    "jsonl_records": "SELECT 'article' AS type, 'guide' AS guide_title, count(*) AS n, count(*) AS with_article, 0::BIGINT AS with_term FROM articles UNION ALL SELECT 'glossary_term', 'guide', count(*), 0, count(*) FROM definitions",
    "html_facts": r"SELECT page_id, trim(regexp_extract(html, '<title>(.*?)</title>', 1, 's'), chr(32) || chr(9) || chr(10)) AS title, len(regexp_extract_all(html, '<a href=\"([^\"]*)\"')) AS n_links, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) AS authority FROM pages",
    "entity_fragments": f"SELECT id, name, length(description) AS length, array_to_string({FRAGMENTS}, '#') AS fragments FROM entities WHERE length(description) > 10 ORDER BY length DESC, id LIMIT 100",
    "entity_summaries": f"SELECT id, len(f) AS n_fragments, (SELECT string_agg(v, '; ' ORDER BY k) FROM (SELECT v, min(i) AS k FROM (SELECT unnest(f) AS v, generate_subscripts(f, 1) AS i) GROUP BY v)) AS summary FROM (SELECT id, {FRAGMENTS} AS f FROM entities WHERE description IS NOT NULL) WHERE len(f) >= 2",
    "constraint_checks": "SELECT 'article_id' AS \"constraint\", (SELECT count(*) FROM (SELECT article_id FROM articles GROUP BY 1 HAVING count(*) > 1)) AS broken UNION ALL SELECT 'article_url', (SELECT count(*) FROM (SELECT url FROM articles GROUP BY 1 HAVING count(*) > 1)) UNION ALL SELECT 'chunk_id', (SELECT count(*) FROM (SELECT chunk_id FROM chunks WHERE chunk_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)) UNION ALL SELECT 'term_id', (SELECT count(*) FROM (SELECT term_id FROM definitions GROUP BY 1 HAVING count(*) > 1)) UNION ALL SELECT 'chunk_article', (SELECT count(*) FROM chunks WHERE article_id IS NULL) UNION ALL SELECT 'node_name', (SELECT count(*) FROM nodes WHERE name IS NULL)",
    "article_vectors": f"SELECT article_id, 64::BIGINT AS dimensions, len({_TOKENS})::DOUBLE AS words FROM articles",
    "community_member_rows": f", part_of AS ({PARTITION}) SELECT community, id, name, label, description FROM entities JOIN part_of ON node = name",
    "mention_backfill_terms": MENTIONS.replace("FROM nodes WHERE", "FROM (SELECT id, label, name FROM nodes UNION ALL SELECT DISTINCT 'term-' || t, 'Standard', t FROM (SELECT lower(string_split(term, ' ')[1]) AS t FROM definitions WHERE ord < 100000 UNION ALL SELECT lower(term) FROM definitions WHERE ord < 100000) WHERE t <> '') WHERE"),
    "ghost_entities_bare": "SELECT e.id, e.label, e.name, m.chunk_id FROM entities e JOIN mentioned m USING (id) ORDER BY 1, 4 LIMIT 100",
    "glossary_top3": GLOSSARY_TOP,
    "chunks_with_entities": """, linked AS (SELECT DISTINCT e.dst AS chunk, concat_ws('|', n.name, n.label, coalesce(n.definition, '')) AS t FROM edges e JOIN nodes n ON n.id = e.src WHERE e.type = 'MENTIONED_IN' AND n.name IS NOT NULL)
 SELECT c.id AS chunk, article_id, index, count(t) AS n_entities, coalesce(string_agg(t, ';' ORDER BY t), '') AS entities FROM chunks c LEFT JOIN linked ON chunk = c.id GROUP BY ALL""",
    "backfill_counts": _BACKFILL + " SELECT 'mentions' AS kind, count(*) AS n FROM new_mentions UNION ALL SELECT 'applies_to', count(*) FROM applied",
    "backfill_edges": _BACKFILL + " SELECT type, count(*) AS n FROM (SELECT src, type, dst FROM edges UNION SELECT src, type, dst FROM new_mentions UNION SELECT standard_id, 'APPLIES_TO', coalesce(industry_id, 'industry-' || industry) FROM applied) GROUP BY 1",
    "cleanup_run": f""", gone AS ({_GONE}), left_nodes AS (SELECT * FROM nodes WHERE id NOT IN (SELECT id FROM gone)), m AS (SELECT plural_id AS dup, min(singular_id) AS keep FROM plural_map WHERE plural_id NOT IN (SELECT id FROM gone) AND singular_id NOT IN (SELECT id FROM gone) GROUP BY 1)
 SELECT 'nodes' AS "table", count(*) AS n FROM left_nodes WHERE id NOT IN (SELECT dup FROM m) UNION ALL
 SELECT 'edges', count(*) FROM (SELECT DISTINCT coalesce(a.keep, e.src), e.type, coalesce(b.keep, e.dst) FROM edges e LEFT JOIN m a ON a.dup = e.src LEFT JOIN m b ON b.dup = e.dst WHERE e.src NOT IN (SELECT id FROM gone) AND e.dst NOT IN (SELECT id FROM gone))""",
    "fuzzy_best_match": f", n1 AS (SELECT DISTINCT p_name AS a FROM part), s AS (SELECT a, term, ord, {_ratio('a', 'term')}::DOUBLE AS score FROM n1 JOIN tax ON kind = 'taxonomy' AND 200.0 * least(length(a), length(term)) >= 40 * (length(a) + length(term))) SELECT a AS term, term AS key, round(score, 6) AS score FROM s WHERE score >= 40 QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, ord) = 1",
    "schema_types": " SELECT * FROM (VALUES " + _rows([("node", x) for x in rules.ENTITY_LABELS] + [("relationship", x) for x in rules.RELATIONSHIPS]) + ") x(kind, name)",
    "schema_patterns": " SELECT source_label, type, target_label FROM patterns",
    "search_chain": f""", hit AS (SELECT e.id FROM nodes e LEFT JOIN (SELECT id, count(DISTINCT other) AS c FROM ends GROUP BY 1) x ON x.id = e.id WHERE label IN {_set(rules.SEARCH_LABELS)} AND (contains(name, 'gear') OR contains(display_name, 'gear')) ORDER BY coalesce(c, 0) DESC, e.id LIMIT 1)
 SELECT e.type AS rel_type, CASE WHEN outgoing THEN '->' ELSE '<-' END AS direction, r.label AS related_label, r.name AS related_name, e.id, e.other FROM ends e JOIN hit USING (id) JOIN nodes r ON r.id = e.other""",
    "article_topk": f", near AS (SELECT vec_id, {COSINE} AS score FROM embeddings ORDER BY score DESC, vec_id LIMIT 5) SELECT c.id AS chunk_id, c.article_id, a.title, round(score, 6) AS score FROM near JOIN chunks c ON c.id = 'doc-' || vec_id || '-0' LEFT JOIN articles a ON a.article_id = c.article_id",
    "health_queries": f""" SELECT 'orphan_chunks' AS "check", ({_SUMMARY['orphan_chunks']}) AS value UNION ALL SELECT 'industries', ({_SUMMARY['industries']}) UNION ALL SELECT 'duplicates', (SELECT count(*) FROM (SELECT label, name FROM entities GROUP BY 1, 2 HAVING count(*) > 1))
 UNION ALL SELECT 'missing_embeddings', ({_SUMMARY['missing_embeddings']}) UNION ALL SELECT 'communities_without_vector', (SELECT count(DISTINCT community) FROM ({PARTITION}) WHERE community = 'Concept')""",
    "related_labels": "SELECT e.type, CASE WHEN outgoing THEN 'out' ELSE 'in' END AS direction, o.label AS other_label, count(*) AS n FROM ends e JOIN nodes n ON n.id = e.id AND n.label = 'Concept' JOIN nodes o ON o.id = e.other GROUP BY ALL ORDER BY n DESC, 1, 2, 3 LIMIT 10",
    "mention_overlap": "SELECT label, count(*) AS mentioned, count_if(NOT list_contains(labels, '__Entity__'))::BIGINT AS without_entity_label, count_if(id IN (SELECT id FROM ends WHERE type <> 'MENTIONED_IN'))::BIGINT AS with_relations FROM nodes WHERE id IN (SELECT src FROM edges WHERE type = 'MENTIONED_IN') GROUP BY 1",
    "mention_edges": f", {_HITS} SELECT 'MENTIONED_IN' AS type, count(*) AS n, count(DISTINCT name) AS entities FROM hits WHERE length(name) >= 2",
    "community_assignment": f", part_of AS ({PARTITION}) SELECT id, community FROM entities LEFT JOIN part_of ON node = name",
    "in_community_edges": f", part_of AS ({PARTITION}) SELECT id AS src, 'IN_COMMUNITY' AS type, 'community-' || community AS dst FROM entities JOIN part_of ON node = name",
    "community_members": f", part_of AS ({PARTITION}) SELECT community, count(*) AS member_count, count(DISTINCT label) AS labels FROM entities JOIN part_of ON node = name GROUP BY 1",
}

QUERIES |= documents.GRAPH_ORACLES
QUERIES |= indexed.oracles(plain, PRIORITY, ENTITY, BM25)

ORACLES = {name: BASE + (", " + sql[1:] if sql.startswith(",") else sql) for name, sql in QUERIES.items()}
