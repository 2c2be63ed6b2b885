"""The registered queries in SQL, where SQL can say them; written for DuckDB."""

from __future__ import annotations

from starmill.llm import licenses
from starmill.llm.chat import ChatTemplate

ORACLES: dict[str, str] = {}

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = rf"regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


# -- chat --------------------------------------------------------------------

_TEMPLATE = ChatTemplate()
_MARKS = sum(len(m) for m in (_TEMPLATE.start, _TEMPLATE.middle, _TEMPLATE.end))


def _escaped_chars(column: str) -> str:
    """Characters of an escaped text: one more for every backslash and every control string."""
    times = [f"(length({column}) - length(replace({column}, {quoted(c)}, ''))) // {len(c)}" for c in ("\\", *_TEMPLATE.controls)]
    return " + ".join([f"length({column})", *times])


ORACLES["op1_chat"] = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '\\### Assistant: </turn> ok' FROM range(2) r(i)
),
chats AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS lost,
    string_agg(CASE WHEN role IN ('user', 'assistant', 'system') THEN role[1] ELSE '?' END, '' ORDER BY turn, role, text) AS roles,
    CAST(sum({_MARKS} + {_escaped_chars("role")} + {_escaped_chars("text")}) AS BIGINT) AS formatted_chars
  FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(lost) AS loss_chars, sha256(lost) AS loss_sha256, formatted_chars,
  regexp_full_match(roles, 's?(ua)+') AS valid
FROM chats"""

# -- licenses ----------------------------------------------------------------

_TEMPLATES = licenses.PHRASES + licenses.NOTICES
_PAIRS = [
    f"({i}, '{t.label}', {t.exact}, {len(t.text.split()) - 1}, {place}, '{a}', '{b}')"
    for i, t in enumerate(_TEMPLATES)
    for place, (a, b) in enumerate(zip(t.text.split(), t.text.split()[1:], strict=False))
]

ORACLES["op3_licenses"] = f"""
WITH split AS (SELECT doc_id, {WORDS} AS w FROM documents),
known(template, label, exact, n_pairs, place, a, b) AS (VALUES {", ".join(_PAIRS)}),
pairs AS (SELECT doc_id, unnest(list_transform(range(1, len(w)), lambda s: {{'at': s - 1, 'a': w[s], 'b': w[s + 1]}})) AS p FROM split),
votes AS (
  SELECT doc_id, template, label, exact, n_pairs, p.at - place AS diagonal, list(place) AS places, min(p.at) AS first_at
  FROM pairs JOIN known ON p.a = a AND p.b = b GROUP BY ALL
),
marked AS (
  SELECT *, CASE WHEN diagonal - lag(diagonal) OVER t <= CASE WHEN exact THEN 0 ELSE {licenses.DRIFT} END THEN 0 ELSE 1 END AS begins
  FROM votes WINDOW t AS (PARTITION BY doc_id, template ORDER BY diagonal)
),
spans AS (SELECT *, sum(begins) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS span FROM marked),
scored AS (
  SELECT doc_id, template, label, exact, span, min(first_at) AS first_word,
    CAST(len(list_distinct(flatten(list(places)))) AS DOUBLE) / n_pairs AS score
  FROM spans GROUP BY doc_id, template, label, exact, n_pairs, span
),
found AS (SELECT * FROM scored WHERE CASE WHEN exact THEN score = 1 ELSE score >= {licenses.SHARE} END),
per_doc AS (
  SELECT doc_id, count(*) FILTER (WHERE exact) AS n_base, min(first_word) FILTER (WHERE exact) AS first_word,
    max(first_word) FILTER (WHERE exact) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE exact) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
  FROM found GROUP BY doc_id
)
SELECT s.doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, coalesce(score, 0) AS score
FROM split s LEFT JOIN per_doc f ON f.doc_id = s.doc_id"""

# -- decontamination ---------------------------------------------------------

ORACLES["op4_decontaminate"] = f"""
WITH docs AS (SELECT doc_id, {WORDS} AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, w, least(len(w), 10) AS n FROM (SELECT item_id, {WORDS} AS w FROM benchmark) WHERE len(w) > 0),
item_windows AS (
  SELECT DISTINCT item, n, unnest(list_transform(range(1, len(w) - n + 2), lambda s: array_to_string(w[s:s + n - 1], ' '))) AS words FROM items
),
doc_windows AS (
  SELECT doc_id, n, unnest(list_transform(range(1, len(w) - n + 2), lambda s: {{'s': s, 'words': array_to_string(w[s:s + n - 1], ' ')}})) AS v
  FROM docs, (SELECT DISTINCT n FROM item_windows) WHERE len(w) >= n
),
hits AS (SELECT doc_id, item, v.s AS s, d.n FROM doc_windows d JOIN item_windows i ON i.n = d.n AND i.words = v.words),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(DISTINCT item) AS n_items, sha256(string_agg(DISTINCT item, ',' ORDER BY item)) AS items_sha256 FROM hits GROUP BY doc_id),
postings AS (SELECT doc_id, generate_subscripts(w, 1) - 1 AS at, unnest(w) AS term FROM docs),
units AS (SELECT row_number() OVER () AS unit, item, w, n FROM (SELECT DISTINCT item, w, n FROM items)),
unit_words AS (SELECT unit, generate_subscripts(w, 1) - 1 AS place, unnest(w) AS term FROM units),
frequencies AS (SELECT term, count(*) AS f FROM postings WHERE term IN (SELECT term FROM unit_words) GROUP BY term),
starts AS (SELECT unit, n, unnest(range(0, len(w) - n + 1)) AS s FROM units),
ranked AS (
  SELECT s.unit, s.s, u.place, u.term, min(coalesce(f, 0)) OVER (PARTITION BY s.unit, s.s) AS least,
    row_number() OVER (PARTITION BY s.unit, s.s ORDER BY coalesce(f, 0), u.place) AS r
  FROM starts s JOIN unit_words u ON u.unit = s.unit AND u.place >= s.s AND u.place < s.s + s.n LEFT JOIN frequencies f ON f.term = u.term
),
needs AS (SELECT DISTINCT unit, list(place ORDER BY place) AS places FROM ranked WHERE least > 0 AND r <= 3 GROUP BY unit, s),
wanted AS (SELECT DISTINCT unit, place, term FROM ranked WHERE least > 0 AND r <= 3),
beginnings AS (SELECT p.doc_id, w.unit, p.at - w.place AS b, w.place FROM postings p JOIN wanted w ON w.term = p.term),
frames AS (SELECT doc_id, unit, list(place) OVER (PARTITION BY doc_id, unit ORDER BY b RANGE BETWEEN CURRENT ROW AND 20 FOLLOWING) AS found FROM beginnings),
close AS (
  SELECT doc_id, count(DISTINCT u.item) AS n_near_items
  FROM (SELECT DISTINCT doc_id, unit, list_sort(list_distinct(found)) AS found FROM frames) f JOIN needs n ON n.unit = f.unit AND list_has_all(f.found, n.places) JOIN units u ON u.unit = f.unit
  GROUP BY doc_id
)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near_items, 0) AS n_near_items
FROM docs d LEFT JOIN places p ON p.doc_id = d.doc_id LEFT JOIN named i ON i.doc_id = d.doc_id LEFT JOIN close c ON c.doc_id = d.doc_id"""

# -- WARC --------------------------------------------------------------------

_NIBBLE = "(strpos('0123456789abcdef', h[5 * g + {}]) - 1)"
_GROUP = " + ".join(f"{16 ** (5 - k)} * {_NIBBLE.format(k)}" for k in range(1, 6))
_LETTER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[CAST(floor(v / {}) AS BIGINT) % 32 + 1]"
_LETTERS = " || ".join(_LETTER.format(32**k) for k in (3, 2, 1, 0))

ORACLES["op5_warc"] = f"""
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages),
groups AS (SELECT page_id, g, {_GROUP} AS v FROM payloads, range(8) r(g)),
digests AS (SELECT page_id, string_agg({_LETTERS}, '' ORDER BY g) AS payload_digest FROM groups GROUP BY page_id),
firsts AS (SELECT page_id, payload, min(page_id) OVER (PARTITION BY payload) AS first FROM payloads)
SELECT f.page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN first = f.page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN first <> f.page_id THEN first END AS refers_to
FROM firsts f JOIN digests d ON d.page_id = f.page_id"""

# -- near-duplicates ---------------------------------------------------------

ORACLES["op9_neardup"] = rf"""
WITH RECURSIVE split AS (SELECT doc_id, regexp_extract_all({LOWERED}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE
    list_distinct(list_transform(range(1, greatest(len(w) - 3, 2)), lambda s: array_to_string(w[s:s + 4], ' '))) END AS shingles
  FROM split
),
each AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM each a JOIN each b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
),
reached(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b),
least AS (SELECT a, min(b) AS b FROM reached GROUP BY a)
SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, coalesce(least(b, doc_id), doc_id) AS component_id, coalesce(least(b, doc_id), doc_id) = doc_id AS kept
FROM sets LEFT JOIN least ON a = doc_id"""

# -- manifest ------------------------------------------------------------------

#: Levels below and above the subroots that are written out: 16^4 documents to a source, 16^2 sources.
_BELOW, _ABOVE = 4, 2


def _said(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({value}) || ':' || {value} END"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_said(f"CAST({c} AS VARCHAR)") for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


# One step for each bit; a byte comes in with the first of its eight.
_BITS = "flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: [CAST(ascii(d) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))"
_STEP = "CASE WHEN xor(c, x) & 1 = 1 THEN xor(xor(c, x) >> 1, 3988292384) ELSE xor(c, x) >> 1 END"
_CRC = f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {_BITS}), lambda c, x: {_STEP}), 4294967295)"


def _tree(name: str, levels: int) -> str:
    """Tables ``<name>0`` (grp, pos, node) up to ``<name><levels>``, and the runs of each level but the last."""
    parts = []
    for k in range(levels):
        run = f"{name}_runs{k} AS (SELECT grp, pos // 16 AS run, list(node ORDER BY pos) AS nodes, any_value(n) AS n FROM (SELECT *, count(*) OVER (PARTITION BY grp) AS n FROM {name}{k}) GROUP BY ALL)"
        top = f"{name}{k + 1} AS (SELECT grp, run AS pos, CASE WHEN n = 1 THEN nodes[1] ELSE sha256(array_to_string(nodes, '')) END AS node FROM {name}_runs{k})"
        parts += [run, top]
    return ",\n".join(parts)


def _way(name: str, levels: int, rows: str) -> str:
    """Tables that add to rows (grp, pos, beside, folded) what stands beside their way, and fold it in, level by level."""
    parts, before = [], rows
    for k in range(levels):
        i = f"(pos // {16**k}) % 16"
        left, right = f"array_to_string(nodes[1:{i}], '')", f"array_to_string(nodes[{i} + 2:], '')"
        parts.append(
            f"{name}_way{k} AS (SELECT w.* REPLACE (beside || {left} || {right} AS beside, CASE WHEN n = 1 THEN folded ELSE sha256({left} || folded || {right}) END AS folded) "
            f"FROM {before} w JOIN {name}_runs{k} r ON r.grp IS NOT DISTINCT FROM w.grp AND r.run = w.pos // {16 ** (k + 1)})"
        )
        before = f"{name}_way{k}"
    return ",\n".join(parts)


_LOWER_TEXT = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES["op12_merkle"] = f"""
WITH leaves AS (SELECT doc_id, source AS grp, {_leaf("text")} AS leaf, CASE WHEN {_CRC} % 5 = 0 THEN {_leaf(_LOWER_TEXT)} END AS tampered FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
t0 AS (SELECT grp, pos, leaf AS node FROM placed),
{_tree("t", _BELOW)},
s0 AS (SELECT 0 AS grp, row_number() OVER (ORDER BY grp NULLS FIRST) - 1 AS pos, node, grp AS source FROM t{_BELOW}),
{_tree("s", _ABOVE)},
started AS (SELECT grp, pos, doc_id, leaf, '' AS beside, coalesce(tampered, leaf) AS folded FROM placed),
{_way("t", _BELOW, "started")},
crossed AS (
  SELECT s0.grp, s0.pos, w.doc_id, w.leaf, w.beside, w.folded, s0.node AS subroot
  FROM t_way{_BELOW - 1} w JOIN s0 ON s0.source IS NOT DISTINCT FROM w.grp
),
{_way("s", _ABOVE, "crossed")}
SELECT doc_id, leaf, subroot, root.node AS root, sha256(beside) AS proof_sha256, folded AS folded_root, folded = root.node AS verified
FROM s_way{_ABOVE - 1}, s{_ABOVE} root"""
