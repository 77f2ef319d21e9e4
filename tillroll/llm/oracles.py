"""DuckDB SQL for the queries of this subpackage whose rows SQL can give."""

from __future__ import annotations

from tillroll.llm.licences import THRESHOLD, size_bounds, template_bigrams
from tillroll.llm.templates import TEMPLATES


def _lowered(column: str) -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"translate({column}, '{upper}', '{upper.lower()}')"


def _words(column: str) -> str:
    return rf"regexp_extract_all({_lowered(column)}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _templates() -> str:
    rows = []
    for name, pairs in template_bigrams(TEMPLATES):
        low, high = size_bounds(len(pairs), THRESHOLD)
        rows.append(f"('{name}', {pairs!r}, {low}, {high})")
    return ",\n".join(rows)


_VECTORS = """
WITH RECURSIVE numbered AS (SELECT *, row_number() OVER () AS r FROM embeddings), good AS (
  SELECT r, vec_id, label, embedding::DOUBLE[] AS v FROM numbered
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), linked AS (
  SELECT a.r AS a, b.r AS b FROM good a JOIN good b
  ON a.label = b.label AND a.r <> b.r AND len(a.v) = len(b.v)
    AND list_cosine_similarity(a.v, b.v) >= 0.93
), joined AS (
  SELECT a, b FROM linked
  UNION SELECT x.r, y.r FROM good x JOIN good y ON x.vec_id = y.vec_id AND x.r <> y.r
), reached AS (
  SELECT r AS node, r AS other FROM good
  UNION
  SELECT r.node, l.b FROM reached r JOIN joined l ON r.other = l.a
), component AS (
  SELECT node, min(vec_id) AS root FROM reached JOIN good ON other = r GROUP BY node
), counted AS (SELECT a, count(*) AS n FROM linked GROUP BY a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, coalesce(root, e.vec_id) AS component_id,
  e.vec_id = coalesce(root, e.vec_id) AS kept
FROM numbered e LEFT JOIN component ON node = r LEFT JOIN counted ON a = r
"""

_LICENCES = rf"""
WITH template(license, pairs, low, high) AS (VALUES {_templates()}),
lines AS (
  SELECT doc_id, string_split(text, chr(10)) AS parts, text FROM documents
), segment AS (
  SELECT doc_id, unnest(range(len(parts)))::INT AS line, unnest(parts) AS t FROM lines
  UNION ALL SELECT doc_id, -1, text FROM lines WHERE len(parts) > 1
), words AS (
  SELECT doc_id, line, {_words("t")} AS w FROM segment
), pairs AS (
  SELECT doc_id, line,
    list_distinct(list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1])) AS own
  FROM words WHERE len(w) > 1
), near AS (
  SELECT doc_id, line, license,
    2.0::DOUBLE * len(list_intersect(own, pairs)) / (len(own) + len(pairs)) AS dice
  FROM (SELECT p.doc_id, p.line, p.own, t.license, t.pairs FROM pairs p JOIN template t
        ON len(p.own) BETWEEN t.low AND t.high)
), best AS (
  SELECT DISTINCT ON (doc_id, line) doc_id, line, license, dice FROM near
  WHERE dice >= {THRESHOLD} ORDER BY doc_id, line, dice DESC, license
)
SELECT doc_id, license, max(dice) AS dice, arg_min(line, (-dice, line)) AS line,
  count(*) AS n_lines
FROM best GROUP BY doc_id, license
"""

_CONTAMINATION = rf"""
WITH item AS (
  SELECT item_id::VARCHAR AS item_id, {_words("coalesce(text, '')")} AS w FROM benchmark
), item_window AS (
  SELECT item_id, unnest(list_transform(range(0, greatest(len(w) - 12, 1)),
    lambda k: array_to_string(w[k + 1:k + 13], ' '))) AS run, least(len(w), 13) AS size
  FROM item WHERE len(w) > 0
), doc AS (
  SELECT doc_id, {_words("coalesce(text, '')")} AS w FROM documents
), size AS (SELECT DISTINCT size FROM item_window),
doc_window AS (
  SELECT doc_id, size, unnest(range(0, len(w) - size + 1)) AS k,
    unnest(list_transform(range(0, len(w) - size + 1),
      lambda k: array_to_string(w[k + 1:k + size], ' '))) AS run
  FROM doc, size WHERE len(w) >= size
), met AS (
  SELECT d.doc_id, d.k, d.size, i.item_id FROM doc_window d JOIN item_window i USING (run, size)
), hit AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit FROM (
    SELECT doc_id, unnest(range(k, k + size)) AS place FROM (SELECT DISTINCT doc_id, k, size FROM met))
  GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS listed
  FROM (SELECT DISTINCT doc_id, item_id FROM met WHERE item_id IS NOT NULL) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM doc d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""



def _crc32(text: str) -> str:
    """Unsigned crc32 of a text's UTF-8, bit by bit."""
    codes = f"hex(encode({text}))"
    digit = "(strpos('0123456789ABCDEF', substr({0}, {1}, 1)) - 1)"
    high, low = digit.format(codes, "bit // 4 + 1"), digit.format(codes, "bit // 4 + 2")
    mixed = f"CASE WHEN bit % 8 = 0 THEN xor(crc, {high} * 16 + {low}) ELSE crc END"
    step = f"CASE WHEN ({mixed}) & 1 = 1 THEN xor(({mixed}) >> 1, 3988292384) ELSE ({mixed}) >> 1 END"
    bits = f"range(0, 4 * length({codes}))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bits}), lambda crc, bit: {step}), 4294967295)"


_TRIE = f"""
WITH turns AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS k,
    {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS t
  FROM conversations WHERE conv_id IS NOT NULL
), cut AS (
  SELECT c, ({_crc32("c::VARCHAR")} % 9)::INT AS h FROM (SELECT DISTINCT c FROM turns)
), placed AS (
  SELECT cut.c, k, t FROM cut JOIN turns ON turns.c = cut.c - cut.c % 5 AND k <= h
  UNION ALL SELECT cut.c, k, t FROM cut JOIN turns ON turns.c = cut.c AND k > h
), rebuilt AS (
  SELECT cut.c, coalesce(list(t ORDER BY k) FILTER (k IS NOT NULL), []) AS whole
  FROM cut LEFT JOIN placed ON placed.c = cut.c GROUP BY cut.c
), prefix AS (
  SELECT c, d, whole[1:d] AS p, len(whole) = d AS ends
  FROM (SELECT c, whole, unnest(range(0, len(whole) + 1)) AS d FROM rebuilt)
), node AS (
  SELECT p, d, min(c) AS least, count(*) AS n,
    coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '') AS ids
  FROM prefix GROUP BY p, d
), upward AS (
  SELECT n.p, n.d, count(m.p) AS children
  FROM node n LEFT JOIN node m ON m.d = n.d + 1 AND m.p[1:n.d] = n.p GROUP BY n.p, n.d
), own AS (
  SELECT n.*, children, CASE WHEN n.d = 0 THEN 0 ELSE (n.n - 1) * strlen(n.p[n.d].text) END AS saved
  FROM node n JOIN upward u ON u.d = n.d AND u.p = n.p
), subtree AS (
  SELECT n.p, n.d, count(*) FILTER (m.children = 0) AS leaves, sum(m.saved)::BIGINT AS saved
  FROM own n JOIN own m ON m.d >= n.d AND m.p[1:n.d] = n.p GROUP BY n.p, n.d
)
SELECT n.least AS conv_id, n.d AS depth, up.least AS parent_conv_id, n.n AS n_convs,
  n.children AS n_children, s.leaves AS n_leaves, s.saved AS saved_tokens, sha256(n.ids) AS ends_sha256
FROM own n JOIN subtree s ON s.d = n.d AND s.p = n.p
LEFT JOIN node up ON up.d = n.d - 1 AND up.p = n.p[1:n.d - 1]
"""

_SPELLING = f"""
WITH RECURSIVE run AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]{{7,}}')) AS r
  FROM documents
), hashed AS (
  SELECT r, {_crc32("coalesce(doc_id::VARCHAR, '') || ':' || r")} AS h FROM run
), slipped AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(r, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS word
  FROM hashed
), words AS (
  SELECT word, count(*) AS n FROM slipped WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2
), cut AS (
  SELECT word, n, left(word, k - 1) AS a, substr(word, k + 1) AS b
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS k FROM words)
), near AS (
  SELECT x.word, y.word AS other, y.n FROM cut x JOIN cut y ON x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT x.word, y.word, y.n FROM cut x JOIN words y ON x.a || x.b = y.word
  UNION SELECT y.word, x.word, x.n FROM cut x JOIN words y ON x.a || x.b = y.word
), best AS (
  SELECT word, count(*) AS n_near, max(n) AS most, min(other) FILTER (n = top) AS form
  FROM (SELECT *, max(n) OVER (PARTITION BY word) AS top FROM near) GROUP BY word
), formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN most >= 10 * w.n THEN form END AS form, CASE WHEN most >= 10 * w.n THEN most END AS form_n
  FROM words w LEFT JOIN best USING (word)
), walk AS (
  SELECT word, word AS at, form AS next FROM formed
  UNION ALL SELECT w.word, f.word, f.form FROM walk w JOIN formed f ON w.next = f.word
)
SELECT f.word, f.form, w.at AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN walk w ON f.word = w.word AND w.next IS NULL
"""

ORACLES: dict[str, str] = {
    "op4_sign_hashing": _VECTORS,
    "op5_licence_dice": _LICENCES,
    "op6_suffix_arrays": _CONTAMINATION,
    "op12_prefix_trie": _TRIE,
    "op13_trie_frontier": _SPELLING,
}
