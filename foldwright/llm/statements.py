"""The results of the registered queries as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from foldwright.llm.common import WORD
from foldwright.llm.url_filter import SOFT_LIMIT, SOFT_TERMS, STRICT_TERMS

_ABC = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _term(term: str) -> str:
    return f"regexp_matches(low, '(^|[^a-z0-9]){term}([^a-z0-9]|$)')"


_STRICT = " OR ".join(_term(t) for t in STRICT_TERMS)
_SOFT = " + ".join(f"{_term(t)}::INT" for t in SOFT_TERMS)



def _usable(component: str) -> str:
    return f"""SELECT vec_id AS id, list_transform(embedding, lambda x: {component}) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""


SQL = {
    "op1_cover_tree": f"""
WITH rows AS (
  {_usable("floor(256 * x::DOUBLE)")}),
scored AS (
  SELECT q.id AS query_id, r.id AS vec_id, list_inner_product(q.v, r.v)::BIGINT AS score
  FROM rows q JOIN rows r ON q.id <> r.id WHERE q.id % 50 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op4_tool_calls": f"""
WITH turns AS (
  SELECT conv_id, turn, role, coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS n FROM conversations),
calls AS (
  SELECT conv_id, turn, n, 'c' || conv_id || '-' || turn AS call_id, role FROM turns WHERE role = 'user'),
links AS (
  SELECT c.conv_id, c.turn, p.turn AS parent
  FROM calls c JOIN calls p ON c.conv_id = p.conv_id AND p.turn = c.turn // 2 AND p.turn < c.turn),
levels AS (
  WITH RECURSIVE walk AS (
    SELECT conv_id, turn, 0 AS level FROM calls
    WHERE (conv_id, turn) NOT IN (SELECT conv_id, turn FROM links)
    UNION ALL SELECT l.conv_id, l.turn, w.level + 1 FROM walk w JOIN links l ON l.conv_id = w.conv_id AND l.parent = w.turn)
  SELECT * FROM walk),
results AS (
  SELECT conv_id, turn - 1 AS asked, min(turn) AS result_turn, min(n) AS n, count(*) AS n_results
  FROM turns WHERE role = 'assistant' GROUP BY ALL),
judged AS (
  SELECT c.*, l.level, r.result_turn, coalesce(r.n_results, 0)::BIGINT AS n_results, r.n AS answered,
         list_filter([CASE WHEN c.n % 7 = 0 THEN 'type of note' END, CASE WHEN c.n % 5 = 0 THEN 'missing words' END,
                      CASE WHEN c.n % 11 = 0 THEN 'unknown extra' END], lambda p: p IS NOT NULL) AS wrong
  FROM calls c JOIN levels l ON c.conv_id = l.conv_id AND c.turn = l.turn
  LEFT JOIN results r ON r.conv_id = c.conv_id AND r.asked = c.turn)
SELECT conv_id, call_id, 'answer' AS name, turn AS call_turn, level, result_turn, n_results,
       array_to_string(wrong, '; ') AS problems, len(wrong) = 0 AS valid,
       '{{"arguments":{{' || CASE WHEN n % 11 = 0 THEN '"extra":' || n || ',' ELSE '' END
         || CASE WHEN n % 7 = 0 THEN '"note":"' || n || '",' ELSE '' END || '"topic":"' || role || '"'
         || CASE WHEN n % 5 <> 0 THEN ',"words":' || n ELSE '' END
         || '}},"id":"' || call_id || '","name":"answer","result":'
         || CASE WHEN answered IS NULL THEN 'null' ELSE '{{"words":' || answered || '}}' END || '}}' AS json
FROM judged""",
    "op7_block_ann": f"""
WITH rows AS (
  SELECT * FROM ({_usable("x::DOUBLE")}) WHERE len(list_filter(v, lambda x: x <> 0)) > 0),
scored AS (
  SELECT q.id AS query_id, r.id AS vec_id, list_inner_product(q.v, r.v) AS score
  FROM rows q JOIN rows r ON q.id <> r.id WHERE q.id % 20 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20""",
    # The mix: targets by water-filling, then the cut at 36 bits of the document's hash.
    "op6_mix_sources": f"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
         ('0x' || substr(md5(concat_ws('|', doc_id::VARCHAR, text)), 1, 15))::BIGINT AS hash
  FROM documents),
sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
weighed AS (
  SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM sizes),
levelled AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(source_size * 2.0::DOUBLE) OVER (
             ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
           / sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST
                               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
         row_number() OVER (ORDER BY source_size / weight, source NULLS LAST) AS place
  FROM weighed),
common AS (
  SELECT arg_min(level, place) AS level FROM levelled WHERE level * weight <= source_size * 2.0::DOUBLE),
targets AS (
  SELECT source, source_size,
         CASE WHEN coalesce(c.level * weight, source_size * 2.0::DOUBLE) < source_size * 2.0::DOUBLE
              THEN c.level * weight ELSE source_size * 2.0::DOUBLE END AS target
  FROM levelled CROSS JOIN common c),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole,
         target - (CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END) * source_size AS need
  FROM targets),
cells AS (
  SELECT source, hash >> 24 AS cell, sum(size) AS words FROM docs GROUP BY ALL),
summed AS (
  SELECT *, coalesce(sum(words) OVER (PARTITION BY source ORDER BY cell ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM cells),
crossing AS (
  SELECT s.source, max(s.cell) AS cell, arg_max(s.before, s.cell) AS before, arg_max(s.words, s.cell) AS words, any_value(p.need) AS need
  FROM summed s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source
  WHERE p.need > 0 AND s.before < p.need GROUP BY s.source),
cut AS (
  SELECT source, CASE WHEN need - before > before + words - need THEN (cell + 1) * 16777216 ELSE cell * 16777216 END AS threshold
  FROM crossing)
SELECT d.doc_id, d.size, p.source_size, p.target,
       (d.size * (p.whole + (d.hash < coalesce(c.threshold, 0))::INT))::BIGINT AS taken
FROM docs d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source
LEFT JOIN cut c ON d.source IS NOT DISTINCT FROM c.source""",
    "op5_trie_jaccard": f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_ABC}), '{WORD}') AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4
    THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i : i + 3], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS gram
  FROM words),
sizes AS (
  SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id
  JOIN sizes s ON s.doc_id = a.doc_id JOIN sizes t ON t.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, s.n, t.n
  HAVING 100 * count(*) >= 85 * (s.n + t.n - count(*))),
reach AS (
  SELECT x AS doc_id, x AS hit FROM links
  UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON r.hit = l.x)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, coalesce(m.least, d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
LEFT JOIN (SELECT doc_id, min(hit) AS least FROM reach GROUP BY doc_id) m ON m.doc_id = d.doc_id""",
    "op10_url_filter": f"""
WITH parts AS (
  SELECT page_id, translate(coalesce(url, ''), {_ABC}) AS low,
         CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
split AS (
  SELECT page_id, low, translate(regexp_extract(rest, '^[^/?#]*'), {_ABC}) AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM parts),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/en/1%' THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/es/%' THEN 'example.org/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/fr/%' THEN 'com/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/de/%' THEN 'com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/%' THEN 'org/' END AS rule
  FROM split)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN {_STRICT} THEN 'block' WHEN {_SOFT} >= {SOFT_LIMIT} THEN 'block' ELSE 'allow' END AS verdict
FROM ruled""",
    "op12_source_divergence": f"""
WITH words AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS doc,
         regexp_extract_all(coalesce(text, ''), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS found FROM documents),
counts AS (
  SELECT lang, source, doc, term, count(*) AS n
  FROM (SELECT lang, source, doc, translate(unnest(found), {_ABC}) AS term FROM words) GROUP BY ALL),
kept AS (
  SELECT lang, term, sum(n) AS n FROM counts GROUP BY lang, term HAVING count(DISTINCT doc) >= 3),
groups AS (SELECT DISTINCT lang, source FROM words),
cells AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM groups g JOIN kept k USING (lang)
  LEFT JOIN (SELECT lang, source, term, sum(n) AS n FROM counts GROUP BY ALL) c USING (lang, source, term)),
shares AS (
  SELECT lang, source, term, n,
         1 + 1000000000 * (n + 1) // (sum(n) OVER (PARTITION BY lang, source) + count(*) OVER (PARTITION BY lang, source)) AS p
  FROM cells),
whole AS (
  SELECT lang, term, 1 + 1000000000 * (n + 1) // (sum(n) OVER (PARTITION BY lang) + count(*) OVER (PARTITION BY lang)) AS q FROM kept),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares JOIN whole USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (
  SELECT lang, source, part, item, value::BIGINT AS value,
         row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM every)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200""",
    "op13_line_dedup": f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (
  SELECT r, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM docs),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), {_ABC}) AS key FROM lines),
common AS (
  SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10),
kept AS (
  SELECT k.r, count(*) AS n_lines, count(c.key) AS n_dropped,
         coalesce(string_agg(k.line, chr(10) ORDER BY k.place) FILTER (WHERE c.key IS NULL), '') AS kept
  FROM keyed k LEFT JOIN common c ON c.key = k.key GROUP BY k.r)
SELECT d.doc_id, k.n_lines::BIGINT AS n_lines, k.n_dropped::BIGINT AS n_dropped, sha256(k.kept) AS kept_sha256
FROM docs d JOIN kept k ON k.r = d.r""",
}
