"""The same results in plain SQL, where SQL can express them."""

from baitline.llm.license_texts import KNOWN, SAME_WORDS

def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _canonical(column: str) -> str:
    bare = f"regexp_replace(lower({column}), '(?m)^[ \\t]*(copyright|\\(c\\)|©)[^\\n]*$', '', 'g')"
    words = f"concat(' ', trim(regexp_replace({bare}, '[^\\p{{L}}\\p{{N}}]+', '  ', 'g')), ' ')"
    for one, other in SAME_WORDS:
        words = f"replace({words}, ' {one} ', ' {other} ')"
    return words


OP9 = f"""
WITH known AS (
  SELECT DISTINCT license, sha256({_canonical("t")}) AS digest
  FROM (VALUES {", ".join(f"({_text(n)}, {_text(t)})" for n, t in KNOWN)}) AS k(license, t)),
docs AS (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL),
units AS (
  SELECT doc_id, text, 'document' AS unit, 0 AS place, text AS t FROM docs UNION ALL
  SELECT doc_id, text, 'line', generate_subscripts(string_split(text, chr(10)), 1),
    unnest(string_split(text, chr(10))) FROM docs)
SELECT doc_id, unit, license, count(*) AS n
FROM units JOIN known ON sha256({_canonical("t")}) = digest GROUP BY ALL
"""

OP10 = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT r, doc_id, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM docs),
keyed AS (
  SELECT *, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
owners AS (SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10 GROUP BY key),
marked AS (
  SELECT k.*, coalesce(o.owner < k.doc_id, false) AS lost
  FROM keyed k LEFT JOIN owners o ON k.key = o.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
FROM marked GROUP BY r
"""


OP2 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
    vec_id, score FROM scored)
SELECT * FROM ranked WHERE rank <= 5
"""

OP6 = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM docs),
flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM grams),
met AS (
  SELECT x.doc_id AS a, y.doc_id AS b, x.n AS n, y.n AS m, count(*) AS c
  FROM flat x JOIN flat y ON x.g = y.g AND x.doc_id <> y.doc_id AND 4 * least(x.n, y.n) >= 3 * greatest(x.n, y.n)
  GROUP BY ALL),
links AS (SELECT a, b FROM met WHERE 100 * c >= 75 * (n + m - c)),
reach AS (SELECT a AS x, a AS y FROM links UNION SELECT r.x, l.b FROM reach r JOIN links l ON r.y = l.a),
least_of AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT doc_id, len(s) AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM grams LEFT JOIN least_of ON x = doc_id
"""

OP11 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.e, c.e)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, vec_id AS negative_id, positive_score,
  score AS negative_score
FROM positives p JOIN scored s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 3
"""


def statements() -> dict[str, str]:
    return {"op2_topk_search": OP2, "op6_jaccard_join": OP6, "op9_license_scan": OP9,
            "op10_line_dedup": OP10, "op11_negative_mining": OP11}
