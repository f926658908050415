"""DuckDB SQL with the rows of the operator queries that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP1 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), u AS (SELECT * FROM v WHERE list_dot_product(e, e) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), comp AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a
), degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN comp ON comp.a = e.vec_id LEFT JOIN degree d ON d.a = e.vec_id
"""

OP7 = f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS no FROM documents
), s AS (
  SELECT doc_id, no, line, list_sort(list_distinct(regexp_extract_all(translate(line, '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+'))) AS words FROM l
), f AS (SELECT words, len(words) AS n, min((doc_id, no)) AS first FROM s WHERE len(words) > 0 GROUP BY words
), k AS (SELECT row_number() OVER (ORDER BY first) AS id, * FROM f
), t AS (SELECT id, n, unnest(words) AS word FROM k
), p AS (
  SELECT b.id FROM t a JOIN t b ON a.word = b.word AND a.id < b.id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), gone AS (SELECT DISTINCT id FROM p
), o AS (
  SELECT s.doc_id, s.no, s.line, len(s.words) > 0 AND ((s.doc_id, s.no) <> k.first OR gone.id IS NOT NULL) AS removed
  FROM s LEFT JOIN k ON s.words = k.words LEFT JOIN gone ON gone.id = k.id
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE removed) AS n_removed,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (WHERE NOT coalesce(removed, false)), '')) AS kept_sha256
FROM o GROUP BY doc_id
"""

OP10 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) < 2 THEN w ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM w
), t AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM t a JOIN t b ON a.x = b.x AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), comp AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT s.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, s.doc_id = component_id AS kept FROM s JOIN comp ON comp.a = s.doc_id
"""

OP9 = """
WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), s AS (
  SELECT doc_id, unnest(range(1, len(h) // 2 - 48)) AS i, unnest(list_transform(range(1, len(h) // 2 - 48), lambda i: substr(h, 2 * i - 1, 100))) AS x FROM h WHERE len(h) >= 100
), m AS (SELECT x, min(doc_id) AS first FROM s GROUP BY x
), gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM s JOIN m USING (x) WHERE first < doc_id
), runs AS (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM gone
), r AS (SELECT doc_id, count(*) AS n_removed, count(*) FILTER (WHERE before IS NULL OR before <> p - 1) AS n_spans FROM runs GROUP BY doc_id
), b AS (SELECT doc_id, unnest(range(1, len(h) // 2 + 1)) AS p, unnest(regexp_extract_all(h, '..')) AS x FROM h
), k AS (SELECT b.doc_id, string_agg(x, '' ORDER BY b.p) AS kept FROM b LEFT JOIN gone USING (doc_id, p) WHERE gone.p IS NULL GROUP BY b.doc_id)
SELECT h.doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM h LEFT JOIN r USING (doc_id) LEFT JOIN k USING (doc_id)
"""

OP12 = """
WITH v AS (
  SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS c FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, CAST(coalesce(list_inner_product(a.c::DOUBLE[], b.c::DOUBLE[]), 0) AS BIGINT) AS score
  FROM v a JOIN v b ON a.id % 100 = 0 AND len(a.c) = len(b.c)
), p AS (SELECT * FROM s WHERE same AND id <> anchor_id QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
), n AS (
  SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""
