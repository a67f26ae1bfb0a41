"""SQL for the queries whose results SQL can state, in DuckDB's dialect."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op2_top_products"] = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

ORACLE["op4_near_duplicates"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words
), shingles AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), pairs AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS shared, any_value(a.n) AS n, any_value(b.n) AS m
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT u, v FROM pairs WHERE 100 * shared >= 85 * (n + m - shared)
), edges AS (
  SELECT u, v FROM links UNION ALL SELECT v, u FROM links
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, b.v FROM reach r JOIN edges b ON r.other = b.u
), least AS (
  SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT s.doc_id, len(s.s) AS n_shingles, l.component_id, s.doc_id = l.component_id AS kept
FROM sets s JOIN least l ON s.doc_id = l.doc_id
"""

ORACLE["op5_mixing"] = r"""
WITH sized AS (
  SELECT doc_id, source, text, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, 3 * source_size AS most, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM sources
), swept AS (
  SELECT *,
    coalesce(sum(most) OVER (ORDER BY most / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
    sum(weight) OVER (ORDER BY most / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights_left,
    sum(source_size) OVER () AS total
  FROM weighed
), full_ones AS (
  SELECT *, most * weights_left <= weight * (total - below) AS is_full FROM swept
), level AS (
  SELECT CAST(any_value(total) - sum(CASE WHEN is_full THEN most ELSE 0 END) AS DOUBLE)
    / CAST(sum(CASE WHEN is_full THEN 0 ELSE weight END) AS DOUBLE) AS share
  FROM full_ones
), targets AS (
  SELECT source, source_size, CASE WHEN is_full THEN CAST(most AS DOUBLE) ELSE share * weight END AS target
  FROM full_ones, level
), rated AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
    CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(s.doc_id AS VARCHAR), md5(coalesce(s.text, '')))), 1, 8)
      AS BIGINT) / 4294967296.0 AS draw
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  CAST(size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM rated
"""

ORACLE["op6_near_vectors"] = r"""
WITH RECURSIVE able AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM able a JOIN able b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_inner_product(a.e, b.e) / (sqrt(list_inner_product(a.e, a.e)) * sqrt(list_inner_product(b.e, b.e))) >= 0.98
), reach AS (
  SELECT vec_id, vec_id AS other FROM embeddings
  UNION
  SELECT r.vec_id, l.v FROM reach r JOIN links l ON r.other = l.u
), least AS (
  SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id
), counted AS (
  SELECT u AS vec_id, count(*) AS n FROM links GROUP BY u
)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, l.component_id, e.vec_id = l.component_id AS kept
FROM embeddings e JOIN least l ON e.vec_id = l.vec_id LEFT JOIN counted c ON e.vec_id = c.vec_id
"""

ORACLE["op9_warc"] = r"""
WITH p AS (
  SELECT page_id, sha256(coalesce(html, '')) AS payload_digest, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes
  FROM pages
), firsts AS (
  SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
  CASE WHEN f.first IS NOT NULL AND f.first IS DISTINCT FROM p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN f.first IS DISTINCT FROM p.page_id THEN f.first END AS refers_to
FROM p LEFT JOIN firsts f ON p.payload_digest = f.payload_digest
"""

ORACLE["op13_lexical_search"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), counted AS (
  SELECT r, any_value(doc_id) AS doc_id, term, count(*) AS tf FROM d GROUP BY r, term
), lengths AS (
  SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM counted GROUP BY r
), whole AS (
  SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths
), items AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM counted, whole WHERE term IN (SELECT term FROM items) GROUP BY term
), scored AS (
  SELECT i.item_id, c.r, any_value(c.doc_id) AS doc_id, CAST(sum(w.w * ((1000000000 * c.tf) //
    (1000 * c.tf + 8 * (100 - 90 + (90 * l.n * whole.docs) // whole.terms)))) AS BIGINT) AS score
  FROM items i JOIN weights w ON i.term = w.term JOIN counted c ON c.term = i.term JOIN lengths l ON l.r = c.r, whole
  GROUP BY i.item_id, c.r
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
