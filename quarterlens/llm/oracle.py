"""DuckDB SQL for the operators that SQL can express on whole tables."""

from __future__ import annotations

#: Operator 6: the record table follows from the pages alone.
WARC = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), d AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest FROM p
), r AS (
  SELECT payload_digest, max(page_id) AS response FROM d
  WHERE payload_bytes >= 1000 GROUP BY payload_digest
)
SELECT d.page_id, CAST(d.payload_bytes AS BIGINT) AS payload_bytes, d.payload_digest,
       CASE WHEN r.response <> d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN r.response <> d.page_id THEN r.response END AS refers_to,
       TRUE AS intact
FROM d LEFT JOIN r ON d.payload_digest = r.payload_digest AND d.payload_bytes >= 1000
"""

#: Operator 12: scores are integers, so the ranking is exact.
LEXICAL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents WHERE text IS NOT NULL
), docs AS (
  SELECT r, doc_id, t, len(t) AS n FROM d WHERE len(t) > 0
), size AS (
  SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM docs
), i AS (
  SELECT row_number() OVER () AS q, item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)
), asked AS (
  SELECT q, item_id, term, count(*) AS times FROM (SELECT q, item_id, unnest(t) AS term FROM i) GROUP BY ALL
), tf AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM docs)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), w AS (
  SELECT term, CAST(floor(1000 * ln((2 * big_n + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf CROSS JOIN size GROUP BY term, big_n
), scored AS (
  SELECT q, item_id, r, doc_id, CAST(sum(times * w * ((1000000000 * tf) //
    (1000 * tf + 12 * (100 - 25 + ((25 * n * big_n) // big_l))))) AS BIGINT) AS score
  FROM asked JOIN w USING (term) JOIN tf USING (term) JOIN docs USING (r) CROSS JOIN size
  GROUP BY q, item_id, r, doc_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""

#: Operator 13: inner products of whole numbers are exact in doubles at these sizes.
NEGATIVES = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT a.vec_id AS anchor, b.vec_id AS other, a.label = b.label AS same,
         CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
), p AS (
  SELECT anchor, other AS positive, score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) <= 5
), n AS (
  SELECT p.anchor, p.positive, s.other, p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor, p.positive ORDER BY s.score DESC, s.other) AS rank
  FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same
    AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
)
SELECT anchor AS anchor_id, positive AS positive_id, CAST(rank AS INTEGER) AS rank, other AS negative_id,
       positive_score, negative_score
FROM n WHERE rank <= 3
"""

#: Operator 9: a turn is escaped if it holds a control string or ends with a backslash.
CHAT = r"""
WITH t AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role,
         coalesce(text, '') AS text
  FROM (SELECT conv_id, turn, role, text FROM conversations
        UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok'))
), f AS (
  SELECT *, length(regexp_replace(role, '([\\:\n])', '\\\1', 'g')) + length(
    regexp_replace(regexp_replace(text, '(\\*)(### |</turn>)', '\1\1\\\2', 'g'), '(\\+)\z', '\1\1')) + 14 AS chars
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
         AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op6_warc": WARC, "op9_chat": CHAT, "op12_lexical": LEXICAL, "op13_negatives": NEGATIVES}
