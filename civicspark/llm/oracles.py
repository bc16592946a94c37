"""DuckDB SQL of the queries that SQL can express, over the same tables."""

from __future__ import annotations

import string

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

LEXICAL_SEARCH = rf"""
WITH doc_terms AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
item_terms AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
sizes AS (SELECT doc_id, count(*) AS n FROM doc_terms GROUP BY doc_id),
totals AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM sizes),
tf AS (SELECT doc_id, term, count(*) AS tf FROM doc_terms WHERE term IN (SELECT term FROM item_terms) GROUP BY doc_id, term),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tf, totals GROUP BY term, n_docs),
worth AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * n_docs) // n_terms)))) AS worth
  FROM tf JOIN weights USING (term) JOIN sizes USING (doc_id), totals),
scores AS (SELECT item_id, doc_id, sum(worth)::BIGINT AS score FROM worth JOIN item_terms USING (term) GROUP BY item_id, doc_id)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= 50
"""

#: CRC-32 of an ASCII string: a byte is followed by eight shifts, marked -1; 3988292384 is the reversed polynomial.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split({0}, ''),
    lambda c: list_prepend(ascii(c)::BIGINT, list_transform(range(8), lambda i: -1::BIGINT))))),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295::BIGINT)"""

PREFIX_TRIE = f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, {_CRC.format("conv_id::VARCHAR")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (
  SELECT c.conv_id, list({{'role': t.role, 'text': t.text}} ORDER BY own, pos) FILTER (t.role IS NOT NULL) AS path
  FROM convs c LEFT JOIN (
    SELECT c.conv_id, 0 AS own, pos, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 100 AND pos <= h
    UNION ALL SELECT c.conv_id, 1, pos, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND pos > h) t USING (conv_id)
  GROUP BY c.conv_id),
members AS (
  SELECT conv_id, depth, coalesce(path[:depth], []) AS prefix, depth = coalesce(len(path), 0) AS ends
  FROM rebuilt, unnest(range(coalesce(len(path), 0) + 1)) AS d(depth)),
nodes AS (
  SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256,
    CASE WHEN depth > 0 THEN (count(*) - 1) * length(prefix[-1].text) ELSE 0 END AS saved
  FROM members GROUP BY depth, prefix),
children AS (SELECT prefix[:-2] AS prefix, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
valued AS (SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children USING (prefix)),
above AS (
  SELECT prefix[:up] AS prefix, sum((n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM valued, unnest(range(depth + 1)) AS u(up) GROUP BY 1)
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, n_leaves, saved_tokens, v.ends_sha256
FROM valued v JOIN above a ON a.prefix = v.prefix LEFT JOIN nodes p ON v.depth > 0 AND p.prefix = v.prefix[:-2]
"""
