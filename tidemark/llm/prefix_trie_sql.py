"""The prefix tree of rebuilt conversations as SQL: every prefix is a list, every node meets all its ancestors."""

from __future__ import annotations

#: crc32 of a text of ASCII characters, bit by bit; 3988292384 is the reversed polynomial.
_CRC = """xor(list_reduce(
    list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda s, b: list_reduce([xor(s, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda t, z: xor(t >> 1, (t & 1) * 3988292384))
), 4294967295)"""

SQL = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, role, text) AS turns
    FROM turns GROUP BY conv_id
), heads AS (
    SELECT *, {_CRC} % 9 AS h FROM convs
), rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:]) AS turns
    FROM heads c LEFT JOIN convs b ON b.conv_id = c.conv_id - c.conv_id % 5
), steps AS (
    SELECT conv_id, d AS depth, turns[1:d] AS node
    FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)
), nodes AS (
    SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           (count(*) - 1) * CASE WHEN depth = 0 THEN 0 ELSE octet_length(encode(node[depth].text)) END AS saved
    FROM steps GROUP BY node, depth
), children AS (
    SELECT node[1:depth - 1] AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), counted AS (
    SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (node)
), totals AS (
    SELECT node[1:d] AS node, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
    FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM counted) GROUP BY 1
), ends AS (
    SELECT turns AS node, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256
    FROM rebuilt GROUP BY turns
)
SELECT c.conv_id, c.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, n_leaves,
       saved_tokens::BIGINT AS saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM counted c JOIN totals USING (node) LEFT JOIN ends USING (node)
     LEFT JOIN counted p ON c.depth > 0 AND p.depth = c.depth - 1 AND p.node = c.node[1:c.depth - 1]
"""
