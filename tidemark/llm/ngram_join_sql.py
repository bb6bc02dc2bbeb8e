"""Near-duplicate components as SQL, by comparing every pair of documents that share a shingle."""

from __future__ import annotations

from tidemark.llm.common import WORD

_AZ = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL = f"""
WITH RECURSIVE parts AS (
    SELECT doc_id, regexp_extract_all({_AZ}, '{WORD}') AS w FROM documents
), cuts AS (
    SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM parts WHERE len(w) > 0
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM cuts
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS MATERIALIZED (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
         JOIN sizes na ON na.doc_id = a.doc_id JOIN sizes nb ON nb.doc_id = b.doc_id
    GROUP BY ALL HAVING 100 * count(*) >= 80 * (any_value(na.n) + any_value(nb.n) - count(*))
), reach AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION
    SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) LEFT JOIN sizes USING (doc_id)
"""
