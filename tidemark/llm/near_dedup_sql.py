"""Components of two-word shingles as SQL, by comparing every pair of documents that share a shingle."""

from __future__ import annotations

from tidemark.llm.common import WORD

SQL = f"""
WITH RECURSIVE lowered AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents
), parts AS (
    SELECT doc_id, regexp_extract_all(t, '{WORD}') AS w FROM lowered
), shingles AS (
    SELECT DISTINCT doc_id, hash(w[i], w[i + 1]) AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM parts WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), close AS MATERIALIZED (
    SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * shared >= 80 * (x.n + y.n - shared)
), links AS MATERIALIZED (
    SELECT a, b FROM close UNION ALL SELECT b, a FROM close
), reach AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION
    SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other
), least AS (
    SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM least LEFT JOIN sizes USING (doc_id)
"""
