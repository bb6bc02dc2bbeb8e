"""The mix of sources as SQL: one running sum per source instead of bins and cells."""

from __future__ import annotations

from tidemark.llm.common import WORD


def mix_sql(weights: tuple[int, ...] = (1, 2, 3), most: int = 3, seed: int = 17) -> str:
    return f"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size FROM documents
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY source, doc_id, size) - 1 AS number FROM sized
), pulls AS (
    SELECT *, floor(sqrt(size))::BIGINT AS pull FROM numbered
), per_source AS (
    SELECT source, sum(size)::BIGINT AS source_size, sum(size * pull)::BIGINT AS pulled FROM pulls GROUP BY source
), weighted AS (
    SELECT *, [{", ".join(f"{w}::DOUBLE" for w in weights)}]
               [((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)} + 1)::INT] AS weight
    FROM per_source
), filled AS (
    SELECT *, (source_size * {most})::DOUBLE AS cap, (source_size * {most})::DOUBLE / weight AS reach,
           (sum(source_size) OVER ())::DOUBLE AS total, sum(weight) OVER () AS weights
    FROM weighted
), levels AS (
    SELECT *, (total - (sum(cap) OVER o - cap)) / (weights - (sum(weight) OVER o - weight)) AS level
    FROM filled WINDOW o AS (ORDER BY reach, source NULLS LAST)
), goals AS (
    SELECT *, coalesce(least(cap, weight * (SELECT arg_min(level, reach) FROM levels WHERE level < reach)), cap) AS target
    FROM levels
), rests AS (
    SELECT source, source_size, pulled, target,
           CASE WHEN source_size > 0 THEN least(floor(target / source_size), {most}) ELSE 0 END::INT AS certain,
           target - CASE WHEN source_size > 0 THEN least(floor(target / source_size), {most}) ELSE 0 END::INT * source_size AS rest
    FROM goals
), odds AS (
    SELECT doc_id, size, number, r.*, rest * pull / nullif(r.pulled, 0) AS likely,
           (('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, 'null') || ':' || size || ':' || number), 1, 13))::BIGINT + 0.5::DOUBLE) / {2**52}::DOUBLE AS luck
    FROM pulls JOIN rests r ON pulls.source IS NOT DISTINCT FROM r.source
), ranked AS (
    SELECT *, CASE WHEN rest > 0 AND size > 0 AND certain < {most} THEN
                  CASE WHEN likely < 1 THEN (luck / (1 - luck)) / (likely / (1 - likely)) ELSE 0 END END AS ratio
    FROM odds
), summed AS (
    SELECT *, sum(size) FILTER (WHERE ratio IS NOT NULL)
                  OVER (PARTITION BY source ORDER BY ratio NULLS LAST, doc_id NULLS FIRST, size, number ROWS UNBOUNDED PRECEDING) AS upto,
           sum(size) FILTER (WHERE ratio IS NOT NULL) OVER (PARTITION BY source) AS all_words
    FROM ranked
), drawn AS (
    SELECT *, ratio IS NOT NULL AND (upto <= rest OR all_words < rest) AS once,
           CASE WHEN all_words >= rest THEN rest - coalesce(max(upto) FILTER (WHERE ratio IS NOT NULL AND upto <= rest)
                                                                OVER (PARTITION BY source), 0) END AS gap
    FROM summed
), extras AS (
    SELECT source, min((abs(gap - size), doc_id IS NOT NULL, doc_id, size, number)) AS x FROM drawn
    WHERE ratio IS NOT NULL AND NOT once AND abs(gap - size) < abs(gap) GROUP BY source
)
SELECT doc_id, size, source_size, target,
       certain + once_more AS copies, ((certain + once_more) * size)::BIGINT AS taken, source, number
FROM (
    SELECT drawn.*, CASE WHEN once OR (ratio IS NOT NULL AND x IS NOT NULL AND doc_id IS NOT DISTINCT FROM x[3]
                                       AND size = x[4] AND number = x[5]) THEN 1 ELSE 0 END AS once_more
    FROM drawn LEFT JOIN extras ON drawn.source IS NOT DISTINCT FROM extras.source
)
"""
