"""Principal components of frames of any width in SQL.

A frame's scatter matrix is one row with a nested list. Squaring it again and again, scaled to trace
1, leaves the projector onto its main direction; the matrix without that direction gives the next.
"""

from __future__ import annotations

#: 2**24 powers of a matrix: directions whose variances differ by a millionth are told apart.
SQUARINGS = 24


def scatter_sql(source: str, width: int, frame: str, rows: int, where: str = "TRUE") -> str:
    """Adds fr: (ts, ord, x, mean, total, c1) of the rows of ``source`` (ts, ord, pos, value) whose
    ``frame`` has ``rows`` rows without a missing value. ``c1`` is the scatter matrix, ``total`` its trace."""
    places = f"range(1, {width + 1})"
    return f""",
vec AS (
  SELECT ts, ord, list(value ORDER BY pos) AS x, count(value) = {width} AS whole FROM {source} GROUP BY ts, ord),
seen AS (
  SELECT ts, ord, x, list(x) OVER w AS rows_, count(*) OVER w AS n, bool_and(whole) OVER w AS every
  FROM vec WINDOW w AS (ORDER BY ord {frame})),
cols AS (
  SELECT ts, ord, x, [[r[i] for r in rows_] for i in {places}] AS cols
  FROM seen WHERE n = {rows} AND every AND {where}),
centred AS (
  SELECT ts, ord, x, [list_avg(c) for c in cols] AS mean, [[v - list_avg(c) for v in c] for c in cols] AS d FROM cols),
fr AS (
  SELECT ts, ord, x, mean, [[list_inner_product(a, b) for a in d] for b in d] AS c1,
         list_sum([list_inner_product(a, a) for a in d]) AS total
  FROM centred)"""


def components_sql(width: int, k: int) -> str:
    """Adds e1 to ek to ``fr``: (ord, c, p, variance, left), the matrix, the projector onto its main
    direction, the scatter along it, and the matrix without it."""
    places = f"range(1, {width + 1})"
    out = []
    for at in range(1, k + 1):
        given = "SELECT ord, c1 AS c FROM fr" if at == 1 else f"SELECT ord, rest AS c FROM e{at - 1}"
        out.append(f""",
m{at} AS ({given}),
s{at} AS (
  SELECT ord, 0 AS step, c AS p FROM m{at}
  UNION ALL
  SELECT ord, step + 1, [[v / trace for v in r] for r in q]
  FROM (
    SELECT ord, step, q, list_sum([q[i][i] for i in {places}]) AS trace
    FROM (SELECT ord, step, [[list_inner_product(a, b) for a in p] for b in p] AS q FROM s{at} WHERE step < {SQUARINGS}))),
v{at} AS (
  SELECT m{at}.ord, c, p, list_sum([list_inner_product(c[i], p[i]) for i in {places}]) AS variance
  FROM m{at} JOIN s{at} ON m{at}.ord = s{at}.ord AND step = {SQUARINGS}),
e{at} AS (
  SELECT *, [[c[i][j] - variance * p[i][j] for j in {places}] for i in {places}] AS rest FROM v{at})""")
    return "".join(out)


def shares_sql(k: int) -> str:
    """The select of component shares of the one frame of ``fr``, NULL without one."""
    rows = " UNION ALL ".join(
        f"SELECT {at} AS k, variance / total AS share FROM e{at} JOIN fr USING (ord)" for at in range(1, k + 1)
    )
    return f"""SELECT 'PC' || n.k AS component, round(share, 6) + 0.0 AS explained_variance_ratio,
       round(sum(share) OVER (ORDER BY n.k), 6) + 0.0 AS cumulative
FROM range(1, {k + 1}) n(k) LEFT JOIN ({rows}) found ON found.k = n.k"""


def beta_alpha_sql(source: str, width: int, k: int) -> str:
    """The select of beta and alpha of every row of ``source``, NULL without a full frame."""
    moved = " + ".join(f"list_inner_product(e{at}.p[z.pos + 1], d)" for at in range(1, k + 1))
    joins = " ".join(f"JOIN e{at} ON e{at}.ord = fr.ord" for at in range(1, k + 1))
    return f""", fit AS (
  SELECT z.symbol, z.ts, z.value, mean[z.pos + 1] + {moved} AS beta
  FROM (SELECT *, [x[i] - mean[i] for i in range(1, {width + 1})] AS d FROM fr) fr {joins}
  JOIN {source} z ON z.ord = fr.ord)
SELECT z.symbol, z.ts, round(beta, 6) + 0.0 AS beta, round(fit.value - beta, 6) + 0.0 AS alpha
FROM {source} z LEFT JOIN fit ON fit.symbol = z.symbol AND fit.ts = z.ts"""


def residual_sql(source: str, width: int, rows: int) -> str:
    """The select of residual z-scores against the first component of frames of ``rows`` rows."""
    return f"""SELECT symbol, ts, round(r / CASE WHEN sd = 0 THEN 1e-12 ELSE sd END, 6) + 0.0 AS value FROM (
  SELECT z.symbol, z.ts, d[z.pos + 1] - list_inner_product(p[z.pos + 1], d) AS r,
         sqrt(greatest(rest[z.pos + 1][z.pos + 1], 0) / {rows}) AS sd
  FROM (SELECT *, [x[i] - mean[i] for i in range(1, {width + 1})] AS d FROM fr) fr
  JOIN e1 ON e1.ord = fr.ord JOIN {source} z ON z.ord = fr.ord)"""
