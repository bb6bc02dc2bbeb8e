"""Covariance, principal component and residual queries.

Over two symbols the eigenvectors have a closed form, so the same operators
are also run on a pair; over more, SQL gets them by squaring matrices.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.bars import bars
from tidemark.operators.factors import (
    explained_variance,
    residual_zscore,
    rolling_covariance,
    rolling_pca,
)
from tidemark.operators.returns import log_returns, rolling_zscore
from tidemark.panel import Panel, densify
from tidemark.plans import live_snapshot
from tidemark.queries import bindings as b
from tidemark.queries import spectral_sql as spectral
from tidemark.queries.panel_queries import WINDOW, _WEEK_RET, _WEEK_Z, _with, weekly_returns

LOOKBACK = 120
#: Returns in the hourly and in the daily snapshot.
SNAP, SNAP_DAYS = 480, 24
PAIR = b.BRANDS[:2]


def pair_returns(spark: SparkSession, sf_dir: str) -> Panel:
    return log_returns(densify(b.brand_prices(spark, sf_dir), PAIR))


def covariance(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rolling_covariance(weekly_returns(spark, sf_dir), window=WINDOW)
    return found.withColumn("cov", b.r6("cov"))


def _rounded(found: DataFrame, *names: str) -> DataFrame:
    return found.withColumns({name: b.r6(name) for name in names})


def pca(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = rolling_zscore(weekly_returns(spark, sf_dir), window=WINDOW)
    return _rounded(rolling_pca(scores, window=WINDOW, k=3), "beta", "alpha")


def pca_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """beta + alpha gives the input back wherever the frame is full."""
    scores = rolling_zscore(weekly_returns(spark, sf_dir), window=WINDOW)
    found = rolling_pca(scores, window=WINDOW, k=3)
    return found.select("symbol", "ts", b.r6(F.col("beta") + F.col("alpha")).alias("value"))


def pca_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rolling_pca(pair_returns(spark, sf_dir), window=WINDOW, k=1)
    return _rounded(found, "beta", "alpha")


def shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = explained_variance(weekly_returns(spark, sf_dir), window=WINDOW, n_components=5)
    return _rounded(found, "explained_variance_ratio", "cumulative")


def shares_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = explained_variance(pair_returns(spark, sf_dir), window=WINDOW, n_components=2)
    return _rounded(found, "explained_variance_ratio", "cumulative")


def residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = residual_zscore(weekly_returns(spark, sf_dir), window=LOOKBACK, latest_only=False)
    return _rounded(found, "value")


def residuals_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(residual_zscore(weekly_returns(spark, sf_dir), window=LOOKBACK), "value")


def residuals_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = residual_zscore(pair_returns(spark, sf_dir), window=LOOKBACK, latest_only=False)
    return _rounded(found, "value")


def _snapshot(spark: SparkSession, sf_dir: str) -> dict:
    hourly = bars(b.one_feed(spark, sf_dir), "1 hour")
    return live_snapshot(hourly, b.KINDS, lookback=SNAP, z_window=WINDOW)


def snapshot_zscores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_snapshot(spark, sf_dir)["zscores"].long(), "value")


def snapshot_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _snapshot(spark, sf_dir)["close"].long("close")


def snapshot_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_snapshot(spark, sf_dir)["log_returns"].long(), "value")


def snapshot_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_snapshot(spark, sf_dir)["latest_zscore"], "value")


def snapshot_residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily, as only whole rows count and hours without a tick leave fewer than a lookback of them."""
    daily = bars(b.one_feed(spark, sf_dir), "1 day")
    found = live_snapshot(daily, b.KINDS, lookback=SNAP_DAYS, z_window=SNAP_DAYS // 2)
    return _rounded(found["latest_residual_zscore"], "value")


def snapshot_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _snapshot(spark, sf_dir)["explained_variance"]
    return _rounded(found, "explained_variance_ratio", "cumulative")


QUERIES = {
    "rolling_covariance": covariance,
    "pca_beta_alpha": pca,
    "pca_identity": pca_identity,
    "pca_beta_alpha_pair": pca_pair,
    "explained_variance": shares,
    "explained_variance_pair": shares_pair,
    "residual_zscore": residuals,
    "residual_zscore_latest": residuals_latest,
    "residual_zscore_pair": residuals_pair,
    "live_snapshot_close": snapshot_close,
    "live_snapshot_returns": snapshot_returns,
    "live_snapshot_zscores": snapshot_zscores,
    "live_snapshot_latest": snapshot_latest,
    "live_snapshot_residuals": snapshot_residuals,
    "live_snapshot_shares": snapshot_shares,
}

_PAIR_RET = b.brand_prices_sql("week").replace(
    "range(1, 26)", f"range(1, {len(PAIR) + 1})"
) + b.DENSE_SQL.replace("FROM prices", "FROM prices WHERE symbol IN (SELECT symbol FROM uni)") + b.returns_sql(
    len(PAIR)
)


def _axis(frame: str) -> str:
    """Moments of the pair over a frame, its main direction and its smaller eigenvalue."""
    return f""",
xy AS (
  SELECT ts, ord, max(value) FILTER (WHERE pos = 0) AS x, max(value) FILTER (WHERE pos = 1) AS y
  FROM ret GROUP BY ts, ord),
mom AS (
  SELECT ts, ord, x, y, count(*) OVER w AS n, avg(x) OVER w AS mx, avg(y) OVER w AS my,
         var_samp(x) OVER w AS a, var_samp(y) OVER w AS c, covar_samp(x, y) OVER w AS k
  FROM xy WINDOW w AS (ORDER BY ord {frame})),
ax AS (
  SELECT *, 0.5 * atan2(2 * k, a - c) AS t,
         (a + c) / 2 - sqrt((a - c) * (a - c) / 4 + k * k) AS small,
         (a + c) / 2 + sqrt((a - c) * (a - c) / 4 + k * k) AS big FROM mom)"""


_LAST = f"ROWS BETWEEN {WINDOW - 1} PRECEDING AND CURRENT ROW"
_TRAIN = f"ROWS BETWEEN {LOOKBACK - 1} PRECEDING AND 1 PRECEDING"

def _snapshot_sql(grain: str, returns: int) -> str:
    """Dense closes, returns and z-scores of a snapshot."""
    listed = ", ".join(f"('{s}', {i})" for i, s in enumerate(b.KINDS))
    return b.ticks_sql(one=True) + b.flagged_sql(grain) + b.bars_sql(grain) + f""",
uni AS (SELECT * FROM (VALUES {listed}) v(symbol, pos)),
newest AS (SELECT DISTINCT bar_end FROM bars ORDER BY bar_end DESC LIMIT {returns + 1}),
prices AS (
  SELECT symbol, bar_end AS ts, close_fixed / 1e9 AS price FROM bars WHERE bar_end IN (SELECT bar_end FROM newest)),
{b.DENSE_SQL}{b.returns_sql(len(b.KINDS))}{b.zscore_sql(WINDOW, "1e-12")}"""


_SNAP = _snapshot_sql("hour", SNAP)


def _recursive(*parts: str, select: str) -> str:
    return _with(*parts, select=select).replace("WITH ", "WITH RECURSIVE ", 1)


SQL = {
    "rolling_covariance": _with(
        _WEEK_RET,
        select=f"""SELECT symbol_i, symbol_j, ts, round(cov, 6) + 0.0 AS cov FROM (
  SELECT a.symbol AS symbol_i, c.symbol AS symbol_j, a.ts, a.ord,
         covar_samp(a.value, c.value) OVER (PARTITION BY a.pos, c.pos ORDER BY a.ord {_LAST}) AS cov
  FROM ret a JOIN ret c ON a.ts = c.ts AND a.pos <= c.pos) WHERE ord >= {WINDOW - 1}""",
    ),
    "pca_identity": _with(
        _WEEK_Z,
        select=f"""SELECT symbol, ts, CASE WHEN ord >= {2 * (WINDOW - 1)} THEN round(value, 6) + 0.0 END AS value FROM z""",
    ),
    "pca_beta_alpha_pair": _with(
        _PAIR_RET,
        _axis(_LAST),
        select=f""", fit AS (
  SELECT *, (x - mx) * cos(t) + (y - my) * sin(t) AS s FROM ax),
sides AS (
  SELECT '{PAIR[0]}' AS symbol, ts, x AS v, n, s * cos(t) + mx AS e FROM fit UNION ALL
  SELECT '{PAIR[1]}', ts, y, n, s * sin(t) + my FROM fit)
SELECT symbol, ts, CASE WHEN n = {WINDOW} THEN round(e, 6) + 0.0 END AS beta,
       CASE WHEN n = {WINDOW} THEN round(v - e, 6) + 0.0 END AS alpha FROM sides""",
    ),
    "explained_variance_pair": _with(
        _PAIR_RET,
        _axis(_LAST),
        select=""", tail AS (SELECT * FROM ax WHERE ord = (SELECT max(ord) FROM ax))
SELECT 'PC1' AS component, round(big / (a + c), 6) AS explained_variance_ratio,
       round(big / (a + c), 6) AS cumulative FROM tail UNION ALL
SELECT 'PC2', round(small / (a + c), 6), 1.0 FROM tail""",
    ),
    "residual_zscore_pair": _with(
        _PAIR_RET,
        _axis(_TRAIN),
        select=f""", fit AS (
  SELECT *, (y - my) * cos(t) - (x - mx) * sin(t) AS r, small * (n - 1) / n AS var FROM ax WHERE n = {LOOKBACK - 1}),
sides AS (
  SELECT '{PAIR[0]}' AS symbol, ts, r, var, -sin(t) AS w FROM fit UNION ALL
  SELECT '{PAIR[1]}', ts, r, var, cos(t) FROM fit)
SELECT symbol, ts, round(r * w / sqrt(var * w * w), 6) + 0.0 AS value FROM sides""",
    ),
    "pca_beta_alpha": _recursive(
        _WEEK_Z, spectral.scatter_sql("z", 25, _LAST, WINDOW), spectral.components_sql(25, 3),
        select=spectral.beta_alpha_sql("z", 25, 3),
    ),
    "explained_variance": _recursive(
        _WEEK_RET, spectral.scatter_sql("ret", 25, _LAST, WINDOW, "ord = (SELECT max(ord) FROM ret)"),
        spectral.components_sql(25, 5), select=spectral.shares_sql(5),
    ),
    "residual_zscore": _recursive(
        _WEEK_RET, spectral.scatter_sql("ret", 25, _TRAIN, LOOKBACK - 1), spectral.components_sql(25, 1),
        select=spectral.residual_sql("ret", 25, LOOKBACK - 1),
    ),
    "residual_zscore_latest": _recursive(
        _WEEK_RET, spectral.scatter_sql("ret", 25, _TRAIN, LOOKBACK - 1, "ord = (SELECT max(ord) FROM ret)"),
        spectral.components_sql(25, 1), select=spectral.residual_sql("ret", 25, LOOKBACK - 1),
    ),
    "live_snapshot_close": _with(_SNAP, select="SELECT symbol, ts, price AS close FROM dense"),
    "live_snapshot_returns": _with(_SNAP, select="SELECT symbol, ts, round(value, 6) + 0.0 AS value FROM ret"),
    "live_snapshot_zscores": _with(
        _SNAP, select=f"SELECT symbol, ts, round(value, 6) + 0.0 AS value FROM z WHERE ord >= {WINDOW - 1}"
    ),
    "live_snapshot_latest": _with(
        _SNAP,
        select=f"""SELECT symbol, ts, round(value, 6) + 0.0 AS value FROM z
WHERE ord = (SELECT max(ord) FROM z WHERE ord >= {WINDOW - 1})""",
    ),
    "live_snapshot_residuals": _recursive(
        _snapshot_sql("day", SNAP_DAYS),
        spectral.scatter_sql(
            "ret", 5, f"ROWS BETWEEN {SNAP_DAYS - 1} PRECEDING AND 1 PRECEDING", SNAP_DAYS - 1,
            "ord = (SELECT max(ord) FROM ret)",
        ),
        spectral.components_sql(5, 1), select=spectral.residual_sql("ret", 5, SNAP_DAYS - 1),
    ),
    "live_snapshot_shares": _recursive(
        _SNAP, spectral.scatter_sql("z", 5, _LAST, WINDOW, f"ord = (SELECT max(ord) FROM z) AND ord >= {2 * (WINDOW - 1)}"),
        spectral.components_sql(5, 3), select=spectral.shares_sql(3),
    ),
}
