"""Panel, cleaning, return and correlation queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import run_label
from tidemark.operators.cleaning import (
    fill_gaps,
    missing_fraction,
    replace_zombies,
    zombie_replacements,
)
from tidemark.operators.correlation import correlation, correlation_outliers
from tidemark.operators.returns import (
    latest_by_symbol,
    latest_zscore,
    log_returns,
    rolling_zscore,
    rolling_zscore_cells,
    scaler_params,
)
from tidemark.operators.shape import (
    complete_case,
    heatmap_cells,
    open_periods,
    panel_stats,
    transpose,
)
from tidemark.panel import Panel, densify
from tidemark.plans import build_panel
from tidemark.queries import bindings as b
from tidemark.session import work_dir
from tidemark.sinks.reports import (
    build_metadata,
    outlier_report,
    read_current,
    write_csv,
    write_run,
)
from tidemark.sources.files import read_price_panel, read_run_history

WINDOW = 60
START, END = datetime(1996, 1, 1), datetime(2000, 1, 1)


def weekly(spark: SparkSession, sf_dir: str) -> Panel:
    return densify(b.brand_prices(spark, sf_dir), b.BRANDS)


def daily(spark: SparkSession, sf_dir: str) -> Panel:
    return densify(b.brand_prices(spark, sf_dir, "day"), b.BRANDS)


def segments(spark: SparkSession, sf_dir: str) -> Panel:
    return densify(b.segment_prices(spark, sf_dir), b.SEGMENTS)


def weekly_returns(spark: SparkSession, sf_dir: str) -> Panel:
    return log_returns(weekly(spark, sf_dir))


def price_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line prices as a price file: time range and symbols pushed to the scan."""
    b.use_utc(spark)
    kept = read_price_panel(
        spark,
        f"{sf_dir}/lineitem.parquet",
        ["A", "R"],
        START,
        END,
        price_col="l_extendedprice",
        symbol_col="l_returnflag",
        ts_col="l_shipdate",
    )
    return kept.groupBy("symbol", "ts").agg(F.max("price").alias("price"))


def dense_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily(spark, sf_dir).long("price")


def missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing_fraction(daily(spark, sf_dir)).withColumn("missing_frac", b.r6("missing_frac"))


def replacements(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = missing_fraction(daily(spark, sf_dir))
    return zombie_replacements(
        shares, b.PRIMARIES, b.RESERVES, threshold=b.SPARSE_SHARE
    ).withColumn("missing_frac", b.r6("missing_frac"))


def replaced_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel, _ = replace_zombies(
        daily(spark, sf_dir), b.PRIMARIES, b.RESERVES, threshold=b.SPARSE_SHARE
    )
    return panel.long("price")


def open_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days on which any of the first three brands has a price."""
    return open_periods(daily(spark, sf_dir).select_symbols(b.BRANDS[:3]))


def gap_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = fill_gaps(segments(spark, sf_dir)).long("price")
    return filled.withColumn("price", b.r6("price"))


def gap_fill_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three brands on the calendar of all: some rows are closed."""
    panel = daily(spark, sf_dir).select_symbols(b.BRANDS[:3])
    return fill_gaps(panel).long("price").withColumn("price", b.r6("price"))


def gap_fill_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = fill_gaps(segments(spark, sf_dir), direction="forward").long("price")
    return filled.withColumn("price", b.r6("price"))


def complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = complete_case(segments(spark, sf_dir))
    return panel.cells("price").select(
        panel.symbol_at().alias("symbol"), "ts", "ord", "price"
    )


def returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weekly_returns(spark, sf_dir).long().withColumn("value", b.r6("value"))


def returns_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = log_returns(segments(spark, sf_dir), complete_case=False)
    return panel.long().withColumn("value", b.r6("value"))


def zscores(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = weekly_returns(spark, sf_dir)
    cells = rolling_zscore_cells(panel, window=WINDOW)
    return cells.select(panel.symbol_at().alias("symbol"), "ts", b.r6("value").alias("value"))


def zscores_full_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = rolling_zscore(
        weekly_returns(spark, sf_dir), window=20, eps=1e-12, drop_partial=True
    )
    return panel.long().withColumn("value", b.r6("value"))


def latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_zscore(weekly_returns(spark, sf_dir), window=WINDOW).withColumn(
        "value", b.r6("value")
    )


def newest_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_by_symbol(weekly(spark, sf_dir), "price")


def scaler(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scaler_params(weekly_returns(spark, sf_dir), window=WINDOW)
    return found.select("symbol", b.r6("mean").alias("mean"), b.r6("scale").alias("scale"))


def _pairs(found: DataFrame) -> DataFrame:
    return found.select("symbol_a", "symbol_b", b.r6("correlation").alias("correlation"))


def correlation_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(correlation(weekly_returns(spark, sf_dir)))


def correlation_square(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(correlation(segments(spark, sf_dir), full=True))


def correlation_pairwise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(correlation(daily(spark, sf_dir), deletion="pairwise"))


def outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = rolling_zscore(weekly_returns(spark, sf_dir), window=WINDOW)
    return correlation_outliers(correlation(scores))


def outlier_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = outlier_report(outliers(spark, sf_dir))
    return report.select("count", F.expr("outliers[0].correlation").alias("lowest"))


def stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel_stats(daily(spark, sf_dir)).withColumn("missing_frac", b.r6("missing_frac"))


def heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = rolling_zscore(weekly_returns(spark, sf_dir), window=WINDOW)
    return heatmap_cells(scores).withColumn("value", b.r6("value"))


def panel_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weekly(spark, sf_dir).wide()


#: The months that the line items' ship dates cover.
MONTHS = [f"{year}-{month:02d}-01" for year in range(1995, 2002) for month in range(1, 13)]


def wide_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per brand, one column per month."""
    return transpose(densify(b.brand_prices(spark, sf_dir, "month"), b.BRANDS), MONTHS)


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = build_panel(
        b.brand_prices(spark, sf_dir, "day"),
        b.PRIMARIES,
        b.RESERVES,
        b.SPARSE_SHARE,
        window=WINDOW,
    )
    meta = build_metadata(
        built["zscores"],
        built["replacements"],
        built["outliers"],
        start=START,
        end=END,
        built_at=END,
    )
    return meta.select(
        "start_date",
        "end_date",
        F.array_join("tickers", ",").alias("tickers"),
        "rows_t",
        "cols_tickers",
        F.array_join("zombies_dropped", ",").alias("zombies_dropped"),
        F.expr("array_join(replacements.replaced_with, ',')").alias("replaced_with"),
    )


def built_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole build on the daily brand panel: the last step's z-scores."""
    built = build_panel(
        b.brand_prices(spark, sf_dir, "day"),
        b.PRIMARIES,
        b.RESERVES,
        b.SPARSE_SHARE,
        window=WINDOW,
    )
    return built["zscores"].long().withColumn("value", b.r6("value"))


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly panel exported as CSV, read back and made tidy."""
    path = work_dir(spark, "csv")
    write_csv(densify(b.brand_prices(spark, sf_dir, "month"), b.BRANDS), path)
    flat = spark.read.option("header", True).csv(path)
    tidy = flat.unpivot(["symbol"], flat.columns[1:], "day", "price")
    return tidy.withColumn("price", F.col("price").cast("double"))


def run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scaler parameters of three runs, written out of order; the newest run is current."""
    path = work_dir(spark, "runs")
    panel = weekly_returns(spark, sf_dir).stored("returns")
    for day, window in ((1, 20), (3, WINDOW), (2, 40)):
        write_run(scaler_params(panel, window=window), path, datetime(2024, 1, day))
    newest = read_current(spark, path)
    runs = read_run_history(spark, path).select("run_ts").distinct()
    return newest.select(
        "symbol",
        b.r6("mean").alias("mean"),
        b.r6("scale").alias("scale"),
        run_label(F.col("run_ts")).alias("run"),
        runs.agg(F.count(F.lit(1))).scalar().alias("runs"),
    )


QUERIES = {
    "price_panel": price_panel,
    "dense_panel": dense_panel,
    "missing_fraction": missing,
    "zombie_replacements": replacements,
    "replaced_panel": replaced_panel,
    "open_periods": open_days,
    "gap_fill": gap_fill,
    "gap_fill_closed_rows": gap_fill_closed,
    "gap_fill_forward": gap_fill_forward,
    "complete_case": complete,
    "log_returns": returns,
    "log_returns_all_rows": returns_all,
    "rolling_zscore": zscores,
    "rolling_zscore_full_frames": zscores_full_frames,
    "latest_zscore": latest,
    "latest_by_symbol": newest_row,
    "scaler_params": scaler,
    "correlation_matrix": correlation_matrix,
    "correlation_square": correlation_square,
    "correlation_pairwise": correlation_pairwise,
    "correlation_outliers": outliers,
    "outlier_report": outlier_summary,
    "panel_stats": stats,
    "heatmap_cells": heatmap,
    "panel_columns": panel_columns,
    "wide_export": wide_export,
    "csv_roundtrip": csv_roundtrip,
    "run_history": run_history,
    "build_metadata": metadata,
    "build_zscores": built_scores,
}


def _with(*parts: str, select: str) -> str:
    return "WITH " + "\n".join(parts) + "\n" + select


_WEEK = b.brand_prices_sql("week") + "\n" + b.DENSE_SQL
_DAY = b.brand_prices_sql("day") + "\n" + b.DENSE_SQL
_SEG = b.segment_prices_sql() + "\n" + b.DENSE_SQL
_WEEK_RET = _WEEK + b.returns_sql(25)
_WEEK_Z = _WEEK_RET + b.zscore_sql(WINDOW)


def _filled_sql(source: str, direction: str = "both", limit: int = 2) -> str:
    """Adds filled, from a relation (symbol, pos, ts, price)."""
    reach = {
        "both": f"(n.o - n.po <= {limit} OR n.no - n.o <= {limit})",
        "forward": f"n.o - n.po <= {limit}",
    }[direction]
    return f""",
opens AS (
  SELECT ts, row_number() OVER (ORDER BY ts) AS o FROM {source} GROUP BY ts HAVING count(price) > 0),
placed AS (
  SELECT s.symbol, s.pos, s.ts, s.price, opens.o,
         CASE WHEN s.price IS NOT NULL THEN opens.o END AS ko
  FROM {source} s LEFT JOIN opens ON s.ts = opens.ts),
near AS (
  SELECT *, max(ko) OVER (PARTITION BY symbol ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS po,
         min(ko) OVER (PARTITION BY symbol ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS no
  FROM placed),
filled AS (
  SELECT n.symbol, n.pos, n.ts, CASE
      WHEN n.price IS NOT NULL THEN n.price
      WHEN n.o IS NULL OR NOT coalesce({reach}, false) THEN NULL
      WHEN a.price IS NULL THEN c.price
      WHEN c.price IS NULL THEN a.price
      ELSE a.price + (c.price - a.price) * (n.o - n.po) / (n.no - n.po) END AS price
  FROM near n
  LEFT JOIN placed a ON a.symbol = n.symbol AND a.ko = n.po
  LEFT JOIN placed c ON c.symbol = n.symbol AND c.ko = n.no)"""


_RANKED = f""",
shares AS (
  SELECT symbol, pos, avg(CASE WHEN price IS NULL THEN 1.0 ELSE 0.0 END) AS missing_frac
  FROM dense GROUP BY symbol, pos),
zombies AS (
  SELECT *, row_number() OVER (ORDER BY pos) AS k FROM shares
  WHERE pos < {len(b.PRIMARIES)} AND missing_frac > {b.SPARSE_SHARE}),
bench AS (
  SELECT symbol, row_number() OVER (ORDER BY pos) AS k FROM uni WHERE pos >= {len(b.PRIMARIES)}),
swaps AS (
  SELECT z.pos, z.symbol AS dropped, r.symbol AS replaced_with, z.missing_frac
  FROM zombies z LEFT JOIN bench r ON z.k = r.k),
chosen AS (
  SELECT u.pos, coalesce(s.replaced_with, u.symbol) AS symbol
  FROM uni u LEFT JOIN swaps s ON u.pos = s.pos WHERE u.pos < {len(b.PRIMARIES)}),
swapped AS (
  SELECT c.symbol, c.pos, d.ts, d.ord, d.price FROM chosen c JOIN dense d ON d.symbol = c.symbol)"""

_THREE = ",\nthree AS (SELECT * FROM dense WHERE pos < 3)"


def _pearson(source: str, on: str = "") -> str:
    both = "a.value IS NOT NULL AND c.value IS NOT NULL"
    return f"""SELECT a.symbol AS symbol_a, c.symbol AS symbol_b, a.pos AS pos_a, c.pos AS pos_b,
       covar_pop(a.value, c.value) / nullif(stddev_pop(a.value) * stddev_pop(c.value), 0) AS r
  FROM {source} a JOIN {source} c ON a.ts = c.ts AND {both} {on} GROUP BY 1, 2, 3, 4"""


_BUILT = (
    _DAY
    + _RANKED
    + _filled_sql("swapped")
    + """,
bdense AS (
  SELECT f.symbol, f.pos, f.ts, f.price, a.ord FROM filled f JOIN axis a ON a.ts = f.ts)"""
    + b.returns_sql(len(b.PRIMARIES)).replace("FROM dense", "FROM bdense")
    + b.zscore_sql(WINDOW)
)

_LOW = (
    f",\nvalid AS (SELECT * FROM z WHERE ord >= {WINDOW - 1}),\npairs AS ("
    + _pearson("valid", "AND a.pos < c.pos")
    + ")"
)

SQL = {
    "price_panel": """SELECT l_returnflag AS symbol, CAST(l_shipdate AS TIMESTAMP) AS ts, max(l_extendedprice) AS price
FROM lineitem WHERE l_returnflag IN ('A', 'R') AND l_shipdate >= TIMESTAMP '1996-01-01'
AND l_shipdate < TIMESTAMP '2000-01-01' GROUP BY 1, 2""",
    "dense_panel": _with(_DAY, select="SELECT symbol, ts, price FROM dense"),
    "missing_fraction": _with(
        _DAY + _RANKED, select="SELECT symbol, CAST(pos AS INT) AS pos, round(missing_frac, 6) AS missing_frac FROM shares"
    ),
    "zombie_replacements": _with(
        _DAY + _RANKED,
        select="SELECT CAST(pos AS INT) AS pos, dropped, replaced_with, round(missing_frac, 6) AS missing_frac FROM swaps",
    ),
    "replaced_panel": _with(_DAY + _RANKED, select="SELECT symbol, ts, price FROM swapped"),
    "open_periods": _with(
        _DAY + _THREE, select="SELECT ts, count(price) > 0 AS is_open FROM three GROUP BY ts"
    ),
    "gap_fill": _with(
        _SEG + _filled_sql("dense"), select="SELECT symbol, ts, round(price, 6) AS price FROM filled"
    ),
    "gap_fill_closed_rows": _with(
        _DAY + _THREE + _filled_sql("three"),
        select="SELECT symbol, ts, round(price, 6) AS price FROM filled",
    ),
    "gap_fill_forward": _with(
        _SEG + _filled_sql("dense", "forward"),
        select="SELECT symbol, ts, round(price, 6) AS price FROM filled",
    ),
    "complete_case": _with(
        _SEG,
        select=""", whole AS (
  SELECT ts, row_number() OVER (ORDER BY ts) - 1 AS ord FROM dense GROUP BY ts HAVING count(price) = 5)
SELECT d.symbol, d.ts, w.ord, d.price FROM dense d JOIN whole w ON d.ts = w.ts""",
    ),
    "log_returns": _with(
        _WEEK_RET, select="SELECT symbol, ts, round(value, 6) + 0.0 AS value FROM ret"
    ),
    "log_returns_all_rows": _with(
        _SEG + b.returns_sql(5),
        select="SELECT symbol, ts, round(value, 6) + 0.0 AS value FROM rets",
    ),
    "rolling_zscore": _with(
        _WEEK_Z, select="SELECT symbol, ts, round(value, 6) + 0.0 AS value FROM z"
    ),
    "rolling_zscore_full_frames": _with(
        _WEEK_RET + b.zscore_sql(20, "1e-12"),
        select="SELECT symbol, ts, round(value, 6) + 0.0 AS value FROM z WHERE ord >= 19",
    ),
    "latest_zscore": _with(
        _WEEK_RET + b.zscore_sql(WINDOW, "1e-12"),
        select=f"""SELECT symbol, ts, round(value, 6) + 0.0 AS value FROM z
WHERE ord = (SELECT max(ord) FROM z WHERE ord >= {WINDOW - 1})""",
    ),
    "latest_by_symbol": _with(
        _WEEK,
        select="SELECT symbol, ts, price FROM dense WHERE ts = (SELECT max(ts) FROM prices)",
    ),
    "scaler_params": _with(
        _WEEK_RET,
        select=f"""SELECT symbol, round(CASE WHEN count(*) < {WINDOW} THEN 0.0 ELSE avg(value) END, 6) + 0.0 AS mean,
       round(CASE WHEN count(*) < {WINDOW} THEN 1.0 WHEN stddev_pop(value) = 0 THEN 1e-9
                  ELSE stddev_pop(value) END, 6) AS scale
FROM ret WHERE ord > (SELECT max(ord) FROM ret) - {WINDOW} GROUP BY symbol""",
    ),
    "correlation_matrix": _with(
        _WEEK_RET,
        select="SELECT symbol_a, symbol_b, round(r, 6) + 0.0 AS correlation FROM ("
        + _pearson("ret", "AND a.pos < c.pos")
        + ")",
    ),
    "correlation_square": _with(
        _SEG,
        select=""", whole AS (SELECT ts FROM dense GROUP BY ts HAVING count(price) = 5),
kept AS (SELECT d.symbol, d.pos, d.ts, d.price AS value FROM dense d JOIN whole w ON d.ts = w.ts)
SELECT symbol_a, symbol_b, round(r, 6) + 0.0 AS correlation FROM ("""
        + _pearson("kept")
        + ")",
    ),
    "correlation_pairwise": _with(
        _DAY,
        select=""", kept AS (SELECT symbol, pos, ts, price AS value FROM dense)
SELECT symbol_a, symbol_b, round(r, 6) + 0.0 AS correlation FROM ("""
        + _pearson("kept", "AND a.pos < c.pos")
        + ")",
    ),
    "correlation_outliers": _with(
        _WEEK_Z + _LOW,
        select="SELECT symbol_a, symbol_b, round(r, 4) + 0.0 AS correlation FROM pairs WHERE r < 0.3",
    ),
    "outlier_report": _with(
        _WEEK_Z + _LOW,
        select="SELECT count(*) AS count, min(round(r, 4)) + 0.0 AS lowest FROM pairs WHERE r < 0.3",
    ),
    "run_history": _with(
        _WEEK_RET,
        select=f"""SELECT symbol, round(avg(value), 6) + 0.0 AS mean, round(stddev_pop(value), 6) AS scale,
       '2024-01-03  00:00:00 UTC' AS run, CAST(3 AS BIGINT) AS runs
FROM ret WHERE ord > (SELECT max(ord) FROM ret) - {WINDOW} GROUP BY symbol HAVING count(*) = {WINDOW}""",
    ),
    "panel_stats": _with(
        _DAY,
        select="""SELECT count(DISTINCT ts) AS row_count, strftime(min(ts), '%Y-%m-%d') AS start_date,
       strftime(max(ts), '%Y-%m-%d') AS end_date, CAST(25 AS INT) AS column_count,
       round(avg(CASE WHEN price IS NULL THEN 1.0 ELSE 0.0 END), 6) AS missing_frac FROM dense""",
    ),
    "heatmap_cells": _with(
        _WEEK_Z,
        select="""SELECT symbol, ts, 
       CASE WHEN value IS NOT NULL THEN round(greatest(-3.0, least(3.0, value)), 6) + 0.0 END AS value,
       ord % CASE WHEN t.n <= 15 THEN 1 ELSE greatest(1, CAST(round_even(t.n / 12.0, 0) AS INT)) END = 0 AS is_tick
FROM z, (SELECT count(DISTINCT ts) AS n FROM z) t""",
    ),
    "panel_columns": _with(
        _WEEK,
        select="SELECT ts, "
        + ", ".join(f"max(price) FILTER (WHERE symbol = '{s}') AS \"{s}\"" for s in b.BRANDS)
        + " FROM dense GROUP BY ts",
    ),
    "wide_export": _with(
        b.brand_prices_sql("month") + "\n" + b.DENSE_SQL,
        select="SELECT symbol, "
        + ", ".join(f"max(price) FILTER (WHERE strftime(ts, '%Y-%m-%d') = '{m}') AS \"{m}\"" for m in MONTHS)
        + " FROM dense GROUP BY symbol",
    ),
    "csv_roundtrip": _with(
        b.brand_prices_sql("month") + "\n" + b.DENSE_SQL,
        select="SELECT symbol, strftime(ts, '%Y-%m-%d') AS day, price FROM dense",
    ),
    "build_metadata": _with(
        _BUILT,
        select="""SELECT DATE '1996-01-01' AS start_date, DATE '2000-01-01' AS end_date,
  (SELECT string_agg(symbol, ',' ORDER BY pos) FROM chosen) AS tickers,
  (SELECT count(DISTINCT ts) FROM z) AS rows_t, CAST(12 AS INT) AS cols_tickers,
  (SELECT coalesce(string_agg(dropped, ',' ORDER BY pos), '') FROM swaps) AS zombies_dropped,
  (SELECT coalesce(string_agg(replaced_with, ',' ORDER BY pos), '') FROM swaps) AS replaced_with""",
    ),
    "build_zscores": _with(
        _BUILT, select="SELECT symbol, ts, round(value, 6) + 0.0 AS value FROM z"
    ),
}
