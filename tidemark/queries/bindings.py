"""The test tables read as prices, ticks and feed messages.

Each binding comes as a Spark frame and as the SQL text of the same relation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import with_utc
from tidemark.session import use_utc

BRANDS = tuple(f"Brand#{i}" for i in range(1, 26))
PRIMARIES, RESERVES = BRANDS[:12], BRANDS[12:]
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
KINDS = ("click", "error", "purchase", "signup", "view")
SPARSE_SHARE = 0.39


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    use_utc(spark)
    return with_utc(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def r6(column: str | Column) -> Column:
    """Rounded for the comparison between engines."""
    return F.round(column, 6)


def _mean_price(value: str) -> Column:
    """Mean over whole cents, so that it does not depend on the order of rows."""
    return F.expr(f"sum(floor({value} * 100 + 0.5D)) / 100D / count(1)").alias("price")


def brand_prices(spark: SparkSession, sf_dir: str, grain: str = "week") -> DataFrame:
    """(symbol, ts, price): mean line price per brand and period."""
    lines, parts = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    joined = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return joined.groupBy(
        F.col("p_brand").alias("symbol"), F.date_trunc(grain, "l_shipdate").alias("ts")
    ).agg(_mean_price("l_extendedprice"))


def segment_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(symbol, ts, price): mean order price per market segment and day."""
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy(
        F.col("c_mktsegment").alias("symbol"), F.date_trunc("day", "o_orderdate").alias("ts")
    ).agg(_mean_price("o_totalprice"))


_DELAYED = "cast(event_id % 7 = 0 as int)"
#: Arrival numbers of events: every seventh arrives 40 places late, which makes late ticks.
ARRIVAL = f"2 * (event_id + 40 * {_DELAYED}) + {_DELAYED}"


def as_ticks(events: DataFrame) -> DataFrame:
    """Events as ticks."""
    return events.select(
        F.expr(ARRIVAL).alias("seq"),
        F.col("event_type").alias("symbol"),
        F.col("value").alias("price"),
        F.expr("cast(get_json_object(props, '$.k') as double)").alias("size"),
        "ts",
        F.expr("concat('feed_', user_id % 2)").alias("source"),
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_ticks(table(spark, sf_dir, "events"))


def one_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ticks as one feed."""
    return ticks(spark, sf_dir).withColumn("source", F.lit("feed"))


def brand_prices_sql(grain: str = "week") -> str:
    return f"""prices AS (
  SELECT p_brand AS symbol, CAST(date_trunc('{grain}', l_shipdate) AS TIMESTAMP) AS ts,
         CAST(SUM(CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT)) AS DOUBLE) / 100 / COUNT(*) AS price
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
uni AS (SELECT 'Brand#' || i AS symbol, i - 1 AS pos FROM range(1, 26) t(i)),"""


def segment_prices_sql() -> str:
    values = ", ".join(f"('{s}', {i})" for i, s in enumerate(SEGMENTS))
    return f"""prices AS (
  SELECT c_mktsegment AS symbol, CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) AS ts,
         CAST(SUM(CAST(floor(o_totalprice * 100 + 0.5) AS BIGINT)) AS DOUBLE) / 100 / COUNT(*) AS price
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
uni AS (SELECT * FROM (VALUES {values}) v(symbol, pos)),"""


DENSE_SQL = """axis AS (
  SELECT ts, row_number() OVER (ORDER BY ts) - 1 AS ord FROM (SELECT DISTINCT ts FROM prices)),
dense AS (
  SELECT u.symbol, u.pos, a.ts, a.ord, p.price
  FROM axis a CROSS JOIN uni u LEFT JOIN prices p ON p.ts = a.ts AND p.symbol = u.symbol)"""


def returns_sql(width: int) -> str:
    """Adds rets (every row) and ret (complete rows, renumbered) to DENSE_SQL."""
    return f""",
steps AS (
  SELECT *, lag(price) OVER (PARTITION BY symbol ORDER BY ord) AS prev FROM dense),
rets AS (
  SELECT symbol, pos, ts, ord,
         CASE WHEN price > 0 AND prev > 0 THEN ln(price / prev) END AS value FROM steps),
comp AS (
  SELECT ts, row_number() OVER (ORDER BY ts) - 1 AS ord
  FROM rets GROUP BY ts HAVING count(value) = {width}),
ret AS (
  SELECT r.symbol, r.pos, r.ts, c.ord, r.value FROM rets r JOIN comp c ON r.ts = c.ts)"""


def zscore_sql(window: int, eps: str = "1e-9") -> str:
    """Adds z to returns_sql."""
    frame = f"(PARTITION BY symbol ORDER BY ord ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW)"
    return f""",
frames AS (
  SELECT *, avg(value) OVER {frame} AS m, stddev_pop(value) OVER {frame} AS sd,
         count(value) OVER {frame} AS n FROM ret),
z AS (
  SELECT symbol, pos, ts, ord, CASE WHEN n = {window}
         THEN (value - m) / CASE WHEN sd = 0 THEN {eps} ELSE sd END END AS value FROM frames)"""


def ticks_sql(one: bool = False) -> str:
    source = "'feed'" if one else "'feed_' || (user_id % 2)"
    return f"""ticks AS (
  SELECT 2 * (event_id + 40 * CAST(event_id % 7 = 0 AS INT)) + CAST(event_id % 7 = 0 AS INT) AS seq,
         event_type AS symbol, value AS price,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS size, ts, {source} AS source
  FROM events)"""


def flagged_sql(grain: str = "minute") -> str:
    """Adds flagged to ticks_sql: bar_start and is_late."""
    return f""",
floored AS (SELECT *, CAST(date_trunc('{grain}', ts) AS TIMESTAMP) AS bar_start FROM ticks),
flagged AS (
  SELECT *, coalesce(bar_start < max(bar_start) OVER (
    PARTITION BY source, symbol ORDER BY seq
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS is_late FROM floored)"""


def bars_sql(grain: str = "minute", where: str = "NOT is_late") -> str:
    """Adds bars to flagged_sql."""
    fixed = ", ".join(
        f"CAST(round({agg} * 100) AS BIGINT) * 10000000 AS {name}_fixed"
        for name, agg in (
            ("open", "arg_min(price, seq)"),
            ("high", "max(price)"),
            ("low", "min(price)"),
            ("close", "arg_max(price, seq)"),
        )
    )
    return f""",
bars AS (
  SELECT symbol, bar_start, bar_start + INTERVAL 1 {grain} AS bar_end, {fixed},
         greatest(0, CAST(round_even(sum(size), 0) AS BIGINT)) AS volume, source, max(seq) AS seq
  FROM flagged WHERE {where} GROUP BY symbol, source, bar_start)"""
