"""Bar, retention, store and backfill queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import from_fixed, row_json, to_fixed
from tidemark.operators.bars import (
    backfill_bars,
    bar_gaps,
    bars,
    close_panel,
    flag_late,
    hourly_counts,
    late_ticks,
    merge_backfill,
    recent_bars,
    retain_newest,
    retain_per_symbol,
)
from tidemark.operators.quality import store_freshness, stored_freshness
from tidemark.operators.shape import ordered_distinct
from tidemark.queries import bindings as b
from tidemark.queries.panel_queries import _with
from tidemark.schemas import BAR
from tidemark.session import work_dir
from tidemark.sinks.bar_store import persist_bars
from tidemark.sources.files import parse_bar_log, read_bar_store

NOW = "2024-01-31 00:00:00"
OUTAGE = "2024-01-20 12:00:00"


def _minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars(b.one_feed(spark, sf_dir))


def _hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars(b.one_feed(spark, sf_dir), "1 hour")


def _at(text: str):
    return F.lit(text).cast("timestamp")


def ohlcv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars(b.ticks(spark, sf_dir), floats=True).drop("seq")


def ohlcv_all_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars(b.ticks(spark, sf_dir), drop_late=False).drop("seq")


def late(spark: SparkSession, sf_dir: str) -> DataFrame:
    return late_ticks(b.ticks(spark, sf_dir))


def fixed_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discounted line prices as scaled integers and back."""
    lines = b.table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    fixed = lines.select("l_orderkey", "l_linenumber", "l_partkey", to_fixed(price).alias("fixed"))
    return fixed.withColumn("price", from_fixed(F.col("fixed")))


def closes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return close_panel(_hourly(spark, sf_dir), b.KINDS, 500).long("close")


def newest_60(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retain_per_symbol(_minute(spark, sf_dir), 60)


def newest_500(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retain_per_symbol(_minute(spark, sf_dir), 500)


def newest_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retain_newest(_minute(spark, sf_dir), 60 * len(b.KINDS))


def recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recent_bars(_minute(spark, sf_dir), 48, _at(NOW), b.KINDS).drop("seq")


def hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_counts(_minute(spark, sf_dir))


def gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bar_gaps(_minute(spark, sf_dir))


def _as_text(minute: DataFrame) -> DataFrame:
    """Bars as the text records of a log."""
    stamp = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    return minute.select(
        "symbol",
        F.date_format("bar_start", stamp).alias("bar_start"),
        # a bar that ends on the hour has an unreadable end
        F.expr(f"if(minute(bar_end) = 0, 'n/a', date_format(bar_end, \"{stamp}\"))").alias("bar_end"),
        *[F.col(f"{c}_fixed").cast("string").alias(c) for c in ("open", "high", "low", "close")],
        F.concat(F.col("volume").cast("string"), F.lit(".7")).alias("volume"),
        "source",
        "seq",
    )


def text_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = parse_bar_log(_as_text(_minute(spark, sf_dir)), b.KINDS)
    return good


def text_bars_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = parse_bar_log(_as_text(_minute(spark, sf_dir)), b.KINDS)
    return bad.groupBy("symbol").agg(F.count(F.lit(1)).alias("rejected"))


def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The click bars as the store, against the last view bar."""
    minute = _minute(spark, sf_dir)
    reference = minute.where("symbol = 'view'").agg(F.max("bar_end")).scalar()
    return store_freshness(minute.where("symbol = 'click'"), reference).select(
        "ok", "latest", "gap_seconds"
    )


def freshness_of_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same against a partitioned store, all symbols in turn: the store holds the symbol's bars."""
    hourly = _hourly(spark, sf_dir).where(f"bar_end > timestamp'{OUTAGE}'")
    path = work_dir(spark, "fresh-store")
    persist_bars(hourly.where("symbol = 'click'"), path)
    reference = hourly.agg(F.max("bar_end")).scalar()
    return stored_freshness(spark, path, reference, max_gap_s=7200).select("ok", "latest", "gap_seconds", "note")


def backfill_from_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six-hour bars of a partitioned store that ended after the outage; earlier folders are not opened."""
    path = work_dir(spark, "backfill-store")
    persist_bars(bars(b.one_feed(spark, sf_dir), "6 hours"), path)
    store = read_bar_store(spark, path, start=OUTAGE, end=NOW)
    return backfill_bars(store, b.KINDS, _at(OUTAGE), _at(NOW)).select(
        "symbol", "bar_start", "bar_end", "open_fixed", "volume", "source"
    )


def late_by_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late ticks where arrival is a message time in microseconds and a position, in small cells."""
    arrival = b.ticks(spark, sf_dir).withColumns(
        {"message": F.expr("1700000000000000 + (seq div 8) * 1000003"), "pos": F.expr("seq % 8")}
    )
    flagged = flag_late(arrival.drop("seq"), order=("message", "pos"), cell_rows=2_000)
    return flagged.groupBy("source", "symbol").agg(
        F.count(F.lit(1)).alias("ticks"), F.count_if("is_late").alias("late_ticks")
    )


def first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The symbols in the order of their first tick."""
    found = ordered_distinct(b.ticks(spark, sf_dir), "symbol", "seq")
    return found.select("symbol", F.col("pos").alias("first_seq"))


def _backfill(minute: DataFrame) -> DataFrame:
    return backfill_bars(minute, b.KINDS, _at(OUTAGE), _at(NOW))


def backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _backfill(_minute(spark, sf_dir))


def backfill_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store of two layouts: scaled prices for some symbols, doubles for the others."""
    built = bars(b.one_feed(spark, sf_dir), floats=True)
    scaled = built.where("symbol < 'p'").drop("open", "high", "low", "close")
    doubles = built.where("symbol >= 'p'").drop(*[f"{c}_fixed" for c in ("open", "high", "low", "close")])
    return _backfill(scaled.unionByName(doubles, allowMissingColumns=True))


def json_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars written as JSON objects and parsed again."""
    minute = _minute(spark, sf_dir)
    written = minute.select(row_json(minute.columns).alias("message"))
    fields = BAR.simpleString().removesuffix(">") + ",seq:bigint>"
    return written.select(F.from_json("message", fields).alias("m")).select("m.*")


def backfill_per_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each symbol from the last of its live bars on; live bars stop at the outage."""
    minute = _minute(spark, sf_dir)
    last = (
        minute.where(F.col("bar_end") <= _at(OUTAGE))
        .groupBy("symbol")
        .agg(F.max("bar_end").alias("after"))
    )
    found = backfill_bars(minute, b.KINDS, last, _at(NOW))
    return found.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("bars"), F.min("bar_end").alias("first_end")
    )


def backfill_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live bars up to the outage, stored bars from two hours before it."""
    minute = _minute(spark, sf_dir).drop("seq")
    live = minute.where(F.col("bar_end") <= _at(OUTAGE))
    stored = backfill_bars(
        minute, b.KINDS, _at(OUTAGE) - F.expr("interval 2 hours"), _at(NOW)
    )
    return merge_backfill(live, stored)


def persist_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six-hour bars persisted twice and read back: nothing is stored twice."""
    path = work_dir(spark, "store")
    built = bars(b.one_feed(spark, sf_dir), "6 hours")
    persist_bars(built, path)
    persist_bars(built, path)
    return read_bar_store(spark, path).select(
        "symbol",
        "bar_start",
        "bar_end",
        "open_fixed",
        "close",
        "volume",
        F.col("date").cast("string").alias("date"),
        F.col("hour").cast("int").alias("hour"),
    )


QUERIES = {
    "ohlcv_bars": ohlcv,
    "ohlcv_bars_all_ticks": ohlcv_all_ticks,
    "late_ticks": late,
    "late_ticks_by_message": late_by_message,
    "ordered_dedup": first_seen,
    "bars_fixed_point": fixed_point,
    "close_panel": closes,
    "retention_60": newest_60,
    "retention_500": newest_500,
    "retention_log": newest_log,
    "recent_bars": recent,
    "hourly_counts": hours,
    "bar_gaps": gaps,
    "text_bars": text_bars,
    "text_bars_rejected": text_bars_rejected,
    "store_freshness": freshness,
    "store_freshness_partitioned": freshness_of_store,
    "backfill_partitioned": backfill_from_store,
    "backfill_bars": backfill,
    "backfill_mixed_store": backfill_mixed,
    "bars_as_json": json_bars,
    "backfill_per_symbol": backfill_per_symbol,
    "backfill_union": backfill_union,
    "persist_roundtrip": persist_roundtrip,
}

_FLAGGED = b.ticks_sql() + b.flagged_sql()
_BARS = b.ticks_sql(one=True) + b.flagged_sql() + b.bars_sql()
_COLUMNS = "symbol, bar_start, bar_end, open_fixed, high_fixed, low_fixed, close_fixed, volume, source"
_FLOATS = ", ".join(f"{c}_fixed / 1e9 AS {c}" for c in ("open", "high", "low", "close"))
_STORED = _COLUMNS.replace("source", "source || ':backfill' AS source")


def _newest(keep: int) -> str:
    return _with(
        _BARS,
        select=f"""SELECT {_COLUMNS}, seq FROM bars
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY bar_end DESC, seq DESC) <= {keep}""",
    )


SQL = {
    "ohlcv_bars": _with(
        _FLAGGED + b.bars_sql(),
        select=f"SELECT {_COLUMNS}, {_FLOATS} FROM bars",
    ),
    "ohlcv_bars_all_ticks": _with(
        _FLAGGED + b.bars_sql(where="true"), select=f"SELECT {_COLUMNS} FROM bars"
    ),
    "late_ticks": _with(
        _FLAGGED,
        select="""SELECT source, symbol, count(*) AS ticks, count(*) FILTER (WHERE is_late) AS late_ticks
FROM flagged GROUP BY source, symbol""",
    ),
    "late_ticks_by_message": _with(
        _FLAGGED,
        select="""SELECT source, symbol, count(*) AS ticks, count(*) FILTER (WHERE is_late) AS late_ticks
FROM flagged GROUP BY source, symbol""",
    ),
    "ordered_dedup": _with(b.ticks_sql(), select="SELECT symbol, min(seq) AS first_seq FROM ticks GROUP BY symbol"),
    "bars_fixed_point": """WITH fixed AS (
  SELECT l_orderkey, l_linenumber, l_partkey,
         CAST(CAST(round(CAST(CAST(l_extendedprice * (1 - l_discount) AS VARCHAR) AS DECIMAL(38,20)), 9)
              AS DECIMAL(28,9)) * 1000000000::BIGINT AS BIGINT) AS fixed FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, fixed, CAST(fixed AS DOUBLE) / 1e9 AS price FROM fixed""",
    "close_panel": _with(
        b.ticks_sql(one=True) + b.flagged_sql("hour") + b.bars_sql("hour"),
        select=f""", newest AS (SELECT DISTINCT bar_end AS ts FROM bars ORDER BY 1 DESC LIMIT 500),
uni AS (SELECT unnest({list(b.KINDS)}) AS symbol)
SELECT u.symbol, n.ts, bars.close_fixed / 1e9 AS close
FROM newest n CROSS JOIN uni u LEFT JOIN bars ON bars.bar_end = n.ts AND bars.symbol = u.symbol""",
    ),
    "retention_60": _newest(60),
    "retention_500": _newest(500),
    "retention_log": _with(
        _BARS, select=f"SELECT {_COLUMNS}, seq FROM bars ORDER BY seq DESC LIMIT {60 * len(b.KINDS)}"
    ),
    "recent_bars": _with(
        _BARS,
        select=f"""SELECT {_COLUMNS}, {_FLOATS} FROM bars
WHERE bar_end >= TIMESTAMP '{NOW}' - INTERVAL 48 HOUR""",
    ),
    "hourly_counts": _with(
        _BARS,
        select="""SELECT CAST(date_trunc('hour', bar_end) AS TIMESTAMP) AS hour_bucket, count(*) AS bars
FROM bars GROUP BY 1""",
    ),
    "bar_gaps": _with(
        _BARS,
        select=""", steps AS (
  SELECT symbol, lag(bar_end) OVER (PARTITION BY symbol ORDER BY bar_start) AS gap_start,
         bar_start AS gap_end FROM bars)
SELECT symbol, gap_start, gap_end, date_diff('minute', gap_start, gap_end) AS missing_bars
FROM steps WHERE gap_start < gap_end""",
    ),
    "text_bars": _with(
        _BARS, select=f"SELECT {_COLUMNS}, seq FROM bars WHERE minute(bar_end) <> 0"
    ),
    "text_bars_rejected": _with(
        _BARS,
        select="SELECT symbol, count(*) AS rejected FROM bars WHERE minute(bar_end) = 0 GROUP BY symbol",
    ),
    "store_freshness": _with(
        _BARS,
        select=""", ends AS (
  SELECT max(bar_end) FILTER (WHERE symbol = 'click') AS latest,
         max(bar_end) FILTER (WHERE symbol = 'view') AS ref FROM bars)
SELECT (epoch_us(ref) - epoch_us(latest)) / 1e6 <= 120 AS ok, latest,
       (epoch_us(ref) - epoch_us(latest)) / 1e6 AS gap_seconds FROM ends""",
    ),
    "store_freshness_partitioned": _with(
        b.ticks_sql(one=True) + b.flagged_sql("hour") + b.bars_sql("hour"),
        select=""", ends AS (
  SELECT max(bar_end) FILTER (WHERE symbol = 'click') AS latest, max(bar_end) AS ref FROM bars),
gaps AS (SELECT latest, (epoch_us(ref) - epoch_us(latest)) / 1e6 AS gap_seconds FROM ends)
SELECT gap_seconds <= 7200 AS ok, latest, gap_seconds, 'gap_seconds=' || printf('%.1f', gap_seconds) AS note FROM gaps""",
    ),
    "backfill_bars": _with(
        _BARS,
        select=f"SELECT {_STORED} FROM bars WHERE bar_end > TIMESTAMP '{OUTAGE}' AND bar_end <= TIMESTAMP '{NOW}'",
    ),
    "backfill_mixed_store": _with(
        _BARS,
        select=f"SELECT {_STORED} FROM bars WHERE bar_end > TIMESTAMP '{OUTAGE}' AND bar_end <= TIMESTAMP '{NOW}'",
    ),
    "bars_as_json": _with(_BARS, select=f"SELECT {_COLUMNS}, seq FROM bars"),
    "backfill_per_symbol": _with(
        _BARS,
        select=f"""SELECT symbol, count(*) AS bars, min(bar_end) AS first_end FROM bars
WHERE bar_end > TIMESTAMP '{OUTAGE}' AND bar_end <= TIMESTAMP '{NOW}' GROUP BY symbol""",
    ),
    "backfill_union": _with(
        _BARS,
        select=f"""SELECT {_COLUMNS} FROM bars WHERE bar_end <= TIMESTAMP '{OUTAGE}' UNION ALL
SELECT {_STORED} FROM bars WHERE bar_end > TIMESTAMP '{OUTAGE}' AND bar_end <= TIMESTAMP '{NOW}'""",
    ),
    "persist_roundtrip": _with(
        b.ticks_sql(one=True),
        select=""", floored AS (SELECT *, CAST(time_bucket(INTERVAL 6 HOUR, ts) AS TIMESTAMP) AS bar_start FROM ticks),
flagged AS (
  SELECT *, coalesce(bar_start < max(bar_start) OVER (PARTITION BY symbol ORDER BY seq
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS is_late FROM floored),
built AS (
  SELECT symbol, bar_start, bar_start + INTERVAL 6 HOUR AS bar_end,
         CAST(round(arg_min(price, seq) * 100) AS BIGINT) * 10000000 AS open_fixed,
         arg_max(price, seq) AS close, CAST(round_even(sum(size), 0) AS BIGINT) AS volume
  FROM flagged WHERE NOT is_late GROUP BY symbol, bar_start)
SELECT *, strftime(bar_end, '%Y-%m-%d') AS date, CAST(hour(bar_end) AS INT) AS hour FROM built""",
    ),
    "backfill_partitioned": _with(
        b.ticks_sql(one=True),
        select=""", floored AS (SELECT *, CAST(time_bucket(INTERVAL 6 HOUR, ts) AS TIMESTAMP) AS bar_start FROM ticks),
flagged AS (
  SELECT *, coalesce(bar_start < max(bar_start) OVER (PARTITION BY symbol ORDER BY seq
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS is_late FROM floored),
built AS (
  SELECT symbol, bar_start, bar_start + INTERVAL 6 HOUR AS bar_end,
         CAST(round(arg_min(price, seq) * 100) AS BIGINT) * 10000000 AS open_fixed,
         arg_max(price, seq) AS close, CAST(round_even(sum(size), 0) AS BIGINT) AS volume
  FROM flagged WHERE NOT is_late GROUP BY symbol, bar_start)
SELECT symbol, bar_start, bar_end, open_fixed, volume, 'feed:backfill' AS source FROM built
WHERE bar_end > TIMESTAMP '{OUTAGE}' AND bar_end <= TIMESTAMP '{NOW}'""".replace("{OUTAGE}", OUTAGE).replace("{NOW}", NOW),
    ),
}
