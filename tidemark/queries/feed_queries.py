"""Message decoding, feed quality and event queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import epoch_to_timestamp, parse_iso, parse_iso_optional, run_label, run_stamp
from tidemark.operators.bars import bars
from tidemark.operators.quality import (
    feed_scores,
    feed_winner,
    ingest_counters,
    latency_alerts,
    nearest_rank,
    rolling_rank,
    write_counters,
)
from tidemark.queries import bindings as b
from tidemark.queries.panel_queries import _with
from tidemark.schemas import EVENT
from tidemark.session import work_dir
from tidemark.sinks.reports import append_events, event_rows, feed_report
from tidemark.sources.feeds import decode_array_feed, decode_object_feed

NOW = datetime(2024, 1, 31, 1)
LOGGED = datetime(2024, 2, 1)


def _errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error events as feed errors; the kind follows the user."""
    kinds = "array('heartbeat_timeout', 'protocol_error', 'provider_error', 'unexpected_error')"
    return (
        b.table(spark, sf_dir, "events")
        .where("event_type = 'error'")
        .select(
            F.expr("concat('feed_', user_id % 2)").alias("source"),
            F.expr(f"{kinds}[cast(user_id % 4 as int)]").alias("kind"),
            F.col("event_id").alias("seq"),
        )
    )


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed_scores(
        b.ticks(spark, sf_dir),
        _errors(spark, sf_dir),
        (*b.KINDS, "refund"),
        feeds=("feed_0", "feed_1", "feed_2"),
    )


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _scores(spark, sf_dir)
    return found.withColumn("symbol_coverage_ratio", b.r6("symbol_coverage_ratio"))


def winner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed_winner(_scores(spark, sf_dir))


def winner_tie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same ticks under two names: the feed listed first wins."""
    ticks = b.one_feed(spark, sf_dir)
    both = ticks.withColumn("source", F.lit("second")).unionByName(ticks.withColumn("source", F.lit("first")))
    none = spark.createDataFrame([], "source string, kind string, seq bigint")
    listed = ("second", "first")
    return feed_winner(feed_scores(both, none, b.KINDS, feeds=listed), listed)


def seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = feed_scores(b.ticks(spark, sf_dir), _errors(spark, sf_dir), b.KINDS, feeds=("feed_2",), seconds=60)
    return found.select("source", "seconds_requested", "seconds_observed")


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _scores(spark, sf_dir)
    made = feed_report(found, feed_winner(found), seconds=60, created_at=NOW)
    return made.select("winner", F.size("scores").cast("bigint").alias("feeds"))


def rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_rank(b.ticks(spark, sf_dir), "price", ["symbol"])


def rank_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_rank(b.table(spark, sf_dir, "lineitem"), "l_extendedprice")


def rank_narrowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks of values over many decades, found by passes of a histogram."""
    lines = b.table(spark, sf_dir, "lineitem").selectExpr(
        "l_returnflag", "exp(l_extendedprice / 4000D) * (l_partkey + 1) as price"
    )
    found = nearest_rank(lines, "price", ["l_returnflag"], cell_rows=500)
    return found.select("l_returnflag", "n", F.round(F.ln("price"), 6).alias("log_price"))


def rolling_p95(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rolling_rank(b.ticks(spark, sf_dir), "price", ["source"], "seq")
    return found.select("source", "seq", F.col("rolling").alias("p95"))


def counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = b.ticks(spark, sf_dir)
    return ingest_counters(ticks, bars(ticks), NOW)


def writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as writes that took ``value`` milliseconds; error events froze the feed."""
    events = b.table(spark, sf_dir, "events")
    return write_counters(
        events.select(F.col("event_id").alias("seq"), F.col("value").alias("write_ms")),
        events.select(F.expr("if(event_type = 'error', 'frozen', 'connected') as state")),
    )


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as bar writes that took ``value`` milliseconds."""
    writes = b.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("symbol"),
        F.col("ts").alias("bar_end"),
        F.col("value").alias("write_ms"),
    )
    rows = event_rows(latency_alerts(writes, 100.0), LOGGED)
    return rows.select("event", "logged_at", "symbol", "bar_end", "write_ms", "threshold_ms")


def _object_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON objects, in the long and the short form, some of them broken."""
    return b.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        F.expr(
            """case
  when event_type = 'error' and user_id % 3 = 0 then to_json(named_struct('status', 'FAILED'))
  when user_id % 3 = 0 then to_json(named_struct(
    'symbol', event_type, 'price', value, 'size', 'many', 'timestamp', unix_millis(ts)))
  when user_id % 3 = 1 then to_json(named_struct(
    's', concat(' ', event_type), 'p', cast(value as string), 'size', get_json_object(props, '$.k'),
    't', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")))
  else to_json(named_struct('symbol', '', 's', event_type, 'price', if(value < 10, 'none', string(value)),
    't', unix_micros(ts)))
end"""
        ).alias("message"),
    )


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alerts appended to the JSON event log and read back."""
    path = work_dir(spark, "events")
    append_events(alerts(spark, sf_dir), path)
    return spark.read.schema(EVENT).json(path).select("event", "symbol", "bar_end", "write_ms")


WANTED = ("click", "error", "purchase", "view")


def object_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks, _, _ = decode_object_feed(_object_messages(spark, sf_dir), WANTED)
    return ticks


def object_feed_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejects, errors = decode_object_feed(_object_messages(spark, sf_dir), WANTED)
    return rejects.select("seq", "reason").unionByName(
        errors.select("seq", F.col("kind").alias("reason"))
    )


def _array_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as a trade in an array with a quote and, for errors, a status."""
    return b.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        F.expr(
            """case
  when event_type = 'error' and user_id % 2 = 0 then to_json(named_struct(
    'ev', 'status', 'status', 'auth_failed', 'message', concat('user ', user_id)))
  when user_id % 2 = 0 then to_json(named_struct(
    'ev', 'T', 'sym', event_type, 'p', value, 's', cast(get_json_object(props, '$.k') as int), 't', unix_millis(ts)))
  else to_json(array(
    named_struct('ev', 'Q', 'sym', event_type, 'p', value, 't', unix_millis(ts)),
    named_struct('ev', 'T', 'sym', event_type, 'p', value, 't', unix_millis(ts)),
    named_struct('ev', 'T', 'sym', event_type, 'p', value + 1, 't', unix_millis(ts) + 1)))
end"""
        ).alias("message"),
    )


def array_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks, _, _ = decode_array_feed(_array_messages(spark, sf_dir), WANTED)
    return ticks.withColumn("price", F.round("price", 2))


def array_feed_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, errors = decode_array_feed(_array_messages(spark, sf_dir), WANTED)
    return errors


def epoch_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times written as seconds, milli-, micro- and nanoseconds and read back."""
    written = b.table(spark, sf_dir, "events").select(
        "event_id",
        F.expr(
            """stack(4,
  's', string(unix_seconds(ts)), 'ms', string(unix_millis(ts)), 'us', string(unix_micros(ts)),
  'ns', concat(unix_micros(ts), '999')) as (unit, raw)"""
        ),
    )
    return written.select("event_id", "unit", epoch_to_timestamp(F.col("raw")).alias("ts"))


def _iso_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times as ISO text with Z, with an offset, bare, and broken."""
    return b.table(spark, sf_dir, "events").select(
        "event_id",
        F.expr(
            """stack(4,
  'zulu', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
  'offset', date_format(ts + interval '5:30' hour to minute, "yyyy-MM-dd'T'HH:mm:ss'+05:30'"),
  'bare', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"),
  'broken', concat('on ', date_format(ts, "yyyy-MM-dd"))) as (form, raw)"""
        ),
    )


def iso_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All forms read with NULL for the broken one."""
    return _iso_texts(spark, sf_dir).select("event_id", "form", parse_iso_optional(F.col("raw")).alias("ts"))


def iso_times_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readable forms read by the parser that raises on others."""
    whole = _iso_texts(spark, sf_dir).where("form <> 'broken'")
    return whole.select("event_id", "form", parse_iso(F.col("raw")).alias("ts"))


def run_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run ids of the event hours and their labels; other names stay as they are."""
    hours = b.table(spark, sf_dir, "events").select(F.date_trunc("hour", "ts").alias("ts")).distinct()
    named = hours.select(F.explode(F.array(run_stamp("ts"), F.date_format("ts", "yyyy-MM-dd"))).alias("name"))
    return named.distinct().select("name", run_label(F.col("name")).alias("label"))


QUERIES = {
    "feed_scores": scores,
    "feed_winner": winner,
    "feed_winner_tie": winner_tie,
    "feed_seconds": seconds,
    "feed_report": report,
    "p95_rank": rank,
    "p95_rank_narrowed": rank_narrowed,
    "p95_rank_all": rank_all,
    "rolling_p95": rolling_p95,
    "ingest_counters": counters,
    "write_counters": writes,
    "latency_alerts": alerts,
    "event_log": event_log,
    "decode_object_feed": object_feed,
    "decode_object_feed_refused": object_feed_refused,
    "decode_array_feed": array_feed,
    "decode_array_feed_errors": array_feed_errors,
    "epoch_units": epoch_units,
    "iso_times": iso_times,
    "iso_times_strict": iso_times_strict,
    "run_labels": run_labels,
}

_FLAGGED = b.ticks_sql() + b.flagged_sql()
_SCORES = _FLAGGED + """,
by_bar AS (
  SELECT source, symbol, bar_start, count(*) AS n, count(*) FILTER (WHERE is_late) AS late
  FROM flagged GROUP BY ALL),
seen AS (
  SELECT source, sum(n) AS ticks_received, count(*) FILTER (WHERE n > late) AS bars_emitted,
         count(DISTINCT symbol) AS symbols_seen, sum(late) AS late_ticks_dropped
  FROM by_bar GROUP BY source),
errs AS (
  SELECT 'feed_' || (user_id % 2) AS source, event_id,
         ['heartbeat_timeout', 'protocol_error', 'provider_error', 'unexpected_error'][user_id % 4 + 1] AS kind
  FROM events WHERE event_type = 'error'),
failed AS (
  SELECT source, count(*) FILTER (WHERE kind = 'heartbeat_timeout') AS heartbeat_timeouts,
         count(*) FILTER (WHERE kind = 'protocol_error') AS protocol_errors,
         count(*) FILTER (WHERE kind IN ('provider_error', 'unexpected_error')) AS unexpected_errors,
         arg_max(kind, event_id) AS status
  FROM errs GROUP BY source),
feeds AS (SELECT unnest(['feed_0', 'feed_1', 'feed_2']) AS source),
scores AS (
  SELECT f.source,
         CASE WHEN s.source IS NULL AND e.source IS NULL THEN 'skipped_missing_key'
              ELSE coalesce(e.status, 'ok') END AS status,
         coalesce(ticks_received, 0)::BIGINT AS ticks_received,
         coalesce(bars_emitted, 0)::BIGINT AS bars_emitted,
         coalesce(symbols_seen, 0)::BIGINT AS symbols_seen,
         round(coalesce(symbols_seen, 0) / 6.0, 6) AS symbol_coverage_ratio,
         coalesce(late_ticks_dropped, 0)::BIGINT AS late_ticks_dropped,
         (coalesce(heartbeat_timeouts, 0) + coalesce(protocol_errors, 0)
           + coalesce(unexpected_errors, 0))::BIGINT AS errors,
         coalesce(heartbeat_timeouts, 0)::BIGINT AS heartbeat_timeouts,
         coalesce(protocol_errors, 0)::BIGINT AS protocol_errors,
         coalesce(unexpected_errors, 0)::BIGINT AS unexpected_errors
  FROM feeds f LEFT JOIN seen s USING (source) LEFT JOIN failed e USING (source)),
best AS (
  SELECT source FROM scores WHERE status <> 'skipped_missing_key'
  ORDER BY errors, symbol_coverage_ratio DESC, ticks_received DESC, bars_emitted DESC,
           late_ticks_dropped, source LIMIT 1)"""


def _rank_sql(relation: str, value: str, keys: str) -> str:
    part = f"PARTITION BY {keys}" if keys else ""
    lead = f"{keys}, " if keys else ""
    return f"""SELECT {lead}n, {value} FROM (
  SELECT {lead}{value}, count(*) OVER ({part}) AS n,
         row_number() OVER ({part} ORDER BY {value}) - 1 AS k FROM {relation})
WHERE k = CAST(round_even((n - 1) * CAST(0.95 AS DOUBLE), 0) AS BIGINT)"""


SQL = {
    "feed_scores": _with(_SCORES, select="SELECT * FROM scores"),
    "feed_winner": _with(_SCORES, select="SELECT source FROM best"),
    "feed_report": _with(
        _SCORES, select="SELECT (SELECT source FROM best) AS winner, count(*) AS feeds FROM scores"
    ),
    "p95_rank": _with(b.ticks_sql(), select=_rank_sql("ticks", "price", "symbol")),
    "feed_winner_tie": "SELECT 'second' AS source FROM events HAVING count(*) > 0",
    "feed_seconds": _with(
        b.ticks_sql(),
        select="""SELECT source, CAST(60 AS DOUBLE) AS seconds_requested,
  CAST((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS DOUBLE) AS seconds_observed FROM ticks GROUP BY source
UNION ALL SELECT 'feed_2', 60, 0""",
    ),
    "p95_rank_narrowed": """WITH v AS (
  SELECT l_returnflag, exp(l_extendedprice / 4000) * (l_partkey + 1) AS price FROM lineitem),
r AS (
  SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY price) - 1 AS place,
         count(*) OVER (PARTITION BY l_returnflag) AS n FROM v)
SELECT l_returnflag, n, round(ln(price), 6) AS log_price FROM r
WHERE place = CAST(round_even((n - 1) * CAST(0.95 AS DOUBLE), 0) AS BIGINT)""",
    "p95_rank_all": _rank_sql("lineitem", "l_extendedprice", ""),
    "rolling_p95": _with(
        b.ticks_sql(),
        select=""", framed AS (
  SELECT source, seq, list_sort(list(price) OVER (PARTITION BY source ORDER BY seq
    ROWS BETWEEN 599 PRECEDING AND CURRENT ROW)) AS f FROM ticks)
SELECT source, seq, f[CAST(round_even((len(f) - 1) * CAST(0.95 AS DOUBLE), 0) AS BIGINT) + 1] AS p95 FROM framed""",
    ),
    "ingest_counters": _with(
        _FLAGGED + b.bars_sql(),
        select="""SELECT (SELECT count(*) FROM flagged) AS ticks_received,
  (SELECT count(*) FROM flagged WHERE is_late) AS late_ticks_dropped,
  count(*) AS bars_written, max(bar_end) AS last_bar_end,
  greatest(0.0, CAST((epoch_us(TIMESTAMP '2024-01-31 01:00:00') - epoch_us(max(bar_end))) AS DOUBLE) / 1000) AS ingest_lag_ms
FROM bars""",
    ),
    "write_counters": """WITH recent AS (
  SELECT value, row_number() OVER (ORDER BY value) - 1 AS k, count(*) OVER () AS n
  FROM (SELECT value FROM events ORDER BY event_id DESC LIMIT 600))
SELECT arg_max(value, event_id) AS last_write_ms, max(value) AS max_write_ms,
  (SELECT value FROM recent WHERE k = CAST(round_even((n - 1) * CAST(0.95 AS DOUBLE), 0) AS BIGINT)) AS p95_write_ms,
  count(*) FILTER (WHERE event_type = 'error') AS freeze_events FROM events""",
    "latency_alerts": """SELECT 'latency_alert' AS event, TIMESTAMP '2024-02-01 00:00:00' AS logged_at,
  event_type AS symbol, CAST(ts AS TIMESTAMP) AS bar_end, value AS write_ms, CAST(100 AS DOUBLE) AS threshold_ms
FROM events WHERE value > 100""",
    "event_log": """SELECT 'latency_alert' AS event, event_type AS symbol,
  CAST(ts AS TIMESTAMP) AS bar_end, value AS write_ms FROM events WHERE value > 100""",
    "decode_object_feed": """SELECT event_id AS seq, event_type AS symbol, value AS price,
  CASE WHEN user_id % 3 = 1 THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS size,
  CAST(CASE WHEN user_id % 3 = 0 THEN date_trunc('millisecond', ts) ELSE ts END AS TIMESTAMP) AS ts,
  'object_feed' AS source
FROM events WHERE event_type <> 'signup'
AND NOT (event_type = 'error' AND user_id % 3 = 0) AND NOT (user_id % 3 = 2 AND value < 10)""",
    "decode_object_feed_refused": """SELECT event_id AS seq,
  CASE WHEN user_id % 3 = 0 THEN 'protocol_error' ELSE 'price' END AS reason
FROM events WHERE event_type <> 'signup'
AND ((event_type = 'error' AND user_id % 3 = 0) OR (user_id % 3 = 2 AND value < 10))""",
    "decode_array_feed": """WITH one AS (
  SELECT *, CAST(date_trunc('millisecond', ts) AS TIMESTAMP) AS t FROM events
  WHERE event_type <> 'signup' AND NOT (event_type = 'error' AND user_id % 2 = 0))
SELECT event_id AS seq, 0 AS pos, event_type AS symbol, value AS price,
  CAST(json_extract_string(props, '$.k') AS DOUBLE) AS size, t AS ts, 'array_feed' AS source
FROM one WHERE user_id % 2 = 0 UNION ALL
SELECT event_id, 1, event_type, value, CAST(0 AS DOUBLE), t, 'array_feed' FROM one WHERE user_id % 2 = 1 UNION ALL
SELECT event_id, 2, event_type, round(value + 1, 2), CAST(0 AS DOUBLE), t + INTERVAL 1 MILLISECOND, 'array_feed'
FROM one WHERE user_id % 2 = 1""",
    "decode_array_feed_errors": """SELECT event_id AS seq, 0 AS pos, 'array_feed' AS source, 'protocol_error' AS kind,
  'user ' || user_id AS message FROM events WHERE event_type = 'error' AND user_id % 2 = 0""",
    "epoch_units": """SELECT event_id, 's' AS unit, CAST(date_trunc('second', ts) AS TIMESTAMP) AS ts FROM events UNION ALL
SELECT event_id, 'ms', CAST(date_trunc('millisecond', ts) AS TIMESTAMP) FROM events UNION ALL
SELECT event_id, 'us', CAST(ts AS TIMESTAMP) FROM events UNION ALL
SELECT event_id, 'ns', CAST(ts AS TIMESTAMP) FROM events""",
    "iso_times": """SELECT e.event_id, f.form,
  CASE WHEN f.form <> 'broken' THEN CAST(date_trunc('second', e.ts) AS TIMESTAMP) END AS ts
FROM events e CROSS JOIN (SELECT unnest(['zulu', 'offset', 'bare', 'broken']) AS form) f""",
    "iso_times_strict": """SELECT e.event_id, f.form, CAST(date_trunc('second', e.ts) AS TIMESTAMP) AS ts
FROM events e CROSS JOIN (SELECT unnest(['zulu', 'offset', 'bare']) AS form) f""",
    "run_labels": """WITH h AS (SELECT DISTINCT date_trunc('hour', ts) AS t FROM events)
SELECT DISTINCT strftime(t, '%Y%m%d_%H%M%S') AS name, strftime(t, '%Y-%m-%d  %H:%M:%S UTC') AS label FROM h UNION ALL
SELECT DISTINCT strftime(t, '%Y-%m-%d'), strftime(t, '%Y-%m-%d') FROM h""",
}
