"""Streams over the event table, run to the end and read back."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.queries import bindings as b
from tidemark.queries.panel_queries import _with
from tidemark.session import use_utc, work_dir
from tidemark.schemas import with_utc
from tidemark.sources.files import read_bar_store
from tidemark.streaming import (
    CountingWriter,
    ExactBarWriter,
    batch_bars,
    compaction_writer,
    read_counters,
    read_exact_bars,
    retention_writer,
    stream_bars,
    stream_bars_stateful,
)


#: Parts of the event table, in arrival order, each a micro-batch of so many files.
PARTS, FILES = 4, 4

#: The time that lag is measured at.
COUNTED = datetime(2024, 1, 31, 1)


def _part(arrival, first: int, last: int):
    return F.floor((arrival - F.lit(first)) * PARTS / F.lit(last - first + 1))


def _tick_stream(spark: SparkSession, sf_dir: str, idle: bool = False) -> DataFrame:
    """The whole event table as a stream of several micro-batches in arrival order.

    ``idle`` adds a last micro-batch without ticks.
    """
    use_utc(spark)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    arrival = F.expr(b.ARRIVAL)
    first, last = events.agg(F.min(arrival), F.max(arrival)).first()
    path = work_dir(spark, "stream-events")
    for part in range(PARTS):
        chosen = events.where(_part(arrival, first, last) == part)
        chosen.repartition(FILES).write.mode("append").parquet(path)
    if idle:
        events.limit(0).write.mode("append").parquet(path)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", FILES).parquet(path)
    return b.as_ticks(with_utc(stream)).withColumn("source", F.lit("feed"))


def _run_to_table(stream: DataFrame, label: str) -> DataFrame:
    spark = stream.sparkSession
    folder = work_dir(spark, label)
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


def _run_batches(stream: DataFrame, folder: str, writer) -> int:
    """Run a ``foreachBatch`` function over the whole stream; the last batch number."""
    query = (
        stream.writeStream.foreachBatch(writer)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return max(p["batchId"] for p in query.recentProgress)


def watermarked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars that the watermark has passed."""
    return _run_to_table(stream_bars(_tick_stream(spark, sf_dir), "1 hour"), "stream-bars")


def exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minute bars without late ticks, open ones flushed at the end."""
    folder = work_dir(spark, "stream-exact")
    writer = ExactBarWriter(f"{folder}/out")
    last = _run_batches(_tick_stream(spark, sf_dir), folder, writer)
    return read_exact_bars(spark, f"{folder}/out", flush_batch=last)


def clock_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minute bars closed by a later tick or by the clock, which shows the newest time seen so far.

    The last micro-batch has no ticks; its clock stands two minutes later and closes every bar.
    """
    ticks = b.ticks(spark, sf_dir)
    first, last = ticks.agg(F.min("seq"), F.max("seq")).first()
    ends = ticks.groupBy(_part(F.col("seq"), first, last).alias("part")).agg(F.max("ts").alias("ts"))
    newest = [r.ts for r in ends.orderBy("part").collect()]
    times = [max(newest[: k + 1]) for k in range(len(newest))] + [max(newest) + timedelta(minutes=2)]
    folder = work_dir(spark, "stream-clock")
    writer = ExactBarWriter(f"{folder}/out", clock=lambda batch: times[batch])
    last_batch = _run_batches(_tick_stream(spark, sf_dir, idle=True), folder, writer)
    writer.compact(spark, last_batch - 1)
    return read_exact_bars(spark, f"{folder}/out")


def stream_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row of counters per micro-batch of the exact writer."""
    folder = work_dir(spark, "stream-counters")
    writer = CountingWriter(ExactBarWriter(f"{folder}/out"), f"{folder}/counters", now=lambda batch: COUNTED)
    _run_batches(_tick_stream(spark, sf_dir), folder, writer)
    return read_counters(spark, f"{folder}/counters")


def stateful(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minute bars closed by a later tick; the newest bar of a symbol stays open."""
    found = _run_to_table(stream_bars_stateful(_tick_stream(spark, sf_dir)), "stream-stateful")
    return found.where("bar_start is not null").drop("late_ticks")


def stateful_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _run_to_table(stream_bars_stateful(_tick_stream(spark, sf_dir)), "stream-late")
    return found.groupBy("symbol").agg(F.sum("late_ticks").alias("late_ticks"))


def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest 60 bars of each symbol, kept by the stream."""
    folder = work_dir(spark, "stream-retention")

    build, keep = ExactBarWriter(f"{folder}/out"), retention_writer(f"{folder}/log", (60,))

    def write(ticks: DataFrame, batch_id: int) -> None:
        build(ticks, batch_id)
        keep(batch_bars(spark, f"{folder}/out", batch_id), batch_id)

    last = _run_batches(_tick_stream(spark, sf_dir), folder, write)
    # the bars still open at the end are flushed as one more batch
    keep(batch_bars(spark, f"{folder}/out", last, still_open=True), last + 1)
    return spark.read.parquet(f"{folder}/log/newest_60/batch={last + 1}")


def compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six-hour bars merged into the hourly store as the watermark passes them."""
    folder = work_dir(spark, "stream-compaction")
    built = stream_bars(_tick_stream(spark, sf_dir), "6 hours")
    _run_batches(built, folder, compaction_writer(f"{folder}/store"))
    store = read_bar_store(spark, f"{folder}/store")
    return store.select("symbol", "bar_start", "bar_end", "close_fixed", "volume")


QUERIES = {
    "stream_bars": watermarked,
    "stream_bars_exact": exact,
    "stream_clock_close": clock_close,
    "stream_counters": stream_counters,
    "stream_bars_stateful": stateful,
    "stream_late_ticks": stateful_late,
    "stream_retention": retention,
    "stream_compaction": compaction,
}

_COLUMNS = "symbol, bar_start, bar_end, open_fixed, high_fixed, low_fixed, close_fixed, volume, source"
_TICKS = b.ticks_sql(one=True)

SQL = {
    "stream_bars": _with(
        _TICKS + b.flagged_sql("hour") + b.bars_sql("hour", where="true"),
        select=f"SELECT {_COLUMNS} FROM bars WHERE bar_end <= (SELECT max(ts) FROM ticks)",
    ),
    "stream_bars_exact": _with(
        _TICKS + b.flagged_sql() + b.bars_sql(),
        select=f""", lates AS (
  SELECT symbol, bar_start, count(*) AS late_ticks FROM flagged WHERE is_late GROUP BY ALL)
SELECT {_COLUMNS}, coalesce(late_ticks, 0) AS late_ticks
FROM bars LEFT JOIN lates USING (symbol, bar_start)""",
    ),
    "stream_clock_close": _with(
        _TICKS + f""",
floored AS (
  SELECT *, CAST(date_trunc('minute', ts) AS TIMESTAMP) AS bar_start,
         floor((seq - min(seq) OVER ()) * {PARTS} / (max(seq) OVER () - min(seq) OVER () + 1)) AS part FROM ticks),
times AS (SELECT part, max(max(ts)) OVER (ORDER BY part) AS now FROM floored GROUP BY part),
newest AS (
  SELECT symbol, t.part, now, max(bar_start) AS bar_start FROM floored f JOIN times t ON f.part <= t.part GROUP BY ALL),
closed AS (SELECT symbol, part + 1 AS part, bar_start FROM newest WHERE bar_start + INTERVAL 1 MINUTE <= now),
flagged AS (
  SELECT f.*, coalesce(f.bar_start < max(f.bar_start) OVER (
    PARTITION BY f.symbol ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false)
    OR c.symbol IS NOT NULL AS is_late
  FROM floored f LEFT JOIN closed c ON c.symbol = f.symbol AND c.part = f.part AND c.bar_start = f.bar_start)"""
        + b.bars_sql(),
        select=f""", lates AS (
  SELECT symbol, bar_start, count(*) AS late_ticks FROM flagged WHERE is_late GROUP BY ALL)
SELECT {_COLUMNS}, coalesce(late_ticks, 0) AS late_ticks
FROM bars LEFT JOIN lates USING (symbol, bar_start)""",
    ),
    "stream_bars_stateful": _with(
        _TICKS + b.flagged_sql() + b.bars_sql(),
        select=f"""SELECT {_COLUMNS} FROM bars
QUALIFY bar_start < max(bar_start) OVER (PARTITION BY symbol)""",
    ),
    "stream_late_ticks": _with(
        _TICKS + b.flagged_sql(),
        select="SELECT symbol, count(*) FILTER (WHERE is_late) AS late_ticks FROM flagged GROUP BY symbol",
    ),
    "stream_counters": _with(
        _TICKS + b.flagged_sql(),
        select=f""", parted AS (
  SELECT *, CAST(floor((seq - min(seq) OVER ()) * {PARTS} / (max(seq) OVER () - min(seq) OVER () + 1)) AS BIGINT) AS batch
  FROM flagged),
received AS (
  SELECT batch, count(*) AS ticks_received, count(*) FILTER (WHERE is_late) AS late_ticks_dropped FROM parted GROUP BY batch),
starts AS (SELECT source, symbol, bar_start, min(batch) AS batch FROM parted WHERE NOT is_late GROUP BY ALL),
closed AS (
  SELECT bar_start + INTERVAL 1 MINUTE AS bar_end, lead(batch) OVER (PARTITION BY source, symbol ORDER BY bar_start) AS batch FROM starts),
written AS (SELECT batch, count(*) AS bars_written, max(bar_end) AS last_bar_end FROM closed WHERE batch IS NOT NULL GROUP BY batch)
SELECT batch, ticks_received, late_ticks_dropped, coalesce(bars_written, 0) AS bars_written, last_bar_end,
  CASE WHEN last_bar_end IS NOT NULL THEN
    greatest(0.0, CAST((epoch_us(TIMESTAMP '2024-01-31 01:00:00') - epoch_us(last_bar_end)) AS DOUBLE) / 1000) END AS ingest_lag_ms
FROM received LEFT JOIN written USING (batch)""",
    ),
    "stream_retention": _with(
        _TICKS + b.flagged_sql() + b.bars_sql(),
        select=f"""SELECT {_COLUMNS}, seq FROM bars
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY bar_end DESC, seq DESC) <= 60""",
    ),
    "stream_compaction": _with(
        _TICKS,
        select=""", built AS (
  SELECT symbol, CAST(time_bucket(INTERVAL 6 HOUR, ts) AS TIMESTAMP) AS bar_start,
         CAST(round(arg_max(price, seq) * 100) AS BIGINT) * 10000000 AS close_fixed,
         CAST(round_even(sum(size), 0) AS BIGINT) AS volume
  FROM ticks GROUP BY 1, 2)
SELECT symbol, bar_start, bar_start + INTERVAL 6 HOUR AS bar_end, close_fixed, volume FROM built
WHERE bar_start + INTERVAL 6 HOUR <= (SELECT max(ts) FROM ticks)""",
    ),
}
