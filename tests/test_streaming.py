import time
from datetime import timedelta

import numpy as np
import pytest
from test_bars import TICK, at

from tidemark.operators.bars import bars, late_ticks
from tidemark.sinks.reports import event_rows
from tidemark.sources import read_bar_store
from tidemark.streaming import (
    CountingWriter,
    ExactBarWriter,
    compaction_writer,
    event_writer,
    read_counters,
    read_exact_bars,
    read_late_ticks,
    retention_writer,
    stream_bars,
    stream_bars_stateful,
)

KEYS = ["symbol", "bar_start"]
SHOWN = ["symbol", "bar_start", "bar_end", "open_fixed", "high_fixed", "low_fixed", "close_fixed", "volume", "source"]


@pytest.fixture(scope="module")
def ticks(spark):
    """Out of order ticks; most of them belong to one symbol."""
    rng = np.random.default_rng(9)
    seconds = np.arange(400) * 11 + rng.integers(-90, 90, 400) + 120
    rows = [
        (i, "hot" if rng.random() < 0.8 else "cold", float(round(50 + rng.normal(), 2)),
         float(rng.integers(1, 9)), at(int(seconds[i])), "feed")
        for i in range(400)
    ]
    return spark.createDataFrame(rows, TICK)


@pytest.fixture
def source(spark, ticks, tmp_path):
    """The ticks as a stream of four micro-batches, in arrival order."""
    path = str(tmp_path / "in")
    for i in range(4):
        part = ticks.where(f"seq >= {i * 100} and seq < {i * 100 + 100}")
        part.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(TICK).option("maxFilesPerTrigger", 1).parquet(path)


def run_batches(stream, folder, writer):
    query = (
        stream.writeStream.foreachBatch(writer)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return max(p["batchId"] for p in query.recentProgress)


def run_table(stream, folder):
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/out")


def rows(df):
    return sorted(tuple(r[c] for c in SHOWN) for r in df.select(*SHOWN).collect())


def closed(expected):
    return expected.selectExpr("*", "max(bar_start) over (partition by symbol) as n").where("bar_start < n")


def test_exact_bars_equal_the_batch(spark, ticks, source, tmp_path):
    writer = ExactBarWriter(str(tmp_path / "exact"))
    last = run_batches(source, tmp_path, writer)
    expected = bars(ticks)
    assert last == 3
    assert rows(read_exact_bars(spark, writer.path)) == rows(closed(expected))
    flushed = read_exact_bars(spark, writer.path, flush_batch=last)
    assert rows(flushed) == rows(expected)
    late = {r.symbol: r.late_ticks for r in late_ticks(ticks).collect()}
    dropped = read_late_ticks(spark, writer.path, flush_batch=last)
    found = {r.symbol: r.late_ticks for r in dropped.collect()}
    assert found == late and sum(late.values()) > 0


def test_exact_bars_survive_a_repeated_batch(spark, ticks, tmp_path):
    writer = ExactBarWriter(str(tmp_path / "exact"))
    parts = [ticks.where(f"seq >= {i * 200} and seq < {i * 200 + 200}") for i in range(2)]
    for batch in (0, 1, 1):
        writer(parts[batch], batch)
    assert rows(read_exact_bars(spark, writer.path, flush_batch=1)) == rows(bars(ticks))


def test_stateful_bars_equal_the_batch(spark, ticks, source, tmp_path):
    found = run_table(stream_bars_stateful(source), tmp_path)
    assert rows(found.where("bar_start is not null")) == rows(closed(bars(ticks)))
    late = {r.symbol: r.late_ticks for r in late_ticks(ticks).collect()}
    counted = {r.symbol: r.n for r in found.groupBy("symbol").sum("late_ticks").toDF("symbol", "n").collect()}
    assert counted == late


def test_clock_closes_a_bar_once(spark, ticks, source, tmp_path):
    """All bars lie in the past, so the clock closes the newest ones too."""
    stream = stream_bars_stateful(source, wall_clock=True)
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{tmp_path}/out")
        .option("checkpointLocation", f"{tmp_path}/checkpoint")
        .trigger(processingTime="1 second")
        .start()
    )
    try:
        deadline = time.monotonic() + 60
        newest, wanted = None, None
        while time.monotonic() < deadline and query.isActive:
            time.sleep(2)
            if not list(tmp_path.glob("out/*.parquet")):
                continue
            found = spark.read.schema(stream.schema).parquet(f"{tmp_path}/out")
            done = found.where("bar_start is not null")
            newest = {r[0]: r[1] for r in done.groupBy("symbol").agg({"bar_start": "max"}).collect()}
            wanted = {r[0]: r[1] for r in bars(ticks).groupBy("symbol").agg({"bar_start": "max"}).collect()}
            if newest == wanted:
                break
        assert newest == wanted
        assert done.count() == done.select(*KEYS).distinct().count()
    finally:
        query.stop()


def test_watermarked_bars(spark, ticks, source, tmp_path):
    found = run_table(stream_bars(source, watermark="10 minutes"), tmp_path)
    newest = max(r.ts for r in ticks.collect())
    expected = bars(ticks, drop_late=False)
    done = [r for r in rows(expected) if r[2] <= newest - timedelta(minutes=10)]
    assert rows(found) == done


def test_retention_log(spark, tmp_path):
    from test_bars import minute_bars

    write = retention_writer(str(tmp_path / "log"), (3, 5))
    for batch, minutes in ((0, range(4)), (1, range(3, 9)), (1, range(3, 9))):
        write(minute_bars(spark, minutes), batch)
    for size in (3, 5):
        kept = spark.read.parquet(f"{tmp_path}/log/newest_{size}/batch=1")
        assert sorted(r.seq for r in kept.collect()) == list(range(9 - size, 9))
    with pytest.raises(ValueError):
        retention_writer("x", (0,))


def test_compaction_and_events(spark, tmp_path):
    from test_bars import minute_bars

    compact = compaction_writer(str(tmp_path / "store"))
    compact(minute_bars(spark, range(50)), 0)
    compact(minute_bars(spark, range(50)), 0)
    compact(minute_bars(spark, range(40, 70)), 1)
    assert read_bar_store(spark, str(tmp_path / "store")).count() == 70
    log = event_writer(str(tmp_path / "events"))
    log(spark.createDataFrame([("gap",)], "event string"), 0)
    log(spark.createDataFrame([("gap",)], "event string"), 0)
    assert spark.read.json(str(tmp_path / "events")).count() == 1
    assert event_rows(spark.createDataFrame([("gap",)], "event string"), at(0)).first().logged_at == at(0)


def test_clock_closes_bars_of_the_exact_writer(spark, tmp_path):
    """Three batches; the second has no ticks. A late tick does not reopen what the clock closed."""
    times = [at(150), at(400), at(420)]
    writer = ExactBarWriter(str(tmp_path / "clock"), clock=lambda batch: times[batch])
    first = [(1, "A", 10.0, 1.0, at(5), "feed"), (2, "B", 20.0, 1.0, at(130), "feed"), (3, "A", 11.0, 2.0, at(30), "feed")]
    beat = [(4, None, None, None, at(300), "feed")]
    last = [
        (5, "B", 99.0, 1.0, at(170), "feed"),  # its bar was closed by the clock in the second batch
        (6, "B", 21.0, 1.0, at(390), "feed"),
        (7, "A", 98.0, 1.0, at(40), "feed"),  # closed in the first batch
        (8, "A", 12.0, 4.0, at(70), "feed"),  # a bar that never was, after the closed one
    ]
    writer(spark.createDataFrame(first, TICK), 0)
    done = read_exact_bars(spark, writer.path).collect()
    assert [(r.symbol, r.bar_start, r.volume) for r in done] == [("A", at(0), 3)]
    writer(spark.createDataFrame(beat, TICK), 1)
    assert {(r.symbol, r.bar_start) for r in read_exact_bars(spark, writer.path).collect()} == {("A", at(0)), ("B", at(120))}
    for _ in range(2):  # a repeated batch changes nothing
        writer(spark.createDataFrame(last, TICK), 2)
    expected = [("A", at(0), 3, 1), ("A", at(60), 4, 0), ("B", at(120), 1, 1), ("B", at(360), 1, 0)]

    def found(flush=None):
        bars = read_exact_bars(spark, writer.path, flush_batch=flush).collect()
        return sorted((r.symbol, r.bar_start, r.volume, r.late_ticks) for r in bars)

    assert found() == expected
    late = {r.symbol: r.late_ticks for r in read_late_ticks(spark, writer.path).collect()}
    assert late == {"A": 1, "B": 1}
    before = found(flush=2)
    writer.compact(spark, 1)
    writer.compact(spark, 2)
    assert found() == expected and found(flush=2) == before
    assert [p.name for p in (tmp_path / "clock" / "log").iterdir()] == ["batch=2"]
    assert [p.name for p in (tmp_path / "clock" / "store").iterdir()] == ["through=2"]
    writer = ExactBarWriter(writer.path, clock=lambda batch: at(900))
    writer(spark.createDataFrame([], TICK), 3)
    assert found() == expected


def test_counters(spark, source, ticks, tmp_path):
    """Counters per micro-batch add up to the batch ones; a micro-batch run again counts once."""
    writer = CountingWriter(ExactBarWriter(str(tmp_path / "bars")), str(tmp_path / "counters"), now=lambda batch: at(0))
    run_batches(source, tmp_path, writer)
    writer(ticks.where("seq >= 300"), 3)
    rows = {r.batch: r for r in read_counters(spark, writer.path).collect()}
    assert sorted(rows) == [0, 1, 2, 3] and all(r.ticks_received == 100 for r in rows.values())
    late = sum(r.late_ticks for r in late_ticks(ticks).collect())
    assert late > 0 and sum(r.late_ticks_dropped for r in rows.values()) == late
    finished = read_exact_bars(spark, writer.bars.path)
    assert sum(r.bars_written for r in rows.values()) == finished.count()
    newest = finished.orderBy("bar_end", ascending=False).first().bar_end
    assert max(r.last_bar_end for r in rows.values()) == newest
    assert all(r.ingest_lag_ms == 0.0 for r in rows.values())
