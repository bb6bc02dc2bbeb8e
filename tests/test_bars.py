from datetime import datetime, timedelta

import time

import numpy as np
import pytest

from tidemark.functions import from_fixed, to_fixed
from tidemark.operators import ordinals, quality
from tidemark.operators.bars import (
    backfill_bars,
    bar_gaps,
    bars,
    close_panel,
    flag_late,
    merge_backfill,
    recent_bars,
    retain_newest,
    retain_per_symbol,
)
from tidemark.operators.quality import (
    feed_scores,
    feed_winner,
    ingest_counters,
    latency_alerts,
    nearest_rank,
    rolling_rank,
    store_freshness,
    write_counters,
)

T0 = datetime(2026, 4, 5, 10, 0)
TICK = "seq long, symbol string, price double, size double, ts timestamp, source string"
BAR = (
    "symbol string, bar_start timestamp, bar_end timestamp, open_fixed long, high_fixed long,"
    " low_fixed long, close_fixed long, volume long, source string, seq long"
)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def minute_bars(spark, minutes, symbol="A", source="type2"):
    rows = [
        (symbol, at(60 * m), at(60 * m + 60), 100 + m, 101 + m, 99 + m, 100 + m, 10 + m, source, m)
        for m in minutes
    ]
    return spark.createDataFrame(rows, BAR)


@pytest.fixture
def ticks(spark):
    rows = [
        (1, "AAPL", 100.0, 10.0, at(1), "f"),
        (2, "AAPL", 101.0, 5.0, at(30), "f"),
        (3, "AAPL", 99.0, 2.0, at(60), "f"),
        (4, "AAPL", 98.0, 2.0, at(59), "f"),
        (5, "AAPL", 97.5, 0.5, at(61), "f"),
    ]
    return spark.createDataFrame(rows, TICK)


def test_rollover_and_late_tick(ticks):
    first, second = sorted(bars(ticks, floats=True).collect(), key=lambda r: r.bar_start)
    assert (first.open, first.high, first.low, first.close, first.volume) == (100, 101, 100, 101, 15)
    assert first.bar_start == T0 and first.bar_end == at(60)
    # 2.5 rounds half to even
    assert (second.open, second.low, second.volume) == (99, 97.5, 2)
    assert second.close_fixed == 97_500_000_000
    kept = sorted(bars(ticks, drop_late=False, floats=True).collect(), key=lambda r: r.bar_start)
    assert kept[0].close == 98


@pytest.mark.parametrize("cell_rows", [1, 7, 1 << 20])
def test_lateness_does_not_depend_on_the_cells(spark, cell_rows):
    rng = np.random.default_rng(2)
    seconds = np.arange(300) * 13 + rng.integers(-120, 120, 300)
    hot = rng.random(300) < 0.8
    rows = [
        (i * 2, "hot" if hot[i] else "cold", 1.0, 1.0, at(int(seconds[i])), "f") for i in range(300)
    ]
    newest, late = {}, {}
    for seq, symbol, _, _, ts, _ in rows:
        minute = ts.replace(second=0)
        late[seq] = minute < newest.get(symbol, minute)
        newest[symbol] = max(minute, newest.get(symbol, minute))
    found = flag_late(spark.createDataFrame(rows, TICK), cell_rows=cell_rows).collect()
    assert {r.seq: r.is_late for r in found} == late and any(late.values())


def test_sources_are_separate_feeds(spark):
    rows = [(1, "A", 1.0, 1.0, at(60), "x"), (2, "A", 2.0, 1.0, at(0), "y")]
    assert bars(spark.createDataFrame(rows, TICK)).count() == 2


def test_negative_volume_is_zero(spark):
    rows = [(1, "A", 1.0, -3.0, at(0), "x")]
    assert bars(spark.createDataFrame(rows, TICK)).first().volume == 0


def test_fixed_point(spark):
    cases = {150.25: 150_250_000_000, 0.1 + 0.2: 300_000_000, 1e-10: 0, 1.25e-9: 1, 0.4999999999e-9: 0,
             1.5e-9: 2, -1.5e-9: -2}
    df = spark.createDataFrame([(v,) for v in cases], "v double")
    found = df.select("v", to_fixed(df.v).alias("f"), from_fixed(to_fixed(df.v)).alias("b")).collect()
    assert {r.v: r.f for r in found} == cases
    assert found[0].b == 150.25
    with pytest.raises(ValueError):
        to_fixed(df.v, scale=300)


def test_close_panel_keeps_the_newest_and_the_last_written(spark):
    log = minute_bars(spark, range(5)).unionByName(
        minute_bars(spark, [4]).selectExpr(
            "symbol", "bar_start", "bar_end", "open_fixed", "high_fixed", "low_fixed",
            "7L as close_fixed", "volume", "source", "99L as seq",
        )
    ).unionByName(minute_bars(spark, [8], symbol="Z"))
    panel = close_panel(log, ["B", "A"], 2, scale=1)
    rows = panel.rows.orderBy("ord").collect()
    assert [r["values"] for r in rows] == [[None, 103.0], [None, 7.0]]
    assert close_panel(log, ["A"]).rows.count() == 5
    assert close_panel(log, ["nobody"], 3).rows.count() == 0


def test_retention(spark):
    log = minute_bars(spark, range(10)).unionByName(minute_bars(spark, range(3), symbol="B"))
    kept = retain_per_symbol(log, 4)
    assert sorted(r.seq for r in kept.collect()) == [0, 1, 2, 6, 7, 8, 9]
    assert sorted(r.seq for r in retain_newest(log, 2).collect()) == [8, 9]
    assert "WindowGroupLimit" in kept._jdf.queryExecution().executedPlan().toString()


def test_recent_bars(spark):
    log = minute_bars(spark, range(0, 180, 10))
    found = recent_bars(log, 1, at(180 * 60), ["A"], scale=1)
    assert found.count() == 6 and found.first().close == found.first().close_fixed
    with pytest.raises(ValueError):
        recent_bars(log, 0, T0, ["A"])


def test_gaps(spark):
    log = minute_bars(spark, [0, 1, 5, 6, 3000]).unionByName(minute_bars(spark, [2], symbol="B"))
    found = {(r.gap_start, r.missing_bars) for r in bar_gaps(log).collect()}
    assert found == {(at(120), 3), (at(420), 2993)}


def test_backfill_window(spark):
    store = minute_bars(spark, range(3)).drop("seq").withColumnRenamed("bar_end", "e")
    store = store.selectExpr("*", "date_format(e, \"yyyy-MM-dd'T'HH:mm:ssXXX\") as bar_end").drop("e")
    found = backfill_bars(store, ["A"], at(60), at(210), scale=1).orderBy("bar_end").collect()
    assert [r.bar_end for r in found] == [at(120), at(180)]
    assert {r.source for r in found} == {"type2:backfill"}
    assert [r.volume for r in found] == [11, 12]


def test_backfill_of_incomplete_stores(spark):
    rows = [("A", at(60), None, 1.5, None, "7.9", ""), ("A", at(120), 5, 9.9, None, "x", None),
            ("A", None, 5, 9.9, None, "1", "s"), ("B", at(60), 1, 1.0, 1, "1", "s")]
    store = spark.createDataFrame(
        rows, "symbol string, bar_end timestamp, open_fixed long, open double, close_fixed long,"
        " volume string, source string"
    )
    first, second = backfill_bars(store, ["A"], T0, at(500)).orderBy("bar_end").collect()
    assert (first.open_fixed, first.close_fixed, first.volume) == (1_500_000_000, 0, 7)
    assert first.bar_start == first.bar_end and first.source == "type2:backfill"
    assert (second.open_fixed, second.volume, second.source) == (5, 0, "type2:backfill")


def test_backfill_after_each_symbols_last_bar(spark):
    store = minute_bars(spark, range(6)).unionByName(minute_bars(spark, range(6), symbol="B"))
    after = spark.createDataFrame([("A", at(240)), ("B", at(60))], "symbol string, after timestamp")
    found = backfill_bars(store, ["A", "B"], after, at(360)).groupBy("symbol").count().collect()
    assert {r.symbol: r["count"] for r in found} == {"A": 2, "B": 5}


def test_live_bars_win_over_backfill(spark):
    live = minute_bars(spark, range(3), source="live").drop("seq")
    stored = backfill_bars(minute_bars(spark, range(5)), ["A"], T0, at(600))
    found = merge_backfill(live, stored).orderBy("bar_end").collect()
    assert [r.source for r in found] == ["live"] * 3 + ["type2:backfill"] * 2


def test_freshness(spark):
    log = minute_bars(spark, range(3))
    assert store_freshness(log, at(300)).first().ok
    late = store_freshness(log, at(301), reason="timeout").first()
    assert not late.ok and late.gap_seconds == 121 and late.note == "gap_seconds=121.0 reason=timeout"
    assert store_freshness(log).first().ok
    assert not store_freshness(log.limit(0), at(0)).first().ok
    text = spark.createDataFrame([("soon",)], "bar_end string")
    assert not store_freshness(text, at(0)).first().ok


def test_feed_scores_and_winner(spark, ticks):
    other = spark.createDataFrame(
        [(11, "AAPL", 1.0, 1.0, at(0), "g"), (12, "MSFT", 1.0, 1.0, at(0), "g")], TICK
    )
    errors = spark.createDataFrame([("f", "provider_error", 1)], "source string, kind string, seq long")
    scores = feed_scores(ticks.unionByName(other), errors, ["AAPL", "MSFT"], feeds=["f", "g", "h"])
    found = {r.source: r for r in scores.collect()}
    f = found["f"]
    assert (f.ticks_received, f.bars_emitted, f.late_ticks_dropped, f.errors) == (5, 2, 1, 1)
    assert (f.status, f.unexpected_errors, f.symbol_coverage_ratio) == ("provider_error", 1, 0.5)
    assert found["g"].symbol_coverage_ratio == 1.0 and found["g"].status == "ok"
    assert found["h"].status == "skipped_missing_key"
    assert feed_winner(scores).first().source == "g"
    assert feed_winner(scores.where("source = 'h'")).count() == 0


def test_counters_and_alerts(spark, ticks):
    row = ingest_counters(ticks, bars(ticks), at(180)).first()
    assert (row.ticks_received, row.late_ticks_dropped, row.bars_written) == (5, 1, 2)
    assert row.ingest_lag_ms == 60_000
    writes = spark.createDataFrame([("A", T0, 100.0), ("A", T0, 100.5)], "symbol string, bar_end timestamp, write_ms double")
    assert [r.write_ms for r in latency_alerts(writes).collect()] == [100.5]
    with pytest.raises(ValueError):
        latency_alerts(writes, 0)


def test_write_counters(spark):
    times = [5.0, 9.0, 1.0, 2.0, 3.0]
    writes = spark.createDataFrame(list(enumerate(times)), "seq long, write_ms double")
    events = spark.createDataFrame([("frozen",), ("connected",), (None,)], "state string")
    row = write_counters(writes, events, size=3).first()
    assert tuple(row) == (3.0, 9.0, 3.0, 1)
    assert tuple(write_counters(writes.limit(0), events.limit(0)).first()) == (None, None, None, 0)


def p95(values):
    ordered = sorted(values)
    return ordered[int(round((len(ordered) - 1) * 0.95))]


@pytest.mark.parametrize("n", [1, 11, 31, 400])
def test_nearest_rank(spark, n):
    rng = np.random.default_rng(n)
    values = [float(v) for v in np.round(rng.exponential(20, n), 2)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    row = nearest_rank(df, "v").first()
    assert (row.n, row.v) == (n, p95(values))


def test_rolling_rank(spark, monkeypatch):
    rng = np.random.default_rng(1)
    values = [float(v) for v in np.round(rng.exponential(20, 300), 2)]
    df = spark.createDataFrame([(i, "k", v) for i, v in enumerate(values)], "seq long, k string, v double")
    found = rolling_rank(df, "v", ["k"], "seq", size=25).orderBy("seq").collect()
    assert [r.rolling for r in found] == [p95(values[max(0, i - 24) : i + 1]) for i in range(300)]


def test_nearest_rank_of_any_scale(spark):
    """Values in [0, 1] and over twelve decades, with and without keys, at most a few rows put in order."""
    rng = np.random.default_rng(5)
    unit = rng.random(3000)
    wide = 10 ** rng.uniform(-6, 6, 3000) * rng.choice([-1, 1, 1], 3000)
    same = np.repeat([0.25, 0.5], 1500)
    rows = [(k, float(v)) for k, own in (("unit", unit), ("wide", wide), ("same", same)) for v in own]
    df = spark.createDataFrame([*rows, ("unit", None)], "k string, v double").repartition(5)
    found = {r.k: (r.n, r.v) for r in nearest_rank(df, "v", ["k"], cell_rows=20).collect()}
    assert found == {k: (3000, p95([v for own, v in rows if own == k])) for k in ("unit", "wide", "same")}
    whole = nearest_rank(df, "v", cell_rows=20).first()
    assert (whole.n, whole.v) == (9000, p95([v for _, v in rows]))
    counts = df.where("v is not null").groupBy("k", df.v.alias("_value")).count().withColumnRenamed("count", "_n")
    near = quality._near_rank(counts, ["k"], "cast(bround((n - 1) * 0.95D) as bigint)", 20)
    assert near.groupBy("k").count().agg({"count": "max"}).first()[0] <= 20


def test_rolling_rank_with_missing_values_and_blocks(spark):
    rng = np.random.default_rng(7)
    values = [None if rng.random() < 0.2 else float(rng.integers(0, 50)) for _ in range(500)]
    rows = [(i // 3, i % 3, "k", v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "seq long, pos int, k string, v double").repartition(4)
    found = rolling_rank(df, "v", ["k"], ["seq", "pos"], size=7).orderBy("seq", "pos").collect()
    for i, r in enumerate(found):
        frame = [v for v in values[max(0, i - 6) : i + 1] if v is not None]
        assert r.rolling == (p95(frame) if frame else None)


def test_order_statistics_cost_little_more_with_a_longer_window(spark):
    df = spark.range(60_000).selectExpr("id as seq", "'k' as k", "cast(hash(id) as double) as v")
    seconds = []
    for size in (600, 600, 6000):
        start = time.perf_counter()
        rolling_rank(df, "v", ["k"], "seq", size=size).write.format("noop").mode("overwrite").save()
        seconds.append(time.perf_counter() - start)
    assert seconds[2] < 3 * seconds[1] + 2


def test_epoch_arrival_of_one_hot_symbol_is_cut_evenly(spark):
    """Arrival numbers in microseconds, in bursts: cells are as large as the data makes them."""
    rng = np.random.default_rng(11)
    burst = np.repeat(np.arange(40) * 3_600_000_000, 100) + np.tile(np.arange(100), 40)
    seq = 1_775_383_201_250_000 + burst
    seconds = np.arange(4000) * 3 + rng.integers(-90, 90, 4000) + 100
    rows = [(int(seq[i]), "hot" if rng.random() < 0.95 else "cold", 1.0, 1.0, at(int(seconds[i])), "f") for i in range(4000)]
    ticks = spark.createDataFrame(rows, TICK).repartition(6)
    plain = {r.seq: r.is_late for r in flag_late(ticks).collect()}
    cut = {r.seq: r.is_late for r in flag_late(ticks, cell_rows=250).collect()}
    assert cut == plain and any(plain.values())
    cells = ordinals.in_cells(ticks, ["source", "symbol"], ["seq"], 250)
    assert cells.groupBy("_cell").count().agg({"count": "max"}).first()[0] <= 750
    numbered = ordinals.number_rows(ticks, ["symbol"], "seq", cell_rows=250).orderBy("symbol", "seq").collect()
    assert [r.ord for r in numbered if r.symbol == "hot"] == list(range(sum(r[1] == "hot" for r in rows)))


def test_bars_by_message_and_position(spark):
    rows = [(1, 0, "A", 5.0, 1.0, at(1), "f"), (1, 1, "A", 7.0, 1.0, at(2), "f"), (0, 9, "A", 6.0, 1.0, at(3), "f")]
    ticks = spark.createDataFrame(rows, "seq long, pos int, symbol string, price double, size double, ts timestamp, source string")
    bar = bars(ticks, floats=True, order=("seq", "pos")).first()
    assert (bar.open, bar.close, bar.seq, bar.pos) == (6.0, 7.0, 1, 1)


def test_equal_feeds_win_in_the_listed_order(spark):
    ticks = spark.createDataFrame([(i, "AAPL", 1.0, 1.0, at(i), s) for i in range(3) for s in ("a", "z")], TICK)
    none = spark.createDataFrame([], "source string, kind string, seq long")
    scores = feed_scores(ticks, none, ["AAPL"], feeds=["z", "a"], seconds=30)
    assert feed_winner(scores, ["z", "a"]).first().source == "z"
    assert feed_winner(scores).first().source == "a"
    assert {(r.seconds_requested, r.seconds_observed) for r in scores.collect()} == {(30.0, 2.0)}
