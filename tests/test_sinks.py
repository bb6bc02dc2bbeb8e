import json
from datetime import datetime
from pathlib import Path

import numpy as np
import pytest
from panels import long_frame, panel_of, prices, to_wide
from test_bars import at, minute_bars

from tidemark.operators.quality import store_freshness, stored_freshness
from tidemark.plans import build_panel, live_snapshot
from tidemark.session import work_dir
from tidemark.sinks import (
    append_events,
    build_metadata,
    feed_report,
    outlier_report,
    persist_bars,
    read_current,
    write_csv,
    write_json,
    write_run,
)
from tidemark.sources import read_bar_store, read_price_panel, read_run_history
from tidemark.sources.files import read_newest_hour, store_hours


def test_persist_merges_and_dedupes(spark, tmp_path):
    path = str(tmp_path / "store")
    first = persist_bars(minute_bars(spark, range(0, 90)), path)
    assert (first.scanned, first.written, first.deduped) == (90, 90, 0)
    again = minute_bars(spark, range(60, 120)).unionByName(minute_bars(spark, range(60, 120)))
    second = persist_bars(again.withColumn("volume", again.volume * 0 + 1), path)
    assert (second.scanned, second.written, second.deduped) == (120, 60, 60)
    store = read_bar_store(spark, path)
    assert store.count() == 120
    assert store.where("volume = 1").count() == 60
    assert {(str(r.date), r.hour) for r in store.select("date", "hour").distinct().collect()} == {
        ("2026-04-05", 10), ("2026-04-05", 11), ("2026-04-05", 12),
    }
    assert read_bar_store(spark, path, start=at(3600), end=at(7200)).count() == 61
    assert store_freshness(store, at(7200)).first().ok
    assert persist_bars(minute_bars(spark, []), path).scanned == 0


def test_price_files(spark, tmp_path):
    wide = prices(10, ["A", "B"])
    df = long_frame(spark, wide).withColumnRenamed("price", "adj_close")
    for fmt in ("parquet", "json"):
        df.write.format(fmt).save(str(tmp_path / fmt))
    df.write.option("header", True).csv(str(tmp_path / "csv"))
    schema = "symbol string, ts timestamp, adj_close double"
    start, end = wide.index[2].to_pydatetime(), wide.index[5].to_pydatetime()
    for fmt in ("parquet", "json", "csv"):
        found = read_price_panel(
            spark, str(tmp_path / fmt), ["A", "A"], start, end, fmt=fmt, schema=schema
        )
        assert [r.ts for r in found.orderBy("ts").collect()] == [t.to_pydatetime() for t in wide.index[2:5]]
    with pytest.raises(ValueError):
        read_price_panel(spark, str(tmp_path / "parquet"), ["A"], start, end, price_col="close")
    with pytest.raises(ValueError):
        read_price_panel(spark, str(tmp_path / "parquet"), ["Q"], start, end, strict=True)


def test_price_filters_reach_the_scan(spark, tmp_path):
    df = long_frame(spark, prices(10, ["A", "B"])).selectExpr("*", "price as adj_close", "1 as other")
    df.write.parquet(str(tmp_path / "p"))
    found = read_price_panel(spark, str(tmp_path / "p"), ["A"], datetime(2025, 1, 3), datetime(2025, 1, 9))
    plan = found._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    assert "GreaterThanOrEqual(ts" in pushed and "EqualTo(symbol,A)" in pushed
    assert "other" not in pushed


def test_runs(spark, tmp_path):
    path = str(tmp_path / "runs")
    write_run(spark.createDataFrame([(1,)], "v int"), path, datetime(2026, 4, 1))
    write_run(spark.createDataFrame([(2,)], "v int"), path, datetime(2026, 4, 3))
    write_run(spark.createDataFrame([(3,)], "v int"), path, datetime(2026, 4, 2))
    assert [r.v for r in read_run_history(spark, path).collect()] == [2, 3, 1]
    assert [r.v for r in read_current(spark, path).collect()] == [2]
    write_run(spark.createDataFrame([(4,)], "v int"), path, datetime(2026, 4, 3))
    assert [r.v for r in read_current(spark, path).collect()] == [4]


def test_csv(spark, tmp_path):
    wide = prices(5, ["A", "B"])
    write_csv(panel_of(spark, wide), str(tmp_path / "csv"))
    back = spark.read.option("header", True).csv(str(tmp_path / "csv")).orderBy("symbol").toPandas()
    assert list(back.columns) == ["symbol", *[d.strftime("%Y-%m-%d") for d in wide.index]]
    assert np.allclose(back.iloc[:, 1:].astype(float), wide.T)


def test_events(spark, tmp_path):
    path = str(tmp_path / "events")
    append_events(spark.createDataFrame([("gap", "A")], "event string, symbol string"), path, at(0))
    append_events(spark.createDataFrame([("alert", 120.5)], "event string, write_ms double"), path)
    lines = [json.loads(l) for f in Path(path).glob("*.json") for l in f.read_text().splitlines()]
    assert sorted(l["event"] for l in lines) == ["alert", "gap"]
    assert all("logged_at" in l for l in lines)


def test_build(spark, tmp_path):
    primary, reserve = [f"T{i}" for i in range(6)], ["R0", "R1"]
    wide = prices(90, primary + reserve)
    wide.iloc[:9, 2] = np.nan
    wide.iloc[40:42, 1] = np.nan
    for store in (True, False):
        built = build_panel(long_frame(spark, wide), primary, reserve, window=20, store=store)
        assert built["zscores"].symbols == ("T0", "T1", "R0", "T3", "T4", "T5")
        clean = wide[list(built["zscores"].symbols)].interpolate(limit=2, limit_direction="both")
        rets = np.log(clean / clean.shift(1)).dropna()
        expected = (rets - rets.rolling(20).mean()) / rets.rolling(20).std(ddof=0)
        found = to_wide(built["zscores"])
        assert np.allclose(found, expected, equal_nan=True)
    meta = build_metadata(
        built["zscores"], built["replacements"], built["outliers"],
        start=wide.index[0], end=wide.index[-1], built_at=at(0),
    ).first()
    assert meta.rows_t == 89 and meta.zombies_dropped == ["T2"]
    assert [(r.dropped, r.replaced_with) for r in meta.replacements] == [("T2", "R0")]
    low = (expected.dropna().corr().to_numpy()[np.triu_indices(6, 1)] < 0.3).sum()
    assert meta.correlation_outlier_count == low
    report = outlier_report(built["outliers"])
    write_json(report, str(tmp_path / "outliers"))
    assert report.first()["count"] == low
    assert spark.read.json(str(tmp_path / "outliers")).count() == 1


def test_snapshot(spark):
    symbols = ["A", "B", "C"]
    wide = prices(140, symbols)
    rows = [
        (s, at(60 * i), at(60 * i + 60), *[round(p * 1e9)] * 4, 1, "f", i)
        for i, row in enumerate(wide.itertuples(index=False))
        for s, p in zip(symbols, row)
    ]
    from test_bars import BAR

    log = spark.createDataFrame(rows, BAR)
    found = live_snapshot(log, symbols, lookback=100, z_window=20, pca_components=3)
    rets = np.log(wide / wide.shift(1)).iloc[-100:]
    assert np.allclose(to_wide(found["log_returns"]), rets, atol=1e-9)
    z = ((rets - rets.rolling(20).mean()) / rets.rolling(20).std(ddof=0)).dropna()
    assert np.allclose(to_wide(found["zscores"]), z, atol=1e-6)
    latest = {r.symbol: r.value for r in found["latest_zscore"].collect()}
    assert latest == pytest.approx(dict(z.iloc[-1]), abs=1e-6)
    assert found["latest_residual_zscore"].count() == 3
    assert found["explained_variance"].toPandas()["cumulative"].iloc[-1] == pytest.approx(1)
    with pytest.raises(ValueError):
        live_snapshot(log, symbols, lookback=10, z_window=20)


def test_feed_report(spark):
    scores = spark.createDataFrame([("f", 1), ("g", 2)], "source string, errors int")
    row = feed_report(scores, spark.createDataFrame([("f",)], "source string"), seconds=5, created_at=at(0)).first()
    assert row.winner == "f" and [s.source for s in row.scores] == ["f", "g"]


def test_work_dir_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    assert first != second
    if base:
        assert first.startswith(base)


def test_repeated_report_labels_raise(spark):
    from tidemark.operators.shape import transpose

    rows = [("A", datetime(2026, 4, 5, 10, m), float(m)) for m in range(3)]
    from tidemark.panel import densify

    panel = densify(spark.createDataFrame(rows, "symbol string, ts timestamp, price double"), ["A"])
    with pytest.raises(ValueError, match="finer pattern"):
        transpose(panel)
    assert transpose(panel, pattern="HHmm").columns == ["symbol", "1000", "1001", "1002"]


def test_report_raises_on_a_timestamp_that_is_not_stated(spark):
    from tidemark.operators.shape import transpose
    from tidemark.panel import densify

    rows = [("A", datetime(2026, 4, 5, 10, m), float(m)) for m in range(3)]
    panel = densify(spark.createDataFrame(rows, "symbol string, ts timestamp, price double"), ["A"])
    for stamps in (["1000", "1001"], []):
        with pytest.raises(ValueError, match="not among"):
            transpose(panel, stamps, "HHmm")
    found = transpose(panel, ["0959", "1000", "1001", "1002"], "HHmm").collect()
    assert [tuple(r) for r in found] == [("A", None, 0.0, 1.0, 2.0)]


def test_store_keeps_the_bars_of_each_source(spark, tmp_path):
    from tidemark.functions import to_fixed
    from tidemark.sinks.bar_store import persist_bars

    bar = (datetime(2026, 4, 5, 10, 0), datetime(2026, 4, 5, 10, 1), 1, 1, 1, 1, 5)
    rows = [("A", *bar, "one"), ("A", *bar, "two")]
    schema = "symbol string, bar_start timestamp, bar_end timestamp, open_fixed long, high_fixed long, low_fixed long, close_fixed long, volume long, source string"
    result = persist_bars(spark.createDataFrame(rows, schema), str(tmp_path / "store"))
    assert (result.written, result.deduped) == (2, 0)
    assert spark.read.parquet(str(tmp_path / "store")).count() == 2
    wide = spark.createDataFrame([(1e12,), (1e17,), (-2.345,)], "x double")
    assert [r[0] for r in wide.select(to_fixed(wide.x, 100)).collect()] == [10**14, None, -235]


def test_only_the_folders_asked_for_are_opened(spark, tmp_path):
    path = str(tmp_path / "store")
    persist_bars(minute_bars(spark, range(0, 200)), path)
    assert store_hours(spark, path) == [("2026-04-05", h) for h in (10, 11, 12, 13)]
    newest = read_newest_hour(spark, path)
    assert {Path(f).parent.name for f in newest.inputFiles()} == {"hour=13"}
    ranged = read_bar_store(spark, path, start=at(3600), end=at(7199))
    assert {Path(f).parent.name for f in ranged.inputFiles()} == {"hour=11"}
    fresh = stored_freshness(spark, path, at(201 * 60)).first()
    assert fresh.ok and fresh.latest == at(200 * 60)
    # files that nobody asks for may be broken, one that is read may not
    for hour in (10, 13):
        (tmp_path / "store" / "date=2026-04-05" / f"hour={hour}" / "broken.parquet").write_bytes(b"no parquet")
    assert read_bar_store(spark, path, start=at(3600), end=at(7199)).count() == 60
    with pytest.raises(Exception):
        stored_freshness(spark, path, at(0)).first()
    persist_bars(minute_bars(spark, range(100, 110)), path)
    with pytest.raises(Exception):
        persist_bars(minute_bars(spark, range(195, 199)), path)
    empty = stored_freshness(spark, str(tmp_path / "none"), at(0)).first()
    assert (empty.ok, empty.note) == (False, "store is empty")
