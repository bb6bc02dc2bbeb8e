import time

import numpy as np
import pytest

from tidemark.operators import correlation as corr
from tidemark.operators.blocks import running_moments
from tidemark.operators.cleaning import fill_gaps
from tidemark.operators.correlation import correlation
from tidemark.operators.factors import rolling_pca_rows
from tidemark.operators.returns import rolling_zscore
from tidemark.panel import Panel


def frames(x, window):
    mean, square = np.full(x.shape, np.nan), np.full(x.shape, np.nan)
    for t in range(window - 1, len(x)):
        own = x[t - window + 1 : t + 1]
        whole = np.isfinite(own).all(axis=0)
        mean[t, whole] = own[:, whole].mean(axis=0)
        square[t, whole] = ((own[:, whole] - mean[t, whole]) ** 2).sum(axis=0)
    return mean, square


@pytest.mark.parametrize("rows,window", [(1, 2), (5, 7), (7, 7), (8, 7), (50, 7), (63, 7), (40, 2), (100, 33)])
def test_running_moments_equal_each_frame(rows, window):
    rng = np.random.default_rng(rows)
    x = rng.normal(5, 1, (rows, 3))
    x[rng.random(x.shape) < 0.02] = np.nan
    for found, wanted in zip(running_moments(x, window), frames(x, window)):
        np.testing.assert_allclose(found, wanted, rtol=1e-10, atol=1e-12)


def test_outliers_leave_no_trace_and_constant_frames_have_no_deviation():
    x = np.random.default_rng(1).normal(0, 1e-4, (400, 1))
    x[50] = 1e9
    x[200:300] = 0.1
    mean, square = running_moments(x, 20)
    wanted = frames(x, 20)
    calm = np.r_[70:400]
    np.testing.assert_allclose(square[calm], wanted[1][calm], rtol=1e-9, atol=1e-15)
    assert (square[219:300] == 0).all() and (mean[219:300] == 0.1).all()


def made(spark, rows, width, missing=0.0):
    frame = spark.range(rows).selectExpr(
        "timestamp_seconds(id * 60) as ts", "id as ord", f"transform(sequence(1, {width}), i -> cast(randn(5) + i + id % 13 as double)) as values"
    )
    if missing:
        frame = frame.selectExpr("ts", "ord", f"transform(values, (v, i) -> if(abs(hash(ord, i)) % 1000 < {int(missing * 1000)}, null, v)) as values")
    return Panel(frame, tuple(f"S{i}" for i in range(width))).stored()


def seconds(rows):
    start = time.perf_counter()
    rows.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def test_rolling_zscore_costs_the_same_with_a_longer_window(spark):
    panel = made(spark, 150_000, 20)
    seconds(rolling_zscore(panel, window=60).rows)
    pca = seconds(rolling_pca_rows(panel, window=60))
    short = seconds(rolling_zscore(panel, window=60).rows)
    long = seconds(rolling_zscore(panel, window=500).rows)
    gaps = seconds(fill_gaps(made(spark, 150_000, 20, 0.02)).rows)
    print({"pca": pca, "z60": short, "z500": long, "gaps": gaps})
    assert short < pca + 1
    assert long < 2 * short + 2


def test_pairs_of_several_tiles(spark, monkeypatch):
    monkeypatch.setattr(corr, "TILE", 7)
    panel = made(spark, 300, 17, 0.05)
    panel = Panel(panel.rows.repartition(5), panel.symbols).stored()
    found = {(r.pos_a, r.pos_b): r.correlation for r in correlation(panel, deletion="pairwise").collect()}
    x = np.array([[np.nan if v is None else v for v in r.values] for r in panel.rows.select("values").collect()])
    assert len(found) == 17 * 16 // 2
    for (a, b), r in found.items():
        both = np.isfinite(x[:, a]) & np.isfinite(x[:, b])
        assert r == pytest.approx(np.corrcoef(x[both, a], x[both, b])[0, 1], abs=1e-9)


def test_two_thousand_symbols(spark):
    panel = made(spark, 400, 2000)
    rows = correlation(panel)
    assert rows.count() == 2000 * 1999 // 2
    moved = corr.pair_moments(panel.rows, 2000)
    assert moved.agg({"n": "min"}).first()[0] == 400
