import numpy as np
import pandas as pd
import pytest
from pandas.testing import assert_frame_equal
from panels import days, panel_of, prices, to_wide

from tidemark.operators import blocks as kernels
from tidemark.operators import returns
from tidemark.operators.returns import (
    latest_by_symbol,
    latest_zscore,
    log_returns,
    rolling_zscore,
    scaler_params,
)


@pytest.fixture(params=[None, "small"])
def blocks(request, monkeypatch):
    if request.param:
        monkeypatch.setattr(returns, "block_length", lambda width, reach: max(5, reach))
        monkeypatch.setattr(kernels, "block_length", lambda width, reach: max(5, reach))


def reference_z(wide, window, eps=1e-9):
    mean = wide.rolling(window).mean()
    sd = wide.rolling(window).std(ddof=0)
    return (wide - mean) / sd.mask(sd < 1e-14, eps)


def test_value_of_a_return(spark):
    wide = pd.DataFrame({"A": [100.0, 110.0]}, index=days(2))
    assert to_wide(log_returns(panel_of(spark, wide))).iloc[0, 0] == pytest.approx(np.log(1.1))


def test_returns_lose_the_first_row_only(spark, blocks):
    wide = prices(40, ["A", "B", "C"])
    expected = np.log(wide / wide.shift(1)).dropna()
    assert_frame_equal(to_wide(log_returns(panel_of(spark, wide))), expected, check_freq=False)


def test_a_missing_price_costs_two_rows(spark, blocks):
    wide = prices(20, ["A", "B"])
    wide.iloc[7, 1] = np.nan
    found = to_wide(log_returns(panel_of(spark, wide)))
    assert len(found) == 17 and wide.index[7] not in found.index and wide.index[8] not in found.index


def test_zero_and_negative_prices_have_no_return(spark):
    wide = pd.DataFrame({"A": [1.0, 0.0, 2.0, -1.0, -2.0, 4.0]}, index=days(6))
    found = to_wide(log_returns(panel_of(spark, wide), complete_case=False))
    assert found["A"].notna().tolist() == [False, False, False, False, True, False]


def test_strict_needs_two_rows(spark):
    with pytest.raises(ValueError):
        log_returns(panel_of(spark, prices(1, ["A"])), strict=True)


def test_rolling_zscore(spark, blocks):
    wide = prices(100, ["A", "B", "C"]).pct_change().fillna(0.0)
    panel = panel_of(spark, wide)
    found = to_wide(rolling_zscore(panel, window=60))
    assert found.iloc[:59].isna().all().all() and found.iloc[59:].notna().all().all()
    assert_frame_equal(found, reference_z(wide, 60), check_freq=False, rtol=1e-8)
    full = to_wide(rolling_zscore(panel, window=60, drop_partial=True))
    assert_frame_equal(full, found.iloc[59:], check_freq=False)
    newest = {r.symbol: r.value for r in latest_zscore(panel, window=60, eps=1e-9).collect()}
    assert newest == pytest.approx(found.iloc[-1].to_dict())


def test_constant_series_uses_the_guard(spark):
    wide = pd.DataFrame({"A": [0.1] * 10}, index=days(10))
    found = to_wide(rolling_zscore(panel_of(spark, wide), window=4))
    assert (found["A"].iloc[3:].abs() < 1e-6).all()


def test_short_panels_give_nothing(spark):
    panel = panel_of(spark, prices(40, ["A", "B"]))
    assert to_wide(rolling_zscore(panel, window=60)).isna().all().all()
    assert rolling_zscore(panel, window=60, drop_partial=True).rows.count() == 0
    assert latest_zscore(panel, window=60).count() == 0
    assert {(r.mean, r.scale) for r in scaler_params(panel).collect()} == {(0.0, 1.0)}
    with pytest.raises(ValueError):
        rolling_zscore(panel, window=60, strict=True)
    with pytest.raises(ValueError):
        rolling_zscore(panel, window=1)


def test_scaler_is_the_last_window(spark):
    wide = prices(100, ["A", "B"])
    found = scaler_params(panel_of(spark, wide)).toPandas().set_index("symbol")
    last = wide.iloc[-60:]
    assert found["mean"].to_dict() == pytest.approx(last.mean().to_dict())
    assert found["scale"].to_dict() == pytest.approx(last.std(ddof=0).to_dict())


def test_newest_row(spark):
    wide = prices(9, ["A", "B"])
    found = {r.symbol: r.value for r in latest_by_symbol(panel_of(spark, wide)).collect()}
    assert found == pytest.approx(wide.iloc[-1].to_dict())


def test_latest_rows_are_read_by_time(spark):
    wide = pd.DataFrame(np.arange(400.0).reshape(200, 2) + 1, index=days(200), columns=["A", "B"])
    panel = panel_of(spark, wide).stored()
    last = panel.last_rows(5)
    assert sorted(r.values[0] for r in last.collect()) == [391.0, 393.0, 395.0, 397.0, 399.0]
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in plan
    assert panel.with_rows(panel.rows.limit(0)).last_rows(5).count() == 0
