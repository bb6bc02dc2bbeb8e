import numpy as np
import pandas as pd
import pytest
from panels import days, panel_of, prices, tidy_to_wide

from tidemark.operators import blocks as kernels
from tidemark.operators import factors
from tidemark.operators.correlation import correlation, correlation_outliers
from tidemark.operators.factors import (
    explained_variance,
    residual_zscore,
    rolling_covariance,
    rolling_pca,
)

SYMBOLS = ["A", "B", "C", "D"]


@pytest.fixture(params=[None, "small"])
def blocks(request, monkeypatch):
    if request.param:
        monkeypatch.setattr(kernels, "block_length", lambda width, reach: max(7, reach))
        monkeypatch.setattr(factors, "_CHUNK_BYTES", 2048)


@pytest.fixture
def wide():
    rng = np.random.default_rng(5)
    common = rng.normal(0, 1, (80, 1))
    noise = rng.normal(0, 0.5, (80, 4))
    return pd.DataFrame(common * [1.0, 0.8, -0.5, 0.2] + noise, index=days(80), columns=SYMBOLS)


def square(found):
    return {(r.symbol_a, r.symbol_b): r.correlation for r in found.collect()}


def test_correlation(spark, wide):
    expected = wide.corr()
    found = square(correlation(panel_of(spark, wide), full=True))
    assert len(found) == 16
    for (a, b), r in found.items():
        assert r == pytest.approx(expected.loc[a, b], abs=1e-12)


def test_correlation_with_missing_values(spark, wide):
    wide.iloc[3:20, 1] = np.nan
    wide.iloc[15:40, 2] = np.nan
    panel = panel_of(spark, wide)
    for (a, b), r in square(correlation(panel, deletion="pairwise")).items():
        assert r == pytest.approx(wide.corr().loc[a, b], abs=1e-12)
    for (a, b), r in square(correlation(panel)).items():
        assert r == pytest.approx(wide.dropna().corr().loc[a, b], abs=1e-12)


def test_correlation_pools_tasks_with_large_means(spark, wide):
    shifted = wide + 1e6
    panel = panel_of(spark, shifted)
    spread = panel.with_rows(panel.rows.repartition(6))
    for (a, b), r in square(correlation(spread)).items():
        assert r == pytest.approx(wide.corr().loc[a, b], abs=1e-8)


def test_constant_series_has_no_correlation(spark, wide):
    wide["A"] = 1.0
    found = square(correlation(panel_of(spark, wide)))
    assert found[("A", "B")] is None and found[("B", "C")] is not None
    assert correlation_outliers(correlation(panel_of(spark, wide)), low_threshold=2.0).count() == 3


def test_outliers_are_ordered(spark, wide):
    panel = panel_of(spark, wide)
    found = [r.correlation for r in correlation_outliers(correlation(panel), low_threshold=1.1).collect()]
    assert found == sorted(found) and len(found) == 6
    same = pd.DataFrame({s: wide["A"] for s in SYMBOLS})
    assert correlation_outliers(correlation(panel_of(spark, same))).count() == 0


def test_one_symbol_has_no_correlation(spark):
    with pytest.raises(ValueError):
        correlation(panel_of(spark, prices(5, ["A"])))


def test_rolling_covariance(spark, wide, blocks):
    found = rolling_covariance(panel_of(spark, wide), window=10).toPandas()
    assert len(found) == 71 * 10
    for _, row in found.sample(40, random_state=1).iterrows():
        frame = wide.loc[: row["ts"]].iloc[-10:]
        expected = frame.cov().loc[row["symbol_i"], row["symbol_j"]]
        assert row["cov"] == pytest.approx(expected, abs=1e-12)


@pytest.mark.parametrize("k", [1, 2, 9])
def test_rolling_pca(spark, wide, blocks, k):
    found = rolling_pca(panel_of(spark, wide), window=20, k=k)
    beta = tidy_to_wide(found, "beta", SYMBOLS)
    alpha = tidy_to_wide(found, "alpha", SYMBOLS)
    assert len(beta) == 80 and beta.iloc[:19].isna().all().all()
    for i in range(19, 80):
        frame = wide.to_numpy()[i - 19 : i + 1]
        mean = frame.mean(axis=0)
        _, _, rows = np.linalg.svd(frame - mean, full_matrices=False)
        top = rows[:k]
        expected = (frame[-1] - mean) @ top.T @ top + mean
        assert np.allclose(beta.iloc[i], expected, atol=1e-10)
    assert np.allclose((alpha + beta).iloc[19:], wide.iloc[19:])


def test_pca_of_frames_with_holes(spark, wide, blocks):
    wide.iloc[40, 2] = np.nan
    beta = tidy_to_wide(rolling_pca(panel_of(spark, wide), window=20), "beta", SYMBOLS)
    holes = beta.isna().all(axis=1)
    assert holes.iloc[:19].all() and holes.iloc[40:60].all() and not holes.iloc[60:].any()


def test_explained_variance(spark, wide):
    found = explained_variance(panel_of(spark, wide), window=30, n_components=4).toPandas()
    values = np.linalg.eigvalsh(np.cov(wide.iloc[-30:].to_numpy().T))[::-1]
    assert list(found["component"]) == ["PC1", "PC2", "PC3", "PC4"]
    assert np.allclose(found["explained_variance_ratio"], values / values.sum())
    assert found["cumulative"].iloc[-1] == pytest.approx(1.0)
    short = explained_variance(panel_of(spark, wide), window=90, n_components=2).toPandas()
    assert len(short) == 2 and short["explained_variance_ratio"].isna().all()
    flat = panel_of(spark, wide * 0 + 1)
    assert explained_variance(flat, window=30).toPandas()["explained_variance_ratio"].tolist() == [0.0]


def reference_residual(segment, k):
    train, current = segment[:-1], segment[-1]
    mean = train.mean(axis=0)
    _, _, rows = np.linalg.svd(train - mean, full_matrices=False)
    project = rows[:k].T @ rows[:k]
    res = (train - mean) - (train - mean) @ project
    now = (current - mean) - (current - mean) @ project
    return (now - res.mean(axis=0)) / res.std(axis=0)


@pytest.mark.parametrize("factors_kept", [1, 2])
def test_residual_zscore(spark, wide, blocks, factors_kept):
    panel = panel_of(spark, wide)
    every = tidy_to_wide(
        residual_zscore(panel, window=30, factors=factors_kept, latest_only=False), "value", SYMBOLS
    )
    assert len(every) == 51
    for i in range(29, 80):
        expected = reference_residual(wide.to_numpy()[i - 29 : i + 1], factors_kept)
        assert np.allclose(every.iloc[i - 29], expected, atol=1e-9)
    last = tidy_to_wide(residual_zscore(panel, window=30, factors=factors_kept), "value", SYMBOLS)
    assert np.allclose(last.iloc[0], every.iloc[-1]) and len(last) == 1


def test_arguments(spark, wide):
    panel = panel_of(spark, wide)
    for call in (
        lambda: rolling_pca(panel, k=0),
        lambda: rolling_pca(panel, window=1),
        lambda: rolling_covariance(panel, window=1),
        lambda: residual_zscore(panel, window=2),
        lambda: residual_zscore(panel, window=100, strict=True),
        lambda: explained_variance(panel, n_components=0),
    ):
        with pytest.raises(ValueError):
            call()
    assert residual_zscore(panel, window=100).count() == 0
