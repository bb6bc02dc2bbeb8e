import numpy as np
import pandas as pd
import pytest
from pandas.testing import assert_frame_equal
from panels import days, long_frame, panel_of, prices, to_wide

from tidemark.operators import cleaning, ordinals
from tidemark.operators.cleaning import fill_gaps, missing_fraction, replace_zombies
from tidemark.operators.shape import complete_case, open_periods, panel_stats, transpose
from tidemark.panel import densify

PRIMARY = [f"T{i}" for i in range(30)]
RESERVE = [f"R{i}" for i in range(5)]


@pytest.fixture
def small_blocks(monkeypatch):
    """Blocks of a few rows, so that carries and halos cross many of them."""
    monkeypatch.setattr(cleaning, "block_length", lambda width, reach: max(3, reach))


def clean(spark, wide, **options):
    return replace_zombies(panel_of(spark, wide), PRIMARY, RESERVE, **options)


def test_healthy_universe_is_kept(spark):
    panel, made = clean(spark, prices(100, PRIMARY + RESERVE))
    assert list(panel.symbols) == PRIMARY and made.count() == 0


def test_exactly_at_the_threshold_is_kept(spark):
    wide = prices(100, PRIMARY + RESERVE)
    wide.iloc[:5, 0] = np.nan
    panel, _ = clean(spark, wide)
    assert panel.symbols[0] == "T0"


def test_above_the_threshold_is_replaced_in_place(spark):
    wide = prices(100, PRIMARY + RESERVE)
    wide.iloc[:6, 0] = np.nan
    wide.iloc[:10, 7] = np.nan
    wide.iloc[:10, 3] = np.nan
    panel, made = clean(spark, wide)
    assert len(panel.symbols) == 30
    assert [panel.symbols[i] for i in (0, 3, 7)] == ["R0", "R1", "R2"]
    assert {(r.dropped, r.replaced_with) for r in made.collect()} == {
        ("T0", "R0"),
        ("T3", "R1"),
        ("T7", "R2"),
    }
    assert_frame_equal(
        to_wide(panel)[["R0", "T1"]], wide[["R0", "T1"]], check_freq=False, check_exact=False
    )


def test_a_reserve_that_is_a_primary_is_skipped(spark):
    wide = prices(40, ["A", "B", "C"])
    wide.iloc[:10, 0] = np.nan
    panel, _ = replace_zombies(panel_of(spark, wide), ["A", "B"], ["B", "C"])
    assert panel.symbols == ("C", "B")


def test_reserve_health_is_checked_on_request_only(spark):
    wide = prices(40, ["A", "B", "R", "S"])
    wide.iloc[:10, 0] = np.nan
    wide.iloc[:20, 2] = np.nan
    plain, _ = replace_zombies(panel_of(spark, wide), ["A", "B"], ["R", "S"])
    healthy, _ = replace_zombies(
        panel_of(spark, wide), ["A", "B"], ["R", "S"], require_healthy=True
    )
    assert plain.symbols == ("R", "B") and healthy.symbols == ("S", "B")


def test_reserves_can_run_out(spark):
    wide = prices(100, PRIMARY + RESERVE)
    wide.iloc[:20, :6] = np.nan
    with pytest.raises(ValueError):
        clean(spark, wide)


def test_time_must_be_a_time(spark):
    df = spark.createDataFrame([("A", 1, 1.0)], "symbol string, ts int, price double")
    with pytest.raises(TypeError):
        densify(df, ["A"])


def test_missing_shares(spark):
    wide = prices(10, ["A", "B"])
    wide.iloc[:3, 1] = np.nan
    found = {r.symbol: r.missing_frac for r in missing_fraction(panel_of(spark, wide)).collect()}
    assert found == {"A": 0.0, "B": pytest.approx(0.3)}


def test_densify_adds_absent_cells_and_drops_strangers(spark):
    rows = spark.createDataFrame(
        [("A", "2025-01-02", 2.0, 2), ("A", "2025-01-02", 1.0, 1), ("B", "2025-01-01", float("inf"), 1),
         ("Z", "2025-01-05", 1.0, 1)],
        "symbol string, d string, price double, seq int",
    ).selectExpr("symbol", "timestamp(d) as ts", "price", "seq")
    wide = to_wide(densify(rows, ["B", "A", "C", "A"], order="seq"))
    assert list(wide.columns) == ["B", "A", "C"]
    assert np.array_equal(wide.to_numpy(), [[np.nan] * 3, [np.nan, 2.0, np.nan]], equal_nan=True)


def reference_fill(wide, limit=2, direction="both"):
    open_rows = wide.notna().any(axis=1)
    out = wide.copy()
    out.loc[open_rows] = wide.loc[open_rows].interpolate(
        method="linear", limit=limit, limit_direction=direction
    )
    return out


@pytest.mark.parametrize("direction", ["both", "forward"])
def test_gap_lengths(spark, direction, small_blocks):
    wide = pd.DataFrame(index=days(30), columns=list("ABCDEF"), dtype=float)
    wide[:] = np.arange(1.0, 181.0).reshape(30, 6) ** 1.5
    wide.iloc[5:7, 0] = np.nan
    wide.iloc[5:9, 1] = np.nan
    wide.iloc[5:10, 2] = np.nan
    wide.iloc[5:12, 3] = np.nan
    wide.iloc[:3, 4] = np.nan
    wide.iloc[-3:, 4] = np.nan
    wide.iloc[:, 5] = np.nan
    wide.iloc[20, :] = np.nan
    found = to_wide(fill_gaps(panel_of(spark, wide), direction=direction))
    assert_frame_equal(found, reference_fill(wide, direction=direction), check_freq=False)
    if direction == "both":
        assert found.iloc[5:9, 1].notna().all()
        assert found.iloc[5:10, 2].isna().sum() == 1
        assert found.iloc[5:12, 3].isna().sum() == 3
        assert found.iloc[:3, 4].isna().tolist() == [True, False, False]


@pytest.mark.parametrize("seed", [3, 4])
def test_random_gaps_over_many_blocks(spark, seed, small_blocks):
    rng = np.random.default_rng(seed)
    wide = prices(120, list("ABCD"), seed)
    wide = wide.mask(rng.random(wide.shape) < 0.6)
    wide.iloc[30:60, 1] = np.nan
    found = to_wide(fill_gaps(panel_of(spark, wide), limit=3))
    assert_frame_equal(found, reference_fill(wide, limit=3), check_freq=False)


def test_shape_operators(spark):
    wide = prices(6, ["A", "B"])
    wide.iloc[2, 0] = np.nan
    wide.iloc[4, :] = np.nan
    panel = panel_of(spark, wide)
    assert len(to_wide(complete_case(panel))) == 4
    assert [r.is_open for r in open_periods(panel).orderBy("ts").collect()] == [
        True, True, True, True, False, True,
    ]
    row = panel_stats(panel).first()
    assert (row.row_count, row.column_count, row.start_date) == (6, 2, "2025-01-01")
    assert row.missing_frac == pytest.approx(3 / 12)
    flat = transpose(panel).toPandas()
    assert list(flat["symbol"]) == ["A", "B"]
    assert list(flat.columns[1:]) == [d.strftime("%Y-%m-%d") for d in wide.index]


def test_rows_are_numbered_across_tasks(spark):
    wide = prices(500, ["A"])
    df = long_frame(spark, wide).repartition(7)
    panel = densify(df, ["A"])
    assert_frame_equal(to_wide(panel), wide, check_freq=False)


def test_row_numbers_per_key(spark):
    df = spark.range(1000).selectExpr("id * 3 as seq", "if(id % 10 = 0, 'b', 'a') as k")
    found = ordinals.number_rows(df, ["k"], "seq", cell_rows=64).orderBy("k", "seq").collect()
    assert [r.ord for r in found] == [*range(900), *range(100)]
