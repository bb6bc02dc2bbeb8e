"""Registered queries against SQL on the smallest test tables.

QUERY_TESTS=all runs every one of them; the default is a sample of each kind.
"""

import os
from pathlib import Path

import pytest
from compare import connect, differences

import __spark_entry__ as entry

SAMPLE = (
    "price_panel zombie_replacements gap_fill_closed_rows log_returns_all_rows correlation_pairwise"
    " ohlcv_bars late_ticks bars_fixed_point store_freshness backfill_mixed_store"
    " feed_scores p95_rank_all decode_object_feed epoch_units stream_bars_exact stream_counters"
).split()
NAMES = list(entry.oracle_sql()) if os.environ.get("QUERY_TESTS") == "all" else SAMPLE


@pytest.fixture(scope="module")
def con(sf_dir_path):
    return connect(sf_dir_path)


@pytest.fixture(scope="module")
def sf_dir_path():
    from conftest import SF

    if not Path(SF).exists():
        pytest.skip("no test tables")
    return SF


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, sf_dir_path, name):
    frame = entry.queries()[name](spark, sf_dir_path)
    rows, problems = differences(frame, con, entry.oracle_sql()[name])
    assert not problems, problems
    assert rows > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert {"symbol", "ts", "value"} == set(entry.entry(spark).columns)
