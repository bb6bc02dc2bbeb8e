"""Run a query and its SQL on the same files and compare the rows."""

from __future__ import annotations

import datetime as dt
import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events"
    " documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        file = Path(sf_dir) / f"{name}.parquet"
        if file.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{file}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def _rows(columns: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(frame, con: duckdb.DuckDBPyConnection, sql: str) -> tuple[int, list[str]]:
    """(rows, problems); no problems means both results are the same."""
    found = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    wanted = _rows(names, cursor.fetchall())
    problems = []
    if sorted(frame.columns) != sorted(names):
        problems.append(f"columns {sorted(frame.columns)} vs {sorted(names)}")
    if len(found) != len(wanted):
        problems.append(f"{len(found)} rows vs {len(wanted)}")
    bad = [(a, b) for a, b in zip(found, wanted) if a != b]
    if bad:
        problems.append(f"{len(bad)} rows differ, first {bad[0][0]} vs {bad[0][1]}")
    return len(found), problems
