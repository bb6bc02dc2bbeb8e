import json
from datetime import datetime

import pytest

from tidemark.functions import (
    NARROW_CUTOFFS,
    clean_text,
    epoch_to_timestamp,
    finite_or_null,
    lag_ms,
    log_ratio,
    parse_iso,
    parse_iso_optional,
    run_label,
    run_stamp,
)
from tidemark.sources import decode_array_feed, decode_object_feed, parse_bar_log

WHEN = datetime(2026, 4, 5, 10, 0, 1, 250_000)
MS = 1775383201250


def messages(spark, *payloads):
    rows = [(i, p if isinstance(p, str) else json.dumps(p)) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, "seq long, message string")


def test_object_feed(spark):
    df = messages(
        spark,
        {"symbol": "A", "price": 1.5, "size": 3, "timestamp": "2026-04-05T10:00:01.250Z"},
        {"s": " A ", "p": "2.5", "t": MS},
        {"symbol": "", "s": "A", "price": "3", "size": "many", "t": MS // 1000},
        {"symbol": "A", "p": 4, "size": None, "timestamp": "2026-04-05T15:30:01.250+05:30"},
        {"symbol": "Z", "price": 1, "t": MS},
        {"symbol": "A", "t": MS},
        {"symbol": "A", "price": "n/a", "t": MS},
        {"symbol": "A", "price": "NaN", "t": MS},
        {"symbol": "A", "price": 1, "t": "yesterday"},
        {"status": "Error", "message": "no"},
        {"status": "ok", "symbol": "A", "price": 5, "timestamp": 0, "t": MS * 1000},
        "not json",
    )
    ticks, rejects, errors = decode_object_feed(df, ["A", "B"])
    found = {r.seq: r for r in ticks.collect()}
    assert set(found) == {0, 1, 2, 3, 10} - {10} | {10}
    assert [found[i].price for i in range(4)] == [1.5, 2.5, 3.0, 4.0]
    assert [found[i].size for i in range(4)] == [3.0, 0.0, 0.0, 0.0]
    assert [found[i].ts for i in (0, 1, 3)] == [WHEN] * 3
    assert found[2].ts == WHEN.replace(microsecond=0)
    assert {r.seq: r.reason for r in rejects.collect()} == {5: "price", 6: "price", 7: "price", 8: "time", 11: "message"}
    assert [(r.seq, r.kind) for r in errors.collect()] == [(9, "protocol_error")]


def test_array_feed(spark):
    trade = {"ev": "T", "sym": "A", "p": 1.5, "s": 2, "t": MS}
    df = messages(
        spark,
        [trade, {"ev": "Q", "sym": "A"}, {**trade, "p": 2.5, "t": MS * 1_000_000}],
        trade,
        [{"ev": "status", "status": "connected"}, {**trade, "sym": "Z"}, {**trade, "p": None}],
        {"ev": "status", "status": "auth_failed", "message": "bad key"},
        [],
    )
    ticks, rejects, errors = decode_array_feed(df, ["A"])
    found = ticks.orderBy("seq", "pos").collect()
    assert [(r.seq, r.price, r.ts) for r in found] == [(0, 1.5, WHEN), (0, 2.5, WHEN), (1, 1.5, WHEN)]
    assert rejects.count() == 1
    assert [r.message for r in errors.collect()] == ["bad key"]


def test_epoch_units(spark):
    df = spark.createDataFrame([(str(MS * 10**k),) for k in (0, 3, 6)] + [("1775383201",), ("x",)], "v string")
    wide = [r[0] for r in df.select(epoch_to_timestamp(df.v)).collect()]
    assert wide == [WHEN] * 3 + [WHEN.replace(microsecond=0), None]
    narrow = [r[0] for r in df.select(epoch_to_timestamp(df.v, NARROW_CUTOFFS)).collect()]
    assert narrow[0].year == 1970 and narrow[3].year == 2026


def test_iso_times(spark):
    texts = ["2026-04-05T10:00:01.250Z", "2026-04-05T15:30:01.250+05:30", "2026-04-05T10:00:01.250"]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    assert [r[0] for r in df.select(parse_iso(df.v)).collect()] == [WHEN] * 3
    bad = spark.createDataFrame([("soon",), (None,)], "v string")
    assert [r[0] for r in bad.select(parse_iso_optional(bad.v)).collect()] == [None, None]
    with pytest.raises(Exception):
        bad.select(parse_iso(bad.v)).collect()


def test_small_functions(spark):
    df = spark.createDataFrame([(WHEN, " a ", float("nan"), 2.0, -1.0)], "t timestamp, s string, n double, a double, b double")
    row = df.select(
        run_stamp(df.t), run_label(run_stamp(df.t)), run_label(df.s), clean_text(df.s),
        finite_or_null(df.n), log_ratio(df.a, df.b), log_ratio(df.a, df.a), lag_ms(df.t, df.t),
    ).first()
    assert list(row) == [
        "20260405_100001", "2026-04-05  10:00:01 UTC", " a ", "a", None, None, 0.0, 0.0,
    ]


def test_text_bars(spark):
    good = ("A", "2026-04-05T10:00:00Z", "2026-04-05T10:01:00Z", "1", "2", "3", "4", "5.9", "f", 1)
    rows = [good, (" A ", *good[1:9], 2), ("Z", *good[1:9], 3), ("A", None, *good[2:9], 4),
            ("A", "soon", *good[2:9], 5), (*good[:6], "1.x", *good[7:9], 6)]
    df = spark.createDataFrame(
        rows, "symbol string, bar_start string, bar_end string, open string, high string, low string,"
        " close string, volume string, source string, seq long"
    )
    bars, bad = parse_bar_log(df, ["A"])
    found = bars.orderBy("seq").collect()
    assert [r.seq for r in found] == [1, 2] and found[0].volume == 5 and found[1].symbol == "A"
    assert sorted(r.seq for r in bad.collect()) == [4, 5, 6]


def test_every_message_is_a_tick_a_reject_or_an_error(spark):
    texts = [
        '{"symbol": "A", "price": 1.5, "timestamp": 1775383200}',
        '{"symbol": "A", "price": 1.5, "timestamp": "T12:30"}',
        '{"symbol": "A", "price": "x", "timestamp": 1775383200}',
        '{"status": "error"}',
        '{"symbol": "A", "pri',
        "no json",
        "[1]",
        None,
    ]
    messages = spark.createDataFrame(list(enumerate(texts)), "seq long, message string")
    ticks, rejects, errors = decode_object_feed(messages, ["A"])
    assert [r.seq for r in ticks.collect()] == [0]
    assert {r.seq: r.reason for r in rejects.collect()} == {1: "time", 2: "price", 4: "message", 5: "message", 6: "message", 7: "message"}
    assert [r.seq for r in errors.collect()] == [3]

    texts = [
        '[{"ev": "T", "sym": "A", "p": 1, "s": 2, "t": 1775383200000}, {"ev": "T", "sym": "A", "p": 1, "t": "20260101"}]',
        '[{"ev": "T", "sym": "A", "p": 1, "s": 2, "t": 1775383200000}, {"ev"',
        "broken",
        None,
        "[]",
    ]
    messages = spark.createDataFrame(list(enumerate(texts)), "seq long, message string")
    ticks, rejects, errors = decode_array_feed(messages, ["A"])
    assert sorted(r.ts.isoformat()[:10] for r in ticks.collect()) == ["2026-01-01", "2026-04-05"]
    assert sorted((r.seq, r.reason) for r in rejects.collect()) == [(1, "message"), (2, "message"), (3, "message")]
    assert errors.count() == 0
