import math

import numpy as np
import pytest

from tidemark.llm import mih


def brute(rows, every=20, k=20):
    usable = [(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    usable = sorted(set(usable))
    out = {}
    for q, v in usable:
        if q % every == 0:
            scores = []
            for i, w in usable:
                if i != q and len(w) == len(v):
                    total = 0.0
                    for a, b in zip(w, v):
                        total += a * b
                    scores.append((-total, i))
            out[q] = [(r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return out


def found(frame):
    out = {}
    for r in frame.collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return {q: sorted(x) for q, x in out.items()}


def test_ball_is_exact():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 1 << 16, (500, 4)).astype(np.uint16)
    index = mih.MultiIndex(codes)
    for enough in (1, 7, 100, 499, 500, 900):
        code = codes[3] ^ np.array([1, 0, 7, 0], np.uint16)
        distance = np.array([sum(bin(int(a) ^ int(b)).count("1") for a, b in zip(c, code)) for c in codes])
        radius = np.sort(distance)[min(enough, 500) - 1]
        assert sorted(index.ball(code, enough)) == np.flatnonzero(distance <= radius).tolist()


def test_only_buckets_of_the_ball_are_looked_up(monkeypatch):
    rng = np.random.default_rng(3)
    # a cluster around one code, all others far from it in every substring
    centre = rng.integers(0, 1 << 16, 16).astype(np.uint16)
    cluster = np.repeat(centre[None], 40, 0) ^ (np.arange(40)[:, None] == np.arange(16)).astype(np.uint16)
    far = ~centre ^ (1 << rng.integers(0, 16, (2000, 16))).astype(np.uint16)
    index = mih.MultiIndex(np.concatenate([far, cluster]))
    probe, touched = index.probe, set()

    def seen(*args):
        rows = probe(*args)
        touched.update(rows.tolist())
        return rows

    monkeypatch.setattr(index, "probe", seen)
    assert index.ball(centre, 40).tolist() == list(range(2000, 2040))
    assert touched == set(range(2000, 2040))


def test_small_table_is_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist(), i % 3) for i in range(300)]
    rows += [(1000 + i, rows[7][1], 0) for i in range(60)]  # one vector, many ids, some of them queries
    rows += [(400, None, 0), (420, [0.0] * 8, 0), (440, [1.0, None] * 4, 0), (460, [float("nan")] * 8, 0), (480, [float("inf")] * 8, 0)]
    rows += [(None, rows[3][1], 0), (20, rows[20][1], 0), (500, [3.0, 4.0], 0), (501, [1.0, 2.0], 0), (520, [], 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    exact = brute([(i, v and [None if x is None else float(np.float32(x)) for x in v]) for i, v, _ in rows])
    exact = {q: x for q, x in exact.items() if x}
    # one block, then blocks of rows and of queries
    for options in ({}, {"block_rows": 50, "block_queries": 3}):
        got = found(mih.nearest(table, enough=10_000, **options))
        assert got.keys() == exact.keys()
        for q in exact:
            assert [x[:2] for x in got[q]] == [x[:2] for x in exact[q]]
            assert [x[2] for x in got[q]] == pytest.approx([x[2] for x in exact[q]], abs=0)
    assert mih.nearest(table.limit(0)).count() == 0


def test_recall(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    exact = brute([(r.vec_id, list(map(float, r.embedding))) for r in rows.collect()], every=400)
    got = found(mih.nearest(rows, every=400))
    hits = [len({i for _, i, _ in got[q]} & {i for _, i, _ in exact[q]}) / len(exact[q]) for q in exact]
    assert np.mean(hits) >= 0.9
