import re

import pytest

from tidemark.llm import pareto


def targets_by_hand(sizes, weights=(1, 2, 3), most=3):
    """Share, cap, share the excess again, until no target is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    capped, total = set(), sum(sizes.values())
    while True:
        open_ = [s for s in order if s not in capped]
        rest = total - sum(most * sizes[s] for s in capped)
        found = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if found[s] > most * sizes[s]}
        if not over:
            return {s: found.get(s, most * sizes[s]) for s in order}
        capped |= over


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size string")


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1, "c": 2}, {"a": 1000, "B": 3, "c": 5, None: 1, "é": 400}, {"x": 7}])
def test_targets(spark, sizes):
    rows = [(i, "w " * n, s, "clash") for i, (s, n) in enumerate(sizes.items())]
    found = {rows[r.doc_id][2]: r.target for r in pareto.mix(docs_of(spark, rows)).collect()}
    expected = targets_by_hand(sizes)
    assert found == pytest.approx(expected)


def test_mix(spark):
    rows = [(i, "w " * (1 + i * 7919 % 97), ("hot", "hot", "b", "c", None)[i % 5], "x") for i in range(3000)]
    rows += [(5, rows[5][1], rows[5][2], "x"), (None, "a b c", "b", None), (9001, None, "c", None), (9002, "", None, "")]
    rows += [(9003, "long " * 20_000, "b", "")]
    docs = docs_of(spark, rows)
    found = pareto.mix(docs).collect()
    assert len(found) == len(rows)
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _, _ in rows}
    source = {i: s for i, _, s, _ in rows}
    taken, goal = {}, {}
    for r in found:
        assert r.size == size[r.doc_id] and r.taken == r.copies * r.size and 0 <= r.copies <= 3
        taken[source[r.doc_id]] = taken.get(source[r.doc_id], 0) + r.taken
        goal[source[r.doc_id]] = r.target
    for s in goal:
        assert abs(taken[s] - goal[s]) <= 100
    again = pareto.mix(docs.repartition(7)).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.copies)
    assert sorted(map(tuple, found), key=str) == sorted(map(tuple, again), key=str)
    assert sorted(found, key=key) == sorted(again, key=key)


def test_empty(spark):
    assert pareto.mix(docs_of(spark, [])).count() == 0
    nothing = pareto.mix(docs_of(spark, [(1, None, "a", ""), (2, "", None, "")])).collect()
    assert [(r.size, r.source_size, r.target, r.taken) for r in nothing] == [(0, 0, 0.0, 0)] * 2


@pytest.mark.parametrize("same", [7, None])
def test_repeated_rows(spark, same):
    """300 rows of one id, or of none, are 300 choices: the words taken come within one document of the target."""
    rows = [(same, "w " * (10 if i % 2 else 11), "a", f"{i}") for i in range(300)]
    rows += [(1000 + i, "w " * 20, s, "") for i in range(200) for s in ("b", "c")]
    docs = docs_of(spark, rows)
    found = pareto.mix(docs).collect()
    assert len(found) == len(rows)
    for source in "abc":
        mine = [r for r in found if r.source == source]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 20
    key = lambda r: str(tuple(r))
    assert sorted(found, key=key) == sorted(pareto.mix(docs.repartition(5)).collect(), key=key)
    mixed = sorted(map(str, pareto.mixed(docs).collect()))
    assert sum(len(r.text.split()) for r in pareto.mixed(docs).collect()) == sum(r.taken for r in found)
    assert mixed == sorted(map(str, pareto.mixed(docs.repartition(5)).collect()))


def test_one_by_one(spark):
    groups = spark.createDataFrame([(None, 1), ("x", 7), ("y", 3)], "k string, rows long")
    found = sorted((r.k or "", r.number) for r in pareto.one_by_one(groups, run=3).collect())
    assert found == [("", 0)] + [("x", i) for i in range(7)] + [("y", i) for i in range(3)]


def test_equal_rows_by_sql(spark, tmp_path):
    """Repeated rows, null ids and null sources against the SQL."""
    import duckdb

    from tidemark.llm.pareto_sql import mix_sql

    rows = [(i % 40 if i % 3 else None, "w " * (1 + i % 7), ("a", "b", None)[i % 17 % 3], "") for i in range(2000)]
    docs = docs_of(spark, rows)
    docs.write.parquet(str(tmp_path / "documents"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
    found = [tuple(r) for r in pareto.mix(docs).collect()]
    expected = con.execute(mix_sql()).fetchall()
    key = lambda r: str((r[0], r[1], r[6], r[7]))
    assert len(found) == len(expected)
    for a, b in zip(sorted(found, key=key), sorted(expected, key=key)):
        assert a == pytest.approx(b) if None not in a else str(a) == str(b)


def test_mixed_names(spark):
    docs = docs_of(spark, [(1, "a b c", "s", "x"), (1, "a b c", "s", "y"), (2, "d", "t", "z")])
    docs = docs.withColumnRenamed("size", "a.b").selectExpr("*", "1 as copies", "2 as number", "3 as c0", "4 as ord")
    assert pareto.mixed(docs).columns == docs.columns
    assert pareto.mixed(docs).count() > 0
