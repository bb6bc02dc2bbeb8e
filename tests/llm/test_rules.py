import re
from collections import Counter

import pytest
from compare import connect, differences

from tidemark.llm import queries, rules

TEXTS = [
    None,
    "",
    " \n\t ",
    "one two three",
    "a b c a b c",
    "the same line\nthe same line\n\nother",
    "x " * 60,
    "the cat and the dog of my aunt sat on it " * 3 + " ".join(f"w{i}" for i in range(80)),
    "###$$$ " * 55,
    "é" * 300_000 + " " + " ".join(f"word{i} the" for i in range(30_000)),
    "\x0bone\x0c two three  four five",
    "the same line\nthe same line\n\nother",
]


def by_hand(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n, rep = len(words), len(covered)
    return {
        "n_words": n,
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": rep,
        "base_failed": n < 50 or 100 * rep > 50 * n,
    }


def test_counts_equal_brute_force(spark):
    rows = [(i, t, "clash", True) for i, t in enumerate(TEXTS)] + [(None, "a b c d", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words string, kept boolean")
    for row in rules.judge(docs).collect():
        text = TEXTS[row.doc_id] if row.doc_id is not None else "a b c d"
        expected = by_hand(text)
        assert {k: row[k] for k in expected} == expected
        assert row.kept is (not row.base_failed and not row.failed_rules)
    kept = rules.passing(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rules.judge(docs).filter("kept").collect()} >= {7}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert rules.judge(docs).count() == 0
    assert rules.passing(docs).count() == 0


def test_no_python_and_no_shuffle(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = rules.judge(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Exchange", plan)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, sf_dir, name):
    rows, problems = differences(queries.QUERIES[name](spark, sf_dir), connect(sf_dir), queries.SQL[name])
    assert not problems, problems
    assert rows > 0
